"""Filter interaction audit: what each of five filters takes, in every order, from the lattice of their subsets.

A document that a filter meets has passed through the filters applied before it, a subset; a step of an order is an
edge of the lattice from that subset to the subset with the next filter added. There are 80 edges, and they stand
for all 600 steps of the 120 orders. Documents are first counted by what they fail, 32 patterns at most a part and
label, so that the edges are filled from those counts; the orders then look their edges up.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
WORD, SYMBOLS, UPPER = "[^\\x20\\x09-\\x0D]+", "[#$%&*|]", "[A-Z]"

#: (subset already applied, next filter) as bits and number.
EDGES = [(mask, k) for mask in range(1 << len(FILTERS)) for k in range(len(FILTERS)) if not mask >> k & 1]
#: (order, step, subset before it, filter).
STEPS = [("".join(FILTERS[k] for k in order), n + 1, sum(1 << k for k in order[:n]), order[n]) for order in permutations(range(len(FILTERS))) for n in range(len(FILTERS))]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def text_failures(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text with these words fails."""
    upper = F.regexp_count(text, F.lit(UPPER)).cast("long")
    flags = [
        F.size(words) < MIN_WORDS,
        F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * DISTINCT_PERCENT,
        upper * 100 > F.length(text).cast("long") * UPPER_PERCENT,
        text.rlike(SYMBOLS),
    ]
    out = F.lit(0)
    for k, flag in enumerate(flags):
        out = out.bitwiseOR(F.when(flag, 1 << k).otherwise(0))
    return out


def label_values(labels: DataFrame) -> DataFrame:
    """(_key, quality, toxic), a row per doc_id: whether any of its labels says 1."""
    one = lambda name: F.coalesce(F.bool_or(labels[name] == 1), F.lit(False))
    return labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("_key")).agg(one("quality").alias("quality"), one("toxic").alias("toxic"))


def patterns(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, quality, toxic, n): documents of a part by the bits of the filters they fail, E among them.

    A text's copies agree in A to D. So rows are counted by text, id, part and labels, then by text, part and labels
    with the least id, and the least id of the text, over some rows for each text, tells which are first. No key keeps
    the copies of a text together before they are counted.
    """
    doc_id = documents["doc_id"].cast("long")
    text = F.coalesce(documents["text"].cast("string"), F.lit(""))
    texts = documents.select(doc_id.alias("_key"), F.coalesce(documents["lang"].cast("string"), F.lit("")).alias("part"), text.alias("text"))
    # The words are a column of their own, so that they are found once for all filters.
    rows = texts.withColumn("words", words_of(F.col("text"))).select(
        "_key",
        # Rows without an id have no label; they are spread instead of meeting in one partition.
        F.when(F.col("_key").isNull(), F.xxhash64("text") % 1024).otherwise(F.lit(0)).alias("_salt"),
        "part",
        F.sha2("text", 256).alias("digest"),
        text_failures(F.col("text"), F.col("words")).alias("fails"),
    )
    known = label_values(labels).withColumn("_salt", F.lit(0).cast("long"))
    joined = rows.join(known, ["_key", "_salt"], "left").select("_key", "part", "digest", "fails", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic")))
    by_id = joined.groupBy("digest", "_key", "part", "quality", "toxic").agg(F.max("fails").alias("fails"), F.count("*").alias("n"))
    none = F.col("_key").isNull()
    by_text = by_id.groupBy("digest", "part", "quality", "toxic").agg(
        F.max("fails").alias("fails"),
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(none, F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(~none, F.struct("_key", "n"))).alias("least"),
    )
    first = F.min("least._key").over(Window.partitionBy("digest"))
    n_first = F.col("without_id") + F.when(F.col("least._key") == first, F.col("least.n")).otherwise(0)
    told = by_text.withColumn("n_first", n_first)
    split = F.array(F.struct(F.col("fails").alias("fails"), F.col("n_first").alias("n")), F.struct(F.col("fails").bitwiseOR(16).alias("fails"), (F.col("n") - F.col("n_first")).alias("n")))
    return told.select("part", "quality", "toxic", F.explode(split).alias("s")).groupBy("part", "s.fails", "quality", "toxic").agg(F.sum("s.n").alias("n")).where("n > 0")


def edge_counts(counted: DataFrame) -> DataFrame:
    """The six counts of each of the 80 edges (part, mask, k) from ``patterns``; zeros included."""
    edges = F.array(*(F.struct(F.lit(mask).alias("mask"), F.lit(k).alias("k")) for mask, k in EDGES))
    rows = counted.withColumn("e", F.explode(edges)).select("*", "e.mask", "e.k")
    bit = F.expr("shiftleft(1, k)")
    fails, earlier = F.col("fails").bitwiseAND(bit) != 0, F.col("fails").bitwiseAND(F.col("mask")) != 0
    removed = fails & ~earlier
    cases = {
        "kept": ~fails & ~earlier,
        "removed": removed,
        "redundant": fails & earlier,
        "unique_fails": F.col("fails") == bit,
        "good_lost": removed & F.col("quality"),
        "toxic_lost": removed & F.col("toxic"),
    }
    return rows.groupBy("part", "mask", "k").agg(*(F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name) for name, c in cases.items()))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, counts, shapley): 600 rows a part.

    A null text is an empty one, a null lang is the part of the empty string, a document without label has neither.
    Of several labels of a document one that says 1 counts. A null doc_id is not larger than any, so such rows do not
    fail E, and have no label; of repeated rows with the least id all are first. An empty table gives no rows.
    Columns beyond those named are not read.
    """
    edges = edge_counts(patterns(documents, labels))
    applied = F.expr("bit_count(mask)")
    orders = F.element_at(F.array(*(F.lit(factorial(n) * factorial(len(FILTERS) - 1 - n)) for n in range(len(FILTERS)))), applied + 1)
    valued = edges.withColumn("shapley", F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "k")))
    steps = documents.sparkSession.createDataFrame(STEPS, "filter_order string, step int, mask int, k int")
    return valued.join(F.broadcast(steps), ["mask", "k"]).select("part", "filter_order", "step", *COUNTS, "shapley")
