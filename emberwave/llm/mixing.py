"""Mixing sources to target weights.

The sizes of all documents are aggregated by source; the targets share a multiple of their sum by
weight, where a source's target stops at a multiple of its own size and what is cut off goes to the
others by weight. A source's repetition rate is its target over its size. Each document is emitted
floor(rate) times, and once more with the probability of the rate's fraction, drawn from a hash of a
seed and the document, so that a rerun draws the same.

The draws of a source depend on each other, so that its words come near its target: its documents stand in
order of size, in steps of an eighth of a power of two, and of hash, a line of length fraction each behind an offset
drawn for the source. A group of neighbours gets as many copies as whole numbers lie on its stretch, and gives them to
its least hashes. So no stretch of sizes is off by more than one copy, and the words by little more than the largest
document. Only counts of groups are summed along a source, first by size, then within one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwave.llm.common import few, fresh, saved

WEIGHTS = (5, 2, 1)
SHARE_PERCENT, MAX_REPEAT, SEED = 150, 2, 9
#: A group of documents of one source and step of size has some ten thousand hashes, and no source has fewer groups than these.
LEAST_BUCKETS, BUCKET_ROWS = 64, 10_000
#: Rates are broadcast up to this many sources, some tens of bytes each; beyond it both sides shuffle.
BROADCAST_SOURCES = 50_000

WORD = "[^\\x20\\x09-\\x0D]+"


def size_of(text: str | Column = "text") -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text if isinstance(text, Column) else F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from a row per source (source, source_size).

    Sharing the excess again and again ends where the sources with the least room for their weight stand
    at their bound and the others share the rest. Sorted by room for weight, those are a prefix: the
    first for which the rest's share of one weight fits the next source's room.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (at + 1).cast("int")).cast("double")
    room = F.col("source_size").cast("double") * most
    ranked = sizes.withColumn("weight", weight).withColumn("room", room).withColumn("fits", F.col("room") / F.col("weight"))
    by_room = Window.orderBy("fits", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole).cast("double") * (percent / 100)
    shared = ranked.withColumn("full", F.coalesce(F.sum("room").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).withColumn("total", total)
    # The level at which this source and all with more room for their weight share what the others leave.
    shared = shared.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    level = F.min(F.when(F.col("level") <= F.col("fits"), F.struct("fits", "level"))).over(whole)["level"]
    target = F.coalesce(F.least("room", F.col("weight") * level), F.col("room"))
    return shared.select("source", "source_size", target.alias("target"))


def size_step(size: Column) -> Column:
    """Sizes that agree in their four leading bits share a step; steps rise with size."""
    digits = F.length(F.bin(size))
    return (digits * 16 + F.call_function("shiftright", size, F.greatest(digits - 4, F.lit(0)))).cast("long")


def drawn(doc_id: Column, text: Column, seed: int) -> Column:
    """52 bits of a digest of the seed and the document, null as a value of its own."""
    said = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("long")


def cuts(narrow: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """(source, step, bucket, cut): documents of a group get a copy whose hash is at most ``cut``; groups without copies are left out.

    ``narrow``: (source, step, bucket, hash). Equal hashes are counted before they meet, so a group holds each once.
    """
    by_hash = narrow.groupBy("source", "step", "bucket", "hash").agg(F.count("*").alias("n"))
    groups = by_hash.groupBy("source", "step", "bucket").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("hash", "n"))).alias("hashes"))
    groups = saved(groups, "groups")
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda *by: F.coalesce(F.sum("n").over(before(*by)), F.lit(0))
    steps = groups.groupBy("source", "step").agg(F.sum("n").alias("n")).select("source", "step", earlier("source", "step").alias("smaller"))
    steps = steps.withColumnsRenamed({"source": "s_source", "step": "s_step"})
    placed = groups.withColumn("within", earlier("source", "step", "bucket")).join(steps, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("step") == F.col("s_step")))
    known = rates.select(F.col("source").alias("r_source"), (F.col("rate") - F.floor("rate")).alias("part"))
    placed = placed.join(few(known, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("r_source")))
    offset = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("source", F.lit("null")))), 1, 13), 16, 10).cast("long") * F.lit(2.0**-52)
    up_to = lambda n: F.floor(n.cast("double") * F.col("part") + offset)
    first = F.col("smaller") + F.col("within")
    counted = placed.withColumn("k", up_to(first + F.col("n")) - up_to(first)).where("k > 0")
    cut = F.expr("aggregate(hashes, struct(0L AS run, -1L AS cut), (a, x) -> IF(a.run < k, struct(a.run + x.n AS run, x.hash AS cut), a), a -> a.cut)")
    return counted.select("source", "step", "bucket", cut.alias("cut"))


def rated(documents: DataFrame, seed: int = SEED, percent: int = SHARE_PERCENT) -> tuple[DataFrame, list[str]]:
    """``documents`` with four columns more, and their names: size, source_size, target and copies.

    The names are none that ``documents`` has. A null source is a source of its own, the last; a null or
    empty text has size 0, and a source of size 0 has target 0 and is not taken. A repeated row draws what its
    copy draws, as the draw comes from doc_id and text (null as a value of its own). An empty table gives no rows.
    """
    names = fresh(documents, "mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_step", "mix_bucket", "mix_hash", "mix_source", "mix_rate", "mix_cut")
    size, source_size, target, taken, step, bucket, hashed, source, rate, cut = names
    own = documents.select(documents["source"].cast("string").alias("source"), size_of(documents["text"].cast("string")).alias("size"), drawn(documents["doc_id"], documents["text"], seed).alias("hash"))
    own = saved(own, "sizes")
    targets = saved(source_targets(own.groupBy("source").agg(F.sum("size").alias("source_size")), percent=percent), "rates")
    rates = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    buckets = max(LEAST_BUCKETS, -(-own.count() // BUCKET_ROWS))
    keyed = own.withColumn("step", size_step(F.col("size"))).withColumn("bucket", F.col("hash") % buckets)
    chosen = saved(cuts(keyed.select("source", "step", "bucket", "hash"), rates, seed), "cuts").withColumnsRenamed({"source": source, "step": step, "bucket": bucket, "cut": cut})
    sized = documents.withColumns({size: size_of(documents["text"].cast("string")), hashed: drawn(documents["doc_id"], documents["text"], seed)})
    known = rates.select(F.col("source").alias(source), F.col("source_size").alias(source_size), F.col("target").alias(target), F.col("rate").alias(rate))
    joined = sized.join(few(known, BROADCAST_SOURCES), documents["source"].cast("string").eqNullSafe(known[source])).drop(source)
    met = documents["source"].cast("string").eqNullSafe(chosen[source]) & (size_step(F.col(size)) == chosen[step]) & (F.col(hashed) % buckets == chosen[bucket])
    joined = joined.join(few(chosen), met, "left").drop(source, step, bucket)
    copies = F.floor(rate) + F.when(F.col(hashed) <= F.col(cut), 1).otherwise(0)
    return joined.withColumn(taken, copies.cast("long")).drop(hashed, rate, cut), [size, source_size, target, taken]


def mix_report(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken, a row per row of ``documents``.

    Nulls, empty texts, repeated rows and an empty table as in ``rated``.
    """
    found, (size, source_size, target, copies) = rated(documents.select("doc_id", "text", "source"), seed)
    columns = [F.col(size).alias("size"), F.col(source_size).alias("source_size"), F.col(target).alias("target"), (F.col(copies) * F.col(size)).alias("taken")]
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)


def mixed_documents(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """``documents`` with every row as often as the mix takes it; columns stay as they are, whatever their names.

    Nulls, empty texts, repeated rows and an empty table as in ``rated``.
    """
    found, (*_, copies) = rated(documents, seed)
    (copy,) = fresh(found, "mix_copy")
    repeated = found.where(F.col(copies) > 0).select(*documents.columns, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int"))).alias(copy))
    return repeated.select(documents.columns)
