"""The filter audit against document-by-document counting, on odd rows as well."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import functions as F

from emberwave.llm import audit

LONG = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
ROWS = [
    (None, "same text", "en"),
    (1, "same text", "en"),
    (2, "same text", "fr"),
    (2, "same text", "fr"),
    (3, "same text", None),
    (4, None, None),
    (5, "", "en"),
    (6, " \n\t ", ""),
    (-7, LONG, "en"),
    (8, "THE LOUD ONE " * 100, "fr"),
    (9, "one # two", "fr"),
    (10, "É" * 40 + "A", "de"),
    (10, "É" * 40 + "A", "de"),
    (11, "A" + "é" * 32, "de"),
    (12, "x\u00a0y\u2003z " * 250, "de"),
]
LABELS = [(1, 1, 0), (2, None, 1), (2, 1, None), (4, 0, 1), (5, 1, 1), (8, 1, 1), (None, 1, 1), (99, 1, 1), (12, 2, 0)]


def by_hand(rows, labels):
    failing, parts = [], {}
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        bad = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(t[0] is not None and t[0] < doc_id and (t[1] or "") == text for t in rows),
        }
        of = [x for x in labels if x[0] is not None and x[0] == doc_id]
        failing.append((lang or "", {k for k, v in bad.items() if v}, any(x[1] == 1 for x in of), any(x[2] == 1 for x in of)))
    out = {}
    for part in {x[0] for x in failing}:
        shares = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = [x for x in failing if x[0] == part]
            for step, own in enumerate(order):
                gone = [x for x in left if own in x[1]]
                shares[own] += len(gone)
                left = [x for x in left if own not in x[1]]
                redundant = sum(x[0] == part and own in x[1] and bool(x[1] & set(order[:step])) for x in failing)
                unique = sum(x[0] == part and x[1] == {own} for x in failing)
                out[part, "".join(order), step + 1] = [len(left), len(gone), redundant, unique, sum(x[2] for x in gone), sum(x[3] for x in gone), own]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = shares[out[key][-1]]
    return out


def test_audit_by_hand(spark, small):
    own = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    labels = LABELS + [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{small}/labels.parquet").collect()]
    rows = [(None if r[0] is None else r[0] - 1000, *r[1:]) for r in ROWS] + own
    labels = [(None if k is None else k - 1000, q, t) for k, q, t in LABELS] + labels[len(LABELS) :]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for name in ("part", "_key", "words", "digest", "fails", "quality", "n", "mask", "k"):
        docs = docs.withColumn(name, F.lit(name))
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("_key", F.lit(0)).withColumn("part", F.lit("x"))
    found = audit.audit(docs, frame)
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in found.collect()}
    assert got == by_hand(rows, labels)
    assert audit.audit(docs.limit(0), frame).count() == 0
    assert audit.audit(docs, frame.limit(0)).agg(F.max("good_lost")).first()[0] == 0


def test_lattice():
    assert len(audit.EDGES) == 80 and len(audit.STEPS) == 600
    assert {(mask, k) for _, _, mask, k in audit.STEPS} == set(audit.EDGES)
