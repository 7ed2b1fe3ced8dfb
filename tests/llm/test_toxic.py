"""The toxicity field: messages against enumeration, counts by hand, held-out accuracy, odd rows."""

from __future__ import annotations

import collections
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberwave.llm import toxic


def enumerated(codes, emit, move):
    """Marginals of tag 1 and expected pairs by all taggings of one text."""
    weight = {(0, 0): 0.0, (0, 1): move[0], (1, 0): move[1], (1, 1): move[2]}
    total, ones, pairs = 0.0, np.zeros(len(codes)), collections.Counter()
    for tags in itertools.product((0, 1), repeat=len(codes)):
        steps = list(zip((0, *tags), tags, strict=False))
        mass = np.exp(sum(emit[c] * t for c, t in zip(codes, tags, strict=True)) + sum(weight[s] for s in steps))
        total += mass
        ones += mass * np.array(tags)
        for s in steps:
            pairs[s] += mass
    return ones / total, {k: v / total for k, v in pairs.items()}


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(1)
    emit, move = draw.normal(size=toxic.CODES), draw.normal(size=3)
    texts = [draw.integers(0, toxic.CODES, n) for n in (3, 0, 1, 9, 2, 0, 11, 5)]
    starts = np.r_[0, np.cumsum([len(x) for x in texts])]
    codes = np.concatenate(texts)
    p = toxic.marginals(codes, starts, emit, move)
    whole, want = collections.Counter(), []
    for x in texts:
        own, pairs = enumerated(x, emit, move)
        want.append(own)
        whole.update(pairs) if len(x) else None
    assert np.allclose(p, np.concatenate(want))
    ones, pairs = toxic._expected(codes, starts, emit, move)
    assert np.allclose(ones, np.bincount(codes, p, toxic.CODES))
    assert np.allclose(pairs, [whole[0, 1], whole[1, 0], whole[1, 1]])
    assert len(toxic.marginals(np.zeros(0, np.int64), np.array([0, 0]), emit, move)) == 0


def test_long_text_does_not_depend_on_lanes():
    draw = np.random.default_rng(2)
    emit, move = draw.normal(size=toxic.CODES), draw.normal(size=3)
    codes = draw.integers(0, toxic.CODES, 5000)
    m01, m10, m11 = np.exp(move)
    starts = np.array([0, 1234])
    one, many = (toxic._scan(np.exp(emit)[codes], m01, m10, m11, m01, starts, lanes) for lanes in (1, 70))
    assert np.allclose(one, many)


def test_counts_by_hand(spark):
    rows = [("Bad badness, bad", True), ("good BAD_luck", False), ("", True), ("x" * 40, False), ("badness", True)]
    want = collections.Counter()
    for text, y in rows:
        words = {w.lower() for w in re.findall(r"[^\W_]+", text)}
        for f in {f for w in words for f in toxic.features(w)}:
            want[f, y] += 1
    packed = [(bytearray(toxic.word_sets([text])[0]), y) for text, y in rows]
    found = toxic.feature_counts(spark.createDataFrame(packed, "words binary, toxic boolean").repartition(2))
    got = {(r.feature, y): n for r in found.collect() for y, n in ((True, r.n1), (False, r.n0)) if n}
    assert got == dict(want) and ("=" + "x" * 40, False) not in got


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, toxic.fit(docs, labels)


def test_held_out(learned):
    docs, labels, model = learned
    found = toxic.toxicity(docs, model).where("held_out").join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic").toPandas()
    assert all(zlib.crc32(str(k).encode()) % 5 == 0 for k in found.doc_id) and len(found) > 500
    assert (found.predicted == found.toxic).mean() >= 0.98
    assert found[found.toxic == 1].predicted.mean() >= 0.9 and found[found.toxic == 0].predicted.mean() <= 0.01
    assert ((found.score >= 0) & (found.score <= 1)).all()


def test_spans_are_the_planted_words(learned):
    *_, model = learned
    text = "Ében the on, you IDIOT and ##moron## then clown clown nothing. " + "the and of " * 30
    score, spans = toxic.scored([text, "the and of " * 60, ""], model)
    assert [text[a:b] for a, b in spans[0]] == ["IDIOT", "moron", "clown clown"] and spans[1:] == [[], []]
    assert score[0] > 0.5 > score[1]


def test_labels_held_out_are_not_read(spark, learned):
    docs, labels, model = learned
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxic.feature_counts(toxic.labelled(docs.limit(2000), turned)[0]).agg(F.sum("n1")).first() == toxic.feature_counts(toxic.labelled(docs.limit(2000), labels)[0]).agg(F.sum("n1")).first()


def test_odd_rows(spark, learned):
    docs, labels, model = learned
    rows = [(None, "idiot moron"), (1, None), (1, ""), (1, ""), (2, " \n"), (3, "word " * 200_000 + "idiot moron scum"), (5, "İdiot x́")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("held_out", "score", "toxic", "feature", "n1", "codes"):
        frame = frame.withColumn(name, F.lit(name))
    found = toxic.toxicity(frame.repartition(2), model).collect()
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(k for k, _ in rows)
    by = {r.doc_id: r for r in found}
    assert not by[None].held_out and by[None].n_toxic == 1 and by[3].n_toxic == 1 and by[1].spans == ""
    assert toxic.toxicity(frame.limit(0), model).count() == 0
    # Clashing names, repeated ids, null labels; nothing to learn from.
    odd = spark.createDataFrame([(1, 1), (1, None), (None, 1), (3, 0)], "doc_id long, toxic int").withColumn("text", F.lit("t"))
    assert {r.doc_id: r.toxic for r in toxic.labelled(frame, odd)[1].collect()} == {k: k == 1 for k in (1, 3) if zlib.crc32(str(k).encode()) % 5}
    empty = toxic.fit(frame, odd.limit(0))
    assert empty.curve is None and {r.score for r in toxic.toxicity(frame, empty).collect()} == {0.5}
    toxic.fit(frame, odd)
    toxic.fit(frame.limit(0), labels)
