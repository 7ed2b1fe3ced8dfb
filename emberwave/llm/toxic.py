"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Evidence comes first, from every labelled row: in how many toxic and how many other documents each word and each
beginning of a word occurs. What is several times as frequent in toxic ones, beyond what chance explains, is kept.
A token is observed by the strongest such beginning, by how much of the word lies behind it, and by the word as a
whole. In the labelled documents of a bounded sample, tokens with evidence are toxic where their document is, and all
others are not: with these labels the field is fitted, two tags a token, weights for what is observed and for
neighbouring tags. A sampled row's own counts are taken out of its evidence.

The field reads every token of every text. Forward and backward messages of two tags are ratios, a step maps a ratio by
a fraction of two linear terms, and such maps compose; texts are laid end to end, cut into lanes that are read in step,
and the lanes' maps are composed by a scan. The marginals say which tokens are toxic (spans), and their sum, their
greatest and the number of tokens give the document's score by a logistic curve, fitted on the same sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwave.llm.common import Scratch, slices

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_toxic long, spans string"
_TOKEN = re.compile(r"[^\W_]+")
#: Lengths of the beginnings of words that are counted, and the longest word that is counted as a whole.
PREFIXES, WHOLE = (3, 4, 5, 6, 7), 16
#: Bytes of compressed words whose features are counted at once.
COUNTED_BYTES = 2_000_000
#: Words whose observations a task remembers.
SEEN_WORDS = 500_000
#: Steps of strength, by the logarithm of how many times as frequent a feature is in toxic documents.
STEPS, STEP = 6, 0.7
#: Letters behind a beginning: none, one or two, more.
_TAILS = np.array([0, 1, 1, 2])
CODES = (STEPS + 1) * 3 * (STEPS + 1)


@dataclass(frozen=True)
class Settings:
    """``sample`` labelled ids, whole rows each, fit the field and the curve; ``features`` is the most that it knows.

    A feature is kept where it is at least ``ratio`` times as frequent in toxic documents and its log-likelihood ratio
    is above 2 ln(rows) + ``slack``, so that among more rows, with more features, no more of them pass by chance.
    """

    sample: int = 4000
    features: int = 200_000
    ratio: float = 3.0
    slack: float = 4.0
    rounds: int = 60
    held_out_of: int = 5


@dataclass
class Model:
    """Counts of the kept features, and the weights of the field and of the curve."""

    counts: dict[str, tuple[int, int]]
    rows: tuple[int, int]
    settings: Settings = field(default_factory=Settings)
    emit: np.ndarray = field(default_factory=lambda: np.full(CODES, -8.0))
    move: np.ndarray = field(default_factory=lambda: np.zeros(3))
    curve: np.ndarray | None = None
    prior: float = 0.5


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Runs of letters and digits as (id of each token, start of each text, lower-cased tokens by id)."""
    found: list[str] = []
    starts = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        found += _TOKEN.findall(text)
        starts[k + 1] = len(found)
    coded = pa.array(found, pa.string()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, [x.lower() for x in coded.dictionary.to_pylist()]


def features(word: str) -> list[str]:
    """The word as a whole, then its beginnings, the shortest first."""
    return ([f"={word}"] if len(word) <= WHOLE else []) + [f"^{word[:k]}" for k in PREFIXES if len(word) > k]


def word_sets(texts: list[str]) -> list[bytes]:
    """The distinct tokens of each text, compressed: what leaves the texts to meet the labels."""
    ids, starts, words = tokens(texts)
    lower = pa.array(words, pa.string()).dictionary_encode()
    ids, words = lower.indices.to_numpy(zero_copy_only=False)[ids] if words else ids, lower.dictionary.to_pylist()
    pack = zstandard.ZstdCompressor(level=3)
    return [pack.compress(" ".join([words[k] for k in np.unique(ids[a:b]).tolist()]).encode()) for a, b in zip(starts, starts[1:], strict=False)]


def _counted(sets: list[bytes], toxic: np.ndarray) -> pa.RecordBatch:
    """Of each feature of some texts, the number of toxic and of other texts that hold it."""
    unpack = zstandard.ZstdDecompressor()
    texts = [unpack.decompress(x).decode().split() for x in sets]
    coded = pa.array([w for x in texts for w in x], pa.string()).dictionary_encode()
    ids, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    known: dict[str, int] = {}
    own = [np.array([known.setdefault(f, len(known)) for f in features(w)], np.int64) for w in words]
    sizes = np.array([len(x) for x in own], np.int64)
    begins = np.r_[0, np.cumsum(sizes)][:-1]
    flat = np.concatenate(own) if own else np.zeros(0, np.int64)
    many = sizes[ids]
    at = np.repeat(begins[ids] - np.r_[0, np.cumsum(many)][:-1], many) + np.arange(many.sum())
    both = np.unique(np.repeat(owner, many) * max(len(known), 1) + flat[at]) if len(ids) else np.zeros(0, np.int64)
    owner, feature = np.divmod(both, max(len(known), 1))
    n1 = np.bincount(feature[toxic[owner]], minlength=len(known))
    n0 = np.bincount(feature[~toxic[owner]], minlength=len(known))
    return pa.RecordBatch.from_pydict({"feature": pa.array(list(known), pa.string()), "n1": pa.array(n1.astype(np.int64)), "n0": pa.array(n0.astype(np.int64))})


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, n1, n0) over all ``rows`` (words, toxic), the words as ``word_sets`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "words", COUNTED_BYTES):
            yield _counted(part.column("words").to_pylist(), part.column("toxic").to_numpy(zero_copy_only=False).astype(bool))

    return rows.select("words", "toxic").mapInArrow(run, "feature string, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _evidence(n1: np.ndarray, n0: np.ndarray, rows: tuple[int, int], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Steps of strength of features, 0 for none, and their log-likelihood ratios."""
    t1, t0 = max(rows[0], 1), max(rows[1], 1)
    share = (n1 + n0) / (t1 + t0)
    with np.errstate(divide="ignore", invalid="ignore"):
        told = 2 * (np.where(n1 > 0, n1 * np.log(n1 / (t1 * share)), 0) + np.where(n0 > 0, n0 * np.log(n0 / (t0 * share)), 0))
    strength = np.log((n1 + 0.5) / (t1 + 1)) - np.log((n0 + 0.5) / (t0 + 1))
    over = strength - np.log(settings.ratio)
    step = np.where((over >= 0) & (told > 2 * np.log(t1 + t0) + settings.slack), 1 + np.minimum(STEPS - 1, np.floor(over / STEP)), 0)
    return np.nan_to_num(step).astype(np.int64), np.nan_to_num(told)


def codes_of(words: list[str], model: Model, own: int | None = None) -> np.ndarray:
    """What each word is observed as, 0 without evidence; ``own``, the label of the row they are of, is not counted."""
    less = np.array([own == 1, own == 0], np.int64)
    held = [(k, f) for k, w in enumerate(words) for f in features(w) if f in model.counts]
    out = np.zeros(len(words), np.int64)
    if not held:
        return out
    n = np.maximum(np.array([model.counts[f] for _, f in held], np.int64) - less, 0)
    steps, _ = _evidence(n[:, 0], n[:, 1], (model.rows[0] - int(less[0]), model.rows[1] - int(less[1])), model.settings)
    whole, head, tail = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for (k, f), step in zip(held, steps.tolist(), strict=True):
        if f[0] == "=":
            whole[k] = step
        elif step >= head[k] and step:
            head[k], tail[k] = step, _TAILS[min(3, len(words[k]) - len(f) + 1)]
    return (head * 3 + tail) * (STEPS + 1) + whole


# The field: emit[code] and move[0 to 1, 1 to 0, 1 to 1] are scores of tag 1 and of pairs of tags; those of tag 0 and of 0 to 0 are 0.


def _scan(weight: np.ndarray, x: float, y: float, m11: float, first: float, starts: np.ndarray, lanes: int) -> np.ndarray:
    """r = w (m11 r + x) / (y r + 1) from token to token, w times ``first`` where a text starts: lanes in step, then their maps."""
    n = len(weight)
    steps = -(-n // lanes)
    w = np.ones(steps * lanes)
    w[:n] = weight
    fresh = np.zeros(steps * lanes, bool)
    fresh[starts[starts < n]] = True
    w, fresh = w.reshape(lanes, steps).T.copy(), fresh.reshape(lanes, steps).T.copy()
    # The map of a lane takes r to (a r + b) / (c r + d).
    a, b, c, d = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for k in range(steps):
        a, b, c, d = w[k] * (m11 * a + x * c), w[k] * (m11 * b + x * d), y * a + c, y * b + d
        if fresh[k].any():
            f = fresh[k]
            a[f], b[f], c[f], d[f] = 0, w[k][f] * first, 0, 1
        size = a + b + c + d
        a, b, c, d = a / size, b / size, c / size, d / size
    before, r = np.zeros(lanes), 0.0
    for k in range(lanes):
        before[k] = r
        r = (a[k] * r + b[k]) / (c[k] * r + d[k])
    out, r = np.empty((steps, lanes)), before
    for k in range(steps):
        r = np.where(fresh[k], w[k] * first, w[k] * (m11 * r + x) / (y * r + 1))
        out[k] = r
    return out.T.ravel()[:n]


def messages(codes: np.ndarray, starts: np.ndarray, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token the forward and the backward message as ratios of tag 1 to tag 0; the forward one has its own weight.

    A text begins as after tag 0. Backward, the message times the token's weight follows the same kind of map from the end.
    """
    n = len(codes)
    lanes = max(1, int(np.sqrt(n)))
    weight = np.exp(emit)[codes]
    m01, m10, m11 = np.exp(move)
    forward = _scan(weight, m01, m10, m11, m01, starts[:-1], lanes)
    weighted = _scan(weight[::-1], m10, m01, m11, 1.0, n - starts[1:], lanes)[::-1]
    return forward, weighted / weight


def marginals(codes: np.ndarray, starts: np.ndarray, emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The probability of tag 1 of each token."""
    if not len(codes):
        return np.zeros(0)
    forward, backward = messages(codes, starts, emit, move)
    both = forward * backward
    return both / (1 + both)


def _expected(codes: np.ndarray, starts: np.ndarray, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected counts of tag 1 by code, and of the three pairs of tags."""
    forward, backward = messages(codes, starts, emit, move)
    both = forward * backward
    p = both / (1 + both)
    m01, m10, m11 = np.exp(move)
    r = np.r_[0.0, forward[:-1]]
    r[starts[:-1][starts[:-1] < len(codes)]] = 0.0
    u = np.exp(emit)[codes] * backward
    whole = (1 + m10 * r) + u * (m01 + m11 * r)
    pairs = np.array([(m01 * u / whole).sum(), (m10 * r / whole).sum(), (m11 * r * u / whole).sum()])
    return np.bincount(codes, p, CODES), pairs


def fit_field(codes: np.ndarray, starts: np.ndarray, tags: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of greatest likelihood with a small quadratic penalty, each climbing at a pace of its own."""
    one = np.bincount(codes, tags, CODES)
    before = np.r_[0, tags[:-1]]
    before[starts[:-1][starts[:-1] < len(codes)]] = 0
    pairs = np.array([((before == 0) & (tags == 1)).sum(), ((before == 1) & (tags == 0)).sum(), ((before == 1) & (tags == 1)).sum()], float)
    emit = np.log((one + 0.1) / (np.bincount(codes, minlength=CODES) - one + 0.5))
    emit[np.bincount(codes, minlength=CODES) == 0] = 0.0
    weights = np.r_[np.clip(emit, -8, 8), np.zeros(3)]
    pace, last = np.full(len(weights), 0.2), np.zeros(len(weights))
    for _ in range(rounds):
        e, q = _expected(codes, starts, weights[:CODES], weights[CODES:])
        slope = np.r_[one - e, pairs - q] - 0.02 * weights
        same = np.sign(slope) * np.sign(last)
        pace = np.clip(np.where(same > 0, pace * 1.2, np.where(same < 0, pace * 0.5, pace)), 1e-3, 1.0)
        weights = np.clip(weights + np.sign(slope) * pace, -12, 12)
        last = np.where(same < 0, 0, slope)
    return weights[:CODES], weights[CODES:]


def _summed(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What the curve takes of each text: sum and greatest of its marginals, and its tokens."""
    n = np.diff(starts)
    total = np.diff(np.r_[0, np.cumsum(p)][starts])
    most = np.zeros(len(n))
    np.maximum.at(most, np.repeat(np.arange(len(n)), n), p)
    return np.c_[np.ones(len(n)), np.log(np.maximum(total, 0) + 0.02), most, np.log1p(n)]


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
    return w


def labelled(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Rows to learn from (doc_id, words, toxic), and their ids (doc_id, toxic).

    Ids whose crc32 leaves 0 are held out; of several labels of an id one that says 1 counts, and none is no label.
    Only the distinct words of a text travel to its label, compressed, and at every size by a shuffle of both.
    """
    key = labels["doc_id"].cast("long")
    learned = F.crc32(F.col("doc_id").cast("string")) % settings.held_out_of != 0
    known = labels.where(key.isNotNull() & labels["toxic"].isNotNull()).groupBy(key.alias("doc_id")).agg(F.bool_or(labels["toxic"] == 1).alias("toxic")).where(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "words": pa.array(word_sets(part.column("text").to_pylist()), pa.binary())})

    words = _texts(documents).where(learned).mapInArrow(run, "doc_id long, words binary")
    return words.join(known.hint("merge"), "doc_id"), known


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), F.coalesce(documents["text"].cast("string"), F.lit("")).alias("text"))


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Evidence from all labelled rows that are not held out, the field and the curve from a sample of them."""
    scratch = Scratch(documents.sparkSession, "toxic")
    rows, known = labelled(documents, labels, settings)
    rows = scratch.saved(rows.select("words", "toxic"), "words")
    told = rows.agg(F.count_if("toxic").alias("n1"), F.count_if(~F.col("toxic")).alias("n0")).first()
    model = Model({}, (told.n1, told.n0), settings, prior=(told.n1 + 1) / (told.n1 + told.n0 + 2))
    if not (told.n1 and told.n0):
        scratch.done()
        return model
    # Only what is frequent enough in toxic documents leaves the count; the test of chance follows on those.
    share = (F.col("n1") + 0.5) / (told.n1 + 1) / ((F.col("n0") + 0.5) / (told.n0 + 1))
    likely = 2 * F.col("n1") * F.log(F.col("n1") * (told.n1 + told.n0) / ((F.col("n1") + F.col("n0")) * told.n1))
    likely = likely + F.when(F.col("n0") > 0, 2 * F.col("n0") * F.log(F.col("n0") * (told.n1 + told.n0) / ((F.col("n1") + F.col("n0")) * told.n0))).otherwise(0)
    counts = feature_counts(rows).where((F.col("n1") > 1) & (share >= settings.ratio))
    kept = counts.withColumn("likely", likely).where(F.col("likely") > 2 * float(np.log(told.n1 + told.n0)) + settings.slack)
    kept = scratch.saved(kept, "features")
    model.counts = {r.feature: (r.n1, r.n0) for r in kept.orderBy(F.desc("likely"), "feature").limit(settings.features).collect()}
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    sampled = _texts(documents).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.bool_or("toxic").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            toxic = part.column("toxic").to_pylist()
            ids, starts, words = tokens(part.column("text").to_pylist())
            by_label = [codes_of(words, model, own).astype(np.uint8) for own in (0, 1)]
            found = [by_label[int(y)][ids[a:b]].tobytes() for y, a, b in zip(toxic, starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "toxic": part.column("toxic"), "codes": pa.array(found, pa.binary())})

    # Texts stay where they are; a byte for each token of the sample comes to the driver.
    sample = sorted(sampled.mapInArrow(run, "doc_id long, toxic boolean, codes binary").collect(), key=lambda r: r.doc_id)
    scratch.done()
    if sample:
        coded = [np.frombuffer(r.codes, np.uint8).astype(np.int64) for r in sample]
        y = np.array([r.toxic for r in sample], float)
        starts = np.r_[0, np.cumsum([len(x) for x in coded])]
        codes = np.concatenate(coded)
        tags = ((codes > 0) & (np.repeat(y, np.diff(starts)) > 0)).astype(np.int64)
        if len(codes):
            model.emit, model.move = fit_field(codes, starts, tags, settings.rounds)
        model.curve = fit_curve(_summed(marginals(codes, starts, model.emit, model.move), starts), y)
    return model


def scored(texts: list[str], model: Model, seen: dict[str, int] | None = None) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """The scores of texts, and the spans of their toxic tokens as code points, neighbours in one span.

    ``seen`` remembers what words are observed as; it is emptied when it has very many.
    """
    seen = {} if seen is None else seen
    ids, starts, words = tokens(texts)
    new = list({w for w in words if w not in seen})
    if len(seen) + len(new) > SEEN_WORDS:
        seen.clear()
        new = list(set(words))
    seen.update(zip(new, codes_of(new, model).tolist(), strict=True))
    codes = np.array([seen[w] for w in words], np.int64)
    p = marginals(codes[ids], starts, model.emit, model.move)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    bad = p >= 0.5
    for k in np.unique(np.searchsorted(starts, np.flatnonzero(bad), "right") - 1).tolist():
        joined = False
        for m, flag in zip(_TOKEN.finditer(texts[k]), bad[starts[k] : starts[k + 1]].tolist(), strict=True):
            if flag and joined:
                spans[k][-1] = (spans[k][-1][0], m.end())
            elif flag:
                spans[k].append(m.span())
            joined = flag
    if model.curve is None:
        return np.full(len(texts), model.prior), spans
    return 1 / (1 + np.exp(-np.clip(_summed(p, starts) @ model.curve, -30, 30))), spans


def toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic and spans (start:end, comma-joined), a row per row of ``documents``.

    A null text is an empty one, scored by the curve alone; a null doc_id is passed on and is not held out. Repeated
    rows give repeated results, an empty table none. Columns beyond doc_id and text are not read. Without labels of
    both kinds every score is the share of toxic labels, one of each kind added.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for part in slices(batches):
            score, spans = scored(part.column("text").to_pylist(), shared.value, seen)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "held_out": part.column("held_out"),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= 0.5).astype(np.int32)),
                    "n_toxic": pa.array([len(x) for x in spans], pa.int64()),
                    "spans": pa.array([",".join(f"{a}:{b}" for a, b in x) for x in spans], pa.string()),
                }
            )

    held_out = F.coalesce(F.crc32(documents["doc_id"].cast("long").cast("string")) % model.settings.held_out_of == 0, F.lit(False))
    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(documents["text"].cast("string"), F.lit("")).alias("text")).mapInArrow(run, SCHEMA)
