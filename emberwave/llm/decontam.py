"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document. A segment holds a bounded run of whole texts: its terms, the
postings of each term (ascending positions, as differences), and the first position of each text. Texts
lie a gap apart, so that no phrase reaches from one into the next. Segments are rows of a written table,
so a lost executor costs a segment, and later benchmarks search the same index.

A search takes the windows of the benchmark items, a block of bounded size at a time. The index's term lists alone
tell how often each term of a block occurs in all segments, and a window is anchored at its rarest term: a
segment looks at the windows anchored at terms it holds, and at no others. There, a window's terms are ranked
by their number of postings; the list of the rarest, less its offset in the window, gives the candidate
starts, and each further list is intersected with them after the same shift, rarest first, until none is
left or the phrase is proven. Proximity asks only for a posting within ``slop`` positions of each term's place.

A block writes what it finds, some rows for each text that is hit; the index itself is written once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwave.llm.common import encoded, few, fresh, saved, shared_dir, slices, word_ids

WINDOW = 10
#: Empty positions between two texts; proximity searches may not reach over it.
GAP = 64
#: Bytes of the windows of a block, as they are broadcast; one item beyond that is a block of its own.
BLOCK_BYTES = 64_000_000
#: What a word of the benchmark comes to there: a window of ten 4-byte terms, its item, length and number.
WORD_BYTES = 4 * (WINDOW + 4)

#: Texts that are hit are broadcast up to this many, some hundred bytes each.
HIT_TEXTS = 100_000

#: A-Z become lower case, digits and a-z stay, other ASCII separates words; bytes of non-ASCII stay.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "segment long, doc_ids array<long>, text_keys array<long>, firsts binary, n_words binary, terms array<binary>, lists binary, postings binary"
FOUND = "segment long, k int, spans array<struct<start:long,end:long>>, items array<string>"
HITS = "doc_id long, text_key long, n_words long, n_hit long, n_items long, items array<string>"
MATCHES = "doc_id long, item_id string, window long, position long, kind string"


def build_index(documents: DataFrame) -> DataFrame:
    """The segments of ``documents`` (doc_id, text), every word of every text in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, starts, terms = word_ids(encoded(part.column("text")), WORDS)
            n = np.diff(starts)
            firsts = starts[:-1] + GAP * np.arange(len(n))
            positions = np.arange(len(ids)) + np.repeat(GAP * np.arange(len(n)), n)
            order = np.argsort(ids, kind="stable")
            lists = np.r_[0, np.cumsum(np.bincount(ids, minlength=len(terms)))]
            postings = positions[order]
            steps = np.diff(postings, prepend=0)
            steps[lists[:-1]] = postings[lists[:-1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_ids": pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "text_keys": pa.array([part.column("text_key").to_pylist()], pa.list_(pa.int64())),
                    "firsts": [firsts.astype("<u4").tobytes()],
                    "n_words": [n.astype("<u4").tobytes()],
                    "terms": pa.array([terms], pa.list_(pa.binary())),
                    "lists": [lists.astype("<u4").tobytes()],
                    "postings": [steps.astype("<u4").tobytes()],
                }
            )

    text = documents["text"].cast("string")
    own = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    segments = own.mapInArrow(run, INDEX.removeprefix("segment long, "))
    return segments.select(F.monotonically_increasing_id().alias("segment"), "*")


def stored_index(documents: DataFrame) -> DataFrame:
    """``build_index`` as a written table in the shared folder: what names a segment is fixed from then on."""
    path = shared_dir(documents.sparkSession, "index")
    build_index(documents).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(INDEX).parquet(path)


@dataclass
class Windows:
    """The windows of a block of benchmark items: term of each place (-1 beyond the end), item, length."""

    terms: list[bytes]
    places: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    items: list[str | None]
    numbers: np.ndarray
    #: Windows by anchor: those of term t are anchored[bounds[t] : bounds[t + 1]].
    anchored: np.ndarray | None = None
    bounds: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_number"}

    @property
    def number(self) -> dict[bytes, int]:
        """The number of each term; made once in a task."""
        if "_number" not in self.__dict__:
            self.__dict__["_number"] = {t: k for k, t in enumerate(self.terms)}
        return self.__dict__["_number"]

    def anchor(self, counts: np.ndarray) -> None:
        """Anchors each window at the term with the fewest postings of all, the first of several."""
        often = np.where(self.places < 0, np.iinfo(np.int64).max, np.r_[counts, 0][self.places])
        term = self.places[np.arange(len(self.places)), often.argmin(axis=1)] if len(self.places) else np.zeros(0, np.int64)
        self.anchored = np.argsort(term, kind="stable").astype(np.int32)
        self.bounds = np.r_[0, np.cumsum(np.bincount(term, minlength=len(self.terms)))]


def windows(items: list[tuple[str | None, str | None]], size: int = WINDOW) -> Windows:
    """``size`` consecutive words each; an item with fewer is one window, without words none."""
    ids, starts, terms = word_ids([(text or "").encode() for _, text in items], WORDS)
    n = np.diff(starts)
    width = np.minimum(n, size)
    count = np.where(width > 0, n - width + 1, 0)
    owner = np.repeat(np.arange(len(items)), count)
    numbers = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    lengths = width[owner]
    at = (starts[:-1][owner] + numbers)[:, None] + np.arange(size)
    inside = np.arange(size) < lengths[:, None]
    places = np.where(inside, ids[np.minimum(at, max(len(ids) - 1, 0))] if len(ids) else -1, -1)
    return Windows(terms, places.astype(np.int32).reshape(-1, size), lengths.astype(np.int32), owner.astype(np.int32), [i for i, _ in items], numbers.astype(np.int32))


class Segment:
    """One row of the index, opened for a search of ``wanted`` windows."""

    def __init__(self, row: dict, wanted: Windows) -> None:
        self.firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        self.n_words = np.frombuffer(row["n_words"], "<u4").astype(np.int64)
        self.lists = np.frombuffer(row["lists"], "<u4").astype(np.int64)
        self.steps = np.frombuffer(row["postings"], "<u4")
        number = wanted.number
        both = [(number[t], k) for k, t in enumerate(row["terms"]) if t in number]
        #: Of the terms that block and segment share, the number here by the number there.
        self.term = dict(both)
        self.open: dict[int, np.ndarray] = {}
        wide = np.diff(self.lists)
        self.count = np.zeros(len(wanted.terms) + 1, np.int64)
        if both:
            there, here = np.array(both).T
            self.count[there] = wide[here]

    def postings(self, term: int) -> np.ndarray:
        if term not in self.open:
            k = self.term[term]
            self.open[term] = np.cumsum(self.steps[self.lists[k] : self.lists[k + 1]], dtype=np.int64)
        return self.open[term]

    def candidates(self, wanted: Windows) -> np.ndarray:
        """The windows whose anchor is a term of this segment and whose other terms are too."""
        here = np.array(sorted(self.term), np.int64)
        found = [wanted.anchored[wanted.bounds[t] : wanted.bounds[t + 1]] for t in here[wanted.bounds[here + 1] > wanted.bounds[here]].tolist()]
        if not found:
            return np.zeros(0, np.int64)
        found = np.sort(np.concatenate(found)).astype(np.int64)
        return found[((wanted.places[found] < 0) | (self.count[wanted.places[found]] > 0)).all(axis=1)]

    def search(self, wanted: Windows, slop: int = 0) -> Iterator[tuple[int, np.ndarray]]:
        """(window, starts) of each window that occurs; with ``slop``, of each that nearly does."""
        some = self.candidates(wanted)
        counts = np.where(wanted.places[some] < 0, np.iinfo(np.int64).max, self.count[wanted.places[some]])
        order = np.argsort(counts, axis=1, kind="stable")
        for w, ranked in zip(some.tolist(), order, strict=True):
            starts = None
            for offset in ranked[: wanted.lengths[w]].tolist():
                there = self.postings(int(wanted.places[w, offset])) - offset
                if starts is None:
                    starts = there
                else:
                    at = np.searchsorted(there, starts - slop)
                    starts = starts[(at < len(there)) & (there[np.minimum(at, len(there) - 1)] <= starts + slop)]
                if not len(starts):
                    break
            if slop and len(starts):
                starts = starts[self._apart(wanted.places[w, : wanted.lengths[w]], starts, slop)]
            if len(starts):
                # A posting of the rarest term is a real word; its text is the match's, wherever the start would be.
                yield w, starts + (int(ranked[0]) << 48)

    def _apart(self, places: np.ndarray, starts: np.ndarray, slop: int) -> np.ndarray:
        """Whether each word of a window has a posting of its own near its place, where the window repeats words.

        Places of one word in order have windows of the same width in order, so each takes the first posting that is left.
        """
        fine = np.ones(len(starts), bool)
        for term in np.unique(places[places >= 0]).tolist():
            offsets = np.flatnonzero(places == term)
            if len(offsets) < 2:
                continue
            there, used = self.postings(term), np.full(len(starts), -1, np.int64)
            for offset in offsets.tolist():
                at = np.searchsorted(there, np.maximum(starts + offset - slop, used + 1))
                used = there[np.minimum(at, len(there) - 1)]
                fine &= (at < len(there)) & (used <= starts + offset + slop)
        return fine

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, positions, "right") - 1


def split_match(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start of each match, and the position of the rarest term, a real posting, in it."""
    offset = coded >> 48
    starts = coded - (offset << 48)
    return starts, starts + offset


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of bounded size, of which the driver holds one at a time.

    An item's size is counted by its words, as each makes a window; a word is two characters at least.
    """
    block, size = [], 0
    for row in benchmark.select(benchmark["item_id"].cast("string").alias("i"), benchmark["text"].cast("string").alias("t")).toLocalIterator():
        more = WORD_BYTES * (len(row.t or "") // 2 + 1) + len(row.i or "")
        if block and size + more > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += more
    if block:
        yield block


def _anchored(index: DataFrame, block: list[tuple[str | None, str | None]], size: int) -> Broadcast:
    """The windows of a block, anchored at their rarest terms over the whole index, as a broadcast.

    The index's terms meet the block's, and the numbers of postings are summed up before they come to the
    driver: a number for each term of the block at most.
    """
    wanted = windows(block, size)
    context = index.sparkSession.sparkContext
    terms = context.broadcast(wanted.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(terms.value)}
        total = np.zeros(len(number), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                wide = np.diff(np.frombuffer(row["lists"], "<u4").astype(np.int64)).tolist()
                for t, n in zip(row["terms"], wide, strict=True):
                    if t in number:
                        total[number[t]] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": seen, "n": total[seen]})

    counts = np.zeros(len(wanted.terms), np.int64)
    if wanted.terms:
        for row in index.select("terms", "lists").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            counts[row.term] = row.n
    terms.destroy()
    wanted.anchor(counts)
    return context.broadcast(pickle.dumps(wanted, protocol=5))


def _spans(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _hit_texts(row: dict, wanted: Windows) -> Iterator[dict]:
    """Of each text that is hit the spans of words, counted from its first one, and the items."""
    segment = Segment(row, wanted)
    found: dict[int, set[str | None]] = {}
    size = int(segment.firsts[-1] + segment.n_words[-1]) if len(segment.firsts) else 0
    change = np.zeros(size + 1, np.int64)
    for w, coded in segment.search(wanted):
        starts, real = split_match(coded)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + wanted.lengths[w], -1)
        for k in np.unique(segment.text_of(real)).tolist():
            found.setdefault(k, set()).add(wanted.items[wanted.owner[w]])
    marked = np.cumsum(change) > 0
    for k, items in found.items():
        first = int(segment.firsts[k])
        spans = _spans(marked[first : first + int(segment.n_words[k])])
        yield {"segment": row["segment"], "k": k, "spans": [{"start": a, "end": b} for a, b in spans], "items": list(items)}


def _found(index: DataFrame, benchmark: DataFrame, size: int) -> list[DataFrame]:
    """``FOUND`` of each block of the benchmark, as written tables."""
    tables = []
    for block in _blocks(benchmark):
        wanted = _anchored(index, block, size)

        def run(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            own = pickle.loads(wanted.value)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            schema = pa.schema([("segment", pa.int64()), ("k", pa.int32()), ("spans", spans), ("items", pa.list_(pa.string()))])
            for batch in batches:
                for k in range(batch.num_rows):
                    yield pa.RecordBatch.from_pylist(list(_hit_texts(batch.slice(k, 1).to_pylist()[0], own)), schema)

        tables.append(saved(index.select("segment", "firsts", "n_words", "terms", "lists", "postings").mapInArrow(run, FOUND), "found"))
        wanted.destroy()
    return tables


def _texts(index: DataFrame) -> DataFrame:
    """(segment, k, doc_id, text_key, n_words): a row per indexed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = np.frombuffer(row["n_words"], "<u4").astype(np.int64)
                columns = {"segment": np.full(len(n), row["segment"]), "k": np.arange(len(n), dtype=np.int32)}
                yield pa.RecordBatch.from_pydict(columns | {"doc_id": pa.array(row["doc_ids"], pa.int64()), "text_key": pa.array(row["text_keys"], pa.int64()), "n_words": n})

    return index.select("segment", "doc_ids", "text_keys", "n_words").mapInArrow(run, "segment long, k int, doc_id long, text_key long, n_words long")


def _words_in(spans: str):
    """The number of words in the union of spans, which are sorted by their starts."""
    walk = "aggregate(spans, named_struct('n', 0L, 'to', 0L), (a, s) -> named_struct('n', a.n + greatest(s.end - greatest(s.start, a.to), 0L), 'to', greatest(a.to, s.end)), a -> a.n)"
    return F.expr(walk.replace("spans", spans))


def exact_hits(index: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items and items (sorted strings), a row per indexed text.

    Items with the same id count once, and so do all without an id, which are a null at the end of
    ``items``; an item without words occurs nowhere. A null or empty text has no words and no hits. Repeated
    rows give repeated results. Without items, nothing is hit; an empty index gives no rows.
    """
    texts, tables = _texts(index), _found(index, benchmark, size)
    none = F.array().cast("array<string>")
    if not tables:
        return texts.select("doc_id", "text_key", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), none.alias("items"))
    found = tables[0]
    if len(tables) > 1:
        for other in tables[1:]:
            found = found.unionByName(other)
        joined = found.groupBy("segment", "k").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = saved(joined, "found")
    # Only texts that are hit are in the table; it is broadcast where it is counted to be small.
    hit = found.select("segment", "k", _words_in("spans").alias("n_hit"), F.array_sort("items").alias("items"))
    joined = texts.join(few(saved(hit, "hit"), HIT_TEXTS), ["segment", "k"], "left")
    items = F.coalesce("items", none)
    return joined.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"))


def find_matches(index: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """doc_id, item_id, window, position (word of the text) and kind of every match, block by block.

    ``slop`` 0 gives exact phrases. Above it, each word may lie up to ``slop`` positions from its place
    (at most half the gap between texts), and words that are alike are different ones in the text; a match is ``exact`` where it needs none. A match belongs to the text
    that holds its rarest word; its position is where the window would begin, not before the text does.
    Items and texts that are null or empty match nothing; repeated rows and items each give their matches.
    """
    if not 0 <= slop <= GAP // 2:
        raise ValueError(f"slop must be 0 to {GAP // 2}")
    out = None
    for block in _blocks(benchmark):
        wanted = _anchored(index, block, size)

        def run(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            own = pickle.loads(wanted.value)
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from _matches(batch.slice(k, 1).to_pylist()[0], own, slop)

        found = saved(index.mapInArrow(run, MATCHES), "matches")
        wanted.destroy()
        out = found if out is None else out.unionByName(found)
    return out if out is not None else index.sparkSession.createDataFrame([], MATCHES)


def near_report(index: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = 1) -> DataFrame:
    """doc_id, item_id, n_exact and n_near: how many windows of an item a document holds exactly, and how many nearly alone.

    A row for each document and item that match at all. Nulls and repeats as in ``find_matches``.
    """
    found = find_matches(index, benchmark, size, slop).groupBy("doc_id", "item_id", "window").agg(F.bool_or(F.col("kind") == "exact").alias("exact"))
    return found.groupBy("doc_id", "item_id").agg(F.count_if("exact").alias("n_exact"), F.count_if(~F.col("exact")).alias("n_near"))


def _matches(row: dict, wanted: Windows, slop: int) -> Iterator[pa.RecordBatch]:
    segment = Segment(row, wanted)
    exact = {w: split_match(coded)[0] for w, coded in segment.search(wanted)}
    for w, coded in segment.search(wanted, slop):
        starts, real = split_match(coded)
        text = segment.text_of(real)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([row["doc_ids"][t] for t in text], pa.int64()),
                "item_id": pa.array([wanted.items[wanted.owner[w]]] * len(starts), pa.string()),
                "window": pa.array([int(wanted.numbers[w])] * len(starts), pa.int64()),
                "position": np.maximum(starts - segment.firsts[text], 0),
                "kind": pa.array(["exact" if e else "near" for e in np.isin(starts, exact.get(w, []))], pa.string()),
            }
        )


def keep_uncontaminated(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``documents`` without the rows whose text holds a window of the benchmark; columns stay, whatever
    their names.

    A verdict depends on the text alone: rows are matched by doc_id and their text's 64-bit hash. Null and empty
    texts stay, equal rows stay or go together, an empty table or benchmark takes nothing away.
    """
    hits = exact_hits(stored_index(documents), benchmark, size)
    key, bad_id, bad_key = fresh(documents, "text_key", "bad_id", "bad_key")
    bad = saved(hits.where("n_hit > 0").select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct(), "contaminated")
    bad = few(bad)
    keyed = documents.withColumn(key, F.xxhash64(documents["text"].cast("string")))
    on = (F.col(key) == F.col(bad_key)) & keyed["doc_id"].cast("long").eqNullSafe(F.col(bad_id))
    return keyed.join(bad, on, "left_anti").select(documents.columns)


def items_digest(items: str = "items"):
    """The lower-case hex SHA-256 of the comma-joined items; a null is left out."""
    return F.sha2(F.array_join(items, ","), 256)

