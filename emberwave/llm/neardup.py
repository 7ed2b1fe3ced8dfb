"""Near duplicates by min-max hashing.

A signature holds the smallest and the largest value of a set under each of ``permutations`` hash
functions: two unbiased matches for one evaluation, so half the evaluations give a signature of the
same length whose estimate varies less. Bands of ``rows`` values, minima apart from maxima, give the
buckets that propose pairs; every proposed pair is confirmed on the full sets.

Equal sets are one node from the start, so copies never meet in a bucket. A large bucket is first thinned
by a star: each member is compared with one centre, confirmed links join components, and a bucket whose
members have all come together is done. What shares a bucket that is still open, directly or in a chain,
is a group, and a group is dealt to cells: it is cut into blocks of bounded size, and a cell holds two of
its blocks (or one), so that every two members meet in one cell. (A group that chains have made too large
is dealt bucket by bucket instead.) A cell counts the common shingles of all its sets at once. So every
proposed pair is compared or inside one component already, and no list of pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwave.llm.common import LOWER, Scratch, encoded, few, fresh, mixed, saved, slices, word_ids
from emberwave.operators.graph import components
from emberwave.plans.shared import dealt_anew, release

PERMUTATIONS, ROWS = 126, 6
#: Members of a block. Buckets above it are thinned by a star first, and by more while one is above
#: STAR_MEMBERS, MAX_STARS at most.
BLOCK_MEMBERS, STAR_MEMBERS, MAX_STARS = 128, 2048, 4
#: Members of a group that is dealt as a whole.
GROUP_MEMBERS = 8192

_SIGNED = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>"


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """64 bits of each word: a polynomial of its bytes, spread."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts in one array, and where each text's begin.

    A text with fewer words than ``size`` has its whole sequence as one shingle; without words, none.
    """
    ids, starts, words = word_ids(texts, LOWER)
    hashes = _word_hashes(words)[ids] if len(words) else np.zeros(0, np.uint64)
    sets, bounds = [], np.zeros(len(texts) + 1, np.int64)
    for k in range(len(texts)):
        own = hashes[starts[k] : starts[k + 1]]
        width = min(size, len(own))
        if width:
            n = len(own) - width + 1
            value = np.full(n, width, np.uint64)
            for j in range(width):
                value = mixed(value + own[j : j + n])
            own = np.unique(value)
        sets.append(own)
        bounds[k + 1] = bounds[k] + len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), bounds


def signatures(values: np.ndarray, bounds: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """(sets, 2 * permutations) values: all minima, then all maxima. Sets must not be empty."""
    random = np.random.default_rng(20_011)
    factors = random.integers(1, 2**63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = random.integers(0, 2**63, permutations, np.uint64)
    out = np.empty((len(bounds) - 1, 2 * permutations), np.uint64)
    for p in range(permutations):
        hashed = values * factors[p] + offsets[p]
        hashed ^= hashed >> np.uint64(29)
        out[:, p] = np.minimum.reduceat(hashed, bounds[:-1])
        out[:, permutations + p] = np.maximum.reduceat(hashed, bounds[:-1])
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band, different for equal values of different bands."""
    n_bands = signature.shape[1] // rows
    grouped = signature[:, : n_bands * rows].reshape(len(signature), n_bands, rows)
    key = np.broadcast_to(np.arange(1, n_bands + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for r in range(rows):
        key = mixed(key + grouped[:, :, r])
    return key


def _sign(size: int, permutations: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values, bounds = shingle_sets(encoded(part.column("text")), size)
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            a, b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            lists = np.zeros(len(n) + 1, np.int64)
            keys = np.zeros((0, 0), np.uint64)
            if full.size:
                edges = np.r_[bounds[full], bounds[-1]]
                a[full] = np.add.reduceat(mixed(values), edges[:-1])
                b[full] = np.add.reduceat(mixed(values ^ np.uint64(0x9E3779B97F4A7C15)), edges[:-1])
                keys = band_keys(signatures(values, edges, permutations), rows)
                lists[1:] = np.cumsum(np.where(n > 0, keys.shape[1], 0))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "text_key": part.column("text_key"),
                    "n_shingles": n,
                    "set_a": a.view(np.int64),
                    "set_b": b.view(np.int64),
                    "bands": pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(keys.ravel().view(np.int64))),
                }
            )

    return run


def _close(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are linked."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    found = np.searchsorted(y, x)
    common = int(np.count_nonzero(y[np.minimum(found, len(y) - 1)] == x)) if len(y) else 0
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def _sets_of(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The set of each text; equal texts share theirs."""
    distinct = list(dict.fromkeys(texts))
    values, bounds = shingle_sets(distinct, size)
    own = {x: values[bounds[k] : bounds[k + 1]] for k, x in enumerate(distinct)}
    return [own[x] for x in texts]


def _confirm(size: int, percent: int):
    """Keeps the pairs whose full sets are close enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_a"):
            sets = _sets_of(encoded(part.column("text_a")) + encoded(part.column("text_b")), size)
            keep = [_close(sets[k], sets[part.num_rows + k], percent) for k in range(part.num_rows)]
            yield pa.RecordBatch.from_pydict({"a": part.column("a"), "b": part.column("b")}).filter(pa.array(keep, pa.bool_()))

    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the shingles that two or more of the sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.r_[True, values[1:] != values[:-1]]
    place = np.cumsum(first) - 1
    shared = np.bincount(place)[place] > 1
    owner, place = owner[shared], place[shared]
    place = np.cumsum(np.r_[False, place[1:] != place[:-1]]) if len(place) else place
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 16_384
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [start, start + width])
        held = np.zeros((len(sets), min(width, int(place[-1]) + 1 - start)), np.float32)
        held[owner[a:b], place[a:b] - start] = 1
        out += held @ held.T
    return out.astype(np.int64)


def _cell_pairs(nodes: list[int], own: list[int], block: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """The links of a cell's members that join what is not joined yet."""
    if len(set(own)) < 2:
        return
    common, size = _common(sets), np.array([len(x) for x in sets])
    linked = (common > 0) & (100 * common >= percent * (size[:, None] + size[None, :] - common))
    blocks, owns = np.array(block), np.array(own)
    linked &= owns[:, None] != owns[None, :]
    if len(set(block)) > 1:
        linked &= blocks[:, None] != blocks[None, :]
    parent = {x: x for x in own}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(*(x.tolist() for x in np.nonzero(np.triu(linked, 1))), strict=True):
        if root(own[a]) != root(own[b]):
            parent[root(own[b])] = root(own[a])
            yield nodes[a], nodes[b]


def _compare_cells(size: int, percent: int):
    """Compares cell by cell; rows come sorted by cell, and a cell may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def compared(table: pa.Table, cuts: list[int]) -> pa.RecordBatch:
            nodes, own, block = (table.column(c).to_pylist() for c in ("node", "own", "block"))
            sets = _sets_of(encoded(table.column("text").combine_chunks()), size)
            links = [x for s, e in zip(cuts, cuts[1:], strict=False) for x in _cell_pairs(nodes[s:e], own[s:e], block[s:e], sets[s:e], percent)]
            return pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

        for part in slices(batches):
            table = pa.Table.from_batches([part])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            keys = np.array([table.column(c).to_numpy() for c in ("key", "low", "high")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            rest = table.slice(cuts[-1])
            if cuts[-1]:
                yield compared(table, cuts)
        if rest is not None:
            yield compared(rest, [0, rest.num_rows])

    return run


def _texts(scratch: Scratch, own: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text): one text for each node that meets another in a bucket."""
    wanted = sets.join(members.select("node").distinct(), "node", "left_semi")
    wanted = few(scratch.saved(wanted.select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")), "wanted"))
    found = own.select("doc_id", "text", F.xxhash64("text").alias("text_key")).join(wanted, F.expr("text_key = rep_key AND doc_id <=> rep_id"))
    texts = scratch.saved(found.groupBy("node").agg(F.min("text").alias("text")), "texts")
    release(own.sparkSession)
    return texts


def _open_members(scratch: Scratch, members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(node, bucket, own, m): members of buckets with several components, and how many the bucket has."""
    state = _labelled(members.select("node", "bucket"), groups).repartition("bucket")
    several = state.groupBy("bucket").agg(F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("m")).where("low <> high")
    return scratch.saved(state.join(several.select("bucket", "m"), "bucket"), "open")


def _star_links(scratch: Scratch, members: DataFrame, texts: DataFrame, turn: int, size: int, percent: int) -> DataFrame:
    """Links of the members of large buckets to one centre each; the hash that picks it is the turn's."""
    centres = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node"), "node", "own")).alias("c"))
    centres = scratch.saved(centres.select("bucket", F.col("c.node").alias("a"), F.col("c.own").alias("own_a")), "centres")
    pairs = members.withColumnRenamed("node", "b").join(centres, "bucket").where("own <> own_a").select("a", "b").distinct()
    # Members bring their texts first, as they are many and centres few.
    pairs = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return scratch.saved(pairs.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(size, percent), "a long, b long"), "stars")


def _labelled(nodes: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``nodes`` with own, the component that links have joined a node to so far."""
    if groups is None:
        return nodes.withColumn("own", F.col("node"))
    return nodes.join(groups, "node", "left").withColumn("own", F.coalesce("component", "node")).drop("component")


def _dealt(scratch: Scratch, members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(key, node, own, m): the open members by group, or by bucket where their group is too large."""
    lowest = members.groupBy("bucket").agg(F.min("node").alias("low"))
    chained = components(members.join(lowest, "bucket").select("node", "low"), "node", "low", scratch).withColumnRenamed("component", "chain")
    sizes = chained.groupBy("chain").agg(F.count("*").alias("size"))
    grouped = scratch.saved(_labelled(chained.join(sizes, "chain"), groups), "groups")
    whole = grouped.where(F.col("size") <= GROUP_MEMBERS).select(F.col("chain").alias("key"), "node", "own", F.col("size").alias("m"))
    parts = members.join(grouped.where(F.col("size") > GROUP_MEMBERS).select("node", "own"), "node")
    return whole.unionByName(parts.select(F.col("bucket").alias("key"), "node", "own", "m"))


def _cell_links(scratch: Scratch, members: DataFrame, groups: DataFrame | None, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between all members that share a bucket and are in different components."""
    dealt = _dealt(scratch, members, groups).withColumn("blocks", F.ceil(F.col("m") / BLOCK_MEMBERS)).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cells = dealt.select("key", "node", "own", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = cells.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    full = cells.join(texts, "node").select("key", "low", "high", "node", "own", "block", "text")
    sorted_ = full.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return scratch.saved(sorted_.mapInArrow(_compare_cells(size, percent), "a long, b long").distinct(), "cells")


def _groups(scratch: Scratch, members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of the nodes that are linked. Only large buckets are looked at again after a star."""
    links = groups = None
    rest = _open_members(scratch, members, None)
    small, large = rest.where(F.col("m") <= BLOCK_MEMBERS), rest.where(F.col("m") > BLOCK_MEMBERS)
    for turn in range(MAX_STARS):
        largest = large.agg(F.max("m")).first()[0] or 0
        if largest <= (STAR_MEMBERS if turn else 0):
            break
        found = _star_links(scratch, large, texts, turn, size, percent)
        links = found if links is None else links.unionByName(found)
        groups = scratch.saved(components(links, scratch=scratch), "joined")
        large = _open_members(scratch, large.select("node", "bucket"), groups)
    found = _cell_links(scratch, small.unionByName(large).select("node", "bucket", "m"), groups, texts, size, percent)
    links = found if links is None else links.unionByName(found)
    return components(links, scratch=scratch)


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80, permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """A row per row of ``documents``: doc_id, n_shingles, component_id, kept, and text_key and group.

    Documents are linked when 100 * |A & B| >= ``percent`` * |A | B| for their sets of ``size``-word
    shingles; component_id is the smallest doc_id reachable and ``group`` an id of the component. A text
    without words, null or empty, is linked with nothing, not even with another such text, and has no
    group. Rows that repeat a doc_id share a component when their sets do; null names a component only
    if none of its rows has a doc_id. An empty table gives no rows. Columns other than doc_id and text
    are not read, whatever their names. Texts are used whole. Sets are told apart by 128 bits and
    compared by the 64-bit hashes of their shingles.
    """
    scratch = Scratch(documents.sparkSession, "near")
    own = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text"))
    signed = scratch.saved(_signed(own, size, permutations, rows), "signed")
    filled = signed.where("n_shingles > 0")
    sets = filled.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("bands").alias("bands")
    )
    sets = scratch.saved(sets.withColumnRenamed("set_a", "node"), "sets")
    # One shuffle serves both the count of a bucket's sets and the join with it.
    buckets = sets.select("node", F.explode("bands").alias("bucket")).repartition("bucket")
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = scratch.saved(buckets.join(shared.select("bucket"), "bucket").select("node", "bucket"), "members")
    groups = _groups(scratch, members, _texts(scratch, own, sets, members), size, percent)
    named = sets.select("node", "set_b", "first_id")
    named = scratch.saved(named.join(groups, "node", "left").select("node", "set_b", "first_id", F.coalesce("component", "node").alias("group")), "named")
    lowest = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    named = named.join(dealt_anew(lowest, "group"), "group").drop("first_id")
    named = scratch.saved(named.withColumnRenamed("node", "set_a"), "components")
    linked = filled.select("doc_id", "n_shingles", "text_key", "set_a", "set_b").join(named, ["set_a", "set_b"])
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key", F.lit(None).cast("long").alias("group"))
    rows_of = linked.select(alone.columns).unionByName(alone)
    found = rows_of.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"), "text_key", "group")
    return scratch.result(found, "near_duplicates")


def _signed(own: DataFrame, size: int, permutations: int, rows: int) -> DataFrame:
    return own.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(_sign(size, permutations, rows), _SIGNED)


def keep_one(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each component: the smallest doc_id, and of its rows one text.

    A null doc_id stands for a component only if none of its rows has one. Of equal rows one stays. Rows
    without words, null or empty, are all kept; an empty table gives none. Columns stay as they are, whatever
    their names.
    """
    found = near_duplicates(documents, size, percent).where("group IS NOT NULL").select("doc_id", "text_key", "group")
    chosen = found.groupBy("group").agg(F.min(F.struct(F.expr("doc_id IS NULL").alias("none"), "doc_id", "text_key")).alias("rep"))
    # A group's rows beside its chosen one go; rows equal to the chosen one are thinned to one below.
    rows_by_key = found.groupBy("group", "doc_id", "text_key").agg(F.count("*").alias("n")).join(dealt_anew(chosen, "group"), "group")
    is_rep = F.expr("doc_id <=> rep.doc_id AND text_key = rep.text_key")
    key, gone_id, gone_key = fresh(documents, "text_key", "gone_id", "gone_key")
    marked = saved(rows_by_key.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key), "n", is_rep.alias("rep")), "marked")
    keyed = documents.withColumn(key, F.xxhash64(documents["text"].cast("string")))

    def on(frame: DataFrame):
        return (keyed[key] == frame[gone_key]) & keyed["doc_id"].cast("long").eqNullSafe(frame[gone_id])

    gone = few(saved(marked.where("NOT rep OR n > 1").select(gone_id, gone_key), "gone"))
    repeated = few(saved(marked.where("rep AND n > 1").select(gone_id, gone_key), "repeated"))
    single = keyed.join(gone, on(gone), "left_anti")
    one = keyed.join(repeated, on(repeated), "left_semi").dropDuplicates(["doc_id", key])
    return single.unionByName(one).select(documents.columns)
