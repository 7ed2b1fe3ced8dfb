"""Token-id files: one array of ids and Elias-Fano coded document boundaries.

A shard is one file: the ids of all its documents end to end (two bytes each while the vocabulary
allows, else four), then the end of every document and every doc_id as Elias-Fano sequences, then a
footer. An Elias-Fano sequence keeps the low bits of each value packed and the high parts as a unary bit
vector; ``select`` finds the i-th value from a sampled position, without a table of 64-bit offsets.

Each task writes a file of its own name and reports it in a row; the rows are written as a table, the
manifest, which Spark commits for the winning attempts alone. What a lost or repeated task left is in no
manifest, and readers open nothing else.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberwave.llm.common import shared_dir, slices

MAGIC = b"EWTOKEN1"
SAMPLE = 512
#: Bytes of each of the two generations of pieces and ids that a task remembers, a piece counted with what Python
#: adds to it; longer pieces are coded each time they come and kept by none.
CACHE_BYTES, PIECE_CHARS, PIECE_BYTES = 40_000_000, 256, 200
#: Pieces that the library gets as one line, texts that it gets at once, and text bytes that are cut into pieces at once.
LINE, BATCH, CUT_BYTES = 64, 128, 6_000_000
#: The pre-tokenizer with GPT-2's pattern, which has no match with a letter before something else.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: Ids that a reader holds at once.
READ_IDS = 4_000_000

SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
MANIFEST = "partition int, name string, n_docs long, n_ids long"


class EliasFano:
    """A sequence of non-decreasing numbers from 0, coded in about 2 + log2(universe / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, np.uint32))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        places = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little").tobytes(), ones[::SAMPLE].astype(np.uint32))

    def tobytes(self) -> bytes:
        head = json.dumps([self.n, self.low_bits, len(self.low), len(self.high)]).encode()
        return len(head).to_bytes(4, "little") + head + self.low + self.high + self.samples.astype("<u4").tobytes()

    @classmethod
    def frombytes(cls, data: bytes) -> EliasFano:
        size = 4 + int.from_bytes(data[:4], "little")
        n, low_bits, a, b = json.loads(data[4:size])
        return cls(n, low_bits, data[size : size + a], data[size + a : size + a + b], np.frombuffer(data[size + a + b :], "<u4"))

    def _low(self, start: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - start, np.uint64)
        first, last = start * self.low_bits, end * self.low_bits
        packed = np.frombuffer(self.low, np.uint8)[first // 8 : (last + 7) // 8]
        bits = np.unpackbits(packed, bitorder="little")[first % 8 : first % 8 + last - first]
        return bits.reshape(-1, self.low_bits).astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        high = np.frombuffer(self.high, np.uint8)
        byte, seen = at // 8, -int(np.bitwise_count(high[at // 8] & ((1 << at % 8) - 1)))
        while True:
            counts = np.cumsum(np.bitwise_count(high[byte : byte + SAMPLE]), dtype=np.int64) + seen
            if counts[-1] > left:
                k = int(np.searchsorted(counts, left, "right"))
                before = int(counts[k - 1]) if k else seen
                inside = np.flatnonzero(np.unpackbits(high[byte + k : byte + k + 1], bitorder="little"))[left - before]
                position = (byte + k) * 8 + int(inside)
                return ((position - i) << self.low_bits) | int(self._low(i, i + 1)[0])
            byte, seen = byte + SAMPLE, int(counts[-1])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)


#: White space of any library, for character classes of Python and of Arrow.
_WHITE = "\t-\r\x1c-\x20\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space between two characters of which neither is white space: byte-level pre-tokenizers always cut there.
_GAP = re.compile(f"(?<=[^{_WHITE}])(?= [^{_WHITE}])")
#: Any other space.
_ODD = f"[{_WHITE}] | [{_WHITE}]|\\A | \\z"
#: Bytes by what they are: a space 1, a letter 2, ASCII that is neither 3, else 0.
_CLASS = np.array([(b == 32) + 2 * chr(b).isalpha() + 3 * (b != 32 and not chr(b).isalpha()) if b < 128 else 0 for b in range(256)], np.uint8)


def _behind_letters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the places ``at`` behind a letter up to U+023F."""
    at = at[at > 0]
    last, lead = data[at - 1], data[np.maximum(at - 2, 0)]
    # Two bytes from C3 80 to C8 BF are letters but for the signs of multiplication and division.
    two = (last >> 6 == 2) & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    return at[(_CLASS[last] == 2) | two]


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct piece of them once.

    Texts are cut before such spaces and, where the pre-tokenizer is known to cut there, behind words that something
    else than a letter follows, so that a word is coded once whatever stands behind it. Arrow finds the distinct pieces.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        # The byte-level form of a space is U+0120.
        self.spaced = np.zeros(self.library.get_vocab_size(), bool)
        self.spaced[[i for token, i in self.library.get_vocab().items() if token.startswith("\u0120")]] = True
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        before = json.loads(self.library.pre_tokenizer.__getstate__()) if self.library.pre_tokenizer else {}
        self.cuts_words = self.library.normalizer is None and before == BYTE_LEVEL
        #: Pieces that begin texts or stand behind words; pieces that begin with a space, of this generation and the last.
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.chars = 0

    def forget(self) -> None:
        """Gives the memory of pieces back, as a worker outlives its tasks and waits beside those of other stages."""
        self.first, self.rest, self.old, self.chars = {}, {}, {}, 0
        pa.default_memory_pool().release_unused()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        # What the library returns takes some hundred bytes a token.
        coded = (self.library.encode_batch_fast(texts[k : k + BATCH], add_special_tokens=False) for k in range(0, len(texts), BATCH))
        return [np.array(x.ids, self.kind) for x in chain.from_iterable(coded)]

    def _learn_firsts(self, pieces: list[str]) -> None:
        for piece, ids in zip(pieces, self._ids(pieces), strict=True):
            self.first[piece] = ids.tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces that begin with a space. Those without another are coded as lines of many: a
        token that begins with a space begins a piece there."""
        plain = [x for x in pieces if x.rfind(" ") == 0]
        lines = [plain[k : k + LINE] for k in range(0, len(plain), LINE)]
        for line, ids in zip(lines, self._ids(["".join(x) for x in lines]), strict=True):
            data, size = ids.tobytes(), self.kind.itemsize
            cuts = (np.flatnonzero(self.spaced[ids]) * size).tolist() + [len(data)]
            if len(cuts) == len(line) + 1:
                self.rest.update(zip(line, map(data.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
        left = [x for x in pieces if x not in self.rest]
        for piece, ids in zip(left, self._ids(left), strict=True):
            self.rest[piece] = ids.tobytes()

    def _cut(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of texts without odd spaces or added tokens, and the first piece of each text."""
        column = column.cast(pa.large_string())
        _, ends, held = column.buffers()
        ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(held or b"", np.uint8)[ends[0] : ends[-1]]
        kinds, starts = _CLASS[data], ends - ends[0]
        cuts = kinds == 1
        if self.cuts_words:
            cuts[_behind_letters(data, np.flatnonzero(kinds == 3))] = True
        cuts[starts[:-1][starts[:-1] < starts[1:]]] = True
        begins = np.append(np.flatnonzero(cuts), len(data))
        pieces = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(data))
        return pieces, np.searchsorted(begins, starts)

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        coded = list(map(self.rest.get, pieces))
        new, new_first = {}, {}
        for k in [k for k, x in enumerate(coded) if x is None]:
            piece = pieces[k]
            if not piece.startswith(" "):
                coded[k] = self.first.get(piece)
            elif piece in self.old:
                coded[k] = self.rest[piece] = self.old[piece]
            if coded[k] is None:
                (new if piece.startswith(" ") else new_first)[piece] = k
        self._learn(list(new))
        self._learn_firsts(list(new_first))
        for known, learned in ((self.rest, new), (self.first, new_first)):
            for piece, k in learned.items():
                coded[k] = known[piece]
                if len(piece) > PIECE_CHARS:
                    del known[piece]
        self.chars += 3 * sum(len(x) for x in new if len(x) <= PIECE_CHARS)
        return coded

    def _coded(self, pieces: pa.Array, starts: np.ndarray) -> Iterator[bytes]:
        """Ids of texts from their pieces and the first piece of each text."""
        found = pieces.dictionary_encode()
        coded = self._known(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, ends, held = pa.array(coded, pa.large_binary()).take(found.indices).buffers()
        cuts, data = np.frombuffer(ends, np.int64)[starts].tolist(), memoryview(held or b"")
        return (bytes(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        # A piece has few bytes more than characters, and ids of two or four bytes each.
        if len(self.rest) * PIECE_BYTES + self.chars > CACHE_BYTES:
            self.old, self.rest, self.chars = self.rest, {}, 0
        if len(self.first) * 2 * PIECE_BYTES > CACHE_BYTES:
            self.first.clear()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, _ODD)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(column, token))
        plain, odd = np.flatnonzero(pc.invert(odd)), np.flatnonzero(odd)
        coded = dict(zip(plain.tolist(), self._coded(*self._cut(column.take(pa.array(plain)))), strict=True))
        if len(odd):
            cut = [_GAP.split(x) if x else [] for x in column.take(pa.array(odd)).to_pylist()]
            starts = np.cumsum([0, *map(len, cut)])
            coded.update(zip(odd.tolist(), self._coded(pa.array(chain.from_iterable(cut), pa.large_string()), starts), strict=True))
        return [coded[k] for k in range(len(column))]


def open_path(path: str):
    """The filesystem and path of a URI, or of a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


@lru_cache(maxsize=2)
def encoder_of(file: str) -> Encoder:
    """One encoder for all tasks of a worker, so that its vocabulary is read once."""
    return Encoder(file)


def _write_shards(path: str, tokenizer: str, end_id: int):
    """Writes a task's documents as one shard and reports it; a task without documents writes none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = slices(batches, most=CUT_BYTES)
        first = next(parts, None)
        if first is None:
            return
        place, folder = open_path(path)
        name = f"shard-{uuid.uuid4().hex}.tok"
        place.create_dir(folder, recursive=True)
        encoder = encoder_of(tokenizer_file(tokenizer))
        end = np.array([end_id], encoder.kind).tobytes()
        lengths, ids = [], []
        with place.open_output_stream(f"{folder}/{name}") as out:
            for part in chain([first], parts):
                coded = encoder.encode(part.column("text").fill_null(""))
                for x in coded:
                    out.write(x + end)
                lengths += [len(x) // encoder.kind.itemsize + 1 for x in coded]
                ids += part.column("doc_id").to_pylist()
            encoder.forget()
            none = sum(x is None for x in ids)
            least = ids[none] if none < len(ids) else 0
            ends = EliasFano.of(np.cumsum(lengths, dtype=np.uint64)).tobytes()
            docs = EliasFano.of(np.array([x - least for x in ids[none:]], np.uint64)).tobytes()
            out.write(ends + docs)
            footer = {"ids": sum(lengths), "id_bytes": encoder.kind.itemsize, "ends": len(ends), "docs": len(docs), "n_docs": len(ids), "null_ids": none, "least_id": least}
            tail = json.dumps(footer).encode()
            out.write(tail + len(tail).to_bytes(4, "little") + MAGIC)
        yield pa.RecordBatch.from_pydict({"partition": pa.array([TaskContext.get().partitionId()], pa.int32()), "name": [name], "n_docs": [len(ids)], "n_ids": [sum(lengths)]})

    return run


class ShardFile:
    """A shard opened for reading: the offsets of any document, and its ids."""

    def __init__(self, path: str) -> None:
        place, name = open_path(path)
        self.file = place.open_input_file(name)
        size = self.file.size()
        head = self.file.read_at(12, size - 12)
        if head[4:] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        n = int.from_bytes(head[:4], "little")
        self.footer = json.loads(self.file.read_at(n, size - 12 - n))
        self.kind = np.dtype(f"<u{self.footer['id_bytes']}")
        at = self.footer["ids"] * self.kind.itemsize
        self.ends = EliasFano.frombytes(self.file.read_at(self.footer["ends"], at))
        self.docs = EliasFano.frombytes(self.file.read_at(self.footer["docs"], at + self.footer["ends"]))

    def span(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def ids(self, start: int, end: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((end - start) * self.kind.itemsize, start * self.kind.itemsize), self.kind)

    def doc_ids(self) -> list[int | None]:
        least = self.footer["least_id"]
        return [None] * self.footer["null_ids"] + [x + least for x in self.docs.all().tolist()]


def _read_shards(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(ShardFile(f"{path}/{row['name']}"), row["start"], with_ids)

    return run


def _documents(shard: ShardFile, start: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """A shard's documents, some READ_IDS ids at a time."""
    ends, docs = shard.ends.all().astype(np.int64), shard.doc_ids()
    begins = np.r_[0, ends[:-1]]
    block = (ends - 1) // READ_IDS
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        ids = shard.ids(int(begins[a]), int(ends[b - 1])).astype("<u4")
        at = (begins[a:b] - begins[a]).tolist() + [len(ids)]
        columns = {
            "doc_id": pa.array(docs[a:b], pa.int64()),
            "start": begins[a:b] + start,
            "n_tokens": ends[a:b] - begins[a:b],
            "ids_crc32": pa.array([zlib.crc32(ids[x:y]) for x, y in zip(at, at[1:], strict=False)], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_pydict(columns)


def tokenizer_file(name: str) -> str:
    """A path as it is, and a bare name among the public vocabulary files of the machine that asks."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Writes the ids of ``documents`` (doc_id, text) in ascending doc_id order, ``end_id`` after each.

    Null doc_ids come first; rows of one doc_id lie in the order of their texts' hashes. A null or empty
    text has only the end id. Every row is written, repeated ones too; an empty table gives an empty
    manifest. Other columns are not read.
    """
    text = documents["text"].cast("string")
    own = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("order"))
    ranged = own.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order").select("doc_id", "text")
    ranged.mapInArrow(_write_shards(path, tokenizer, end_id), MANIFEST).write.parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files; with ``ids``, the ids too.

    A row of the manifest is a file, so their number is that of the writing tasks; each is read by a
    task of its own. A manifest without rows gives none.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    schema = f"{SCHEMA}, ids array<int>" if ids else SCHEMA
    return shards.repartition(max(1, manifest.count())).mapInArrow(_read_shards(path, ids), schema)


def through_files(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes token files to the shared folder and reads them back: ``read_tokens`` of ``write_tokens``.

    A row per row of ``documents``, repeated ones too; a null doc_id comes first, a null or empty text has
    only the end id, an empty table gives none. Other columns are not read, whatever their names.
    """
    path = shared_dir(documents.sparkSession, "tokens")
    write_tokens(documents, path, tokenizer, end_id)
    return read_tokens(documents.sparkSession, path)
