"""What the training-data operators share: the shared folder, batches of text, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwave.plans.shared import Scratch, saved, shared_dir

__all__ = ["BROADCAST_KEYS", "DOCUMENT_COLUMNS", "LOWER", "SLICE_BYTES", "Scratch", "encoded", "few", "fresh", "mixed", "saved", "shared_dir", "slices", "word_ids"]

#: The documents table, which the stages of the pipeline hand on.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Text bytes that are worked on at once in a Python worker; one longer text is one slice.
SLICE_BYTES = 2_000_000

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


#: Keys that joins broadcast, some tens of bytes each; with more, both sides of a join shuffle.
BROADCAST_KEYS = 500_000


def few(keys: DataFrame, most: int | None = None) -> DataFrame:
    """``keys``, a written table, marked for broadcast if its rows are counted to be few."""
    return F.broadcast(keys) if keys.count() <= (BROADCAST_KEYS if most is None else most) else keys


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``frame`` does not have, whatever case its own are in."""
    held, out = {x.lower() for x in frame.columns}, []
    for name in names:
        own = f"_{name}"
        while own.lower() in held:
            own = f"_{own}"
        held.add(own.lower())
        out.append(own)
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches where the bytes of ``column`` reach ``most``; no row is cut or lost."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, end - start)


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null gives an empty one."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


#: Makes A-Z lower case and leaves every other byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_ids(texts: list[bytes], table: bytes | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words between ASCII white space as (id of each word, start of each text, words by id).

    ``bytes.split()`` cuts at exactly 0x20 and 0x09-0x0D, none of which occurs inside a UTF-8
    sequence. ``table`` translates bytes first.
    """
    words: list[bytes] = []
    starts = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        words += (text.translate(table) if table else text).split()
        starts[k + 1] = len(words)
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, coded.dictionary.to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the SplitMix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_B
    return x ^ (x >> np.uint64(31))
