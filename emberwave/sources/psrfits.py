"""Sub-integrations of PSRFITS search files: a minimal FITS binary-table reader.

A FITS file is a chain of 2880-byte blocks: header cards of 80 characters, then data. Only what search
files need is read: the primary header, and the columns DATA, DAT_OFFS, DAT_SCL, DAT_WTS and DAT_FREQ of
the table SUBINT. Files lie in any filesystem that ``stores`` opens, and a task reads its rows by seeking.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from emberwave.sources import stores

BLOCK, CARD = 2880, 80
# The FITS codes of column types and their big-endian forms.
FORMS = {"B": ">u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8", "A": "S1", "L": "S1"}
SUBINTS = "isub int, data binary, dat_offs array<float>, dat_scl array<float>, dat_wts array<float>, dat_freq array<double>"


def cards(file) -> dict:
    """One header unit; the file stands behind it afterwards."""
    found: dict = {}
    while True:
        block = file.read(BLOCK)
        if len(block) < BLOCK:
            raise EOFError
        for k in range(0, BLOCK, CARD):
            card = block[k : k + CARD].decode("ascii", "replace")
            name = card[:8].strip()
            if name == "END":
                return found
            if card[8:10] == "= ":
                text = card[10:].strip()
                quoted = re.match(r"'((?:[^']|'')*)'", text)
                plain = text.split("/")[0].strip()
                found[name] = quoted[1].replace("''", "'").rstrip() if quoted else plain == "T" if plain in ("T", "F") else float(plain) if re.search("[.ED]", plain) else int(plain or 0)


def data_size(header: dict) -> int:
    """Bytes of a unit's data, filled up to whole blocks."""
    axes = [header[f"NAXIS{k + 1}"] for k in range(header.get("NAXIS", 0))]
    size = abs(header.get("BITPIX", 8)) // 8 * math.prod(axes) + header.get("PCOUNT", 0) if axes else 0
    return -(-size // BLOCK) * BLOCK


@dataclass
class SearchFile:
    primary: dict
    table: dict
    start: int
    columns: dict[str, tuple[int, np.dtype, int]]

    @classmethod
    def open(cls, path: str, factory: str | None = None) -> SearchFile:
        with stores.opened(path, factory) as file:
            primary = cards(file)
            file.seek(data_size(primary), 1)
            while True:
                table = cards(file)
                if table.get("EXTNAME") == "SUBINT":
                    break
                file.seek(data_size(table), 1)
            columns, at = {}, 0
            for k in range(1, table["TFIELDS"] + 1):
                n, code = re.match(r"(\d*)([A-Z])", table[f"TFORM{k}"]).groups()
                kind, count = np.dtype(FORMS[code]), int(n or 1)
                columns[table[f"TTYPE{k}"]] = (at, kind, count)
                at += kind.itemsize * count
            return cls(primary, table, file.tell(), columns)

    def row(self, file, isub: int) -> dict[str, np.ndarray]:
        width = self.table["NAXIS1"]
        file.seek(self.start + isub * width)
        data = file.read(width)
        return {n: np.frombuffer(data, kind, count, at) for n, (at, kind, count) in self.columns.items()}


def spectra(row: dict[str, np.ndarray], nchan: int, nbits: int, scaled: bool = True) -> np.ndarray:
    """(samples, channels) of a sub-integration, scaled, offset and weighted."""
    data = row["DATA"]
    if nbits == 2:
        data = np.array([(data >> s & 3) << 6 for s in (6, 4, 2, 0)]).T.ravel()
    elif nbits == -32:
        data = data.astype(float)
    elif nbits != 8:
        raise ValueError(f"unsupported bit depth: {nbits}")
    data = data.reshape(-1, nchan).astype(float)
    return (data * row["DAT_SCL"] + row["DAT_OFFS"]) * row["DAT_WTS"] if scaled else data


def averaged(x: np.ndarray, mchan: int, msamp: int, mask_dc: bool = False) -> np.ndarray:
    """Means over channels, then over samples, of a sub-integration; missing values do not count."""
    if x.shape[0] % msamp:
        raise ValueError(f"{x.shape[0]} samples do not divide into groups of {msamp}")
    x = x.copy()
    if mask_dc:
        x[:, ::16] = np.nan
    with np.errstate(invalid="ignore"):
        return np.nanmean(np.nanmean(x.reshape(x.shape[0], -1, mchan), axis=2).reshape(-1, msamp, x.shape[1] // mchan), axis=1)


@dataclass
class Rows(InputPartition):
    path: str
    start: int
    stop: int


#: What a row holds beside its data: columns of the table, and the columns here.
_LISTS = (("DAT_OFFS", "f4", pa.float32()), ("DAT_SCL", "f4", pa.float32()), ("DAT_WTS", "f4", pa.float32()), ("DAT_FREQ", "f8", pa.float64()))


class SubintReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.step, self.factory = options["path"], int(options.get("rows_per_task", "64")), options.get("filesystem")
        self.first, self.last = int(options.get("first_subint", "0")), int(options.get("last_subint", "-1"))
        self.with_path = options.get("with_path", "false") == "true"

    def partitions(self) -> list[Rows]:
        found = []
        for path in stores.paths(self.path, ".fits", self.factory):
            n = SearchFile.open(path, self.factory).table["NAXIS2"]
            stop = n if self.last < 0 else min(n, self.last + 1)
            found += [Rows(path, a, min(a + self.step, stop)) for a in range(self.first, stop, self.step)]
        return found or [Rows("", 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        found = SearchFile.open(partition.path, self.factory)
        with stores.opened(partition.path, self.factory) as file:
            for isub in range(partition.start, partition.stop):
                row = found.row(file, isub)
                lists = {c.lower(): pa.array([row[c].astype(k)], pa.list_(t)) for c, k, t in _LISTS}
                own = {"isub": pa.array([isub], pa.int32()), "data": pa.array([row["DATA"].tobytes()], pa.binary()), **lists}
                yield pa.RecordBatch.from_pydict({"path": pa.array([partition.path]), **own} if self.with_path else own)


class Subints(DataSource):
    @classmethod
    def name(cls) -> str:
        return "psrfits"

    def schema(self) -> str:
        return f"path string, {SUBINTS}" if self.options.get("with_path", "false") == "true" else SUBINTS

    def reader(self, schema) -> SubintReader:
        return SubintReader(self.options)


def read(spark: SparkSession, path: str, factory: str | None = None, with_path: bool = False) -> DataFrame:
    """The sub-integrations of all files that ``path`` names."""
    spark.dataSource.register(Subints)
    options = {"with_path": str(with_path).lower()} | ({"filesystem": factory} if factory else {})
    return spark.read.format("psrfits").options(**options).load(path)


def header_cards(spark: SparkSession, path: str, factory: str | None = None) -> DataFrame:
    """(path, unit, key, value) of the cards of all files that ``path`` names; unit is PRIMARY or SUBINT.

    A task reads the headers of its files alone.
    """
    files = spark.createDataFrame([(x,) for x in stores.paths(path, ".fits", factory)], "path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column("path").to_pylist():
                found = SearchFile.open(name, factory)
                rows += [(name, unit, k, str(v)) for unit, held in (("PRIMARY", found.primary), ("SUBINT", found.table)) for k, v in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], ["path", "unit", "key", "value"])

    return files.repartition(max(1, min(200, files.count()))).mapInArrow(run, "path string, unit string, key string, value string")


def window(detect_s: float, window_s: float, subint_s: float, n: int) -> tuple[int, int]:
    """First and last sub-integration of a time window, for the reader's options."""
    return max(0, int((detect_s - window_s) // subint_s)), min(n - 1, int((detect_s + window_s) // subint_s))
