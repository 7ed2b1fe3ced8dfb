"""Dedispersed series as pairs of files: ``name.dat`` with float32 samples, ``name.inf`` with what they are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwave.functions.names import dm_of
from emberwave.plans.shared import saved
from emberwave.sources import stores
from emberwave.sources.textfiles import parse_sidecar

# The sidecar's labels, in the order of its lines, and the fields of a header that fill them.
LABELS = (
    ("Data file name without suffix", "name", "%s"),
    ("Telescope used", "telescope", "%s"),
    ("Instrument used", "instrument", "%s"),
    ("Object being observed", "source_name", "%s"),
    ("J2000 Right Ascension (hh:mm:ss.ssss)", "src_raj", "%s"),
    ("J2000 Declination     (dd:mm:ss.ssss)", "src_dej", "%s"),
    ("Epoch of observation (MJD)", "tstart", "%s"),
    ("Dispersion measure (cm-3 pc)", "dm", "%.2f"),
    ("Number of bins in the time series", "bins", "%d"),
    ("Width of each time series bin (sec)", "width", "%.6f"),
    ("Total bandwidth (MHz)", "bandwidth", "%.6f"),
    ("Number of channels", "nchans", "%d"),
    ("Channel bandwidth (MHz)", "channel", "%.6f"),
)
_UNKNOWN = {"telescope": "LOFAR", "instrument": "Unknown", "source_name": "Unknown", "src_raj": "00:00:00.0000", "src_dej": "+00:00:00.0000", "tstart": 0.0}
FILES = "file string, bins long"


def sidecar(name: str, dm: float, bins: int, width: float, header: dict) -> str:
    """The text of a sidecar; fields that the header lacks have their usual stand-ins."""
    foff, nchans = abs(header.get("foff", 0.0)), header.get("nchans", 0)
    values = _UNKNOWN | header | {"name": name, "dm": dm, "bins": bins, "width": width, "bandwidth": foff * nchans, "channel": foff, "nchans": nchans}
    return "".join(f" {label:<39}=  {form % values[field]}\n" for label, field, form in LABELS)


def write_series(series: DataFrame, folder: str, base: str, tsamp: float, header: dict, factory: str | None = None) -> DataFrame:
    """Writes each trial (dm, downsample, x) as a pair of files named by its one-decimal dm; returns (file, bins).

    The folder may be in any filesystem that ``stores`` opens.

    The tasks write, each the trials that it has; a trial that comes twice is written over by the same.
    Null samples are missing values, a null series is an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores.folder(folder, factory)
        for batch in batches:
            files, bins = [], []
            for row in batch.to_pylist():
                x = np.array(row["x"] or [], np.float64).astype("<f4")
                name = f"{base}_DM{row['dm']:.1f}"
                with stores.written(f"{folder}/{name}.dat", factory) as out:
                    out.write(x.tobytes())
                with stores.written(f"{folder}/{name}.inf", factory) as out:
                    out.write(sidecar(name, row["dm"], len(x), tsamp * row["downsample"], header).encode())
                files.append(f"{name}.dat")
                bins.append(len(x))
            yield pa.RecordBatch.from_pydict({"file": pa.array(files, pa.string()), "bins": pa.array(bins, pa.int64())})

    return saved(series.select("dm", "downsample", "x").mapInArrow(run, FILES), "manifest")


def _floats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.frombuffer(x[: len(x) // 4 * 4], "<f4").astype(float) for x in batch.column("content").to_pylist()]
        sizes = np.r_[0, np.cumsum([len(x) for x in rows])]
        values = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0)))
        yield pa.RecordBatch.from_arrays([batch.column("path"), values], ["path", "x"])


def read_series(spark: SparkSession, folder: str) -> DataFrame:
    """(file, dm, tsamp, object, x) of the pairs in a folder; a sidecar that is missing leaves nulls.

    A data file without a single byte gives no row, as Spark skips empty files.

    The dm comes from the name, as the sidecar rounds it otherwise.
    """
    name = lambda c, end: F.regexp_extract(c, rf"([^/]*)\.{end}$", 1)
    data = spark.read.format("binaryFile").option("pathGlobFilter", "*.dat").load(folder).select("path", "content").mapInArrow(_floats, "path string, x array<double>")
    lines = spark.read.option("pathGlobFilter", "*.inf").text(folder).withColumn("file", name(F.input_file_name(), "inf"))
    found = data.withColumn("file", name(F.col("path"), "dat")).join(parse_sidecar(lines).select("file", "tsamp", "object"), "file", "left")
    return found.select("file", dm_of(F.concat("file", F.lit(".dat"))).alias("dm"), "tsamp", "object", "x")


def is_series(path: Column) -> Column:
    return path.rlike(r"_DM[0-9.]+\.dat$")
