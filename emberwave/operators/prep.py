"""Preparing spectra: scaling, block averages, flat field, normalisation.

Long spectra have a row per (beam, chan, t) with value x; null marks a missing sample. Array spectra
have a row per (beam, chan) with x as an array; block spectra have one per (beam, chan, block), a block of so many times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwave.operators.diag import quantiles
from emberwave.plans.shared import saved

#: Raw clock in seconds and subband width in MHz of the survey.
RAW_TSAMP, SUBBAND_MHZ = 5.12e-6, 0.1953125


def unpack_2bit(byte: str | Column, k: int) -> Column:
    """The k-th of a byte's four 2-bit samples, left-aligned as 0, 64, 128 or 192."""
    byte = F.col(byte) if isinstance(byte, str) else byte
    return F.shiftleft(F.shiftright(byte.cast("int"), 6 - 2 * k).bitwiseAND(3), 6)


def unpacked(frame: DataFrame, nbits: int) -> DataFrame:
    """``byte`` column to ``raw`` samples with their position ``k`` in the byte; 2 or 8 bits."""
    if nbits == 8:
        return frame.withColumn("k", F.lit(0)).withColumn("raw", F.col("byte").cast("int"))
    if nbits != 2:
        raise ValueError(f"unsupported bit depth: {nbits}")
    return frame.select("*", F.posexplode(F.array(*(unpack_2bit("byte", k) for k in range(4)))).alias("k", "raw"))


def scaled(raw: str = "raw", scale: str = "scl", offset: str = "offs", weight: str = "wts") -> Column:
    return (F.col(raw) * F.col(scale) + F.col(offset)) * F.col(weight)


def without_dc(spectrum: DataFrame, every: int = 16) -> DataFrame:
    """Null for the channel that each subband begins with."""
    return spectrum.withColumn("x", F.when(F.col("chan") % every != 0, F.col("x")))


def zapped(spectrum: DataFrame, channels: list[int]) -> DataFrame:
    return spectrum.withColumn("x", F.when(~F.col("chan").isin(*channels), F.col("x")))


def scrunched(spectrum: DataFrame, mchan: int, msamp: int, *keys: str) -> DataFrame:
    """Means over ``mchan`` channels, then means of those over ``msamp`` samples; nulls do not count.

    The two steps weigh differently from one mean where samples are missing.
    """
    first = spectrum.groupBy(*keys, "t", F.expr(f"chan div {mchan}").alias("chan")).agg(F.avg("x").alias("x"))
    return first.groupBy(*keys, "chan", F.expr(f"t div {msamp}").alias("t")).agg(F.avg("x").alias("x"))


def block_mean(spectrum: DataFrame, mchan: int, msamp: int, *keys: str) -> DataFrame:
    """One mean over each block of channels and samples."""
    return spectrum.groupBy(*keys, F.expr(f"chan div {mchan}").alias("chan"), F.expr(f"t div {msamp}").alias("t")).agg(F.avg("x").alias("x"))


def mean_beam(spectrum: DataFrame, first: int = 13, last: int = 73) -> DataFrame:
    """(chan, t, mean_x): the mean of the central beams, short beams filled with their channel's mean.

    A fill is a property of (beam, chan): the sum over present samples, plus the means of the beams that
    have ended, needs no grid of beams by times.
    """
    central = spectrum.where(F.col("beam").between(first, last))
    lengths = central.groupBy("beam", "chan").agg(F.max("t").alias("end"), F.avg("x").alias("fill"))
    n_beams = central.agg(F.countDistinct("beam").alias("n_beams"))
    sums = central.groupBy("chan", "t").agg(F.sum("x").alias("s"))
    # The fills of all beams that ended at or before each time, added up in order of their ends.
    ended = lengths.groupBy("chan", "end").agg(F.sum("fill").alias("fill"))
    running = Window.partitionBy("chan").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = ended.select("chan", (F.col("end") + 1).alias("at"), F.lit(0).alias("kind"), "fill", F.lit(None).cast("double").alias("s"))
    points = sums.select("chan", F.col("t").alias("at"), F.lit(1).alias("kind"), F.lit(0.0).alias("fill"), "s")
    filled = events.unionByName(points).withColumn("fills", F.sum("fill").over(running)).where("kind = 1")
    return filled.join(F.broadcast(n_beams)).select("chan", F.col("at").alias("t"), ((F.col("s") + F.col("fills")) / F.col("n_beams")).alias("mean_x"))


def plain_mean_beam(spectrum: DataFrame, first: int = 0, last: int = 73) -> DataFrame:
    """(chan, t, mean_x): the mean of the beams that have a sample there, without any fill."""
    return spectrum.where(F.col("beam").between(first, last)).groupBy("chan", "t").agg(F.avg("x").alias("mean_x"))


def flat_fielded(spectrum: DataFrame, mean: DataFrame) -> DataFrame:
    """Each sample over the mean beam's; null where that is 0. Samples past its end are cut off."""
    return spectrum.join(mean, ["chan", "t"]).withColumn("x", F.try_divide("x", "mean_x")).drop("mean_x")


def time_blocks(spectrum: DataFrame, length: int, *keys: str) -> DataFrame:
    """(keys, block, x) of long spectra (keys, t, x): ``length`` samples a row, null where one is missing, the last block shorter."""
    held = spectrum.select(*keys, F.expr(f"t div {length}").alias("block"), (F.col("t") % length).cast("int").alias("_k"), "x")
    found = held.groupBy(*keys, "block").agg(F.map_from_entries(F.collect_list(F.struct("_k", "x"))).alias("_at"), F.max("_k").alias("_last"))
    return found.select(*keys, "block", F.transform(F.sequence(F.lit(0), "_last"), lambda k: F.try_element_at("_at", k)).alias("x"))


def from_blocks(blocks: DataFrame, length: int, *keys: str) -> DataFrame:
    """Long spectra (keys, t, x) of block spectra; missing samples are rows of null."""
    return blocks.select(*keys, "block", F.posexplode("x").alias("_k", "x")).select(*keys, (F.col("block") * length + F.col("_k")).cast("long").alias("t"), "x")


def _added(a: Column, b: Column) -> Column:
    """Sums of two arrays place by place; what one lacks does not count."""
    return F.zip_with(a, b, lambda p, q: F.coalesce(p + q, p, q))


def mean_beam_blocks(blocks: DataFrame, length: int, first: int = 13, last: int = 73, fill: bool = True) -> DataFrame:
    """(chan, block, mean_x): the mean of the central beams as block spectra, short beams filled with their channel's mean.

    As ``mean_beam``, with arrays: a group holds the blocks of the beams, which are few, at one channel and time. The fills
    of beams that have ended come from the sum over earlier blocks and from the ends inside the block. Without ``fill``
    the mean is of the beams that have a sample.
    """
    central = blocks.where(F.col("beam").between(first, last))
    added = lambda column: F.aggregate(F.collect_list(column), F.array().cast("array<double>"), _added)
    if not fill:
        counted = central.withColumn("n", F.transform("x", lambda v: F.when(v.isNotNull(), F.lit(1.0))))
        sums = counted.groupBy("chan", "block").agg(added(F.col("x")).alias("s"), added(F.col("n")).alias("n"))
        return sums.select("chan", "block", F.zip_with("s", "n", lambda s, n: s / n).alias("mean_x"))
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    held = central.select("beam", "chan", "block", "x", total.alias("total"), F.size(F.filter("x", lambda v: v.isNotNull())).alias("n"), (F.col("block") * length + F.size("x")).alias("past"))
    ends = held.groupBy("beam", "chan").agg(F.max("past").alias("past"), F.try_divide(F.sum("total"), F.sum("n")).alias("fill"))
    n_beams = central.agg(F.countDistinct("beam").alias("n_beams"))
    ended = ends.groupBy("chan", F.expr(f"past div {length}").alias("block")).agg(F.sum("fill").alias("fills"), F.collect_list(F.struct((F.col("past") % length).alias("at"), "fill")).alias("inside"))
    sums = held.groupBy("chan", "block").agg(added(F.col("x")).alias("s"))
    earlier = Window.partitionBy("chan").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    met = sums.join(ended, ["chan", "block"], "full_outer").withColumn("before", F.coalesce(F.sum("fills").over(earlier), F.lit(0.0))).where("s IS NOT NULL")
    fills = lambda k: F.aggregate(F.coalesce("inside", F.array()), F.col("before"), lambda a, e: F.when(e["at"] <= k, a + F.coalesce(e["fill"], F.lit(0.0))).otherwise(a))
    mean = F.transform("s", lambda v, k: (v + fills(k)) / F.col("n_beams"))
    return met.join(F.broadcast(n_beams)).select("chan", "block", mean.alias("mean_x"))


def flat_fielded_blocks(blocks: DataFrame, mean: DataFrame) -> DataFrame:
    """Block spectra over the mean beam's, null where that is 0. Samples past its end are cut off; none leaves its array."""
    met = blocks.join(mean, ["chan", "block"])
    cut = F.least(F.size("x"), F.size("mean_x"))
    return met.withColumn("x", F.zip_with(F.slice("x", F.lit(1), cut), F.slice("mean_x", F.lit(1), cut), F.try_divide)).drop("mean_x")


def fitted_length(x: Column, n: int) -> Column:
    """An array cut or filled with its mean to ``n`` values."""
    mean = F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / F.size(x)
    return F.slice(F.concat(x, F.array_repeat(mean, n)), 1, n)


def normalised(spectrum: DataFrame, *keys: str) -> DataFrame:
    """x over the exact median of each key's whole spectrum, less 1; keys are beams, so their medians are few.

    The spectrum is written once, as its ends, its counts, its ranks and the division each read it.
    """
    spectrum = saved(spectrum, "spectrum")
    medians = quantiles(spectrum, "x", [0.5], *keys).select(*keys, F.col("value").alias("_m"))
    joined = spectrum.join(F.broadcast(medians), list(keys)) if keys else spectrum.join(F.broadcast(medians))
    return joined.withColumn("x", F.col("x") / F.col("_m") - 1).drop("_m")


def snapped_bandwidth(bw: Column) -> Column:
    """The subband's width over a whole number of channels; halves round to even."""
    return F.lit(SUBBAND_MHZ) / F.rint(F.lit(SUBBAND_MHZ) / F.abs(bw))


def snapped_tsamp(tsamp: Column, msamp: Column | int) -> Column:
    return F.rint(tsamp * msamp / RAW_TSAMP) * RAW_TSAMP


def output_header(headers: DataFrame, mchan: int, msamp: int) -> DataFrame:
    """Header of averaged data from (obsfreq, chan_bw, nchan, tbin)."""
    bw = snapped_bandwidth(F.col("chan_bw"))
    return headers.withColumn("foff", -bw * mchan).withColumn("fch1", F.col("obsfreq") - bw * F.col("nchan") / 2 + bw * F.col("nchan")).withColumn("tsamp", snapped_tsamp(F.col("tbin"), msamp)).withColumn("nchans", F.floor(F.col("nchan") / mchan).cast("int"))


def with_axes(spectrum: DataFrame) -> DataFrame:
    """Frequency and time of each sample from fch1, foff and tsamp columns."""
    return spectrum.withColumn("nu", F.col("fch1") + F.col("foff") * F.col("chan")).withColumn("time", F.col("t") * F.col("tsamp"))


def flipped(spectrum: DataFrame, nchan: int) -> DataFrame:
    return spectrum.withColumn("chan", nchan - 1 - F.col("chan"))


def clipped(x: Column, nbits: int) -> Column:
    """A value in the range of an unsigned sample of 8 or 16 bits, truncated; 32 bits are floats."""
    if nbits == 32:
        return x.cast("float")
    if nbits not in (8, 16):
        raise ValueError(f"unsupported sample width: {nbits}")
    return F.least(F.greatest(x, F.lit(0)), F.lit((1 << nbits) - 1)).cast("int")
