"""The frames behind the diagnostic figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(frame: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) over equal bins from minimum to maximum; the last bin holds the maximum.

    Bins without values are left out. Values that are all equal lie half a unit from either end.
    """
    ends = frame.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    ends = ends.select(F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("a"), F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("b"))
    at = F.least(F.floor((F.col(column) - F.col("a")) * bins / (F.col("b") - F.col("a"))), F.lit(bins - 1)).cast("int")
    counted = frame.where(F.col(column).isNotNull()).join(F.broadcast(ends)).withColumn("bin", at).groupBy("bin", "a", "b").agg(F.count("*").alias("n"))
    edge = lambda k: F.col("a") + (F.col("b") - F.col("a")) * k / bins
    return counted.select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "n")


def time_averaged(spectrum: DataFrame, factor: int, *keys: str) -> DataFrame:
    """(keys, t, x): means of ``factor`` samples; an incomplete last group is dropped."""
    lengths = spectrum.groupBy(*keys).agg((F.max("t") + 1).alias("_n"))
    joined = spectrum.join(lengths, list(keys)) if keys else spectrum.join(F.broadcast(lengths))
    return joined.where(F.col("t") < F.expr(f"(_n div {factor}) * {factor}")).groupBy(*keys, F.expr(f"t div {factor}").alias("t")).agg(F.avg("x").alias("x"))


def mean_spectrum(expanded: DataFrame) -> DataFrame:
    """(chan, mean_x, mean_kept): over all samples, and over unmasked ones."""
    return expanded.groupBy("chan").agg(F.avg("x").alias("mean_x"), F.avg(F.when(~F.col("masked"), F.col("x"))).alias("mean_kept"))


def mean_series(expanded: DataFrame) -> DataFrame:
    return expanded.groupBy("t").agg(F.avg("x").alias("mean_x"), F.avg(F.when(~F.col("masked"), F.col("x"))).alias("mean_kept"))


def flag_fraction(expanded: DataFrame, by: str) -> DataFrame:
    return expanded.groupBy(by).agg(F.avg(F.col("masked").cast("double")).alias("flag_frac"))


#: Equal bins that values are counted in before those of a few bins are ranked.
QUANTILE_BINS = 16_384


def quantiles(frame: DataFrame, column: str, levels: list[float], *keys: str, bins: int = QUANTILE_BINS) -> DataFrame:
    """(keys, level, value): exact quantiles, linearly interpolated between neighbours, of values that are not null.

    Values are counted in equal bins first; the counts tell in which bin the wanted ranks lie, and only
    the values of those bins are ranked. So no buffer holds all distinct values: the largest group is a
    bin's distinct values. A key without values has no rows.
    """
    own = frame.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_x"))
    ends = own.groupBy(*keys).agg(F.min("_x").alias("_a"), F.max("_x").alias("_b"), F.count("*").alias("_n"))
    placed = own.join(ends, list(keys)) if keys else own.join(F.broadcast(ends))
    at = F.when(F.col("_a") < F.col("_b"), F.least(F.floor((F.col("_x") - F.col("_a")) / (F.col("_b") - F.col("_a")) * bins), F.lit(bins - 1))).otherwise(0)
    placed = placed.withColumn("_bin", at.cast("int"))
    counts = placed.groupBy(*keys, "_n", "_bin").agg(F.count("*").alias("_c"))
    # At most so many rows a key as there are bins.
    below = counts.withColumn("_below", F.sum("_c").over(Window.partitionBy(*keys).orderBy("_bin")) - F.col("_c"))
    ranks = F.explode(F.array(*(F.struct(F.lit(float(p)).alias("level"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank")) for p in levels))).alias("_r")
    each = F.explode(F.array(F.floor("_r.rank"), F.ceil("_r.rank"))).alias("_k")
    wanted = below.select(*keys, "_bin", "_below", "_c", ranks).select("*", each).where((F.col("_k") >= F.col("_below")) & (F.col("_k") < F.col("_below") + F.col("_c")))
    wanted = wanted.select(*keys, "_bin", F.col("_r.level").alias("level"), F.col("_r.rank").alias("_rank"), "_k", (F.col("_k") - F.col("_below")).alias("_inside")).distinct()
    met = placed.select(*keys, "_bin", "_x").join(wanted, [*keys, "_bin"]).groupBy(*keys, "level", "_rank", "_k", "_inside", "_x").agg(F.count("*").alias("_c"))
    found = met.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*keys, "level", "_k").orderBy("_x")))
    found = found.where((F.col("_inside") < F.col("_upto")) & (F.col("_inside") >= F.col("_upto") - F.col("_c")))
    part = F.col("_rank") - F.floor("_rank")
    weight = F.when(F.col("_k") == F.floor("_rank"), F.lit(1.0) - part).otherwise(part)
    # A whole rank has one row, of weight one.
    return found.groupBy(*keys, "level").agg(F.sum(weight * F.col("_x")).alias("value"))


def percentiles(frame: DataFrame, column: str, levels: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated percentiles as columns of one row; nulls where there are no values."""
    found = quantiles(frame, column, sorted(set(levels.values())))
    return found.agg(*(F.max(F.when(F.col("level") == float(p), F.col("value"))).alias(name) for name, p in levels.items()))


def z_scored(frame: DataFrame, column: str = "x", *keys: str) -> DataFrame:
    stats = frame.groupBy(*keys).agg(F.avg(column).alias("_mean"), F.stddev_pop(column).alias("_std"))
    joined = frame.join(stats, list(keys)) if keys else frame.join(F.broadcast(stats))
    return joined.withColumn("z", F.try_divide(F.col(column) - F.col("_mean"), F.col("_std"))).drop("_mean", "_std")


def rescaled(frame: DataFrame, sn: Column, *keys: str, least: float | None = None) -> DataFrame:
    """x scaled so that its largest value is ``sn``; ``least`` bounds that value from below."""
    top = F.max("x").over(Window.partitionBy(*keys))
    return frame.withColumn("x", F.try_divide(F.col("x") * sn, F.greatest(top, F.lit(least)) if least is not None else top))


def cropped(frame: DataFrame, centre: int, width: int, *keys: str) -> DataFrame:
    """Samples in [centre - width / 2, centre + width / 2)."""
    half = width // 2
    return frame.where((F.col("t") >= max(0, centre - half)) & (F.col("t") < centre + half))


def observation_info(headers: DataFrame) -> DataFrame:
    """Frequency range, duration and counts of an observation from its header fields."""
    first, last = F.col("fch1"), F.col("fch1") + F.col("foff") * (F.col("nchans") - 1)
    return headers.withColumn("freq_min", F.least(first, last)).withColumn("freq_max", F.greatest(first, last)).withColumn("duration_s", F.col("nspec") * F.col("tsamp")).withColumn("bandwidth_mhz", F.abs(F.col("foff")) * F.col("nchans"))
