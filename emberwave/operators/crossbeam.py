"""One candidate in all beams: which beams, its S/N there, and where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberwave.operators.dedisperse import dedisperse
from emberwave.operators.matched import peaks_near


def nearest_beams(beams: DataFrame, trigger: int, n: int = 73) -> DataFrame:
    """The ``n`` beams next to the trigger by number, ties by number, with their rank."""
    return beams.select("beam").distinct().orderBy(F.abs(F.col("beam") - trigger), "beam").limit(n).withColumn("rank", F.row_number().over(Window.orderBy(F.abs(F.col("beam") - trigger), "beam")))


def first_successful(beams: DataFrame, n: int = 75) -> DataFrame:
    """The first ``n`` beams in order of name of those that were processed (name, ok)."""
    return beams.where("ok").orderBy("name").limit(n)


def positioned(sn: DataFrame, positions: DataFrame) -> DataFrame:
    """S/N by beam with the beam's position; beams without one are left out."""
    return sn.join(positions.where("ra_deg IS NOT NULL AND dec_deg IS NOT NULL AND NOT isnan(ra_deg) AND NOT isnan(dec_deg)"), "beam")


def beam_map(sn: DataFrame, positions: DataFrame) -> DataFrame:
    """(beam, sn, x_arcmin, y_arcmin, level): offsets from the mean position, S/N over the largest."""
    at = positioned(sn, positions)
    centre = at.agg(F.avg("ra_deg").alias("ra_0"), F.avg("dec_deg").alias("dec_0"), F.max("sn").alias("sn_0"))
    offset = at.join(F.broadcast(centre))
    return offset.select(
        "beam",
        "sn",
        ((F.col("ra_deg") - F.col("ra_0")) * 60 * F.cos(F.radians("dec_0"))).alias("x_arcmin"),
        ((F.col("dec_deg") - F.col("dec_0")) * 60).alias("y_arcmin"),
        F.try_divide("sn", "sn_0").alias("level"),
    )


def nearest_sample(samples: DataFrame, at: float, *keys: str) -> DataFrame:
    """(keys, t, time): the sample nearest in time, the first on a tie."""
    return samples.groupBy(*keys).agg(F.min(F.struct(F.abs(F.col("time") - at).alias("d"), "time", "t")).alias("m")).select(*keys, "m.t", "m.time")


def cross_beam_sn(spectrum: DataFrame, dm: float, time_s: float, width: int, tsamp: float, beam: str = "beam") -> DataFrame:
    """(beam, sn, peak_t) of one pulse in every beam of ``spectrum`` (beam, chan, nu, x)."""
    grid = spectrum.sparkSession.createDataFrame([(float(dm), 1)], "dm double, downsample int")
    series = dedisperse(spectrum, grid, tsamp, beam)
    return peaks_near(series, tsamp, width, round(time_s / tsamp), beam)


def peak_window(series: DataFrame, index: int, *keys: str, window: int = 10) -> DataFrame:
    """(keys, t, x) of the largest sample within ``window`` of ``index``, the first on a tie; long series."""
    near = series.where(F.col("t").between(index - window, index + window))
    return near.groupBy(*keys).agg(F.max(F.struct(F.col("x"), (-F.col("t")).alias("back"))).alias("m")).select(*keys, (-F.col("m.back")).alias("t"), F.col("m.x").alias("x"))
