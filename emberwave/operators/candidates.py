"""The candidate table: lookups, gates, ranking, union and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwave.plans.settings import Settings, of_plan

#: Ties in S/N are broken by these, so no result depends on the order of files.
ORDER = ("dm", "time", "sample", "filter_width", "beam")
COLUMNS = ("dm", "sn", "time", "sample", "filter_width")
_ALIASES = {"snr": "sn", "s/n": "sn", "strength": "sn", "width": "filter_width", "time_s": "time", "sample_idx": "sample"}


def best_first(*more: str) -> list[Column]:
    return [F.col("sn").desc(), *(F.col(c) for c in (*ORDER, *more))]


def normalised_columns(frame: DataFrame) -> DataFrame:
    """Lower-case, stripped names with the known aliases resolved; ``sample`` is -1 where there is none."""
    names = [c.strip().lower() for c in frame.columns]
    frame = frame.toDF(*(_ALIASES.get(c, c) for c in names))
    if "sample" not in frame.columns:
        frame = frame.withColumn("sample", F.lit(-1).cast("long"))
    if missing := [c for c in COLUMNS if c not in frame.columns]:
        raise ValueError(f"candidates have no {', '.join(missing)}")
    return frame


def single_candidate(spark, dm: float | None, time: float | None, sn: float | None, width: int | None, sample: int = -1) -> DataFrame | None:
    """A table of one candidate given by its values, or None unless all four are given."""
    if None in (dm, time, sn, width):
        return None
    return spark.createDataFrame([(float(dm), float(sn), float(time), int(sample), int(width))], "dm double, sn double, time double, sample long, filter_width int")


def with_plan(cands: DataFrame) -> DataFrame:
    """Adds the trial step, the downsampling and dm_scaled = dm / ddm."""
    return cands.withColumn("ddm", of_plan("dm", "ddm")).withColumn("downsample", of_plan("dm", "downsample")).withColumn("dm_scaled", F.col("dm") / F.col("ddm"))


def rounded(cands: DataFrame) -> DataFrame:
    """The precision of the text format: three decimals for dm and S/N, six for time."""
    return cands.withColumn("dm", F.round("dm", 3)).withColumn("sn", F.round("sn", 3)).withColumn("time", F.round("time", 6))


def top_per_dm(cands: DataFrame, k: int = 5, *by: str) -> DataFrame:
    """The k best of each dm (of each ``by``). Catalyst prunes by a partial group limit before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by, "dm").orderBy(*best_first()))
    return cands.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def gate(cands: DataFrame, least_dm: float, above_sn: float) -> DataFrame:
    return cands.where((F.col("dm") >= least_dm) & (F.col("sn") > above_sn))


def detections(response: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Rows of a long response (…, sn) at or over the threshold."""
    return response.where(F.col("sn") >= threshold)


def sn_by_dm(cands: DataFrame) -> DataFrame:
    """The sum of S/N at each dm, in order of dm."""
    return cands.groupBy("dm").agg(F.sum("sn").alias("sum_sn")).orderBy("dm")


def collected(cands: DataFrame) -> DataFrame:
    """The union of all beams' lists: beam label first, central beams and the excluded one as they come."""
    return cands.select(F.format_string("B%03d", "beam").alias("beam_label"), "dm", "sn", "time", "sample", "filter_width")


def union_beams(lists: dict[int, DataFrame]) -> DataFrame | None:
    """UNION ALL of lists by beam, the beam prepended; None without lists. Lists in files are read at once by ``textfiles.read_beams``."""
    out = None
    for beam, frame in sorted(lists.items()):
        one = frame.select(F.lit(beam).alias("beam"), *COLUMNS)
        out = one if out is None else out.unionByName(one)
    return out


def beam_summary(cands: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """By beam: candidates after top-k but before the gate, and the highest S/N past the gate, 0 if none."""
    rank = F.row_number().over(Window.partitionBy("beam", "dm").orderBy(*best_first()))
    top = cands.withColumn("_rank", rank).where(F.col("_rank") <= settings.top_per_dm)
    past = (F.col("dm") >= settings.main_gate[0]) & (F.col("sn") > settings.main_gate[1])
    return top.groupBy("beam").agg(F.count("*").alias("num_candidates"), F.count_if(past).alias("num_gated"), F.coalesce(F.max(F.when(past, F.col("sn"))), F.lit(0.0)).alias("highest_snr"))


def redetection_counts(labelled: DataFrame) -> DataFrame:
    """(n_candidates, n_redetections) of labelled candidates."""
    return labelled.agg(F.count_if(F.col("detection_type") == "candidate").alias("n_candidates"), F.count_if(F.col("detection_type") == "known_pulsar").alias("n_redetections"))


def top_detection(cands: DataFrame) -> DataFrame:
    return cands.orderBy(*best_first()).limit(1)


def sample_index(tsamp: float, time: str = "time") -> Column:
    """int(time / tsamp), truncated, on the base sampling whatever the downsampling."""
    return (F.col(time) / F.lit(tsamp)).cast("long")
