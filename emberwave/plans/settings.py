"""Search settings: the dedispersion plan, thresholds and the grids they expand to."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Segment:
    low_dm: float
    high_dm: float
    ddm: float
    downsample: int

    @property
    def trials(self) -> int:
        return math.ceil((self.high_dm - self.low_dm) / self.ddm)


# The dispersion-measure plan of the survey.
PLAN = (
    Segment(0.0, 150.6, 0.1, 1),
    Segment(150.6, 289.8, 0.3, 2),
    Segment(289.8, 511.8, 0.5, 4),
    Segment(511.8, 1010.8, 1.0, 8),
    Segment(1010.8, 2014.8, 2.0, 16),
    Segment(2014.8, 4469.8, 5.0, 32),
    Segment(4469.8, 8939.8, 10.0, 64),
    Segment(8939.8, 10019.8, 20.0, 128),
)
#: Inverse of the dispersion constant: delays are dm * (nu**-2 - nu_max**-2) / this, with nu in MHz.
DISPERSION = 2.41e-4


@dataclass(frozen=True)
class Settings:
    """One configuration for every stage; ``merged`` overrides the defaults that a mapping names."""

    tsamp: float = 0.00786432
    rfi_block_size: int = 1000
    rfi_averaging_factor: int = 128
    sigma_low: float = 3.0
    sigma_high: float = 3.0
    bad_channel: int = 138
    detection_threshold: float = 5.0
    cluster_gate: float = 6.0
    cluster_eps: float = 5.0
    main_gate: tuple[float, float] = (10.0, 7.0)
    post_gate: tuple[float, float] = (3.0, 6.5)
    probability_gate: float = 0.5
    cone_deg: float = 5.0
    dm_tolerance: float = 0.5
    top_per_dm: int = 5
    kernel_slope: float = 1000.0
    max_width_s: float = 600.0
    n_widths: int = 16
    central_beams: tuple[int, int] = (13, 73)
    excluded_beam: int = 12
    classify_beams: int = 75
    nearest_beams: int = 73
    plan: tuple[Segment, ...] = field(default=PLAN)

    def merged(self, config: dict) -> Settings:
        known = {f.name for f in fields(self)}
        return replace(self, **{k: v for k, v in config.items() if k in known})

    def dump(self) -> str:
        """JSON text that ``load`` reads back."""
        config = asdict(self)
        config["dedispersion_plan"] = config.pop("plan")
        return json.dumps(config)

    @classmethod
    def load(cls, text: str) -> Settings:
        """Settings from JSON text, or from YAML where its library is installed; the plan as a list of mappings."""
        try:
            config = json.loads(text)
        except ValueError:
            import yaml

            config = yaml.safe_load(text) or {}
        config = {k: tuple(v) if isinstance(v, list) and k != "dedispersion_plan" else v for k, v in config.items()}
        if "dedispersion_plan" in config:
            config["plan"] = tuple(Segment(float(x["low_dm"]), float(x["high_dm"]), float(x["ddm"]), int(x["downsample"])) for x in config["dedispersion_plan"])
        return cls().merged(config)


def plan_table(spark: SparkSession, plan: tuple[Segment, ...] = PLAN) -> DataFrame:
    rows = [(k, s.low_dm, s.high_dm, s.ddm, s.downsample) for k, s in enumerate(plan)]
    return spark.createDataFrame(rows, "seg int, low_dm double, high_dm double, ddm double, downsample int")


def of_plan(dm: str | Column, name: str, plan: tuple[Segment, ...] = PLAN) -> Column:
    """``ddm`` or ``downsample`` of the first segment with low <= dm < high, else 1: a folded CASE, no join."""
    dm = F.col(dm) if isinstance(dm, str) else dm
    out = None
    for s in plan:
        inside, value = (dm >= s.low_dm) & (dm < s.high_dm), F.lit(getattr(s, name))
        out = F.when(inside, value) if out is None else out.when(inside, value)
    return out.otherwise(F.lit(1.0 if name == "ddm" else 1))


def dm_grid(spark: SparkSession, plan: tuple[Segment, ...] = PLAN) -> DataFrame:
    """Every trial: seg, i, dm, downsample and dm_name, the one-decimal name its series goes by."""
    table = plan_table(spark, plan).withColumn("n", F.ceil((F.col("high_dm") - F.col("low_dm")) / F.col("ddm")))
    trials = table.select("seg", "downsample", "low_dm", "ddm", F.explode(F.expr("sequence(0L, n - 1)")).alias("i"))
    return trials.select("seg", "i", (F.col("low_dm") + F.col("i") * F.col("ddm")).alias("dm"), "downsample").withColumn("dm_name", F.format_string("%.1f", "dm"))


def distinct_trials(grid: DataFrame) -> DataFrame:
    """One trial a name: where names collide, the later segment has overwritten the earlier."""
    latest = grid.groupBy("dm_name").agg(F.max(F.struct("seg", "i", "dm", "downsample")).alias("t"))
    return latest.select("dm_name", "t.seg", "t.i", "t.dm", "t.downsample")


def width_grid(grid: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct truncated geometric widths from 1 to max_width_s, for each row's ``tsamp`` and ``downsample``.

    The last width is the bound itself, not a power that may fall just short of it.
    """
    last = settings.n_widths - 1
    widest = F.floor(F.lit(settings.max_width_s) / (F.col("tsamp") * F.col("downsample"))).cast("int")
    steps = F.expr(f"array_distinct(transform(sequence(0, {last}), i -> CASE WHEN i = {last} THEN widest ELSE cast(pow(widest, i / {last}D) AS int) END))")
    return grid.withColumn("widest", widest).where("widest >= 1").withColumn("width", F.explode(steps)).drop("widest")
