"""Boxcars and recursive filters over series of any length: sums within blocks, and what blocks hand on to each other."""

from __future__ import annotations

import cmath
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwave.plans.shared import saved


def prefix_sums(series: DataFrame, *keys: str, block: int = 65_536) -> DataFrame:
    """(keys, t, p, n): sum and number of the values up to each time, over dense series (keys, t, x) from t = 0.

    Values are summed within blocks first; the sums of blocks, a row each, are summed along a series and given back to
    the blocks. So a task holds one block, and what runs along a whole series is a row a block.
    """
    cut = series.select(*keys, "t", F.expr(f"t div {block}").alias("_block"), F.coalesce("x", F.lit(0.0)).alias("x"), F.when(F.col("x").isNotNull(), 1).otherwise(0).alias("n"))
    within = Window.partitionBy(*keys, "_block").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_block").agg(F.sum("x").alias("_x"), F.sum("n").alias("_n"))
    before = totals.select(*keys, "_block", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_x", "_n")))
    own = cut.select(*keys, "t", "_block", F.sum("x").over(within).alias("p"), F.sum("n").over(within).alias("n"))
    return own.join(before, [*keys, "_block"]).select(*keys, "t", (F.col("p") + F.col("_x")).alias("p"), (F.col("n") + F.col("_n")).alias("n"))


def boxcars(series: DataFrame, halves: list[int], *keys: str, block: int = 65_536) -> DataFrame:
    """(keys, half, t, x): the mean of what is there from ``half`` samples before each time to as many behind.

    Windows are cut off at the ends of a series. Each is a difference of two prefix sums, looked up by their distance in a
    block that holds the edges of its neighbours as far as the widest window reaches; no window adds its values up again.
    """
    reach = max(halves) + 1
    if reach > block:
        raise ValueError(f"windows of {reach - 1} reach over blocks of {block}")
    sums = saved(prefix_sums(series, *keys, block=block), "prefix")
    at, home = F.col("t") % block, F.expr(f"t div {block}")
    # A row stands in its own block and, near an edge, as a guest in the next or the last one.
    homes = F.array_compact(F.array(home, F.when(at < reach, home - 1), F.when(at >= block - reach, home + 1)))
    dealt = sums.withColumn("_home", home).withColumn("_block", F.explode(homes))
    row = Window.partitionBy(*keys, "_block").orderBy("t")
    ends = row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    means = []
    for half in halves:
        # Beyond a series' end the last sum stands; before its start it is 0.
        high = [F.coalesce(F.lead(c, half).over(row), F.last(c).over(ends)) for c in ("p", "n")]
        low = [F.coalesce(F.lag(c, half + 1).over(row), F.lit(0)) for c in ("p", "n")]
        means.append(F.struct(F.lit(half).alias("half"), F.try_divide(high[0] - low[0], (high[1] - low[1]).cast("double")).alias("x")).alias(f"m{half}"))
    found = dealt.select(*keys, "t", "_block", "_home", *means).where("_block = _home")
    parts = [found.select(*keys, f"m{half}.half", "t", f"m{half}.x") for half in halves]
    return reduce(DataFrame.unionByName, parts) if len(parts) == 1 else found.select(*keys, "t", F.explode(F.array(*(f"m{half}" for half in halves))).alias("m")).select(*keys, "m.half", "t", "m.x")


def _times(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def _powers(pole: complex, n: int, start: int = 0) -> tuple[Column, Column]:
    """Literal arrays of the real and imaginary parts of the powers of a pole."""
    values = [pole**k for k in range(start, start + n)]
    return F.array(*(F.lit(float(v.real)) for v in values)), F.array(*(F.lit(float(v.imag)) for v in values))


def recursed(drive: DataFrame, pole: complex, *keys: str, block: int = 256, longest: int | None = None) -> DataFrame:
    """(keys, t, re, im): y[t] = pole * y[t - 1] + drive[t] from y = 0, over dense series (keys, t, re, im) from t = 0.

    Within a block, y is a running sum of the drive over powers of the pole. A block maps the state before it to the
    state behind it by a product and a sum; such maps compose, so the states between blocks follow the same kind of
    recursion with the pole's power, over a row a block, and are found the same way until one block is left. ``longest`` is
    the length of the longest series, counted where it is not given.
    """
    # Powers stay within what a double holds, whatever the pole.
    size = abs(pole)
    block = max(2, min(block, int(280 / -math.log10(size)))) if 0 < size < 1 else block
    if size == 0:
        return drive.select(*keys, "t", "re", "im")
    if longest is None:
        longest = (drive.agg(F.max("t")).first()[0] or 0) + 1
    cut = drive.withColumn("_block", F.expr(f"t div {block}")).withColumn("_k", (F.col("t") % block).cast("int"))
    back, forth = _powers(1 / pole, block), _powers(pole, block)
    at = lambda pair: (F.get(pair[0], F.col("_k")), F.get(pair[1], F.col("_k")))
    scaled = _times((F.col("re"), F.col("im")), at(back))
    within = Window.partitionBy(*keys, "_block").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumn("_re", scaled[0]).withColumn("_im", scaled[1]).withColumn("_re", F.sum("_re").over(within)).withColumn("_im", F.sum("_im").over(within))
    own = _times((F.col("_re"), F.col("_im")), at(forth))
    local = summed.select(*keys, "t", "_block", "_k", own[0].alias("re"), own[1].alias("im"))
    if longest <= block:
        return local.select(*keys, "t", "re", "im")
    local = saved(local, "local")
    ends = local.where(F.col("_k") == block - 1).select(*keys, F.col("_block").alias("t"), "re", "im")
    states = recursed(ends, pole**block, *keys, block=block, longest=-(-longest // block))
    before = states.select(*keys, (F.col("t") + 1).alias("_block"), F.col("re").alias("_re"), F.col("im").alias("_im"))
    met = local.join(before, [*keys, "_block"], "left")
    lasting = _times((F.col("_re"), F.col("_im")), at(_powers(pole, block, 1)))
    return met.select(*keys, "t", *((F.col(c) + F.coalesce(v, F.lit(0.0))).alias(c) for c, v in zip(("re", "im"), lasting, strict=True)))


def steps(series: DataFrame, *keys: str, block: int, first: bool) -> DataFrame:
    """Differences to the sample before, over dense series; the one before the first is 0, or the first itself."""
    cut = series.withColumn("_block", F.expr(f"t div {block}"))
    order = Window.partitionBy(*keys, "_block").orderBy("t")
    ends = cut.groupBy(*keys, "_block").agg(F.max_by(F.struct("re", "im"), "t").alias("_end")).select(*keys, (F.col("_block") + 1).alias("_block"), "_end")
    held = cut.withColumn("_last", F.lag(F.struct("re", "im")).over(order)).join(ends, [*keys, "_block"], "left")
    zero = F.struct(F.lit(0.0).alias("re"), F.lit(0.0).alias("im"))
    before = F.coalesce("_last", "_end", F.struct("re", "im") if first else zero)
    return held.select(*keys, "t", *((F.col(c) - before[c]).alias(c) for c in ("re", "im")))


def butterworth_poles(cutoff_hz: float, dt: float, order: int) -> list[complex]:
    """The poles of a Butterworth high pass by the bilinear transform."""
    warped = math.tan(math.pi * cutoff_hz * dt)
    analog = [warped / cmath.exp(1j * cmath.pi * (2 * k + order - 1) / (2 * order)) for k in range(1, order + 1)]
    return [(1 + a) / (1 - a) for a in analog]


def high_passed(series: DataFrame, dt: float, *keys: str, cutoff_hz: float = 0.004, order: int = 3, block: int = 256) -> DataFrame:
    """(keys, t, x): a Butterworth high pass run forward and backward over dense series (keys, t, x) from t = 0.

    As ``matched.high_passed``, a section for each pole and the ends extended by their odd images, but block by block: no task
    holds a series, and what runs along one is a row a block.
    """
    series = saved(series.select(*keys, "t", F.col("x").cast("double").alias("x")), "series")
    sizes = series.groupBy(*keys).agg((F.max("t") + 1).alias("_n"))
    pad = F.least(F.lit(3 * (order + 1)), F.col("_n") - 1)
    edges = series.join(sizes.withColumn("_pad", pad), list(keys)) if keys else series.join(F.broadcast(sizes.withColumn("_pad", pad)))
    ends = edges.groupBy(*keys).agg(F.max(F.when(F.col("t") == 0, F.col("x"))).alias("_a"), F.max(F.when(F.col("t") == F.col("_n") - 1, F.col("x"))).alias("_b"))
    edges = edges.join(ends, list(keys)) if keys else edges.join(F.broadcast(ends))
    # A sample near an end stands once for itself and once for its image beyond that end.
    own = F.struct((F.col("t") + F.col("_pad")).alias("t"), F.col("x").alias("x"))
    left = F.when((F.col("t") >= 1) & (F.col("t") <= F.col("_pad")), F.struct((F.col("_pad") - F.col("t")).alias("t"), (F.col("_a") * 2 - F.col("x")).alias("x")))
    after = F.col("_n") - 1 - F.col("t")
    right = F.when((after >= 1) & (after <= F.col("_pad")), F.struct((F.col("_pad") + F.col("_n") - 1 + after).alias("t"), (F.col("_b") * 2 - F.col("x")).alias("x")))
    wide = edges.select(*keys, "_n", "_pad", F.explode(F.array_compact(F.array(own, left, right))).alias("s")).select(*keys, "_n", "_pad", "s.t", F.col("s.x").alias("re"), F.lit(0.0).alias("im"))
    facts = wide.select(*keys, "_n", "_pad").distinct()
    longest = (wide.agg(F.max("t")).first()[0] or 0) + 1
    now = wide.select(*keys, "t", "re", "im")

    def passed(frame: DataFrame) -> DataFrame:
        for number, pole in enumerate(butterworth_poles(cutoff_hz, dt, order)):
            drive = steps(frame, *keys, block=block, first=number == 0)
            gain = _times((F.col("re"), F.col("im")), (F.lit(((1 + pole) / 2).real), F.lit(((1 + pole) / 2).imag)))
            frame = saved(recursed(drive.select(*keys, "t", gain[0].alias("re"), gain[1].alias("im")), pole, *keys, block=block, longest=longest), "section")
        return frame.withColumn("im", F.lit(0.0))

    def turned(frame: DataFrame) -> DataFrame:
        met = frame.join(facts, list(keys)) if keys else frame.join(F.broadcast(facts))
        return met.withColumn("t", F.col("_n") + 2 * F.col("_pad") - 1 - F.col("t"))

    back = turned(passed(turned(passed(now)).select(*keys, "t", "re", "im")))
    return back.where((F.col("t") >= F.col("_pad")) & (F.col("t") < F.col("_pad") + F.col("_n"))).select(*keys, (F.col("t") - F.col("_pad")).alias("t"), F.col("re").alias("x"))
