"""Lines of text about observations and candidates, and constants."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Angles, by rule: what an arcsecond, a second of time, a degree and an hour are in radians, and their inverses.
ARCSEC_RAD, SECOND_RAD, DEGREE_RAD, HOUR_RAD = (math.pi / x for x in (648_000, 43_200, 180, 12))
RAD_ARCSEC, RAD_SECOND, RAD_DEGREE, RAD_HOUR = (1 / x for x in (ARCSEC_RAD, SECOND_RAD, DEGREE_RAD, HOUR_RAD))
TWO_PI, HALF_PI = 2 * math.pi, math.pi / 2
# Units of time and length, masses, radii and constants of nature.
DAY_S, JULIAN_YEAR_S = 86400.0, 31557600.0
PARSEC_KM, KILOPARSEC_KM = 3.0856776e13, 3.0856776e16
SUN_S, SUN_KG, JUPITER_KG = 4.925490947e-6, 1.9891e30, 1.8987e27
SUN_M, EARTH_M = 6.9551e8, 6.378e6
LIGHT_M_S, GRAVITY = 299792458.0, 6.673e-11
SUN_KG_ROUNDED = 1.989e30


def galactic_line(ra: Column, dec: Column, lon: Column, lat: Column, dm_a: Column, dm_b: Column) -> Column:
    """Where a candidate lies and the most its dm could be by two models of the galaxy, if they say."""
    most = lambda dm: F.when(dm.isNotNull(), F.format_string("%.1f", dm)).otherwise("unknown")
    return F.concat(
        F.format_string("RA: %s  DEC: %s | l: %.2f b: %.2f\n", ra, dec, lon, lat),
        F.lit("Max DM NE2001: "),
        most(dm_a),
        F.lit(" | Max DM YMW16: "),
        most(dm_b),
    )


def redetection_line(psrj: Column, dm: Column, sn: Column, width: Column) -> Column:
    return F.format_string("*Redetected:* %s  DM=%.2f  highest S/N=%.2f  Width=%d", psrj, dm, sn, width)


def result_lines(probs: Column, names: tuple[str, ...] = tuple("abcdef"), gate: float = 0.5) -> Column:
    """The text of a classification: each model's probability, the highest, and the verdict."""
    lines = [F.format_string(f"{n.upper()}: %.4f", F.get(probs, k)) for k, n in enumerate(names)]
    top = F.array_max(probs)
    verdict = F.when(top > gate, "YES").otherwise("NO")
    return F.concat_ws("\n", F.lit("FETCH Classification Probabilities:"), *lines, F.format_string("Highest Probability: %.4f", top), F.concat(F.lit("Classified as Astrophysical? "), verdict))


def with_max_dm(frame: DataFrame, table: DataFrame, step: float = 1.0) -> DataFrame:
    """``frame`` (l_deg, b_deg) with the two models' largest dm from a table of cells (l_cell, b_cell, dm_a, dm_b).

    The models themselves are no part of this engine: a table of their values on a grid of ``step``
    degrees stands in, and a place without a cell has nulls.
    """
    cell = lambda c: F.floor(F.col(c) / step).cast("long")
    return frame.withColumn("l_cell", cell("l_deg")).withColumn("b_cell", cell("b_deg")).join(table, ["l_cell", "b_cell"], "left").drop("l_cell", "b_cell")


def send(messages: DataFrame, notify) -> int:
    """Hands each message (value) to ``notify``, one at a time on the driver; off unless it is called.

    Messages are few, as only the best redetection of each source makes one; null ones are left out.
    """
    n = 0
    for row in messages.where("value IS NOT NULL").select("value").toLocalIterator():
        notify(row.value)
        n += 1
    return n
