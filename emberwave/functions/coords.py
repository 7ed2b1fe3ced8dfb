"""Angles and dates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rotation from equatorial (J2000) to galactic axes.
GALACTIC = (
    (-0.0548755604162154, -0.8734370902348850, -0.4838350155487132),
    (0.4941094278755837, -0.4448296299600112, 0.7469822444972189),
    (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669),
)
# Radians in an arc second and in a second of right ascension, seconds in a day, speed of light in m/s.
ARCSEC_RAD, SEC_RAD = math.pi / 648_000, math.pi / 43_200
SECONDS_PER_DAY, LIGHT = 86_400, 299_792_458.0
MJD_EPOCH = 40_587


def _parts(packed: Column) -> tuple[Column, Column, Column]:
    size = F.abs(packed)
    return F.floor(size / 10_000), F.floor((size % 10_000) / 100), size % 100


def packed_ra_text(packed: Column) -> Column:
    """HHMMSS.S as HH:MM:SS.SS."""
    h, m, s = _parts(packed)
    return F.format_string("%02d:%02d:%05.2f", h, m, s)


def packed_dec_text(packed: Column) -> Column:
    """DDMMSS.S as +DD:MM:SS.SS; the sign is that of the whole number."""
    d, m, s = _parts(packed)
    return F.concat(F.when(packed >= 0, "+").otherwise("-"), F.format_string("%02d:%02d:%05.2f", d, m, s))


def packed_degrees(packed: Column, hours: bool) -> Column:
    d, m, s = _parts(packed)
    value = d + m / 60 + s / 3600
    return F.when(packed < 0, -value).otherwise(value) * (15 if hours else 1)


def packed_radians(packed: Column, hours: bool) -> Column:
    d, m, s = _parts(packed)
    seconds = (d * 60 + m) * 60 + s
    return F.when(packed < 0, -seconds).otherwise(seconds) * (SEC_RAD if hours else ARCSEC_RAD)


def text_degrees(text: Column, hours: bool) -> Column:
    """HH:MM:SS.S or ±DD:MM:SS.S in degrees; parts that are left out are 0."""
    parts = F.split(F.regexp_replace(F.trim(text), "^[+-]", ""), ":")
    part = lambda k: F.coalesce(F.get(parts, k).try_cast("double"), F.lit(0.0))
    value = part(0) + part(1) / 60 + part(2) / 3600
    return F.when(F.trim(text).startswith("-"), -value).otherwise(value) * (15 if hours else 1)


def galactic(ra_deg: Column, dec_deg: Column) -> tuple[Column, Column]:
    """Longitude in [0, 360) and latitude in degrees."""
    ra, dec = F.radians(ra_deg), F.radians(dec_deg)
    axes = (F.cos(dec) * F.cos(ra), F.cos(dec) * F.sin(ra), F.sin(dec))
    x, y, z = (sum((axes[k] * row[k] for k in range(1, 3)), axes[0] * row[0]) for row in GALACTIC)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z))))


def mjd_text(mjd: Column) -> Column:
    """A modified Julian date as ISO text with milliseconds; 0 and null are Unknown."""
    at = F.timestamp_millis(F.round((mjd - MJD_EPOCH) * SECONDS_PER_DAY * 1000).cast("long"))
    return F.when(F.coalesce(mjd, F.lit(0.0)) == 0, "Unknown").otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"))


def mjd_of(at: Column) -> Column:
    """The modified Julian date of a timestamp."""
    return F.unix_micros(at.cast("timestamp")) / (SECONDS_PER_DAY * 1e6) + MJD_EPOCH
