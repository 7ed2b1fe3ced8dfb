"""Sub-integrations decoded and averaged by column functions: packed bytes to samples, scales, weights, block means.

A row is a sub-integration: (keys, isub, data binary, dat_scl, dat_offs, dat_wts), its samples time by time with all
channels of one together. Nothing leaves the JVM, and a row becomes rows of averaged spectra before it is averaged, so
that a task holds one sub-integration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: as a lambda's argument it is not put into the lambdas that read it."""
    return F.get(F.transform(F.array(value), use), 0)


def byte_values(data: Column) -> Column:
    """The bytes of a binary column as an array of whole numbers from 0 to 255: each is one character of Latin-1."""
    characters = F.split(F.decode(data, "ISO-8859-1"), "")
    return F.when(F.length(data) > 0, F.transform(characters, F.ascii)).otherwise(F.array().cast("array<int>"))


def _float_of(b: list[Column]) -> Column:
    """The number that four bytes say, the highest first, as a 32-bit float."""
    exponent = F.shiftleft(b[0].bitwiseAND(127), 1).bitwiseOR(F.shiftright(b[1], 7))
    fraction = (F.shiftleft(b[1].bitwiseAND(127), 16) + F.shiftleft(b[2], 8) + b[3]).cast("double")
    sign = F.when(b[0] >= 128, F.lit(-1.0)).otherwise(F.lit(1.0))
    special = F.when(fraction > 0, F.lit(float("nan"))).otherwise(sign * F.lit(float("inf")))
    small = sign * fraction * F.lit(2.0**-149)
    return F.when(exponent == 255, special).when(exponent == 0, small).otherwise(sign * (fraction * F.lit(2.0**-23) + 1) * F.pow(F.lit(2.0), exponent - 127))


def samples(data: Column, nbits: int) -> Column:
    """An array of all samples: 2 bits left-aligned as 0, 64, 128 or 192, 8 bits as they are, -32 as floats."""
    held = byte_values(data)
    if nbits == 8:
        return F.transform(held, lambda b: b.cast("double"))
    if nbits == 2:
        return F.flatten(F.transform(held, lambda b: F.array(*(F.shiftleft(F.shiftright(b, 6 - 2 * k).bitwiseAND(3), 6).cast("double") for k in range(4)))))
    if nbits == -32:
        index = F.sequence(F.lit(0), (F.length(data) / 4 - 1).cast("int"))
        floats = _once(held, lambda h: F.transform(index, lambda i: _float_of([F.get(h, 4 * i + k) for k in range(4)])))
        return F.when(F.length(data) >= 4, floats).otherwise(F.array().cast("array<double>"))
    raise ValueError(f"unsupported bit depth: {nbits}")


def _mean(values: Column) -> Column:
    """The mean of what is there; null of nothing."""
    held = F.filter(values, lambda v: v.isNotNull() & ~F.isnan(v))
    return _once(held, lambda h: F.try_divide(F.aggregate(h, F.lit(0.0), lambda a, v: a + v), F.size(h)))


def averaged_spectra(subints: DataFrame, nchan: int, nsblk: int, nbits: int, mchan: int, msamp: int, *keys: str, scaled: bool = True, mask_dc: bool = False) -> DataFrame:
    """(keys, t, spectrum): means over ``mchan`` channels of each sample, then over ``msamp`` samples.

    Samples are scaled, offset and weighted first, unless told otherwise; with ``mask_dc`` every sixteenth channel does
    not count. A mean of nothing is null. t counts averaged spectra over all sub-integrations.
    """
    if nsblk % msamp or nchan % mchan:
        raise ValueError(f"{nsblk} samples of {nchan} channels do not divide into groups of {msamp} by {mchan}")
    groups, new = nsblk // msamp, nchan // mchan
    cut = _once(samples(F.col("data"), nbits), lambda x: F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.slice(x, g * (msamp * nchan) + 1, msamp * nchan)))
    rows = subints.select(*keys, "isub", *(["dat_scl", "dat_offs", "dat_wts"] if scaled else []), F.posexplode(cut).alias("_g", "_x"))

    def value(v: Column, i: Column) -> Column:
        channel = i % nchan
        out = (v * F.get("dat_scl", channel) + F.get("dat_offs", channel)) * F.get("dat_wts", channel) if scaled else v
        return F.when(channel % 16 != 0, out) if mask_dc else out

    def over_channels(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(msamp * new - 1)), lambda k: _mean(F.slice(x, k * mchan + 1, mchan)))

    def over_samples(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(new - 1)), lambda c: _mean(F.transform(F.sequence(F.lit(0), F.lit(msamp - 1)), lambda s: F.get(x, s * new + c))))

    spectrum = _once(_once(F.transform("_x", value), over_channels), over_samples)
    return rows.select(*keys, (F.col("isub").cast("long") * groups + F.col("_g")).alias("t"), spectrum.alias("spectrum"))
