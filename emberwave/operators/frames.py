"""The frames of whole figures: scatter plots, panels, layouts, tables of what an observation is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwave.functions import coords
from emberwave.operators import diag

#: Minutes of arc: the radius of a beam, the boundary of a pointing's beams, and the room around them.
BEAM_RADIUS, BOUNDARY_RADIUS, MARGIN = 3.5, 18.0, 5.0
#: Samples that are averaged in the overview's series.
FACTORS = (16, 128, 512, 1024)


def scatter(cands: DataFrame) -> DataFrame:
    """A point per candidate: dm, sn and time, for S/N over dm and dm over time."""
    return cands.select("dm", "sn", "time")


def cluster_scatter(clustered: DataFrame, representatives: DataFrame, *by: str) -> DataFrame:
    """A point per candidate with its cluster, and a point more for each representative."""
    own = clustered.select(*by, "time", "dm", "sn", "cluster", F.lit(False).alias("representative"))
    return own.unionByName(representatives.select(*by, "time", "dm", "sn", "cluster", F.lit(True).alias("representative")))


def mean_intensity(spectrum: DataFrame, factors: tuple[int, ...] = FACTORS) -> DataFrame:
    """(factor, t, x): the mean over channels of x as it is (factor 1) and averaged in time by each factor."""
    out = spectrum.groupBy("t").agg(F.avg("x").alias("x")).select(F.lit(1).alias("factor"), "t", "x")
    for factor in factors:
        averaged = diag.time_averaged(spectrum, factor, "chan").groupBy("t").agg(F.avg("x").alias("x"))
        out = out.unionByName(averaged.select(F.lit(factor).alias("factor"), "t", "x"))
    return out


def beam_layout(mapped: DataFrame) -> DataFrame:
    """Each beam's circle and what the axes span; one row for the boundary, with no beam, at the centre."""
    ends = mapped.agg(*(f(c).alias(f"{n}_{c}") for c in ("x_arcmin", "y_arcmin") for n, f in (("min", F.min), ("max", F.max))))
    span = [F.coalesce(F.col(f"{n}_{c}") + s * MARGIN, F.lit(s * (BOUNDARY_RADIUS + MARGIN))).alias(f"{n}_{c}") for c in ("x_arcmin", "y_arcmin") for n, s in (("min", -1), ("max", 1))]
    beams = mapped.select("beam", "x_arcmin", "y_arcmin", "level", F.lit(BEAM_RADIUS).alias("radius"))
    edge = ends.select(F.lit(None).cast(mapped.schema["beam"].dataType).alias("beam"), F.lit(0.0).alias("x_arcmin"), F.lit(0.0).alias("y_arcmin"), F.lit(None).cast("double").alias("level"), F.lit(BOUNDARY_RADIUS).alias("radius"))
    return beams.unionByName(edge).join(F.broadcast(ends.select(*span)))


def candidate_panel(cands: DataFrame, samples: int, trials: int, tsamp: Column) -> DataFrame:
    """The axes of a candidate's figure: (…, axis, k, value) for time, and for trials from dm - 5 to dm + 5."""
    time = F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: F.col("time") + k * tsamp)
    dms = F.transform(F.sequence(F.lit(0), F.lit(trials - 1)), lambda k: F.col("dm") - 5 + k * (10.0 / (trials - 1)))
    axes = F.explode(F.array(F.struct(F.lit("time").alias("axis"), time.alias("v")), F.struct(F.lit("dm").alias("axis"), dms.alias("v")))).alias("a")
    return cands.select("*", axes).select(*cands.columns, F.col("a.axis").alias("axis"), F.posexplode("a.v").alias("k", "value"))


def sn_plane(trials: DataFrame, centre: int, width: int) -> DataFrame:
    """(dm, t, z): series of several trials, each in deviations from its mean, around one sample."""
    return diag.cropped(diag.z_scored(trials, "x", "dm"), centre, width).select("dm", "t", "z")


def observation_table(headers: DataFrame, block_size: int, factor: int) -> DataFrame:
    """The nineteen fields that describe an observation, as text or numbers, beside ``headers``' own columns.

    Headers have src_raj, src_dej, tstart, tsamp, nspec, fch1, foff, nchans, nbits, source_name, barycentric,
    pulsarcentric and masked_frac; what is null is Unknown, a start of 0 too.
    """
    info = diag.observation_info(headers)
    text = lambda form, *c: F.format_string(form, *c)
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))
    values = {
        "object": known("source_name"),
        "telescope": F.lit("LOFAR"),
        "instrument": F.lit("Unknown"),
        "ra_text": coords.packed_ra_text(F.coalesce("src_raj", F.lit(0.0))),
        "dec_text": coords.packed_dec_text(F.coalesce("src_dej", F.lit(0.0))),
        "observation_date": coords.mjd_text(F.coalesce("tstart", F.lit(0.0))),
        "t_sample": text("%.6f", F.col("tsamp")),
        "t_total": text("%.2f", F.col("nspec") * F.col("tsamp")),
        "frequency_range": text("%.2f - %.2f", F.col("freq_min"), F.col("freq_max")),
        "block_size": F.lit(block_size),
        "rfi_fraction": text("%.2f%%", F.col("masked_frac") * 100),
        "averaging_factor": F.lit(factor),
        "num_channels": known("nchans"),
        "num_intervals": F.expr(f"nspec div {block_size}"),
        "is_barycentric": known("barycentric"),
        "is_pulsarcentric": known("pulsarcentric"),
        "sampling_time": text("%.6f", F.col("tsamp")),
        "number_of_bits": known("nbits"),
        "channel_width": text("%.6f", F.coalesce("foff", F.lit(0.0))),
    }
    return info.select(*headers.columns, *(v.alias(k) for k, v in values.items()))


def axis_header(headers: DataFrame) -> DataFrame:
    """The two axes in FITS terms: cdelt1 is the sampling, crval2 the far end of the band, cdelt2 a channel's width."""
    axes = {"mjd_obs": F.col("tstart"), "crpix1": F.lit(0), "crval1": F.lit(0.0), "cdelt1": F.col("tsamp"), "crpix2": F.lit(0), "crval2": F.col("foff") * F.col("nchans") + F.col("fch1"), "cdelt2": F.abs("foff")}
    return headers.withColumns(axes)


def group_frequencies(channels: DataFrame, mchan: int, *keys: str) -> DataFrame:
    """(keys, chan, nu): the mean frequency of each ``mchan`` channels."""
    return channels.groupBy(*keys, F.expr(f"chan div {mchan}").alias("chan")).agg(F.avg("nu").alias("nu"))
