"""Queries over files, control tables, figure frames and whole searches, each with its SQL.

Those over files write a table of the driver in a file format, in the shared folder, and read it back; their SQL
says what must come out of the table alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberwave.functions import messages
from emberwave.operators import asof, candidates, catalogue, crossbeam, cutouts, dedisperse, frames, prep, runs, sliding, subints
from emberwave.plans import oracle, search, settings, views
from emberwave.plans.shared import saved, shared_dir
from emberwave.sources import discover, sigproc, stores, textfiles
from emberwave.sources import series as series_files
from emberwave.streaming import arrivals, notices

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TSAMP = settings.Settings().tsamp


def _query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# Filterbanks.

#: A table of embeddings as spectra: a row is a time, its 64 values are the channels.
_WHOLE = f"""{oracle._SERIES}, times AS (SELECT series_id, row_number() OVER (ORDER BY series_id) - 1 AS n FROM (SELECT DISTINCT series_id FROM series) q),
 spectra AS (SELECT times.n AS t, series.t AS chan, CAST(CAST(x AS FLOAT) AS DOUBLE) AS x FROM series JOIN times ON times.series_id = series.series_id)"""
_HEADER = {"fch1": 150.0, "foff": -0.0625, "nchans": 64, "tsamp": 0.0078125, "source_name": "field", "telescope_id": 11}


def _spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.series(spark, sf_dir).select(F.col("series_id").alias("t"), F.transform("x", lambda v: v.cast("float")).alias("spectrum"))


def _write(spectra: DataFrame, path: str, mode: str, nbits: int = 32, at: int | None = None) -> None:
    sigproc.save(spectra, path, {**_HEADER, "nbits": nbits}, mode, at)


@_query(f"WITH {_WHOLE} SELECT t, chan, CASE WHEN t BETWEEN 10 AND 19 THEN -x ELSE x END AS x FROM spectra WHERE t BETWEEN 5 AND 1000")
def filterbank_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in two parts, ten spectra put over by their own negatives, and a span of times read back."""
    sigproc.register(spark)
    path, place = f"{shared_dir(spark, 'filterbank')}.fil", saved(_spectra(spark, sf_dir), "spectra")
    _write(place.where("t < 40"), path, "overwrite")
    _write(place.where("t >= 40"), path, "append")
    negative = place.where("t BETWEEN 10 AND 19").withColumn("spectrum", F.transform("spectrum", lambda v: -v))
    _write(negative, path, "append", at=10)
    back = spark.read.format("filterbank").option("spectra_per_task", "50").load(path).where("t >= 5 AND t <= 1000")
    return sigproc.long_form(back)


@_query(f"WITH {_WHOLE} SELECT t, chan, CAST(trunc(least(greatest(x * 30000 + 10000, 0), 65535)) AS DOUBLE) AS x FROM spectra")
def filterbank_16_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of 16 bits are clipped to their range and cut to whole numbers."""
    sigproc.register(spark)
    path = f"{shared_dir(spark, 'filterbank')}.fil"
    wide = _spectra(spark, sf_dir).withColumn("spectrum", F.transform("spectrum", lambda v: v.cast("double") * 30000 + 10000))
    _write(wide, path, "overwrite", nbits=16)
    return sigproc.long_form(spark.read.format("filterbank").load(path))


@_query(
    f"""WITH {_WHOLE} SELECT key, value FROM (VALUES ('bytes_per_spectrum', '256'), ('fch1', '150.0'), ('foff', '-0.0625'), ('folded', 'false'), ('freq_max', '150.0'), ('freq_min', '146.0625'), ('nbits', '32'),
 ('nchans', '64'), ('source_name', 'field'), ('telescope_id', '11'), ('tsamp', '0.0078125')) v(key, value) UNION ALL SELECT 'nspec', CAST(max(t) + 1 AS VARCHAR) FROM spectra"""
)
def filterbank_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    sigproc.register(spark)
    path = f"{shared_dir(spark, 'filterbank')}.fil"
    _write(_spectra(spark, sf_dir), path, "overwrite")
    return sigproc.metadata(spark, path).select("key", "value")


@_query(f"WITH {_WHOLE} SELECT t, chan, x FROM spectra WHERE t BETWEEN 64 AND 127")
def time_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a second of a file: from its time in seconds to spectra."""
    sigproc.register(spark)
    path = f"{shared_dir(spark, 'filterbank')}.fil"
    _write(_spectra(spark, sf_dir), path, "overwrite")
    return sigproc.long_form(sigproc.time_slice(spark.read.format("filterbank").load(path), 0.5, 1.0, _HEADER["tsamp"]))


# Sub-integrations.

#: An embedding as the 64 bytes of a sub-integration of sixteen channels: 4 samples of 8 bits, or 16 of 2.
_BYTES = """bytes AS (SELECT vec_id AS isub, i - 1 AS k, ((CAST(floor(CAST(embedding[CAST(i AS INTEGER)] AS DOUBLE) * 1000) AS BIGINT) % 256) + 256) % 256 AS b FROM embeddings, range(1, 65) r(i))"""
_CHANNELS = """SELECT isub, s, c, CASE WHEN {mask} THEN (raw * (1 + CAST(c AS DOUBLE) / 4) + c) * (CASE WHEN c = 3 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) END AS x FROM raw"""


def _averages(raw: str, groups: int, msamp: int, mask: str) -> str:
    return f"""WITH {_BYTES}, raw AS ({raw}), scaled AS ({_CHANNELS.format(mask=mask)}), first AS (SELECT isub, s, c // 4 AS c, avg(x) AS x FROM scaled GROUP BY isub, s, c // 4)
 SELECT isub * {groups} + s // {msamp} AS t, CAST(c AS BIGINT) AS chan, round(avg(x), 6) + 0 AS x FROM first GROUP BY isub, s // {msamp}, c, isub * {groups} + s // {msamp}"""


def _subints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written table of sub-integrations with scales, offsets and weights of their channels."""
    held = F.transform("x", lambda v: F.pmod(F.floor(v * 1000), F.lit(256)))
    data = F.unhex(F.array_join(F.transform(held, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    channels = [float(c) for c in range(16)]
    arrays = {"dat_scl": [1 + c / 4 for c in channels], "dat_offs": channels, "dat_wts": [0.0 if c == 3 else 1.0 for c in channels]}
    rows = views.series(spark, sf_dir).select(F.col("series_id").alias("isub"), data.alias("data"), *(F.array(*map(F.lit, v)).alias(k) for k, v in arrays.items()))
    return saved(rows, "subints")


def _long_spectra(spectra: DataFrame) -> DataFrame:
    return _rounded(spectra.select("t", F.posexplode("spectrum").alias("chan", "x")).withColumn("chan", F.col("chan").cast("long")), 6, "x")


@_query(_averages("SELECT isub, k * 4 // 16 + j // 16 AS s, (k * 4 + j) % 16 AS c, ((b >> CAST(6 - 2 * j AS BIGINT)) & 3) * 64 AS raw FROM bytes, range(0, 4) q(j)", 4, 4, "true"))
def subints_of_2_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a written table of packed sub-integrations to averaged spectra, by column functions alone."""
    return _long_spectra(subints.averaged_spectra(_subints(spark, sf_dir), 16, 16, 2, 4, 4))


@_query(_averages("SELECT isub, k // 16 AS s, k % 16 AS c, b AS raw FROM bytes", 2, 2, "c % 16 <> 0"))
def subints_without_dc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of samples of 8 bits, the channel that a subband begins with left out."""
    return _long_spectra(subints.averaged_spectra(_subints(spark, sf_dir), 16, 4, 8, 4, 2, mask_dc=True))


# Series and text.


@_query(
    f"""WITH {oracle._SERIES} SELECT printf('beam_DM%.1f', series_id + CAST(0.5 AS DOUBLE)) AS file, series_id + CAST(0.5 AS DOUBLE) AS dm, CAST(0.015625 AS DOUBLE) AS tsamp, 'field' AS object, t,
 CAST(CAST(x AS FLOAT) AS DOUBLE) AS x FROM series"""
)
def series_files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "series")
    trials = views.series(spark, sf_dir).select((F.col("series_id") + 0.5).alias("dm"), F.lit(2).alias("downsample"), "x")
    series_files.write_series(trials, folder, "beam", 0.0078125, {"source_name": "field", "nchans": 16, "foff": -0.0625})
    found = series_files.read_series(spark, folder)
    return found.select("file", "dm", "tsamp", "object", F.posexplode("x").alias("t", "x")).withColumn("t", F.col("t").cast("long"))


_TEXT = "CAST(printf('%.3f', dm) AS DOUBLE) AS dm, CAST(printf('%.3f', sn) AS DOUBLE) AS sn, CAST(printf('%.6f', time) AS DOUBLE) AS time, sample, filter_width"


@_query(f"WITH {oracle._CANDS} SELECT {_TEXT} FROM cands")
def candidate_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "list")
    textfiles.write_candidates(views.candidates(spark, sf_dir), path)
    return textfiles.read_candidates(spark, path)


@_query(f"WITH {oracle._CANDS} SELECT CAST(beam AS VARCHAR) AS beam, {_TEXT} FROM cands")
def collected_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "list")
    textfiles.write_collected(views.candidates(spark, sf_dir), path)
    return textfiles.read_candidates(spark, path, with_beam=True)


@_query(f"WITH {oracle._CANDS} SELECT dm, sn, time, sample, CAST(filter_width AS INTEGER) AS filter_width, beam % 7 AS cluster FROM cands")
def clustered_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "list")
    own = views.candidates(spark, sf_dir).select(F.col("dm").alias("DM"), F.col("sn").alias("S/N"), F.col("time").alias("Time"), F.col("sample").cast("double").alias("Sample"), F.col("filter_width").alias("Width"), (F.col("beam") % 7).alias("Cluster"))
    textfiles.write_clustered(own, path)
    return textfiles.read_clustered(spark, path)


@_query(
    """SELECT 'f' || o_orderkey AS file, CAST(printf('%.6f', o_custkey / CAST(1000 AS DOUBLE)) AS DOUBLE) AS tsamp, 'obj' || o_custkey AS object, CAST(NULL AS VARCHAR) AS frequency_range, 'LOFAR' AS telescope, CAST(NULL AS VARCHAR) AS instrument,
 CAST(NULL AS VARCHAR) AS observation_date FROM orders"""
)
def sidecar_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    lines = F.array(
        F.format_string(" Width of each time series bin (sec)    =  %.6f", F.col("o_custkey") / 1000.0),
        F.concat(F.lit(" Object being observed                  =  obj"), F.col("o_custkey").cast("string")),
        F.lit(" Telescope used                         =  LOFAR"),
        F.lit(" Something else                         =  x"),
    )
    return textfiles.parse_sidecar(orders.select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("file"), F.explode(lines).alias("value")))


_URLS = "urls AS (SELECT 'https://host/a/L' || (o_orderkey % 5) || '_SAP00' || (o_orderkey % 3) || '_B' || lpad(CAST(o_custkey % 74 AS VARCHAR), 3, '0') || '_' || o_orderkey AS url, 'L' || (o_orderkey % 5) AS obsid, 'SAP00' || (o_orderkey % 3) AS sap, 'B' || lpad(CAST(o_custkey % 74 AS VARCHAR), 3, '0') AS field FROM orders)"


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, beam = F.col("o_orderkey"), F.lpad((F.col("o_custkey") % 74).cast("string"), 3, "0")
    url = F.concat(F.lit("https://host/a/L"), (key % 5).cast("string"), F.lit("_SAP00"), (key % 3).cast("string"), F.lit("_B"), beam, F.lit("_"), key.cast("string"), F.lit(" \r"))
    lines = views.table(spark, sf_dir, "orders").select(F.explode(F.array(url, F.lit("# comment"), F.lit("  "))).alias("value"))
    return textfiles.parse_addresses(lines)


@_query(f"WITH {_URLS} SELECT url, obsid, sap, row_number() OVER (ORDER BY field, url) AS place FROM urls")
def address_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _addresses(spark, sf_dir)
    return found.select("url", "obsid", "sap", F.row_number().over(Window.orderBy("field", "url")).cast("long").alias("place"))


@_query(f"WITH {_URLS} SELECT (SELECT count(*) FROM urls) AS n, url AS first_url, obsid, sap FROM urls ORDER BY field, url LIMIT 1")
def address_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textfiles.address_summary(_addresses(spark, sf_dir))


_STAGED = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'success' ELSE 'in progress' END AS status, o_orderdate FROM orders"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(key % 4 == 1, "success").when(key % 4 != 0, "in progress")
    surls = F.array_repeat(F.struct(F.lit("srm://x").alias("surl")), (key % 3).cast("int"))
    answer = F.to_json(F.struct(key.cast("int").alias("id"), status.alias("currentStatusCode"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("when"), surls.alias("surls")))
    return textfiles.parse_staging(views.table(spark, sf_dir, "orders").select(answer.alias("value")))


@_query(
    f"""WITH r AS ({_STAGED}) SELECT 'same' AS test, CAST(id AS INTEGER) AS id, CAST(id % 3 AS INTEGER) AS n_surls FROM r WHERE status = 'success'
 UNION ALL SELECT 'other', CAST(id AS INTEGER), CAST(id % 3 AS INTEGER) FROM r WHERE status IS DISTINCT FROM 'success'
 UNION ALL SELECT 'recent', CAST(id AS INTEGER), CAST(id % 3 AS INTEGER) FROM r WHERE CAST(o_orderdate AS TIMESTAMP) >= TIMESTAMP '1997-06-30 00:00:00' - INTERVAL 24 HOUR"""
)
def staging_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _requests(spark, sf_dir)
    parts = {"same": textfiles.staging_progress(found, "success"), "other": textfiles.staging_progress(found, "success", equal=False), "recent": textfiles.staged_since(found, "1997-06-30 00:00:00")}
    out = [frame.select(F.lit(name).alias("test"), "id", "n_surls") for name, frame in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


_PATHS = "paths AS (SELECT '/data/' || CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE 'B' END || lpad(CAST(o_custkey % 40 AS VARCHAR), 3, '0') || '/L1_BEAM' || (o_orderkey % 74) || '_' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '_32bit.fil' ELSE '.fits' END AS path, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE 'B' END || lpad(CAST(o_custkey % 40 AS VARCHAR), 3, '0') AS folder, o_orderkey % 74 AS beam FROM orders)"


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    end = F.when(key % 2 == 0, "_32bit.fil").otherwise(".fits")
    folder = F.concat(F.when(key % 3 == 0, "X").otherwise("B"), F.lpad((F.col("o_custkey") % 40).cast("string"), 3, "0"))
    path = F.concat(F.lit("/data/"), folder, F.lit("/L1_BEAM"), (key % 74).cast("string"), F.lit("_"), key.cast("string"), end)
    return discover.with_names(views.table(spark, sf_dir, "orders").select(path.alias("path")))


@_query(f"WITH {_PATHS} SELECT path, CAST(beam AS INTEGER) AS beam, folder LIKE 'B%' AS in_beam_folder FROM paths WHERE path LIKE '%_32bit.fil'")
def beam_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _listed(spark, sf_dir)
    return discover.beam_files(listed).join(listed.select("path", discover.in_beam_folder(F.col("folder"), F.col("name")).alias("in_beam_folder")), "path")


@_query(f"WITH {_PATHS} SELECT folder, min(path) AS path FROM paths WHERE path LIKE '%.fits' GROUP BY folder")
def first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.first_in_folder(_listed(spark, sf_dir)).select("folder", "path")


# Lines and scalars.


@_query(
    f"""WITH {oracle._CATALOGUE}, cells AS (SELECT DISTINCT CAST(floor(ra_deg) AS BIGINT) AS l_cell, CAST(floor(dec_deg) AS BIGINT) AS b_cell FROM catalogue WHERE ord % 20 = 0)
 SELECT c.ord, printf('RA: %s  DEC: %s | l: %.2f b: %.2f', c.psrj, c.psrj, c.ra_deg, c.dec_deg) || chr(10) || 'Max DM NE2001: ' || coalesce(printf('%.1f', CAST(x.l_cell AS DOUBLE) + 0.5), 'unknown') || ' | Max DM YMW16: ' || coalesce(printf('%.1f', CAST(x.b_cell AS DOUBLE)), 'unknown') AS line,
 printf('*Redetected:* %s  DM=%.2f  highest S/N=%.2f  Width=%d', c.psrj, c.dm, c.dm / 4, c.ord) AS again FROM catalogue c LEFT JOIN cells x ON x.l_cell = floor(c.ra_deg) AND x.b_cell = floor(c.dec_deg)"""
)
def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.catalogue(spark, sf_dir)
    cells = sources.where("ord % 20 = 0").select(F.floor("ra_deg").alias("l_cell"), F.floor("dec_deg").alias("b_cell")).distinct()
    table = cells.withColumn("dm_a", F.col("l_cell") + 0.5).withColumn("dm_b", F.col("b_cell").cast("double"))
    found = messages.with_max_dm(sources.withColumn("l_deg", F.col("ra_deg")).withColumn("b_deg", F.col("dec_deg")), table)
    line = messages.galactic_line(F.col("psrj"), F.col("psrj"), F.col("l_deg"), F.col("b_deg"), F.col("dm_a"), F.col("dm_b"))
    return found.select("ord", line.alias("line"), messages.redetection_line(F.col("psrj"), F.col("dm"), F.col("dm") / 4, F.col("ord")).alias("again"))


@_query(
    """WITH p AS (SELECT p_partkey, CAST(150 + p_size AS DOUBLE) AS fch1, CAST(-0.0625 AS DOUBLE) AS foff, p_size * 16 AS nchans FROM part) SELECT p_partkey, fch1 + foff * nchans AS crval2, abs(foff) AS cdelt2, CAST(0.25 AS DOUBLE) AS cdelt1,
 printf('%.2f - %.2f', fch1 + foff * (nchans - 1), fch1) AS frequency_range, printf('%.2f', p_partkey * CAST(0.25 AS DOUBLE)) AS t_total, '0.250000' AS t_sample, printf('%.2f%%', CAST(12.5 AS DOUBLE)) AS rfi_fraction, CAST(nchans AS VARCHAR) AS num_channels,
 CAST(p_partkey // 10 AS BIGINT) AS num_intervals, '-0.062500' AS channel_width, 'Unknown' AS is_barycentric, CASE WHEN p_partkey % 2 = 0 THEN 'x' ELSE 'Unknown' END AS object FROM p"""
)
def observation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, key = views.table(spark, sf_dir, "part"), F.col("p_partkey")
    none = F.lit(None).cast("int")
    header = part.select("p_partkey", (F.lit(150.0) + F.col("p_size")).alias("fch1"), F.lit(-0.0625).alias("foff"), (F.col("p_size") * 16).alias("nchans"), F.lit(0.25).alias("tsamp"), key.cast("long").alias("nspec"), F.lit(0.125).alias("masked_frac"), F.lit(0.0).alias("src_raj"), F.lit(0.0).alias("src_dej"), F.lit(0.0).alias("tstart"), F.lit(32).alias("nbits"), none.alias("barycentric"), none.alias("pulsarcentric"), F.when(key % 2 == 0, "x").alias("source_name"))
    found = frames.axis_header(frames.observation_table(header, 10, 128))
    return found.select("p_partkey", "crval2", "cdelt2", "cdelt1", "frequency_range", "t_total", "t_sample", "rfi_fraction", "num_channels", "num_intervals", "channel_width", "is_barycentric", "object")


@_query(f"WITH {oracle._SERIES}, c AS (SELECT DISTINCT beam, series_id FROM series) SELECT beam, series_id // 4 AS chan, round(avg(CAST(150 AS DOUBLE) - series_id * CAST(0.01 AS DOUBLE)), 8) AS nu FROM c GROUP BY beam, series_id // 4")
def group_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = views.series(spark, sf_dir).select("beam", F.col("series_id").alias("chan"), (F.lit(150.0) - F.col("series_id") * 0.01).alias("nu"))
    return _rounded(frames.group_frequencies(channels, 4, "beam"), 8, "nu")


@_query("WITH p(seg, low_dm, high_dm, ddm, downsample) AS (VALUES " + ", ".join(f"({k}, CAST({s.low_dm} AS DOUBLE), CAST({s.high_dm} AS DOUBLE), CAST({s.ddm} AS DOUBLE), {s.downsample})" for k, s in enumerate(settings.PLAN)) + f"), {oracle._CANDS} SELECT p.*, (SELECT count(*) FROM cands WHERE dm >= low_dm AND dm < high_dm) AS n_cands FROM p")
def settings_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of settings that were written and read, with how many candidates lie in each segment."""
    plan = settings.plan_table(spark, settings.Settings.load(settings.Settings().dump()).plan)
    # A segment is found by its number, which a CASE over the plan tells.
    of = F.coalesce(*(F.when((F.col("dm") >= s.low_dm) & (F.col("dm") < s.high_dm), k) for k, s in enumerate(settings.PLAN)))
    counts = views.candidates(spark, sf_dir).groupBy(of.alias("seg")).agg(F.count("*").alias("n_cands"))
    return plan.join(counts, "seg", "left").fillna(0, ["n_cands"])


# Figures.


@_query(f"WITH {oracle._CANDS} SELECT dm, sn, time FROM cands")
def scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.scatter(views.candidates(spark, sf_dir))


_FACTORS = (2, 16)


@_query(
    f"""WITH {oracle._SAMPLES}, lens AS (SELECT chan, count(*) AS n FROM samples GROUP BY chan) SELECT 1 AS factor, t, round(avg(x), 11) + 0 AS x FROM samples GROUP BY t"""
    + "".join(f" UNION ALL SELECT {k}, t, round(avg(x), 11) + 0 FROM (SELECT s.chan, s.t // {k} AS t, avg(s.x) AS x FROM samples s JOIN lens l ON l.chan = s.chan WHERE s.t < l.n // {k} * {k} GROUP BY s.chan, s.t // {k}) q GROUP BY t" for k in _FACTORS)
)
def mean_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(frames.mean_intensity(views.samples(spark, sf_dir), _FACTORS), 11, "x")


@_query(
    f"""WITH {oracle._SAMPLES}, cands AS (SELECT DISTINCT t % 7 AS k0, CAST(t % 7 AS DOUBLE) AS time, CAST(100 + t % 7 AS DOUBLE) AS dm FROM samples) SELECT time, dm, 'time' AS axis, CAST(r.r AS INTEGER) AS k, time + r.r * CAST(0.5 AS DOUBLE) AS value FROM cands, range(0, 8) r(r)
 UNION ALL SELECT time, dm, 'dm', CAST(r.r AS INTEGER), dm - 5 + r.r * CAST(2.5 AS DOUBLE) FROM cands, range(0, 5) r(r)"""
)
def candidate_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("t") % 7
    cands = views.samples(spark, sf_dir).select(k.cast("double").alias("time"), (k + 100).cast("double").alias("dm")).distinct()
    return frames.candidate_panel(cands, 8, 5, F.lit(0.5))


@_query(
    """WITH b AS (SELECT CAST(p_partkey AS BIGINT) AS beam, CAST(p_size AS DOUBLE) AS x, CAST(p_size - 25 AS DOUBLE) AS y FROM part WHERE p_partkey <= 50), e AS (SELECT min(x) - 5 AS x0, max(x) + 5 AS x1, min(y) - 5 AS y0, max(y) + 5 AS y1 FROM b)
 SELECT beam, x AS x_arcmin, y AS y_arcmin, CAST(0.5 AS DOUBLE) AS level, CAST(3.5 AS DOUBLE) AS radius, x0 AS min_x_arcmin, x1 AS max_x_arcmin, y0 AS min_y_arcmin, y1 AS max_y_arcmin FROM b, e
 UNION ALL SELECT NULL, 0, 0, NULL, 18, x0, x1, y0, y1 FROM e"""
)
def beam_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty beams, which is what a pointing has; the layout is of beams, not of rows."""
    size = F.col("p_size").cast("double")
    beams = views.table(spark, sf_dir, "part").where("p_partkey <= 50").select(F.col("p_partkey").cast("long").alias("beam"), size.alias("x_arcmin"), (size - 25).alias("y_arcmin"), F.lit(0.5).alias("level"))
    return frames.beam_layout(beams)


@_query(f"WITH {oracle._SERIES}, s AS (SELECT series_id, avg(x) AS m, stddev_pop(x) AS d FROM series GROUP BY series_id) SELECT CAST(series.series_id AS DOUBLE) AS dm, t, round((x - m) / d, 4) + 0 AS z FROM series JOIN s ON s.series_id = series.series_id WHERE t >= 24 AND t < 40")
def sn_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = views.series(spark, sf_dir).select(F.col("series_id").cast("double").alias("dm"), F.posexplode("x").alias("t", "x")).withColumn("t", F.col("t").cast("long"))
    return _rounded(frames.sn_plane(trials, 32, 16), 4, "z")


@_query(f"WITH {oracle._SERIES}, s AS (SELECT series_id, stddev_pop(x) AS d FROM series GROUP BY series_id) SELECT series.series_id, round(x / d, 5) + 0 AS sn FROM series JOIN s ON s.series_id = series.series_id WHERE t = 30")
def raw_beam_sn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(search.raw_sn(views.series(spark, sf_dir), 7.4, 0.25, "series_id"), 5, "sn")


# Candidates, beams and runs.


@_query(f"WITH {oracle._CANDS} SELECT beam, {_TEXT} FROM cands")
def union_beams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of all beams, written as text in a folder each and read under one another in one scan."""
    path = shared_dir(spark, "lists")
    own = views.candidates(spark, sf_dir).withColumn("folder", F.format_string("B%03d", "beam"))
    textfiles.candidate_lines(own, "folder").write.partitionBy("folder").text(path)
    return textfiles.read_beams(spark, path)


@_query("SELECT name, beam FROM (SELECT 'B' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS name, s_suppkey AS beam FROM supplier WHERE s_suppkey % 3 <> 0) q ORDER BY name LIMIT 75")
def first_beams(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    beams = views.table(spark, sf_dir, "supplier").select(F.concat(F.lit("B"), F.lpad(key.cast("string"), 4, "0")).alias("name"), key.alias("beam"), (key % 3 != 0).alias("ok"))
    return crossbeam.first_successful(beams).select("name", "beam")


@_query(f"WITH {oracle._SAMPLES}, b AS (SELECT chan % 4 AS beam, chan // 4 AS chan, t, x FROM samples), m AS (SELECT chan, t, avg(x) AS m FROM b GROUP BY chan, t) SELECT beam, b.chan, b.t, round(CASE WHEN m <> 0 THEN x / m END, 6) + 0 AS x FROM b JOIN m ON m.chan = b.chan AND m.t = b.t")
def flatfield_unpadded(spark: SparkSession, sf_dir: str) -> DataFrame:
    beams = views.samples(spark, sf_dir).select((F.col("chan") % 4).alias("beam"), F.expr("chan div 4").alias("chan"), "t", "x")
    blocks = saved(prep.time_blocks(beams, 256, "beam", "chan"), "blocks")
    flat = prep.flat_fielded_blocks(blocks, prep.mean_beam_blocks(blocks, 256, 0, 73, fill=False))
    return _rounded(prep.from_blocks(flat, 256, "beam", "chan"), 6, "x")


@_query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS beam_id, CASE WHEN s_suppkey % 5 = 0 THEN 'error' ELSE 'processing' END AS outcome, CASE WHEN s_suppkey % 5 = 0 THEN 'disk full' END AS error_message FROM supplier WHERE s_suppkey % 5 < 2"""
)
def failed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of each beam is started; of five one fails, one is left as it is and three are classified."""
    key = F.col("s_suppkey")
    beams = views.table(spark, sf_dir, "supplier").select(key.cast("string").alias("beam_id"), F.lit("2024-01-01").alias("observation_date"))
    begun = saved(runs.started(beams, "v"), "begun")
    number = F.col("beam_id").cast("long") % 5
    failed = runs.updated(begun.where(number == 0), "error", error_message="disk full")
    done = runs.updated(begun.where(number >= 2), "classified", num_candidates=3)
    return search.failed_beams(saved(begun.unionByName(failed).unionByName(done), "events"))


@_query(
    f"""WITH {oracle._CANDS}, {oracle._CATALOGUE}, {oracle._TOP}, {oracle._GATED}, {oracle._matches('gated')}, found AS (SELECT g.*, f.psrj FROM gated g LEFT JOIN firsts f ON f.dm = g.dm),
 best AS (SELECT *, row_number() OVER (PARTITION BY psrj ORDER BY {oracle._ORDER}) AS k FROM found WHERE psrj IS NOT NULL)
 SELECT (SELECT count(*) FROM found WHERE psrj IS NULL) AS n_candidates, (SELECT count(*) FROM best WHERE k = 1) AS n_redetections"""
)
def redetection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = candidates.gate(candidates.top_per_dm(views.candidates(spark, sf_dir)), 10.0, 7.0)
    return candidates.redetection_counts(catalogue.labelled(top, views.catalogue(spark, sf_dir)))


@_query(
    f"""WITH {oracle._CANDS}, {oracle._CATALOGUE}, {oracle._TOP}, {oracle._GATED}, {oracle._matches('gated')}, found AS (SELECT g.*, f.psrj FROM gated g LEFT JOIN firsts f ON f.dm = g.dm),
 best AS (SELECT *, row_number() OVER (PARTITION BY psrj ORDER BY {oracle._ORDER}) AS k FROM found WHERE psrj IS NOT NULL)
 SELECT CAST(beam AS VARCHAR) AS beam_id, dm AS candidate_dm, sn AS snr, CAST(filter_width AS INTEGER) AS width_samples, 'known_pulsar' AS detection_type, psrj AS pulsar_name FROM best WHERE k = 1
 UNION ALL SELECT CAST(beam AS VARCHAR), dm, sn, CAST(filter_width AS INTEGER), 'candidate', NULL FROM found WHERE psrj IS NULL"""
)
def detection_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = candidates.gate(candidates.top_per_dm(views.candidates(spark, sf_dir)), 10.0, 7.0)
    rows = runs.detection_rows(catalogue.labelled(top, views.catalogue(spark, sf_dir)))
    return rows.select("beam_id", "candidate_dm", "snr", "width_samples", "detection_type", "pulsar_name")


_HEADS = "a AS (SELECT p_partkey AS key FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_partkey AS key FROM part WHERE p_partkey % 5 <> 0)"


@_query(f"WITH {_HEADS} SELECT 'both' AS side, key FROM (SELECT key FROM a INTERSECT SELECT key FROM b) q UNION ALL SELECT 'a', key FROM (SELECT key FROM a EXCEPT SELECT key FROM b) q UNION ALL SELECT 'b', key FROM (SELECT key FROM b EXCEPT SELECT key FROM a) q")
def header_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"))
    a, b = keys.where("key % 3 <> 0"), keys.where("key % 5 <> 0")
    sides = {"both": runs.common_keys(a, b), "a": runs.keys_only_in(a, b), "b": runs.keys_only_in(b, a)}
    out = [frame.select(F.lit(side).alias("side"), "key") for side, frame in sides.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@_query(
    """WITH p AS (SELECT vec_id AS cand_id, (vec_id % 9) / CAST(8 AS DOUBLE) AS a, (vec_id % 5) / CAST(8 AS DOUBLE) AS b FROM embeddings) SELECT cand_id, 'FETCH Classification Probabilities:' || chr(10) || 'A: ' || printf('%.4f', a) || chr(10) || 'B: ' || printf('%.4f', b) || chr(10) || 'Highest Probability: ' || printf('%.4f', greatest(a, b)) || chr(10) ||
 'Classified as Astrophysical? ' || CASE WHEN greatest(a, b) > 0.5 THEN 'YES' ELSE 'NO' END AS text, greatest(a, b) AS max_prob, CAST(64 AS INTEGER) AS pixels FROM p"""
)
def candidate_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their images as a written table, and the text of each one's classification."""
    own = views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), F.array((F.col("vec_id") % 9) / 8.0, (F.col("vec_id") % 5) / 8.0).alias("probs"), F.col("embedding").cast("array<double>").alias("frequency_time"))
    path = shared_dir(spark, "images")
    cutouts.write_images(own.withColumn("dm_time", F.col("frequency_time")), path)
    back = cutouts.read_images(spark, path)
    return back.select("cand_id", messages.result_lines(F.col("probs"), ("a", "b")).alias("text"), F.array_max("probs").alias("max_prob"), F.size("frequency_time").alias("pixels"))


# Whole transforms and searches.

_DM, _DOWN = 60.7, 2
_NU = "CAST(150 AS DOUBLE) - series_id * CAST(0.01 AS DOUBLE)"


@_query(
    f"""WITH {oracle._SERIES}, tops AS (SELECT beam, max({_NU}) AS top FROM series GROUP BY beam),
 lags AS (SELECT DISTINCT s.series_id, s.beam, {_DM} * (1 / pow({_NU}, 2) - 1 / pow(top, 2)) / 2.41e-4 AS lag FROM series s JOIN tops ON tops.beam IS NOT DISTINCT FROM s.beam),
 bins AS (SELECT CAST(k.k * {_DOWN} AS BIGINT) AS k FROM range(0, {32 // _DOWN + 1}) k(k)),
 dft AS (SELECT s.series_id, s.beam, b.k, sum(x * cos(2 * pi() * b.k * t / 64)) AS re, -sum(x * sin(2 * pi() * b.k * t / 64)) AS im FROM series s, bins b GROUP BY s.series_id, s.beam, b.k),
 turned AS (SELECT d.beam, d.k // {_DOWN} AS j, sum(re * cos(p) - im * sin(p)) AS re, sum(re * sin(p) + im * cos(p)) AS im FROM (SELECT d.*, 2 * pi() * d.k / (64 * {TSAMP!r} * {_DOWN}) * l.lag AS p FROM dft d JOIN lags l ON l.series_id = d.series_id) d GROUP BY d.beam, d.k // {_DOWN})
 SELECT beam, n.n AS t, round(sum(CASE WHEN j = 0 THEN re WHEN j = {32 // _DOWN} THEN re * cos(pi() * n.n) ELSE 2 * (re * cos(2 * pi() * j * n.n / {64 // _DOWN}) - im * sin(2 * pi() * j * n.n / {64 // _DOWN})) END) / {64 // _DOWN}, 4) + 0 AS x
 FROM turned, range(0, {64 // _DOWN}) n(n) GROUP BY beam, n.n"""
)
def dedisperse_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One downsampled trial at a dm where every channel lags: phases, folding and the inverse transform."""
    spectrum = views.series(spark, sf_dir).select("beam", (F.lit(150.0) - F.col("series_id") * 0.01).alias("nu"), "x")
    grid = spark.createDataFrame([(_DM, _DOWN)], "dm double, downsample int")
    found = dedisperse.dedisperse(spectrum, grid, TSAMP, "beam", chunk=8)
    return _rounded(found.select("beam", F.posexplode("x").alias("t", "x")).withColumn("t", F.col("t").cast("long")), 4, "x")


#: Spectra that a task makes at a time.
_RUN = 8192


def _noise(path: str, n_values: int, total: int, header: dict, beam: int, dm: float, height: float):
    """Spectra of a beam from the values in a file of one channel, which tasks read in ranges, with a pulse at 12 s."""
    nu = header["fch1"] + header["foff"] * np.arange(header["nchans"])
    lags, spread = dedisperse.delays(dm, nu, nu.max()), 8 * header["tsamp"] / 2.35

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = sigproc.layout(path).size
        with stores.opened(path) as file:

            def values(at: int, n: int) -> np.ndarray:
                parts = []
                while n:
                    at %= n_values
                    m = min(n, n_values - at)
                    file.seek(begin + 4 * at)
                    parts.append(np.frombuffer(file.read(4 * m), "<f4").astype(float))
                    at, n = at + m, n - m
                return np.concatenate(parts)

            for first in (k for batch in batches for k in batch.column("id").to_pylist()):
                t = np.arange(first, min(first + _RUN, total))
                x = np.empty((len(t), len(nu)), np.float32)
                for chan in range(len(nu)):
                    e, u = (values(int(first) + chan * a + beam * b, len(t)) for a, b in ((7919, 104729), (15485863, 1299709)))
                    off = (t * header["tsamp"] - 12.0 - lags[chan]) / spread
                    x[:, chan] = 100.0 + np.sqrt(e * 2) * np.cos((1 - np.exp(-u)) * 2 * np.pi) + height * np.exp(-0.5 * off * off)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.ListArray.from_arrays(pa.array(np.arange(len(t) + 1) * len(nu), pa.int32()), pa.array(x.ravel()))], ["t", "spectrum"])

    return run


def _injected(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Three beams of noise as filterbanks; beam 14 has a pulse at dm 60.7, beam 15 one at dm 40 of a known source.

    The noise is made of the events' values, and as long as there are events: two of them, far apart and of another
    distance in each channel of each beam, are a radius and an angle, which gives normal deviates. The values are a file of
    one channel; as the values of a channel follow each other there, tasks read ranges of it and no sample is shuffled.
    """
    sigproc.register(spark)
    header = {"fch1": 150.0, "foff": -1.0, "nchans": 32, "tsamp": TSAMP, "nbits": 32, "source_name": "field"}
    path = f"{shared_dir(spark, 'values')}.fil"
    sigproc.save(views.table(spark, sf_dir, "events").select(F.col("event_id").alias("t"), F.array((F.col("value") / 50).cast("float")).alias("spectrum")), path, {"nchans": 1, "tsamp": TSAMP})
    n = sigproc.layout(path).nspec
    total = max(4096, n)
    for beam, dm, height in ((13, 0.0, 0.0), (14, 60.7, 9.0), (15, 40.0, 9.0)):
        spectra = spark.range(0, total, _RUN).mapInArrow(_noise(path, n, total, header, beam, dm, height), sigproc.SPECTRA)
        name = f"{folder}/downsampled_L1_SAP0_BEAM{beam}_32bit_ff.fil"
        spectra.write.format("filterbank").options(**{k: str(v) for k, v in header.items()}).mode("overwrite").save(name)


_SEARCH = settings.Settings(rfi_block_size=512, sigma_low=5.0, sigma_high=5.0, bad_channel=-1, detection_threshold=7.0, cluster_gate=7.0, max_width_s=0.5, probability_gate=0.0, plan=(settings.Segment(30.0, 80.0, 1.0, 1),))


def _folder(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_dir(spark, "beams")
    stores.folder(folder)
    _injected(spark, sf_dir, folder)
    return folder


@_query(
    """SELECT * FROM (VALUES (CAST(14 AS BIGINT), 'candidate', CAST(NULL AS VARCHAR), true, true), (CAST(15 AS BIGINT), 'known_pulsar', 'J0000+40', true, true)) v(beam, detection_type, psrj, dm_right, time_right) WHERE EXISTS (SELECT 1 FROM events)"""
)
def search_of_a_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From filterbank files to labelled detections: the best of each beam, and whether it is the pulse put in."""
    sources = spark.createDataFrame([("J0000+40", 40.0, 1)], "psrj string, dm double, ord long")
    found = search.run_search(spark, _folder(spark, sf_dir), sources, shared_dir(spark, "search"), _SEARCH)
    best = found.withColumn("_rank", F.row_number().over(Window.partitionBy("beam").orderBy(*candidates.best_first()))).where("_rank = 1")
    put = F.when(F.col("beam") == 14, 60.7).otherwise(40.0)
    near = (F.abs(F.col("dm") - put) <= 1.5).alias("dm_right"), (F.abs(F.col("time") - 12.0) <= 8 * TSAMP).alias("time_right")
    return best.select(F.col("beam").cast("long").alias("beam"), "detection_type", "psrj", *near)


@_query("SELECT * FROM (VALUES (CAST(14 AS BIGINT), CAST(1 AS BIGINT), true), (CAST(13 AS BIGINT), CAST(2 AS BIGINT), false), (CAST(15 AS BIGINT), CAST(3 AS BIGINT), false)) v(other, rank, seen) WHERE EXISTS (SELECT 1 FROM events)")
def follow_up_of_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate of beam 14 in all beams next to it: it is seen in its own alone."""
    channels = saved(search.channel_arrays(search.beam_blocks(spark, _folder(spark, sf_dir))), "channels")
    spectra = search.normalised_arrays(channels).withColumn("x", F.transform("x", lambda v: v.cast("double") / F.col("_m") - 1)).drop("_m")
    cands = spark.createDataFrame([(14, 60.7, 12.0, 8)], "beam int, dm double, time double, filter_width int")
    found = search.follow_up(cands, spectra, TSAMP)
    return found.select(F.col("other").cast("long").alias("other"), F.col("rank").cast("long").alias("rank"), (F.col("sn") > 7).alias("seen"))


# Times and places.

_SEEN = """seen AS (SELECT user_id % 73 AS beam, CAST(epoch_us(ts) // 1000 % 3600000 AS DOUBLE) / 1000 AS time, min(event_id) AS event, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2)"""


@_query(
    f"""WITH {oracle._CANDS}, {_SEEN}, b AS (SELECT c.*, s.time AS b_time, s.event AS b_event FROM cands c ASOF LEFT JOIN seen s ON s.beam = c.beam AND s.time <= c.time),
 a AS (SELECT b.*, s.time AS a_time, s.event AS a_event FROM b ASOF LEFT JOIN seen s ON s.beam = b.beam AND s.time > b.time)
 SELECT beam, time, sample, b_event AS last_event, a_event AS next_event, CASE WHEN b_time IS NULL OR a_time - time < time - b_time THEN a_event ELSE b_event END AS nearest_event FROM a"""
)
def events_of_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each candidate with the last, the next and the nearest event of its beam."""
    seen = views.table(spark, sf_dir, "events").select((F.col("user_id") % 73).alias("beam"), (F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000 % 3600000").cast("double") / 1000).alias("time"), F.col("event_id").alias("event"))
    seen = saved(seen.groupBy("beam", "time").agg(F.min("event").alias("event")), "seen")
    cands = views.candidates(spark, sf_dir).select("beam", "time", "sample")
    met = asof.asof_each(cands, seen, "beam", prefixes={d: f"{d}_" for d in ("backward", "forward", "nearest")})
    return met.select("beam", "time", "sample", F.col("backward_event").alias("last_event"), F.col("forward_event").alias("next_event"), F.col("nearest_event"))


#: Parts and suppliers all over the sphere, poles and both sides of 0 among them.
_SKY = {"part": "p_partkey", "supplier": "s_suppkey"}
_PLACE = "CAST(({key} * 7919) % 36000 AS DOUBLE) / 100 AS ra_deg, CAST(({key} * 104729) % 18001 AS DOUBLE) / 100 - 90 AS dec_deg"


@_query(
    f"""WITH s AS (SELECT p_partkey AS source, {_PLACE.format(key="p_partkey")} FROM part), c AS (SELECT s_suppkey AS centre, {_PLACE.format(key="s_suppkey")} FROM supplier),
 met AS (SELECT centre, source, degrees(2 * asin(least(1, sqrt(power(sin(radians(s.dec_deg - c.dec_deg) / 2), 2) + cos(radians(c.dec_deg)) * cos(radians(s.dec_deg)) * power(sin(radians(s.ra_deg - c.ra_deg) / 2), 2))))) AS sep FROM c, s)
 SELECT centre, source, round(sep, 5) + 0 AS sep_deg FROM met WHERE sep <= 5"""
)
def cone_match_of_the_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts within five degrees of each supplier, as places all over the sphere."""
    at = {name: views.table(spark, sf_dir, name).selectExpr(f"{key} AS {'source' if name == 'part' else 'centre'}", *(x.strip() for x in _PLACE.format(key=key).split(", CAST")[:1]), "CAST" + _PLACE.format(key=key).split(", CAST")[1]) for name, key in _SKY.items()}
    return _rounded(catalogue.cone_match(at["supplier"], at["part"], in_degrees=True).select("centre", "source", "sep_deg"), 5, "sep_deg")


@_query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS below, CASE WHEN event_id % 3 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS deep,
 CASE WHEN event_id % 5 = 0 THEN 'late' WHEN event_id % 5 = 1 THEN 'unknown error' END AS error FROM events"""
)
def answers_walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of answers that differ in what they hold: the events' properties, plain, in other objects or in lists, with errors or none."""
    key = F.col("event_id")
    inner = F.when(key % 3 == 0, F.concat(F.lit('{"data": {"id": '), "props", F.lit("}}"))).when(key % 3 == 1, F.concat(F.lit('{"data": ['), "props", F.lit("]}"))).otherwise(F.lit("no json"))
    errors = F.when(key % 5 == 0, F.lit('{"errors": [{"message": "late"}, {}]}')).when(key % 5 == 1, F.lit('{"errors": [{"code": 3}]}')).when(key % 5 == 2, F.lit('{"errors": []}'))
    rows = views.table(spark, sf_dir, "events").select("event_id", "props", inner.alias("inner"), errors.alias("errors"))
    return rows.select(
        "event_id",
        textfiles.walked("props", "k", kind="long").alias("k"),
        textfiles.walked("props", "k", "deeper").alias("below"),
        textfiles.walked("inner", "data", "id", "k", kind="long").alias("deep"),
        textfiles.first_error("errors").alias("error"),
    )


@_query(f"WITH {oracle._CANDS} SELECT printf('DM=%.2f S/N=%.2f beam %d', dm, sn, beam) AS value, count(*) AS n FROM cands WHERE dm >= 10 AND sn > 9.5 GROUP BY 1")
def notices_of_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest candidates of files that arrive, a message each, from the ledger of what was sent."""
    folder, ledger = shared_dir(spark, "arrivals"), shared_dir(spark, "ledger")
    views.candidates(spark, sf_dir).withColumn("arrived", F.lit("2020-01-01").cast("timestamp")).repartition(3).write.parquet(folder)
    strong = candidates.gate(arrivals.read_arrivals(spark, folder, 1), 10.0, 9.5)
    lines = strong.select(F.format_string("DM=%.2f S/N=%.2f beam %d", "dm", "sn", "beam").alias("value"))
    notices.start(lines, lambda value: None, ledger, shared_dir(spark, "notices")).awaitTermination()
    return notices.sent(spark, ledger).groupBy("value").agg(F.count("*").alias("n"))


@_query(
    f"""WITH {oracle._SAMPLES}, cents AS (SELECT chan, t, round(x * 100) AS x FROM samples) SELECT chan, t, 3 AS half, avg(x) OVER (PARTITION BY chan ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS x FROM cents
 UNION ALL SELECT chan, t, 20, avg(x) OVER (PARTITION BY chan ORDER BY t ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) FROM cents"""
)
def boxcar_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of windows of 7 and 41 samples, in blocks of 64; whole numbers, whose sums are exact."""
    return sliding.boxcars(views.samples(spark, sf_dir).withColumn("x", F.round(F.col("x") * 100)), [3, 20], "chan", block=64)


_POLE = sliding.butterworth_poles(1.0, 0.05, 1)[0].real


@_query(
    f"""WITH {oracle._SERIES}, d AS (SELECT series_id, t, x - coalesce(lag(x) OVER (PARTITION BY series_id ORDER BY t), 0) AS d FROM series)
 SELECT a.series_id, a.t, round(sum(b.d * power(CAST({_POLE!r} AS DOUBLE), a.t - b.t)), 6) + 0 AS x FROM d a JOIN d b ON b.series_id = a.series_id AND b.t <= a.t GROUP BY a.series_id, a.t"""
)
def recursive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recursion along each embedding, in blocks of 7 samples whose states are handed on from block to block."""
    series = views.series(spark, sf_dir).select("series_id", F.posexplode("x").alias("t", "re")).withColumn("t", F.col("t").cast("long")).withColumn("im", F.lit(0.0))
    drive = sliding.steps(series, "series_id", block=7, first=False)
    return _rounded(sliding.recursed(drive, complex(_POLE), "series_id", block=7).select("series_id", "t", F.col("re").alias("x")), 6, "x")


@_query(f"WITH {oracle._SAMPLES} SELECT 15 - chan AS chan, t, x, 150 - CAST(0.0625 AS DOUBLE) * chan AS nu, t * CAST(0.5 AS DOUBLE) AS time FROM samples")
def spectrum_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency and time of each sample, channels from low to high frequency."""
    held = views.samples(spark, sf_dir).withColumn("fch1", F.lit(150.0)).withColumn("foff", F.lit(-0.0625)).withColumn("tsamp", F.lit(0.5))
    return prep.flipped(prep.with_axes(held), 16).select("chan", "t", "x", "nu", "time")


@_query(
    f"""WITH {oracle._SERIES}, means AS (SELECT series_id, avg(x) AS m FROM series GROUP BY series_id), places AS (SELECT series_id, m, unnest(range(0, CASE WHEN series_id % 2 = 0 THEN 80 ELSE 40 END)) AS t FROM means)
 SELECT p.series_id, p.t, round(coalesce(s.x, p.m), 6) + 0 AS x FROM places p LEFT JOIN series s ON s.series_id = p.series_id AND s.t = p.t"""
)
def fitted_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series cut to 40 samples or filled with their mean to 80."""
    series = views.series(spark, sf_dir)
    fitted = F.when(F.col("series_id") % 2 == 0, prep.fitted_length(F.col("x"), 80)).otherwise(prep.fitted_length(F.col("x"), 40))
    return _rounded(series.select("series_id", F.posexplode(fitted).alias("t", "x")).withColumn("t", F.col("t").cast("long")), 6, "x")


@_query(
    f"""WITH {oracle._CANDS}, best AS (SELECT *, row_number() OVER (PARTITION BY beam ORDER BY {oracle._ORDER}) AS k FROM cands)
 SELECT beam, time, dm, sn, beam % 7 AS cluster, false AS representative FROM cands UNION ALL SELECT beam, time, dm, sn, beam % 7, true FROM best WHERE k = 1"""
)
def scatter_of_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates with their clusters, and the best of each beam once more as its representative."""
    held = views.candidates(spark, sf_dir).withColumn("cluster", F.col("beam") % 7)
    rank = F.row_number().over(Window.partitionBy("beam").orderBy(*candidates.best_first()))
    return frames.cluster_scatter(held, held.withColumn("k", rank).where("k = 1"), "beam")
