"""Text formats: candidate lists, sidecars, address lists, staging answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwave.operators.candidates import normalised_columns

# Fixed value: the first line of a candidate list.
HEADER = "# DM(pc/cm^3)  Detection Strength  Time(s)  Sample  Filter Width(samples)"
# Labels of the sidecar and the fields they fill.
SIDECAR = {
    "Width of each time series bin (sec)": "tsamp",
    "Object being observed": "object",
    "Frequency Range (MHz)": "frequency_range",
    "Telescope used": "telescope",
    "Instrument used": "instrument",
    "Observation Date": "observation_date",
}


def content_lines(lines: DataFrame) -> DataFrame:
    """Lines that are neither blank nor comments, without carriage returns and outer white space."""
    value = F.trim(F.regexp_replace("value", "\r", ""))
    return lines.withColumn("value", value).where((F.col("value") != "") & ~F.col("value").startswith("#"))


def parse_candidates(lines: DataFrame, with_beam: bool = False) -> DataFrame:
    """dm, sn, time, sample, filter_width (after beam, if asked) from white-space separated lines.

    Cells that are no numbers become null.
    """
    cells = F.split("value", r"\s+")
    kinds = [("beam", "string")] * with_beam + [("dm", "double"), ("sn", "double"), ("time", "double"), ("sample", "double"), ("filter_width", "int")]
    columns = [F.get(cells, k).try_cast(kind).alias(name) for k, (name, kind) in enumerate(kinds)]
    return content_lines(lines).select(columns).withColumn("sample", F.col("sample").cast("long"))


def read_candidates(spark: SparkSession, path: str, with_beam: bool = False) -> DataFrame:
    return parse_candidates(spark.read.text(path), with_beam)


def read_beams(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The candidate lists of all beams below a folder in one scan; the beam is what ends the folder's name, as in B012.

    A list in no such folder has a null beam.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path).select("value", "_metadata.file_path")
    beam = F.regexp_extract("file_path", r"([0-9]+)/[^/]*$", 1).try_cast("long")
    value = F.concat_ws(" ", F.coalesce(beam.cast("string"), F.lit("?")), F.trim(F.regexp_replace("value", "\r", "")))
    kept = content_lines(lines).select(value.alias("value"))
    return parse_candidates(kept, with_beam=True).withColumn("beam", F.col("beam").try_cast("long"))


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """A clustered list with a header row, names normalised; samples written as 123.0 are whole again."""
    frame = normalised_columns(spark.read.option("sep", "\t").option("header", True).csv(path))
    kinds = {"dm": "double", "sn": "double", "time": "double", "sample": "double", "filter_width": "double", "cluster": "long", "dm_scaled": "double"}
    frame = frame.select(*(F.trim(F.col(c)).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in frame.columns))
    return frame.withColumn("sample", F.col("sample").cast("long")).withColumn("filter_width", F.col("filter_width").cast("int"))


def candidate_lines(cands: DataFrame, *more: str) -> DataFrame:
    """The text form, three decimals for dm and S/N, six for time; one column ``value``, and those asked for."""
    return cands.select(*more, F.format_string("%.3f  %.3f  %.6f  %d  %d", "dm", "sn", "time", "sample", "filter_width").alias("value"))


def write_candidates(cands: DataFrame, path: str) -> None:
    """The list as text, behind a comment that names the columns; an empty one is that comment alone."""
    first = cands.sparkSession.createDataFrame([(HEADER,)], "value string").coalesce(1)
    first.unionByName(candidate_lines(cands)).write.text(path)


def write_clustered(clustered: DataFrame, path: str) -> None:
    clustered.write.option("sep", "\t").option("header", True).csv(path)


def write_collected(union: DataFrame | None, path: str) -> bool:
    """The combined list, one text line each with the beam in front; nothing is written of an empty one."""
    if union is None or union.isEmpty():
        return False
    union.select(F.concat(F.col("beam").cast("string"), F.lit("  "), F.format_string("%.3f  %.3f  %.6f  %d  %d", "dm", "sn", "time", "sample", "filter_width"))).write.text(path)
    return True


def parse_sidecar(lines: DataFrame, file: str = "file") -> DataFrame:
    """A row per file with a column per known field: what follows the last = of the line that has its label."""
    value = F.trim(F.element_at(F.split("value", "="), -1))
    return lines.groupBy(file).agg(*(F.max(F.when(F.contains("value", F.lit(label)), value)).alias(name) for label, name in SIDECAR.items())).withColumn("tsamp", F.col("tsamp").try_cast("double"))


def parse_addresses(lines: DataFrame) -> DataFrame:
    """Addresses with the observation and subarray their names tell, sorted by third field, then whole."""
    kept = content_lines(lines).select(F.col("value").alias("url"))
    name = F.element_at(F.split("url", "/"), -1)
    return kept.withColumn("name", name).withColumn("obsid", F.split_part("name", F.lit("_"), F.lit(1))).withColumn("sap", F.split_part("name", F.lit("_"), F.lit(2))).withColumn("field", F.split_part("url", F.lit("_"), F.lit(3))).orderBy("field", "url")


def address_summary(addresses: DataFrame) -> DataFrame:
    """How many addresses there are, and what the first one in order tells of the observation."""
    first = F.min(F.struct("field", "url", "obsid", "sap")).alias("a")
    return addresses.agg(F.count("*").alias("n"), first).select("n", F.col("a.url").alias("first_url"), F.col("a.obsid").alias("obsid"), F.col("a.sap").alias("sap"))


STAGING = "id int, requestToken string, requestType string, when string, response string, currentStatusCode string, surls array<struct<surl:string>>"


def parse_staging(answers: DataFrame, column: str = "value") -> DataFrame:
    """Fields of staging answers in JSON; what is no object is all null."""
    return answers.select(F.from_json(column, STAGING).alias("r")).select("r.*").withColumn("n_surls", F.coalesce(F.size("surls"), F.lit(0)))


def staging_progress(requests: DataFrame, status: str, equal: bool = True) -> DataFrame:
    """Requests with, or without, a status; a null one is unequal to any."""
    same = F.col("currentStatusCode").eqNullSafe(F.lit(status))
    return requests.where(same if equal else ~same)


def staged_since(requests: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """Requests of the last ``hours`` before ``now``; one whose time cannot be read is none of them."""
    at = F.to_timestamp(F.regexp_replace("when", "T", " "))
    return requests.where(at.isNotNull() & (at >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")))


def walked(json: Column | str, *keys: str, kind: str = "string") -> Column:
    """What stands under some keys, one in another, of a JSON text, whatever its fields are.

    Null where a step is no object or has no such key, where the value is no ``kind`` and where the text is no JSON. What is
    itself an object or a list is its JSON text as a string.
    """
    found = F.try_parse_json(F.col(json) if isinstance(json, str) else json)
    if not keys:
        return F.to_json(found) if kind == "string" else F.try_variant_get(found, "$", kind)
    if any("'" in k and '"' in k for k in keys):
        raise ValueError(f"a key with both kinds of quotes: {keys}")
    path = "$" + "".join(f'["{k}"]' if "'" in k else f"['{k}']" for k in keys)
    return F.try_variant_get(found, path, kind)


def first_error(json: Column | str) -> Column:
    """The message of the first error that an answer reports, ``unknown error`` where it has none; null without errors."""
    errors = F.try_variant_get(F.try_parse_json(F.col(json) if isinstance(json, str) else json), "$.errors", "array<variant>")
    return F.when(F.size(errors) > 0, F.coalesce(F.try_variant_get(F.get(errors, 0), "$.message", "string"), F.lit("unknown error")))
