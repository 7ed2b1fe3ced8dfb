"""From raw search files to averaged filterbanks: the stage that comes before all others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwave.functions import coords
from emberwave.operators import prep, subints
from emberwave.sources import psrfits, sigproc

#: The telescope's and the data's codes in a filterbank's header.
CODES = {"telescope_id": 11, "machine_id": -1, "data_type": 1, "barycentric": 0, "pulsarcentric": 0, "nifs": 1, "nbits": 32}


def averaged(spark: SparkSession, path: str, mchan: int = 4, msamp: int = 16, mask_dc: bool = False, scaled: bool = True, factory: str | None = None) -> DataFrame:
    """(t, spectrum) of a search file, channels from high to low frequency."""
    found = psrfits.SearchFile.open(path, factory)
    rows = psrfits.read(spark, path, factory)
    spectra = subints.averaged_spectra(rows, found.table["NCHAN"], found.table["NSBLK"], found.table["NBITS"], mchan, msamp, scaled=scaled, mask_dc=mask_dc)
    return spectra.withColumn("spectrum", F.reverse(F.transform("spectrum", lambda v: F.coalesce(v, F.lit(float("nan"))).cast("float"))))


def header(spark: SparkSession, path: str, mchan: int = 4, msamp: int = 16, factory: str | None = None) -> dict:
    """The filterbank header of the averages, from the cards of the file."""
    found = psrfits.SearchFile.open(path, factory)
    primary, table = found.primary, found.table
    raw = spark.createDataFrame([(float(primary["OBSFREQ"]), float(table["CHAN_BW"]), int(table["NCHAN"]), float(table["TBIN"]), str(primary["DATE-OBS"]))], "obsfreq double, chan_bw double, nchan int, tbin double, at string")
    row = prep.output_header(raw, mchan, msamp).withColumn("tstart", coords.mjd_of(F.to_timestamp("at"))).first()
    place = {"source_name": primary["SRC_NAME"], "src_raj": float(primary["RA"].replace(":", "")), "src_dej": float(primary["DEC"].replace(":", ""))}
    return CODES | place | {k: row[k] for k in ("foff", "fch1", "tsamp", "nchans", "tstart")}


def downsample(spark: SparkSession, path: str, out: str, mchan: int = 4, msamp: int = 16, mask_dc: bool = False, factory: str | None = None) -> None:
    """Writes the averages of a search file as a filterbank."""
    sigproc.save(averaged(spark, path, mchan, msamp, mask_dc, factory=factory), out, header(spark, path, mchan, msamp, factory), factory=factory)
