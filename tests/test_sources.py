from __future__ import annotations

import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberwave.functions import coords, names
from emberwave.operators import candidates, catalogue, graph, runs, subints
from emberwave.plans import downsample
from emberwave.sources import psrfits, sigproc, textfiles

HEADER = {"telescope_id": 11, "source_name": "B0000+00", "src_raj": 123456.7, "src_dej": -12345.6, "tstart": 58000.5, "tsamp": 0.00786432, "fch1": 150.0, "foff": -0.5, "nchans": 4, "nifs": 1, "npuls": 2**40}


def test_filterbank_round_trip(spark, tmp_path):
    sigproc.register(spark)
    data = np.random.default_rng(0).normal(size=(5000, 4)).astype("f4")
    frame = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(data)], "t long, spectrum array<float>").repartitionByRange(3, "t").sortWithinPartitions("t")
    path = str(tmp_path / "a.fil")
    frame.write.format("filterbank").options(**{k: str(v) for k, v in HEADER.items()}, nbits="32").mode("append").save(path)
    found = sigproc.layout(path)
    assert found.nspec == 5000 and {k: found.header[k] for k in HEADER} == HEADER and not found.folded
    assert found.frequencies.tolist() == [150.0, 149.5, 149.0, 148.5]
    back = spark.read.format("filterbank").option("spectra_per_task", "1500").load(path)
    assert np.array_equal(np.array([r.spectrum for r in back.orderBy("t").collect()], "f4"), data)
    assert [r.t for r in back.where("t >= 1499 AND t < 1503").orderBy("t").collect()] == [1499, 1500, 1501, 1502]
    with open(path, "ab") as file:
        file.write(b"123")
    assert sigproc.layout(path).nspec == 5000
    assert sigproc.samples_per_file(found.size + 5000 * 16 + 3, found.size, 4, 32) == (5000, False)


def test_filterbank_clips_and_rejects(spark, tmp_path):
    sigproc.register(spark)
    path = str(tmp_path / "b.fil")
    frame = spark.createDataFrame([(0, [-5.0, 300.0, 7.9, 0.0])], "t long, spectrum array<float>")
    frame.write.format("filterbank").options(nchans="4", nbits="8", fch1="1", foff="1", tsamp="1").mode("append").save(path)
    assert spark.read.format("filterbank").load(path).first().spectrum == [0.0, 255.0, 7.0, 0.0]
    with pytest.raises(ValueError, match="width"):
        sigproc.sample_kind(4)
    bad = tmp_path / "c.fil"
    name = lambda x: struct.pack("<i", len(x)) + x.encode()
    bad.write_bytes(name("HEADER_START") + name("no_such_field"))
    with pytest.raises(KeyError):
        sigproc.layout(str(bad))


def _frame(spark, rows):
    return spark.createDataFrame([(t, [float(v), -float(v)]) for t, v in rows], "t long, spectrum array<float>").repartition(3)


def _held(spark, path, **how):
    return [r.spectrum[0] for r in sigproc.read(spark, path, **how).orderBy("t").collect()]


SMALL = {"nchans": 2, "fch1": 1.0, "foff": -1.0, "tsamp": 1.0, "source_name": "x"}


def _all_modes(spark, path, **how):
    """Written in order of t, whatever its gaps and ties; added to; put over inside, over the end, and at the end."""
    sigproc.save(_frame(spark, [(5 * k, k) for k in range(3000)] + [(7, 0.5)]), path, SMALL, **how)
    want = [0.0, 1.0, 0.5, *map(float, range(2, 3000))]
    assert _held(spark, path, **how) == want
    sigproc.save(_frame(spark, [(3, -1), (1, -2)]), path, {}, "append", **how)
    want += [-2.0, -1.0]
    assert _held(spark, path, **how) == want
    sigproc.save(_frame(spark, [(k, 9) for k in range(4)]), path, {}, at=10, **how)
    want[10:14] = [9.0] * 4
    sigproc.save(_frame(spark, [(k, 8) for k in range(4)]), path, {}, at=3001, **how)
    want[3001:] = [8.0] * 4
    assert _held(spark, path, **how) == want
    sigproc.save(_frame(spark, []), path, {}, "append", **how)
    assert _held(spark, path, **how) == want and sigproc.layout(path, how.get("factory")).header["source_name"] == "x"
    with pytest.raises(ValueError, match="beyond the end"):
        sigproc.save(_frame(spark, [(0, 1)]), path, {}, at=4000, **how)
    sigproc.save(_frame(spark, []), path, SMALL, **how)
    assert _held(spark, path, **how) == []


def test_filterbank_saved_in_place(spark, tmp_path):
    _all_modes(spark, str(tmp_path / "a.fil"))
    assert [x.name for x in tmp_path.iterdir()] == ["a.fil"]


def test_filterbank_on_a_filesystem_that_only_its_factory_opens(spark, tmp_path):
    import vault

    path = f"vault:/{tmp_path}/~/beams/a.fil"
    assert not os.path.exists(path)
    (tmp_path / "beams").mkdir()
    _all_modes(spark, path, factory=vault.FACTORY)
    sigproc.save(_frame(spark, [(0, 1)]), path.replace("a.fil", "b.fil"), SMALL, factory=vault.FACTORY)
    folder = path.removesuffix("/a.fil")
    found = {(r.path, r.value) for r in sigproc.metadata(spark, folder, vault.FACTORY).where("key = 'nspec'").collect()}
    assert found == {(path, "0"), (path.replace("a.fil", "b.fil"), "1")}
    assert len(sigproc.paths(f"{folder}/*b.fil", vault.FACTORY)) == 1 and not sigproc.stores.known(path)
    assert sorted(x.name for x in (tmp_path / "beams").iterdir()) == ["a.fil", "b.fil"]


def test_filterbank_read_through_spark_where_arrow_has_no_filesystem(spark, tmp_path, monkeypatch):
    sigproc.save(_frame(spark, [(k, k) for k in range(2500)]), str(tmp_path / "a.fil"), SMALL)
    monkeypatch.setattr(sigproc.stores, "known", lambda *_: False)
    found = sigproc.read(spark, str(tmp_path), with_path=True)
    assert found.count() == 2500 and found.where("t = 2400").first().spectrum == [2400.0, -2400.0] and found.first().path.endswith("/a.fil")


def test_killed_write_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "a.fil")
    sigproc.save(_frame(spark, [(k, k) for k in range(50)]), path, SMALL)
    before = open(path, "rb").read()
    # A task that fails, and a driver that dies before the commit.
    with pytest.raises(Exception, match="channels"):
        sigproc.save(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "t long, spectrum array<float>"), path, {}, "append")
    writer = sigproc.FilterbankWriter({"path": path} | {k: str(v) for k, v in SMALL.items()})
    writer.write([{"t": 0, "spectrum": [5.0, 5.0]}])
    assert open(path, "rb").read() == before and _held(spark, path) == [float(k) for k in range(50)]
    # Attempts that write the same rows again, out of order; places with a gap.
    parts = [writer.write([{"t": t, "spectrum": [float(t), 0.0]} for t in rows]) for rows in ((3, 2), (0, 1), (0, 1))]
    writer.commit(parts[:2])
    assert _held(spark, path) == [0.0, 1.0, 2.0, 3.0]
    sigproc.register(spark)
    with pytest.raises(Exception, match="0 to n - 1"):
        _frame(spark, [(0, 1), (2, 1)]).write.format("filterbank").options(**{k: str(v) for k, v in SMALL.items()}).mode("overwrite").save(path)
    with pytest.raises(Exception, match="use sigproc.save"):
        _frame(spark, [(0, 1)]).write.format("filterbank").options(**{k: str(v) for k, v in SMALL.items()}).mode("append").save(path)
    assert _held(spark, path) == [0.0, 1.0, 2.0, 3.0] and [x.name for x in tmp_path.iterdir()] == ["a.fil"]


def _fits(path, nsub=3, nchan=4, nsblk=8):
    def unit(cards, data=b""):
        text = "".join(f"{c:<80}" for c in [*cards, "END"])
        return text.ljust(-(-len(text) // 2880) * 2880).encode() + data + b"\0" * (-len(data) % 2880)

    card = lambda k, v: f"{k:<8}= {v!r:>20}" if not isinstance(v, bool) else f"{k:<8}= {'T' if v else 'F':>20}"
    raw = np.random.default_rng(1).integers(0, 256, (nsub, nsblk * nchan // 4), dtype=np.uint8)
    rows = b"".join(np.arange(100, 100 + nchan).astype(">f8").tobytes() + np.ones(nchan, ">f4").tobytes() + np.full(nchan, 0.5, ">f4").tobytes() + np.full(nchan, 2.0, ">f4").tobytes() + raw[k].tobytes() for k in range(nsub))
    table = [
        "XTENSION= 'BINTABLE'", card("BITPIX", 8), card("NAXIS", 2), card("NAXIS1", len(rows) // nsub), card("NAXIS2", nsub), card("PCOUNT", 0), card("GCOUNT", 1), card("TFIELDS", 5),
        "TTYPE1  = 'DAT_FREQ'", f"TFORM1  = '{nchan}D'", "TTYPE2  = 'DAT_WTS '", f"TFORM2  = '{nchan}E'", "TTYPE3  = 'DAT_OFFS'", f"TFORM3  = '{nchan}E'", "TTYPE4  = 'DAT_SCL '", f"TFORM4  = '{nchan}E'", "TTYPE5  = 'DATA    '", f"TFORM5  = '{raw.shape[1]}B'",
        "EXTNAME = 'SUBINT  '", card("NBITS", 2), card("NCHAN", nchan), card("NSBLK", nsblk), card("TBIN", 1e-3), card("CHAN_BW", 0.0122),
    ]
    path.write_bytes(unit([card("SIMPLE", True), card("BITPIX", 8), card("NAXIS", 0), card("OBSFREQ", 150.0), "SRC_NAME= 'it''s'", "RA      = '12:34:56.5'", "DEC     = '-01:02:03.5'", "DATE-OBS= '2017-09-04T12:00:00'"]) + unit(table, rows))
    return raw


def test_psrfits(spark, tmp_path):
    raw = _fits(tmp_path / "a.fits")
    found = psrfits.SearchFile.open(str(tmp_path / "a.fits"))
    assert found.primary["SRC_NAME"] == "it's" and found.primary["OBSFREQ"] == 150.0
    spark.dataSource.register(psrfits.Subints)
    got = spark.read.format("psrfits").option("rows_per_task", "2").load(str(tmp_path / "a.fits")).orderBy("isub").collect()
    assert [bytes(r.data) for r in got] == [x.tobytes() for x in raw] and got[0].dat_freq == [100.0, 101.0, 102.0, 103.0]
    assert spark.read.format("psrfits").option("first_subint", "1").option("last_subint", "1").load(str(tmp_path / "a.fits")).first().isub == 1
    with open(tmp_path / "a.fits", "rb") as file:
        x = psrfits.spectra(found.row(file, 0), 4, 2)
    first = [(raw[0][0] >> s & 3) * 64 for s in (6, 4, 2, 0)]
    assert x.shape == (8, 4) and x[0].tolist() == [v * 2.0 + 0.5 for v in first]
    assert psrfits.averaged(x, 2, 4).shape == (2, 2)
    with pytest.raises(ValueError, match="divide"):
        psrfits.averaged(x, 2, 3)
    assert psrfits.window(10.0, 2.0, 1.0, 11) == (8, 10)


@pytest.mark.parametrize("dc", [False, True])
def test_downsampling_equals_numpy(spark, tmp_path, dc):
    """A search file to a filterbank: bytes, scales, both means, the order of channels and the header."""
    path = str(tmp_path / "a.fits")
    raw = _fits(tmp_path / "a.fits", nsub=5, nchan=32, nsblk=12)
    downsample.downsample(spark, path, str(tmp_path / "a.fil"), 4, 3, dc)
    found, x = psrfits.SearchFile.open(path), []
    with open(path, "rb") as file:
        for isub in range(5):
            x.append(psrfits.averaged(psrfits.spectra(found.row(file, isub), 32, 2), 4, 3, dc)[:, ::-1])
    got = [r.spectrum for r in sigproc.read(spark, str(tmp_path / "a.fil")).orderBy("t").collect()]
    assert np.allclose(got, np.concatenate(x)) and len(raw) == 5
    head = sigproc.layout(str(tmp_path / "a.fil")).header
    bw = 0.1953125 / 16
    assert (head["nchans"], head["foff"], head["fch1"], head["tstart"]) == (8, -4 * bw, 150.0 - bw * 16 + bw * 32, 58000.5)
    assert (head["source_name"], head["src_raj"], head["src_dej"]) == ("it's", 123456.5, -10203.5) and head["tsamp"] == pytest.approx(round(3e-3 / 5.12e-6) * 5.12e-6)
    plan = subints.averaged_spectra(spark.createDataFrame([], psrfits.SUBINTS), 32, 12, 2, 4, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    cards = {(r.unit, r.key): r.value for r in psrfits.header_cards(spark, str(tmp_path)).collect()}
    assert cards["PRIMARY", "SRC_NAME"] == "it's" and cards["SUBINT", "NCHAN"] == "32"


def test_samples_of_all_depths(spark):
    values = np.array([0.0, -0.0, 1.5, -2.75, 3.4e38, 1e-45, -1e-40, np.inf, -np.inf, np.nan, 0.1], "f4")
    data = values.astype(">f4").tobytes()
    frame = spark.createDataFrame([(bytearray(data), bytearray(range(256)), bytearray())], "a binary, b binary, c binary")
    row = frame.select(subints.samples(F.col("a"), -32).alias("a"), subints.samples(F.col("b"), 8).alias("b"), subints.samples(F.col("b"), 2).alias("p"), *(subints.samples(F.col("c"), n).alias(f"c{n}") for n in (8, 2, -32))).first()
    assert np.array_equal(np.array(row.a, "f4"), values, equal_nan=True) and row.b == [float(k) for k in range(256)]
    assert row.p == [float((k >> s & 3) << 6) for k in range(256) for s in (6, 4, 2, 0)] and row.c8 == row.c2 == row["c-32"] == []
    with pytest.raises(ValueError, match="depth"):
        subints.samples(F.col("a"), 16)
    with pytest.raises(ValueError, match="divide"):
        subints.averaged_spectra(frame, 4, 8, 8, 3, 4)


def test_unpacking(spark):
    frame = spark.createDataFrame([(0b00011011,)], "byte int")
    from emberwave.operators import prep

    assert [r.raw for r in prep.unpacked(frame, 2).orderBy("k").collect()] == [0, 64, 128, 192]
    with pytest.raises(ValueError, match="depth"):
        prep.unpacked(frame, 4)


def test_candidate_text(spark, tmp_path):
    lines = [textfiles.HEADER, "", "60.700  7.560  2877.916000  365946  1\r", "  1 2 3 4 5  ", "x y z"]
    got = textfiles.parse_candidates(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [tuple(r) for r in got.collect()] == [(60.7, 7.56, 2877.916, 365946, 1), (1.0, 2.0, 3.0, 4, 5), (None, None, None, None, None)]
    textfiles.write_candidates(got.limit(2), str(tmp_path / "c"))
    assert textfiles.read_candidates(spark, str(tmp_path / "c")).exceptAll(got.limit(2)).count() == 0
    textfiles.write_clustered(got.limit(2).withColumn("sample", F.col("sample").cast("double")).withColumn("cluster", F.lit(-1)).withColumnRenamed("sn", "S/N"), str(tmp_path / "d"))
    assert [(r.sample, r.cluster, r.sn) for r in textfiles.read_clustered(spark, str(tmp_path / "d")).orderBy("dm").collect()] == [(4, -1, 2.0), (365946, -1, 7.56)]
    union = candidates.union_beams({2: got.limit(1), 1: got.limit(1)})
    assert textfiles.write_collected(union, str(tmp_path / "e")) and not textfiles.write_collected(union.limit(0), str(tmp_path / "f"))
    assert textfiles.read_candidates(spark, str(tmp_path / "e"), with_beam=True).count() == 2
    assert candidates.union_beams({}) is None
    with pytest.raises(ValueError, match="time"):
        candidates.normalised_columns(spark.createDataFrame([(1.0, 2.0)], "DM double, SNR double"))
    assert candidates.single_candidate(spark, 1.0, None, 2.0, 3) is None and candidates.single_candidate(spark, 1.0, 2.0, 3.0, 4).first().sample == -1


def test_sidecars_addresses_and_answers(spark):
    sidecar = spark.createDataFrame([("a", " Telescope used = LOFAR"), ("a", "Width of each time series bin (sec) =  0.5"), ("a", "noise")], "file string, value string")
    row = textfiles.parse_sidecar(sidecar).first()
    assert (row.telescope, row.tsamp, row.object) == ("LOFAR", 0.5, None)
    urls = textfiles.parse_addresses(spark.createDataFrame([("https://x/L1_SAP0_BEAM3_f.tar\r",), ("",)], "value string")).collect()
    assert [(r.obsid, r.sap) for r in urls] == [("L1", "SAP0")]
    answers = textfiles.parse_staging(spark.createDataFrame([('{"id": 3, "currentStatusCode": "success", "surls": [{"surl": "a"}]}',), ("[]",)], "value string"))
    assert textfiles.staging_progress(answers, "success").first().n_surls == 1 and textfiles.staging_progress(answers, "success", equal=False).count() == 1


def test_walks_over_any_keys(spark):
    rows = ['{"a": {"b": {"it\'s": 1, "o": [1, {"x": null}]}}}', '{"a": [1]}', '{"a": 3}', '[{"a": {"b": 1}}]', "nothing", "", None, '{"a": {"b": null}}', '{"errors": "none"}']
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, v string")
    found = frame.select("k", textfiles.walked("v", "a", "b", "it's", kind="int").alias("n"), textfiles.walked("v", "a", "b", "o").alias("o"), textfiles.walked("v", "a").alias("a"), textfiles.walked("v").alias("whole"), textfiles.first_error("v").alias("e")).collect()
    by = {r.k: r for r in found}
    assert [by[k].n for k in range(9)] == [1] + [None] * 8
    assert by[0].o == '[1,{"x":null}]' and by[1].a == "[1]" and by[2].a == "3" and by[3].a is by[4].a is by[5].a is by[6].a is None
    assert by[2].whole == '{"a":3}' and by[4].whole is None and all(r.e is None for r in found)
    with pytest.raises(ValueError, match="quotes"):
        textfiles.walked("v", "'\"")


def test_angles(spark):
    row = spark.range(1).select(
        coords.packed_dec_text(F.lit(-12345.6)).alias("dec"), coords.packed_dec_text(F.lit(-45.6)).alias("small"), coords.text_degrees(F.lit("-00:30:00"), False).alias("half"),
        coords.packed_degrees(F.lit(-3000.0), False).alias("deg"), coords.mjd_text(F.lit(None).cast("double")).alias("none"), coords.mjd_text(F.lit(58000.5)).alias("iso"), *(x.alias(n) for x, n in zip(coords.galactic(F.lit(266.4051), F.lit(-28.936175)), "lb", strict=True)),
    ).first()
    assert (row.dec, row.small, row.half, row.deg, row.none, row.iso) == ("-01:23:45.60", "-00:00:45.60", -0.5, -0.5, "Unknown", "2017-09-04 12:00:00.000")
    assert min(row.l, 360 - row.l) < 0.01 and abs(row.b) < 0.01
    assert spark.range(1).select(names.beam_of(F.lit("L1_X")).alias("b")).first().b is None


def test_run_log(spark):
    begun = runs.started(spark.createDataFrame([("B1", "2020", "/o", "/l")], "beam_id string, observation_date string, output_dir string, log_file string"), "v1").first()
    events = spark.createDataFrame([("r1", 0, "B1", "processing"), ("r2", 0, "B2", "processing")], "id string, seq long, beam_id string, outcome string")
    done = runs.updated(events.where("id = 'r1'"), "classified", num_candidates=4)
    last = {r.id: r for r in runs.latest(runs._events(events, {}).unionByName(done)).collect()}
    assert (begun.outcome, begun.seq, begun.beam_id) == ("processing", 0, "B1")
    assert (last["r1"].outcome, last["r1"].num_candidates, last["r1"].beam_id, last["r2"].outcome) == ("classified", 4, "B1", "processing")
    runs.create_tables(spark)
    assert spark.table("beam_run_events").count() == 0


def test_components(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(20)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {k: 0 for k in range(21)} | {100: 100, 101: 100, 102: 100}
    assert graph.components(links.limit(0)).count() == 0


def test_matches_take_the_first_source_and_no_null(spark):
    cands = spark.createDataFrame([(10.0,), (10.4,), (None,), (50.0,)], "dm double")
    sources = spark.createDataFrame([("late", 10.2, 2), ("early", 9.9, 1), ("none", None, 0)], "psrj string, dm double, ord int")
    assert {(r.dm, r.psrj) for r in catalogue.redetections(cands, sources).collect()} == {(10.0, "early"), (10.4, "early")}
    assert {r.dm for r in catalogue.new_candidates(cands, sources).collect()} == {None, 50.0}
