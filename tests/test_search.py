"""What the queries with SQL do not reach: errors, odd tables, and numbers against plain NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberwave.functions import messages
from emberwave.operators import diag, frames, matched, runs
from emberwave.plans import search, settings
from emberwave.plans.shared import Scratch, shared_dir
from emberwave.sources import discover, series, sigproc


@pytest.mark.parametrize("bins", [1, 3, 16_384])
def test_quantiles_equal_numpy(spark, bins):
    draw = np.random.default_rng(1)
    data = {1: draw.normal(size=501), 2: draw.integers(0, 4, 200).astype(float), 3: np.array([7.0]), 4: np.array([5.0, 5.0, 5.0]), 5: draw.normal(size=40) ** 9}
    rows = [(k, float(v)) for k, x in data.items() for v in x] + [(1, None), (6, None)]
    frame = spark.createDataFrame(rows, "k int, x double").repartition(3)
    levels = [0.0, 0.01, 0.5, 0.77, 1.0]
    got = {(r.k, r.level): r.value for r in diag.quantiles(frame, "x", levels, "k", bins=bins).collect()}
    assert set(got) == {(k, p) for k in data for p in levels}
    for (k, p), value in got.items():
        assert value == pytest.approx(np.quantile(data[k], p), rel=1e-12, abs=1e-12)
    every = np.concatenate(list(data.values()))
    assert diag.percentiles(frame, "x", {"a": 0.25, "b": 0.9}).first()[:] == pytest.approx((np.quantile(every, 0.25), np.quantile(every, 0.9)))
    assert diag.percentiles(frame.where("false"), "x", {"a": 0.5}).first().a is None


def test_high_pass_takes_the_trend_and_leaves_the_pulse(spark):
    t = np.arange(6000)
    x = 50 + 0.01 * t + 20 * np.sin(2 * np.pi * t / 3000)
    x[3000:3010] += 9
    y = matched.high_passed(x, 0.01, 0.5)
    assert y[3000:3010].mean() > 6 and abs(y[500:2500]).max() < 0.5
    frame = spark.createDataFrame([(1, x.tolist()), (2, []), (3, None)], "k int, x array<double>")
    found = matched.tool_responses(frame, 0.01, "k", cutoff_hz=0.5).where("filter_width = 9").orderBy(F.desc("sn")).first()
    assert found.k == 1 and abs(found.t - 3005) <= 6


def _file(spark, path, n=20, nchans=4, **more):
    sigproc.register(spark)
    rows = [(t, [float(t * nchans + c) for c in range(nchans)]) for t in range(n)]
    header = {"fch1": 150.0, "foff": -1.0, "nchans": nchans, "tsamp": 0.5, "nbits": 32} | more
    spark.createDataFrame(rows, "t long, spectrum array<float>").coalesce(1).write.format("filterbank").options(**{k: str(v) for k, v in header.items()}).mode("overwrite").save(str(path))


def test_many_files_and_gaps(spark, tmp_path):
    for beam in (13, 14):
        (tmp_path / f"B{beam:03d}").mkdir()
        _file(spark, tmp_path / f"B{beam:03d}" / f"L1_SAP0_BEAM{beam}_32bit.fil", n=10 + beam)
    (tmp_path / "X").mkdir()
    _file(spark, tmp_path / "X" / "other.fil")
    read = spark.read.format("filterbank").option("with_path", "true").load(str(tmp_path))
    assert {r["count"] for r in read.groupBy("path").count().collect()} == {20, 23, 24}
    beams = search.beam_spectra(spark, str(tmp_path))
    assert {(r.beam, r["count"]) for r in beams.groupBy("beam").count().collect()} == {(13, 92), (14, 96)}
    one = beams.where("beam = 13 AND chan = 2 AND t = 1").first()
    assert (one.nu, one.x, one.tsamp) == (148.0, 6.0, 0.5)
    listed = discover.files(spark, str(tmp_path), "*.fil")
    assert [r.beam for r in discover.beam_files(listed).collect()] == [13, 14]
    assert listed.where(discover.in_beam_folder(F.col("folder"), F.col("name"))).count() == 2
    path = str(tmp_path / "X" / "other.fil")
    more = spark.createDataFrame([(0, [1.0] * 4)], "t long, spectrum array<float>")
    with pytest.raises(ValueError, match="beyond the end"):
        sigproc.save(more, path, {}, at=21)
    sigproc.save(more, path, {}, at=20)
    assert spark.read.format("filterbank").load(path).count() == 21
    facts = {r.key: r.value for r in sigproc.metadata(spark, path).collect()}
    assert facts["nspec"] == "21" and facts["folded"] == "false"


def test_series_without_sidecars(spark, tmp_path):
    folder = f"file://{tmp_path}/s"
    frame = spark.createDataFrame([(1.5, 2, [1.0, None, 3.0]), (2.5, 1, None)], "dm double, downsample int, x array<double>")
    files = series.write_series(frame, folder, "b", 0.25, {})
    assert {(r.file, r.bins) for r in files.collect()} == {("b_DM1.5.dat", 3), ("b_DM2.5.dat", 0)}
    assert (tmp_path / "s" / "b_DM2.5.dat").read_bytes() == b""
    series.write_series(frame.where("dm = 1.5").withColumn("dm", F.lit(3.5)), f"file://{tmp_path}/t", "b", 0.25, {})
    (tmp_path / "t" / "b_DM3.5.inf").unlink()
    alone = series.read_series(spark, f"file://{tmp_path}/t").first()
    assert alone.dm == 3.5 and alone.tsamp is None and alone.x[2] == 3.0
    got = {r.dm: r for r in series.read_series(spark, folder).collect()}
    assert np.isnan(got[1.5].x[1]) and got[1.5].x[2] == 3.0 and got[1.5].tsamp == 0.5 and set(got) == {1.5}
    assert "Dispersion measure (cm-3 pc)           =  1.50\n" in (tmp_path / "s" / "b_DM1.5.inf").read_text()


def test_a_failing_search_is_logged(spark, tmp_path):
    _file(spark, tmp_path / "L1_SAP0_BEAM13_32bit.fil")
    out = f"file://{tmp_path}/out"
    broken = spark.createDataFrame([("x",)], "wrong string")
    with pytest.raises(Exception, match="dm|UNRESOLVED"):
        search.run_search(spark, str(tmp_path / "L1_SAP0_BEAM13_32bit.fil"), broken, out, settings.Settings(rfi_block_size=5, plan=(settings.Segment(0.0, 1.0, 0.5, 1),)))
    failed = search.failed_beams(spark.read.parquet(f"{out}/events")).collect()
    assert [(r.beam_id, r.outcome) for r in failed] == [("13", "error")] and failed[0].error_message


def test_one_failing_beam_fails_alone(spark, tmp_path, monkeypatch):
    """Two beams are searched though a third fails, and the log says which."""
    for beam in (13, 14, 15):
        _file(spark, tmp_path / f"L1_SAP0_BEAM{beam}_32bit.fil")
    out, own = f"file://{tmp_path}/out", search.channel_arrays

    def failing(samples):
        if samples.where("beam = 14").count():
            raise RuntimeError("no " + "x" * 2000)
        return own(samples)

    monkeypatch.setattr(search, "channel_arrays", failing)
    sources = spark.createDataFrame([], "psrj string, dm double, ord long")
    with pytest.raises(RuntimeError, match="no x"):
        search.run_search(spark, str(tmp_path), sources, out, settings.Settings(rfi_block_size=5, plan=(settings.Segment(0.0, 1.0, 0.5, 1),)))
    last = {r.beam_id: r for r in runs.latest(spark.read.parquet(f"{out}/events")).collect()}
    assert {k: r.outcome for k, r in last.items()} == {"13": "classified", "14": "error", "15": "classified"} and len(last["14"].error_message) > 2000


def test_mixed_sampling_times_are_refused(spark, tmp_path):
    for beam, tsamp in ((13, 0.5), (14, 0.25)):
        _file(spark, tmp_path / f"L1_SAP0_BEAM{beam}_32bit.fil", tsamp=tsamp)
    with pytest.raises(ValueError, match="sampling times"):
        search.run_search(spark, str(tmp_path), spark.createDataFrame([], "psrj string, dm double, ord long"), f"file://{tmp_path}/out")


def test_the_command_says_how_it_went(spark, tmp_path, capsys):
    from emberwave.__main__ import main

    _file(spark, tmp_path / "L1_SAP0_BEAM13_32bit.fil", n=64)
    (tmp_path / "settings.json").write_text(settings.Settings(rfi_block_size=8, plan=(settings.Segment(0.0, 1.0, 0.5, 1),)).dump())
    (tmp_path / "sources.csv").write_text("psrj,dm,ord\nJ0,0.5,1\n")
    arguments = [str(tmp_path), f"file://{tmp_path}/out", "--settings", str(tmp_path / "settings.json")]
    assert main([*arguments, "--sources", str(tmp_path / "sources.csv")]) == 0 and main(arguments) == 0
    assert main([str(tmp_path / "none.fil"), f"file://{tmp_path}/out"]) == 1 and "failed" in capsys.readouterr().err


def test_layout_of_no_beams(spark):
    none = spark.createDataFrame([], "beam long, x_arcmin double, y_arcmin double, level double")
    row = frames.beam_layout(none).first()
    assert (row.beam, row.radius, row.min_x_arcmin, row.max_y_arcmin) == (None, 18.0, -23.0, 23.0)


def test_messages_are_handed_on(spark):
    got = []
    assert messages.send(spark.createDataFrame([("a",), (None,), ("b",)], "value string"), got.append) == 2 and sorted(got) == ["a", "b"]


def test_scratch_tables_go(spark, tmp_path):
    scratch = Scratch(spark, "own")
    a = scratch.saved(spark.range(5), "a")
    b = scratch.saved(a.where("id > 1"), "b")
    scratch.drop(a)
    with pytest.raises(Exception, match="exist|FILE"):
        a.count()
    kept = scratch.result(b.where("id > 2"), "c")
    assert kept.count() == 2 and scratch.root.split("/")[-1] not in {x.split("/")[-1] for x in kept.inputFiles()}


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key):
            return None

    class Context:
        master = "yarn"
        getConf, getCheckpointDir = staticmethod(Conf), staticmethod(lambda: None)  # noqa: N815

    class Session:
        sparkContext = Context()  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_settings_in_other_forms():
    text = settings.Settings(tsamp=0.5, main_gate=(1.0, 2.0)).dump()
    assert settings.Settings.load(text) == settings.Settings(tsamp=0.5, main_gate=(1.0, 2.0))
    pytest.importorskip("yaml")
    assert settings.Settings.load("tsamp: 0.25\nunknown: 1\n") == settings.Settings(tsamp=0.25)
