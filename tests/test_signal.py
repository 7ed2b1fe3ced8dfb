"""Signal operators on small arrays, against plain NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberwave.operators import asof, catalogue, cluster, crossbeam, cutouts, dedisperse, detrend, diag, matched, prep, rfi, sliding
from emberwave.plans import settings

TSAMP = 0.00786432
NU = np.linspace(120.0, 150.0, 8)


def pulse(dm=60.7, at=12.0, width=8, n=4096, seed=1, height=12.0):
    """Unit noise with one pulse that lags by the dispersion of its channel."""
    x = np.random.default_rng(seed).normal(size=(len(NU), n))
    t = np.arange(n) * TSAMP
    for c, lag in enumerate(dedisperse.delays(dm, NU, NU.max())):
        x[c] += height * np.exp(-0.5 * ((t - at - lag) / (width * TSAMP / 2.35)) ** 2)
    return x


def beams(spark, *arrays):
    rows = [(b, c, float(NU[c]), x[c].tolist()) for b, x in enumerate(arrays) for c in range(len(NU))]
    return spark.createDataFrame(rows, "beam int, chan int, nu double, x array<double>")


def long_form(frame):
    return frame.select("beam", "chan", F.posexplode("x").alias("t", "x")).withColumn("t", F.col("t").cast("long"))


def test_dedispersion_equals_numpy_whatever_the_chunk(spark):
    x = pulse()
    grid = spark.createDataFrame([(0.0, 1), (60.7, 1), (300.0, 4)], "dm double, downsample int")
    frame = beams(spark, x, x[::-1].copy())
    for chunk in (257, 4096):
        got = {(r.beam, r.dm): np.array(r.x) for r in dedisperse.dedisperse(frame, grid, TSAMP, "beam", chunk=chunk).collect()}
        for beam, data in enumerate((x, x[::-1])):
            for dm, factor in ((0.0, 1), (60.7, 1), (300.0, 4)):
                assert np.allclose(got[beam, dm], dedisperse.dedispersed(data, NU, TSAMP, np.array([dm]), factor)[0])
    assert np.allclose(got[0, 0.0], x.sum(axis=0))


def test_folding_is_decimation_of_bins(spark):
    x = np.random.default_rng(3).normal(size=256)
    frame = spark.createDataFrame([(1, x.tolist())], "k int, x array<double>")
    assert np.allclose(dedisperse.fold_series(frame, 4, "k").first().x, dedisperse.folded(np.fft.rfft(x), 4))


def test_injected_pulse_is_found(spark):
    frame = beams(spark, pulse(), np.random.default_rng(9).normal(size=(8, 4096)))
    grid = settings.dm_grid(spark, (settings.Segment(50.0, 72.0, 0.5, 1),))
    series = dedisperse.dedisperse(frame, grid, TSAMP, "beam")
    found = matched.find_pulses(series, TSAMP, settings.Settings(detection_threshold=6.0, max_width_s=0.5), "beam")
    best = found.orderBy(F.desc("sn")).first()
    assert best.beam == 0 and abs(best.dm - 60.7) <= 1.5 and abs(best.time - 12.0) <= 8 * TSAMP and best.sample == int(best.time / TSAMP)
    sn = {r.beam: r for r in crossbeam.cross_beam_sn(frame, 60.7, 12.0, 8, TSAMP).collect()}
    assert sn[0].sn > 8 > sn[1].sn and abs(sn[0].peak_t * TSAMP - 12.0) <= 10 * TSAMP


def test_matched_filter_of_odd_and_empty_series(spark):
    odd = matched.responses(np.random.default_rng(0).normal(size=4103), TSAMP, [1, 2, 8])
    assert odd.shape == (3, 4102) and np.allclose(odd.std(axis=1), 1)
    assert not matched.responses(np.zeros(16), TSAMP, [1]).any()
    frame = spark.createDataFrame([(1.0, 1, None), (2.0, 1, []), (3.0, 2, [1.0, 0.0] * 8)], "dm double, downsample int, x array<double>")
    assert matched.find_pulses(frame, 50.0, settings.Settings(detection_threshold=1e9)).count() == 0
    assert len(matched.widths(TSAMP, 1)) in (15, 16) and matched.widths(1e6, 1) == []


def test_high_pass_removes_drift_and_keeps_phase():
    t = np.arange(4096) * 0.1
    fast = np.sin(2 * np.pi * 0.5 * t)
    got = matched.high_passed(fast + 5 + 0.01 * t, 0.1, cutoff_hz=0.05)
    assert np.abs(got[500:-500] - fast[500:-500]).max() < 0.05


def test_moments_and_mask(spark):
    x = np.abs(pulse(height=0.0)) + 1
    x[3, 1000:2000] += np.random.default_rng(4).normal(size=1000) * 20 + 200
    x[5, :] = 2.0
    x = x[:, :4000 - 103]
    moments = rfi.block_moments(long_form(beams(spark, x)), 1000, "beam")
    got = {(r.chan, r.block): r for r in moments.collect()}
    for c in range(8):
        padded = np.r_[x[c], np.full(103, x[c].mean())].reshape(4, 1000)
        for b, y in enumerate(padded):
            y = y / y.mean()
            d = y - y.mean()
            r = got[c, b]
            assert r.std_x == pytest.approx(y.std(), abs=1e-9)
            if c == 5:
                assert r.skew_x is None and r.kurt_x is None
            else:
                assert r.skew_x == pytest.approx((d**3).mean() / y.std() ** 3, rel=1e-6)
                assert r.kurt_x == pytest.approx((d**4).mean() / y.std() ** 4 - 3, rel=1e-6)
    both = [rfi.rfi_mask(moments, "beam", low=2.0, high=2.0), rfi.rfi_mask_rounds(moments, "beam", low=2.0, high=2.0)]
    masks = [{(r.chan, r.block): r.masked for r in m.collect()} for m in both]
    assert masks[0] == masks[1] and masks[0][3, 1] and all(masks[0][5, b] for b in range(4))
    fraction = rfi.masked_fraction(both[0], "beam").first().masked_frac
    assert 0 < fraction < 1


def test_noise_fill_does_not_depend_on_partitions(spark):
    frame = long_form(beams(spark, pulse(height=0.0)[:, :500]))
    masked = frame.withColumn("masked", F.col("t") < 250)
    stats = rfi.fill_statistics(masked, "beam")
    a, b = (rfi.noise_filled(masked.repartition(n), stats, 7, "beam") for n in (1, 5))
    assert a.exceptAll(b).count() == 0
    noise = np.array([r.x for r in a.where("masked").collect()])
    assert abs(noise.mean()) < 0.1 and abs(noise.std() - 1) < 0.1


def test_detrending_removes_a_parabola(spark):
    t = np.arange(400)
    x = np.random.default_rng(2).normal(size=400) + 3 - 0.01 * t + 1e-4 * t * t
    frame = spark.createDataFrame([(1, int(k), float(v)) for k, v in zip(t, x, strict=True)], "chan int, t long, x double")
    got = np.array([r.x for r in detrend.detrended(frame, "chan").orderBy("t").collect()])
    assert np.allclose(got, x - np.polyval(np.polyfit(t, x, 2), t), atol=1e-8)


def test_flat_field_with_a_short_beam(spark):
    draw = np.random.default_rng(1)
    data = {13: draw.uniform(1, 2, (2, 6)), 20: draw.uniform(1, 2, (2, 4)), 5: draw.uniform(1, 2, (2, 8))}
    rows = [(b, c, t, float(x[c, t])) for b, x in data.items() for c in range(2) for t in range(x.shape[1])]
    frame = spark.createDataFrame(rows, "beam int, chan int, t long, x double")
    short = np.hstack([data[20], np.tile(data[20].mean(axis=1, keepdims=True), (1, 2))])
    want = (data[13] + short) / 2
    got = {(r.chan, r.t): r.mean_x for r in prep.mean_beam(frame).collect()}
    assert all(got[c, t] == pytest.approx(want[c, t]) for c in range(2) for t in range(6)) and len(got) == 12
    assert prep.flat_fielded(frame, prep.mean_beam(frame)).where("beam = 5").count() == 12


@pytest.mark.parametrize("length", [1, 3, 4, 5, 100])
def test_flat_field_of_blocks_equals_that_of_samples(spark, length):
    """Beams that end inside a block, at its edge and blocks before the others, and missing samples."""
    draw = np.random.default_rng(3)
    ends = {13: 17, 14: 12, 15: 4, 16: 1, 73: 17, 5: 20}
    rows = [(b, c, t, None if draw.random() < 0.1 else float(draw.uniform(1, 2))) for b, n in ends.items() for c in range(3) for t in range(n)]
    frame = spark.createDataFrame(rows, "beam int, chan int, t long, x double")
    blocks = prep.time_blocks(frame, length, "beam", "chan")
    assert {tuple(r) for r in prep.from_blocks(blocks, length, "beam", "chan").select("beam", "chan", "t", "x").collect()} == set(rows)
    for mean, of_blocks in ((prep.mean_beam(frame), prep.mean_beam_blocks(blocks, length)), (prep.plain_mean_beam(frame), prep.mean_beam_blocks(blocks, length, 0, 73, fill=False))):
        want = {(r.beam, r.chan, r.t): r.x for r in prep.flat_fielded(frame, mean).collect()}
        flat = prep.flat_fielded_blocks(blocks, of_blocks)
        assert "posexplode" not in flat._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.beam, r.chan, r.t): r.x for r in prep.from_blocks(flat, length, "beam", "chan").collect()}
        assert got.keys() == want.keys() and all(got[k] == (want[k] and pytest.approx(want[k], rel=1e-12)) for k in want)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof_by_hand(spark, direction):
    draw = np.random.default_rng(4)
    left = [(None if k % 50 == 0 else int(draw.integers(0, 3)), None if k % 31 == 0 else float(draw.integers(0, 40)) / 2, k) for k in range(400)] + [(9, 1.0, 1000)]
    right = [(None if k % 20 == 0 else int(draw.choice([0, 0, 0, 1, 7])), None if k % 37 == 0 else float(draw.integers(0, 30)) / 2 + 3, k) for k in range(120)]

    def pick(key, t):
        held = sorted((x for x in right if x[0] == key and x[1] is not None), key=lambda x: (x[1], x[2]))
        last = next((x for x in reversed(held) if t is not None and x[1] <= t), None)
        after = next((x for x in held if t is not None and x[1] > t), None)
        if direction != "nearest":
            return last if direction == "backward" else after
        return last if last and (not after or t - last[1] <= after[1] - t) else after

    a, b = spark.createDataFrame(left, "k int, time double, id int"), spark.createDataFrame(right, "k int, time double, id int")
    got = {r.id: (r.r_time, r.r_id) for r in asof.asof(a.repartition(7), b.repartition(5), "k", direction=direction).collect()}
    assert got == {i: (pick(k, t) or (None, None, None))[1:] for k, t, i in left}
    assert asof.asof(a, b.limit(0), "k", direction=direction).where("r_id IS NULL").count() == 401 and asof.asof(a.limit(0), b, "k").count() == 0


def test_cones_reach_over_poles_and_around(spark):
    draw = np.random.default_rng(5)
    z = draw.uniform(-1, 1, 3000)
    places = [(k, float(draw.uniform(-360, 720)), float(np.degrees(np.arcsin(v)))) for k, v in enumerate(z)] + [(9000, 10.0, 90.0), (9001, 200.0, -90.0), (9002, 0.0, 0.0), (9003, 359.999, 0.0), (9004, 360.0, 5.0)]
    frame = spark.createDataFrame(places, "centre int, ra_deg double, dec_deg double")
    for radius in (5.0, 0.7, 40.0):
        centres = frame.where("centre % 40 = 0 OR centre >= 9000")
        got = {(r.centre, r.source) for r in catalogue.cone_match(centres, frame.withColumnRenamed("centre", "source"), radius).select("centre", "source").collect()}
        ra, dec = np.radians([p[1] for p in places]), np.radians([p[2] for p in places])
        v = np.c_[np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)]
        want = {(places[i][0], places[j][0]) for i in range(len(places)) if places[i][0] % 40 == 0 or places[i][0] >= 9000 for j in np.flatnonzero(2 * np.arcsin(np.minimum(1, np.linalg.norm(v - v[i], axis=1) / 2)) <= np.radians(radius))}
        assert len(got ^ want) <= len(want) // 10_000 and len(want) > 70


def test_clusters_are_components(spark):
    draw = np.random.default_rng(6)
    points = [(1, float(round(d, 1)), 7.0, float(round(t, 1)), k, 1) for k, (d, t) in enumerate(draw.uniform((0, 0), (12, 60), (250, 2)))]
    points += [(2, 5.0, 7.0, 5.0, 900, 1), (2, 5.0, 6.5, 5.0, 901, 1), (2, 90.0, 5.0, 500.0, 902, 1)]
    frame = spark.createDataFrame(points, "beam int, dm double, sn double, time double, sample long, filter_width int")
    got = {r.sample: (r.beam, r.cluster) for r in cluster.cluster(frame, "beam").collect()}
    own = [p for p in points if p[0] == 1]
    place = np.array([(p[1] / 0.1, p[3]) for p in own])
    near = ((place[:, None] - place[None]) ** 2).sum(axis=2) <= 25
    label, groups = [-1] * len(own), 0
    for k in range(len(own)):
        if label[k] < 0 and near[k].sum() > 1:
            todo = [k]
            while todo:
                i = todo.pop()
                if label[i] < 0:
                    label[i] = groups
                    todo += np.flatnonzero(near[i]).tolist()
            groups += 1
    pairs = {(label[k], got[p[4]][1]) for k, p in enumerate(own)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) and ((-1, -1) in pairs or -1 not in label)
    assert got[900] == got[901] == (2, 0) and got[902] == (2, -1)
    best = cluster.representatives(cluster.cluster(frame, "beam"), "beam")
    assert {r.sample for r in best.where("beam = 2").collect()} == {900}
    with pytest.raises(ValueError, match="noise"):
        cluster.representatives(frame, noise="other")


def test_cutouts_score_a_pulse_above_noise(spark):
    frame = beams(spark, pulse(height=20.0), np.random.default_rng(9).normal(size=(8, 4096)))
    cands = spark.createDataFrame([(0, 60.7, 20.0, 12.0, 1525, 8), (1, 60.7, 7.0, 12.0, 1525, 8)], "beam int, dm double, sn double, time double, sample long, filter_width int")
    got = {r.beam: r for r in cutouts.classified(frame, cands, TSAMP).collect()}
    assert len(got[0].probs) == 6 and got[0].max_prob > got[1].max_prob and got[0].is_candidate
    assert cutouts.resized(np.arange(4.0).reshape(2, 2), 4, 4).shape == (4, 4)


def test_diagnostics(spark):
    frame = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 2, 10)], "x double")
    got = [(r.bin, r.n) for r in diag.histogram(frame, "x", 10).orderBy("bin").collect()]
    want, _ = np.histogram([0, 1, 1, 2, 10], 10)
    assert got == [(k, n) for k, n in enumerate(want) if n]


def test_grids(spark):
    grid = settings.dm_grid(spark)
    assert [r["count"] for r in grid.groupBy("seg").count().orderBy("seg").collect()] == [1506, 465, 444, 499, 502, 491, 447, 54]
    assert settings.distinct_trials(grid).count() == 4407
    assert settings.distinct_trials(grid).where("dm_name = '289.8'").first().seg == 2
    loaded = settings.Settings.load('{"rfi_block_size": 256, "other": 1, "dedispersion_plan": [{"low_dm": 0, "high_dm": 1, "ddm": 0.5, "downsample": 2}]}')
    assert loaded.rfi_block_size == 256 and loaded.plan == (settings.Segment(0.0, 1.0, 0.5, 2),)
    assert int(2877.916 / TSAMP) in (365945, 365946)


def test_cut_outs_from_blocks_equal_those_of_the_whole_beam(spark, monkeypatch):
    monkeypatch.setattr(cutouts, "BLOCK", 300)
    monkeypatch.setattr(cutouts, "CHANNELS", 3)
    monkeypatch.setattr(cutouts, "BLOCKS", 2)
    x = pulse(n=4096)
    frame = beams(spark, x)
    rows = [(0, 60.7, 9.0, t, 0, w) for t in (0.0, 0.5, 12.0, 32.0) for w in (2, 8)] + [(9, 60.7, 9.0, 1.0, 0, 4)]
    cands = spark.createDataFrame(rows, "beam int, dm double, sn double, time double, sample long, filter_width int")
    looks = lambda a, b: [float(np.abs(a).mean()), float((a * np.arange(a.size).reshape(a.shape)).mean()), float((b * np.arange(b.size).reshape(b.shape)).mean())]
    got = {(r.beam, r.time, r.filter_width): r for r in cutouts.classified(frame, cands, TSAMP, looks).collect()}
    order = np.argsort(NU)
    for _, dm, _, t, _, w in rows[:-1]:
        assert got[0, t, w].probs == pytest.approx(looks(*cutouts.images(x[order], NU[order], TSAMP, dm, t, w)), rel=1e-9, abs=1e-9)
    assert got[9, 1.0, 4].probs == [] and not got[9, 1.0, 4].is_candidate


@pytest.mark.parametrize("block", [4, 7, 1000])
def test_boxcars_by_hand(spark, block):
    draw = np.random.default_rng(6)
    data = {k: [None if draw.random() < 0.2 else float(v) for v in draw.normal(size=n)] for k, n in (("a", 23), ("b", 1), ("c", 8), (None, 14))}
    frame = spark.createDataFrame([(k, t, v) for k, x in data.items() if k for t, v in enumerate(x)], "k string, t long, x double").repartition(3)
    halves = [0, 1, 3]
    got = {(r.k, r.half, r.t): r.x for r in sliding.boxcars(frame, halves, "k", block=block).collect()}
    want = {}
    for k, x in data.items():
        for half in halves if k else []:
            for t in range(len(x)):
                held = [v for v in x[max(0, t - half) : t + half + 1] if v is not None]
                want[k, half, t] = np.mean(held) if held else None
    assert got.keys() == want.keys() and all(got[k] == (None if want[k] is None else pytest.approx(want[k], abs=1e-12)) for k in want)
    with pytest.raises(ValueError, match="reach"):
        sliding.boxcars(frame, [block], "k", block=block)


@pytest.mark.parametrize("block", [4, 256])
def test_high_pass_in_blocks_equals_that_of_whole_series(spark, block):
    draw = np.random.default_rng(7)
    data = {k: np.cumsum(draw.normal(size=n)) + 10 for k, n in ((1, 300), (2, 90), (3, 5), (4, 1))}
    frame = spark.createDataFrame([(k, t, float(v)) for k, x in data.items() for t, v in enumerate(x)], "k int, t long, x double").repartition(3)
    for cutoff, order in ((2.0, 3), (0.2, 1)):
        found = sliding.high_passed(frame, 0.05, "k", cutoff_hz=cutoff, order=order, block=block)
        got = {(r.k, r.t): r.x for r in found.collect()}
        assert len(got) == sum(map(len, data.values()))
        for k, x in data.items():
            assert np.allclose([got[k, t] for t in range(len(x))], matched.high_passed(x, 0.05, cutoff, order), atol=1e-9), (k, cutoff)
    assert not {"Python", "Arrow"} & set(found._jdf.queryExecution().executedPlan().toString().split())


@pytest.mark.parametrize("length", [600, 601, 64])
def test_dedispersion_of_a_given_length(spark, length):
    x = pulse(n=601)
    frame = beams(spark, x)
    grid = spark.createDataFrame([(60.7, 1)], "dm double, downsample int")
    got = dedisperse.dedisperse(frame.where("beam = 0"), grid, TSAMP, "beam", length=length).first().x
    spectrum = (np.fft.rfft(x, axis=1) * np.exp(2j * np.pi * np.fft.rfftfreq(601, TSAMP) * dedisperse.delays(60.7, NU, NU.max())[:, None])).sum(axis=0)
    assert np.allclose(got, np.fft.irfft(spectrum, length))
