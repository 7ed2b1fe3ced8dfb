"""SQL for DuckDB that the registered queries are held against."""

from __future__ import annotations

from emberwave.plans.settings import PLAN, Settings

_TSAMP = repr(Settings().tsamp)

_CANDS = """cands AS (SELECT l_suppkey % 73 AS beam, ((l_partkey * 37) % 100190) / CAST(10 AS DOUBLE) AS dm, l_quantity / CAST(5 AS DOUBLE) AS sn,
 (l_orderkey % 3600) + l_linenumber / CAST(10 AS DOUBLE) AS time, l_orderkey * 10 + l_linenumber AS sample, CAST(power(2, l_linenumber - 1) AS BIGINT) AS filter_width FROM lineitem)"""
_CATALOGUE = """catalogue AS (SELECT p_name AS psrj, CAST((p_partkey * 53) % 10019 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS dm, CAST((p_partkey * 7) % 360 AS DOUBLE) AS ra_deg,
 CAST(p_size AS DOUBLE) - 25 AS dec_deg, p_partkey AS ord FROM part WHERE p_partkey % 10 = 0)"""
_SAMPLES = """samples AS (SELECT user_id % 16 AS chan, row_number() OVER (PARTITION BY user_id % 16 ORDER BY ts, event_id) - 1 AS t, value AS x FROM events)"""
_SERIES = """series AS (SELECT vec_id AS series_id, label AS beam, CAST(r.i - 1 AS BIGINT) AS t, CAST(embedding[CAST(r.i AS INTEGER)] AS DOUBLE) AS x FROM embeddings, range(1, 65) r(i))"""
_ORDER = "sn DESC, dm, time, sample, filter_width, beam"
_COLS = "beam, dm, sn, time, sample, filter_width"
_PLAN = "plan(seg, low_dm, high_dm, ddm, downsample, n) AS (VALUES " + ", ".join(f"({k}, CAST({s.low_dm} AS DOUBLE), CAST({s.high_dm} AS DOUBLE), CAST({s.ddm} AS DOUBLE), {s.downsample}, {s.trials})" for k, s in enumerate(PLAN)) + ")"


def _case(name: str, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN dm >= CAST({s.low_dm} AS DOUBLE) AND dm < CAST({s.high_dm} AS DOUBLE) THEN {f'CAST({s.ddm} AS DOUBLE)' if name == 'ddm' else s.downsample}" for s in PLAN) + f" ELSE {otherwise} END"


_DDM, _DS = _case("ddm", "CAST(1 AS DOUBLE)"), _case("downsample", "1")
_NAMED = f"{_CANDS}, named AS (SELECT printf('%.1f', dm) AS name, count(*) AS n FROM cands GROUP BY 1)"
_TOP = f"top5 AS (SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY dm ORDER BY {_ORDER}) AS k FROM cands) q WHERE k <= 5)"
_GATED = f"gated AS (SELECT {_COLS} FROM top5 WHERE dm >= 10 AND sn > 7)"


def _matches(of: str) -> str:
    return f"""dms AS (SELECT DISTINCT dm FROM {of}),
 firsts AS (SELECT dm, psrj FROM (SELECT d.dm, c.psrj, row_number() OVER (PARTITION BY d.dm ORDER BY c.ord) AS k FROM dms d JOIN catalogue c ON c.dm BETWEEN d.dm - CAST(0.75 AS DOUBLE) AND d.dm + CAST(0.75 AS DOUBLE) AND abs(d.dm - c.dm) <= CAST(0.5 AS DOUBLE)) q WHERE k = 1)"""


_CHANNEL = "channel AS (SELECT chan, avg(x) AS c FROM samples GROUP BY chan)"
# Moments about each block's own mean over the 50 places of a block, empty ones filled with the channel's mean.
_MOMENTS = f"""{_CHANNEL}, filled AS (SELECT b.chan, b.block, p.k, b.n, coalesce(s.x, c.c) AS x FROM (SELECT chan, t // 50 AS block, count(*) AS n FROM samples GROUP BY 1, 2) b
 CROSS JOIN range(0, 50) p(k) JOIN channel c ON c.chan = b.chan LEFT JOIN samples s ON s.chan = b.chan AND s.t = b.block * 50 + p.k),
 means AS (SELECT chan, block, n, avg(x) AS m FROM filled GROUP BY chan, block, n),
 powers AS (SELECT f.chan, f.block, f.n, m.m, avg((f.x - m.m) * (f.x - m.m)) AS v, avg((f.x - m.m) * (f.x - m.m) * (f.x - m.m)) AS m3, avg((f.x - m.m) * (f.x - m.m) * (f.x - m.m) * (f.x - m.m)) AS m4
  FROM filled f JOIN means m ON m.chan = f.chan AND m.block = f.block GROUP BY f.chan, f.block, f.n, m.m),
 moments AS (SELECT chan, block, n, sqrt(v) / abs(m) AS std_x, CASE WHEN v > 0 THEN sign(m) * m3 / power(v, CAST(1.5 AS DOUBLE)) END AS skew_x, CASE WHEN v > 0 THEN m4 / (v * v) - 3 END AS kurt_x FROM powers)"""


def _clip() -> str:
    """Eight clipping rounds of each statistic within its block, two deviations wide."""
    parts, last = [], "moments"
    for name in ("std_x", "skew_x", "kurt_x"):
        parts.append(f"{name}_0 AS (SELECT *, {name} IS NOT NULL AS ok_{name} FROM {last})")
        for k in range(1, 9):
            parts.append(
                f"{name}_{k} AS (SELECT * REPLACE (ok_{name} AND {name} >= m_ - 2 * s_ AND {name} <= m_ + 2 * s_ AS ok_{name}) FROM (SELECT *, avg(CASE WHEN ok_{name} THEN {name} END) OVER (PARTITION BY block) AS m_,"
                f" stddev_pop(CASE WHEN ok_{name} THEN {name} END) OVER (PARTITION BY block) AS s_ FROM {name}_{k - 1}) q)".replace("SELECT * REPLACE", "SELECT * EXCLUDE (m_, s_) REPLACE")
            )
        last = f"{name}_8"
    return ", ".join(parts) + f", masks AS (SELECT chan, block, n, NOT (coalesce(ok_std_x, false) AND coalesce(ok_skew_x, false) AND coalesce(ok_kurt_x, false)) AS masked FROM {last})"


_MASK = f"{_SAMPLES}, {_MOMENTS}, {_clip()}, bad AS (SELECT chan, block, n, masked OR chan = 7 AS masked FROM masks)"
_EXPANDED = f"{_MASK}, expanded AS (SELECT s.chan, s.t, s.x, b.masked FROM samples s JOIN bad b ON b.chan = s.chan AND b.block = s.t // 50)"
_BEAMS = "beams AS (SELECT chan % 4 + 13 AS beam, chan // 4 AS chan, t, x FROM samples)"
# Kernel of the series' 64 places at 0.05 s: width w in samples.
_WIDTHS = (1, 2, 3, 4, 6, 9, 14)
_FILTER = f"""{_SERIES}, widths(w) AS (VALUES {", ".join(f"({w})" for w in _WIDTHS)}),
 kernel AS (SELECT w, k.k, (1 - (CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * tanh(1000 * (k.k * CAST(0.05 AS DOUBLE) - CAST(0.5 AS DOUBLE) * w * CAST(0.05 AS DOUBLE))))
  + (CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * tanh(1000 * (k.k * CAST(0.05 AS DOUBLE) - (63 * CAST(0.05 AS DOUBLE) - CAST(0.5 AS DOUBLE) * w * CAST(0.05 AS DOUBLE)))))) / sqrt(w * CAST(0.05 AS DOUBLE)) AS v FROM widths, range(0, 64) k(k)),
 taps AS (SELECT w, k, v FROM kernel WHERE v > CAST(1e-12 AS DOUBLE)),
 raw AS (SELECT s.series_id, q.w, (s.t - q.k + 64) % 64 AS t, sum(s.x * q.v) AS r FROM series s CROSS JOIN taps q GROUP BY 1, 2, 3),
 response AS (SELECT series_id, CAST(w AS INTEGER) AS filter_width, t, r / stddev_pop(r) OVER (PARTITION BY series_id, w) AS sn FROM raw)"""


def _quadratic() -> str:
    d = lambda c: f"({c[0]} * ({c[4]} * {c[8]} - {c[5]} * {c[7]}) - {c[1]} * ({c[3]} * {c[8]} - {c[5]} * {c[6]}) + {c[2]} * ({c[3]} * {c[7]} - {c[4]} * {c[6]}))"
    m = ["s0", "s1", "s2", "s1", "s2", "s3", "s2", "s3", "s4"]
    swap = lambda k: [f"y{i // 3}" if i % 3 == k else m[i] for i in range(9)]
    sums = ", ".join(f"sum(power(u, {k})) AS s{k}" for k in range(1, 5)) + ", " + ", ".join(f"sum(x * power(u, {k})) AS y{k}" for k in range(3))
    fits = ", ".join(f"{d(swap(k))} / {d(m)} AS c{k}" for k in range(3))
    return f"""scaled AS (SELECT s.chan, s.t, s.x, s.t * CAST(2 AS DOUBLE) / l.last - 1 AS u FROM samples s JOIN (SELECT chan, max(t) AS last FROM samples GROUP BY chan) l ON l.chan = s.chan),
 sums AS (SELECT chan, CAST(count(*) AS DOUBLE) AS s0, {sums} FROM scaled GROUP BY chan), fits AS (SELECT chan, {fits} FROM sums)"""


def _histogram(column: str, bins: int) -> str:
    return f"""WITH {_CANDS}, ends AS (SELECT min({column}) AS a, max({column}) AS b FROM cands),
 binned AS (SELECT CAST(least(floor(({column} - a) * {bins} / (b - a)), {bins - 1}) AS INTEGER) AS bin, a, b FROM cands, ends)
 SELECT bin, round(a + (b - a) * bin / {bins}, 6) AS low, round(a + (b - a) * (bin + 1) / {bins}, 6) AS high, count(*) AS n FROM binned GROUP BY bin, a, b"""


# Points are numbered, linked within eps, and labelled by the smallest number reachable.
_CLUSTER = f"""WITH RECURSIVE {_CANDS}, pts AS (SELECT *, dm / ({_DDM}) AS dm_scaled FROM cands WHERE sn >= 5),
 places AS (SELECT beam, dm_scaled, time, count(*) AS n, row_number() OVER (ORDER BY beam, dm_scaled, time) AS p FROM pts GROUP BY beam, dm_scaled, time),
 cells AS (SELECT *, CAST(floor(time / 5) AS BIGINT) AS cy FROM places),
 links AS (SELECT a.p AS a, b.p AS b FROM (SELECT *, cy + o.o - 1 AS ny FROM cells, range(0, 3) o(o)) a JOIN cells b ON a.beam = b.beam AND a.ny = b.cy
  WHERE a.p <> b.p AND (a.dm_scaled - b.dm_scaled) * (a.dm_scaled - b.dm_scaled) + (a.time - b.time) * (a.time - b.time) <= 25),
 reach(p, r) AS (SELECT a, a FROM links UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.p),
 named AS (SELECT p, min(r) AS c FROM reach GROUP BY p),
 labelled AS (SELECT pts.*, CASE WHEN n.c IS NOT NULL THEN n.c WHEN pl.n > 1 THEN pl.p ELSE -1 END AS cluster FROM pts JOIN places pl ON pl.beam = pts.beam AND pl.dm_scaled = pts.dm_scaled AND pl.time = pts.time LEFT JOIN named n ON n.p = pl.p)"""

_D = lambda v: f"CAST({v} AS DOUBLE)"
_PACKED = f"""packed AS (SELECT o_orderkey, (o_orderkey % 24) * 10000 + (o_custkey % 60) * 100 + o_orderkey % 59 + {_D(0.25)} AS ra,
 ((o_orderkey % 90) * 10000 + (o_custkey % 60) * 100 + o_orderkey % 59 + {_D(0.5)}) * CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE -1 END AS dec FROM orders),
 parts AS (SELECT *, CAST(o_orderkey % 24 AS BIGINT) AS rh, CAST(floor(abs(dec) / 10000) AS BIGINT) AS dd, CAST(floor((abs(dec) % 10000) / 100) AS BIGINT) AS m, ra % 100 AS rs, abs(dec) % 100 AS ds FROM packed)"""


def sql() -> dict[str, str]:
    galactic = lambda row: f"cos(radians(dec_deg)) * cos(radians(ra_deg)) * {_D(row[0])} + cos(radians(dec_deg)) * sin(radians(ra_deg)) * {_D(row[1])} + sin(radians(dec_deg)) * {_D(row[2])}"
    from emberwave.functions.coords import ARCSEC_RAD, GALACTIC

    name = "'downsampled_L' || o_orderkey || '_SAP' || o_orderkey % 3 || '_BEAM' || o_orderkey % 74 || '_32bit_ff.fil'"
    return {
        "plan_lookup": f"WITH {_CANDS} SELECT {_COLS}, {_DDM} AS ddm, {_DS} AS downsample, round(dm / ({_DDM}), 6) AS dm_scaled FROM cands",
        "dm_grid_expand": f"WITH {_PLAN}, {_NAMED} SELECT seg, r.i, round(low_dm + r.i * ddm, 6) AS dm, downsample, printf('%.1f', low_dm + r.i * ddm) AS dm_name, coalesce((SELECT n FROM named WHERE name = printf('%.1f', low_dm + r.i * ddm)), 0) AS n_cands FROM plan, range(0, 2000) r(i) WHERE r.i < n",
        "dm_trials_distinct": f"WITH {_PLAN}, {_NAMED}, grid AS (SELECT seg, r.i, downsample, printf('%.1f', low_dm + r.i * ddm) AS dm_name FROM plan, range(0, 2000) r(i) WHERE r.i < n) SELECT dm_name, seg, i, downsample, coalesce((SELECT n FROM named WHERE name = dm_name), 0) AS n_cands FROM (SELECT *, row_number() OVER (PARTITION BY dm_name ORDER BY seg DESC, i DESC) AS k FROM grid) q WHERE k = 1",
        "width_grid": f"WITH {_PLAN}, {_CANDS}, widths AS (SELECT {_DS} AS downsample, filter_width AS width, count(*) AS n FROM cands GROUP BY 1, 2), wide AS (SELECT seg, downsample, CAST(floor(600 / ({_D(_TSAMP)} * downsample)) AS INTEGER) AS m FROM plan) SELECT seg, downsample, width, coalesce((SELECT n FROM widths v WHERE v.downsample = d.downsample AND v.width = d.width), 0) AS n_cands FROM (SELECT DISTINCT seg, downsample, CASE WHEN r.i = 15 THEN m ELSE CAST(floor(power(m, r.i / {_D(15)})) AS INTEGER) END AS width FROM wide, range(0, 16) r(i)) d",
        "topk_per_dm": f"WITH {_CANDS}, {_TOP} SELECT * FROM top5",
        "gate_main": f"WITH {_CANDS} SELECT * FROM cands WHERE dm >= 10 AND sn > 7",
        "gate_post": f"WITH {_CANDS} SELECT * FROM cands WHERE dm >= 3 AND sn > {_D(6.5)}",
        "catalog_match": f"WITH {_CANDS}, {_CATALOGUE}, {_matches('cands')} SELECT c.*, f.psrj FROM cands c JOIN firsts f ON f.dm = c.dm",
        "new_candidates": f"WITH {_CANDS}, {_CATALOGUE}, {_matches('cands')} SELECT c.* FROM cands c WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.dm = c.dm)",
        "best_redetection": f"WITH {_CANDS}, {_CATALOGUE}, {_TOP}, {_GATED}, {_matches('gated')} SELECT {_COLS}, psrj FROM (SELECT *, row_number() OVER (PARTITION BY psrj ORDER BY {_ORDER}) AS k FROM (SELECT c.*, f.psrj FROM gated c JOIN firsts f ON f.dm = c.dm) m) q WHERE k = 1",
        "labelled_detections": f"""WITH {_CANDS}, {_CATALOGUE}, {_TOP}, {_GATED}, {_matches("gated")}, all_ AS (SELECT c.*, f.psrj FROM gated c LEFT JOIN firsts f ON f.dm = c.dm)
 SELECT {_COLS}, psrj, 'known_pulsar' AS detection_type FROM (SELECT *, row_number() OVER (PARTITION BY psrj ORDER BY {_ORDER}) AS k FROM all_ WHERE psrj IS NOT NULL) q WHERE k = 1 UNION ALL SELECT {_COLS}, psrj, 'candidate' AS detection_type FROM all_ WHERE psrj IS NULL""",
        "cone_match": f"""WITH {_CATALOGUE}, met AS (SELECT a.ord AS centre, b.psrj, degrees(2 * asin(least(1, sqrt(power(sin((radians(b.dec_deg) - radians(a.dec_deg)) / 2), 2) + cos(radians(a.dec_deg)) * cos(radians(b.dec_deg)) * power(sin(radians(b.ra_deg - a.ra_deg) / 2), 2))))) AS sep
 FROM catalogue a JOIN catalogue b ON b.dec_deg BETWEEN a.dec_deg - 5 AND a.dec_deg + 5) SELECT centre, psrj, round(sep, 5) AS sep_deg FROM met WHERE sep <= 5""",
        "catalogue_preview": f"WITH {_CATALOGUE} SELECT psrj, dm, (SELECT greatest(count(*) - 5, 0) FROM catalogue) AS n_more FROM (SELECT *, row_number() OVER (ORDER BY ord) AS k FROM catalogue) q WHERE k <= 5",
        "sn_by_dm": f"WITH {_CANDS} SELECT dm, round(sum(sn), 4) AS sum_sn FROM cands GROUP BY dm",
        "collect_union": f"WITH {_CANDS} SELECT 'B' || lpad(CAST(beam AS VARCHAR), 3, '0') AS beam_label, dm, sn, time, sample, filter_width FROM cands",
        "beam_summary": f"""WITH {_CANDS}, q AS (SELECT *, row_number() OVER (PARTITION BY beam, dm ORDER BY {_ORDER}) AS k FROM cands) SELECT beam, count(*) AS num_candidates, sum(CASE WHEN dm >= 10 AND sn > 7 THEN 1 ELSE 0 END) AS num_gated, coalesce(max(CASE WHEN dm >= 10 AND sn > 7 THEN sn END), 0) AS highest_snr FROM q WHERE k <= 5 GROUP BY beam""",
        "top_detection": f"WITH {_CANDS} SELECT * FROM cands ORDER BY {_ORDER} LIMIT 1",
        "rounded_candidates": f"WITH {_CANDS} SELECT beam, round(dm, 3) AS dm, round(sn, 3) AS sn, round(time, 6) AS time, sample, filter_width, CAST(trunc(round(time, 6) / {_D(_TSAMP)}) AS BIGINT) AS time_sample FROM cands",
        "sn_histogram": _histogram("sn", 20),
        "dm_histogram": _histogram("dm", 100),
        "central_beams": f"WITH {_CANDS} SELECT beam, count(*) AS n, CAST(sum(sample) AS BIGINT) AS samples FROM cands WHERE beam BETWEEN 13 AND 73 GROUP BY beam",
        "cluster_components": f"{_CLUSTER} SELECT beam, count(*) AS n, min(sample) AS first_sample, max(sn) AS max_sn, round(sum(sn), 4) AS sum_sn FROM labelled WHERE cluster >= 0 GROUP BY beam, cluster",
        "cluster_representatives": f"{_CLUSTER} SELECT beam, dm, sn, time, sample, filter_width, cluster >= 0 AS clustered FROM (SELECT *, row_number() OVER (PARTITION BY beam, cluster ORDER BY {_ORDER}) AS k FROM labelled) q WHERE k = 1 AND sn >= 6",
        "normalise_median": f"WITH {_SAMPLES} SELECT chan, t, round(x / (SELECT median(x) FROM samples) - 1, 6) AS x FROM samples",
        "scrunch": f"WITH {_SAMPLES}, first AS (SELECT t, chan // 4 AS chan, avg(CASE WHEN chan % 16 <> 0 THEN x END) AS x FROM samples GROUP BY 1, 2) SELECT chan, t // 16 AS t, round(avg(x), 9) AS x FROM first GROUP BY 1, 2",
        "block_mean": f"WITH {_SAMPLES} SELECT chan // 4 AS chan, t // 16 AS t, round(avg(CASE WHEN chan NOT IN (3, 5) THEN x END), 9) AS x FROM samples GROUP BY 1, 2",
        "flatfield": f"""WITH {_SAMPLES}, {_BEAMS}, fills AS (SELECT beam, chan, avg(x) AS fill FROM beams GROUP BY 1, 2), times AS (SELECT DISTINCT chan, t FROM beams),
 mean AS (SELECT g.chan, g.t, sum(coalesce(b.x, f.fill)) / 4 AS m FROM times g JOIN fills f ON f.chan = g.chan LEFT JOIN beams b ON b.chan = g.chan AND b.t = g.t AND b.beam = f.beam GROUP BY 1, 2)
 SELECT b.beam, b.chan, b.t, round(b.x / m.m, 6) AS x FROM beams b JOIN mean m ON m.chan = b.chan AND m.t = b.t""",
        "block_moments": f"WITH {_SAMPLES}, {_MOMENTS} SELECT chan, block, n, round(std_x, 5) AS std_x, round(skew_x, 5) AS skew_x, round(kurt_x, 5) AS kurt_x FROM moments",
        "rfi_mask": f"WITH {_MASK} SELECT * FROM masks",
        "rfi_mask_windows": f"WITH {_MASK} SELECT * FROM masks",
        "masked_fraction": f"WITH {_MASK} SELECT chan, round(sum(CASE WHEN masked THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE), 6) AS masked_frac FROM bad GROUP BY chan",
        "flag_fraction": f"WITH {_EXPANDED} SELECT t, round(avg(CASE WHEN masked THEN {_D(1)} ELSE 0 END), 6) AS flag_frac FROM expanded GROUP BY t",
        "noise_fill_stats": f"WITH {_EXPANDED} SELECT round(avg(x), 6) AS mean_x, round(stddev_pop(x), 6) AS std_x, count(*) AS n_used FROM expanded WHERE NOT masked",
        "mean_spectrum": f"WITH {_EXPANDED} SELECT chan, round(avg(x), 6) AS mean_x, round(avg(CASE WHEN NOT masked THEN x END), 6) AS mean_kept FROM expanded GROUP BY chan",
        "detrend_poly2": f"WITH {_SAMPLES}, {_quadratic()} SELECT s.chan, s.t, round(s.x - (c0 + c1 * u + c2 * u * u), 5) AS x FROM scaled s JOIN fits f ON f.chan = s.chan",
        "detrend_linear": f"WITH {_SAMPLES}, fit AS (SELECT chan, regr_slope(x, CAST(t AS DOUBLE)) AS a, regr_intercept(x, CAST(t AS DOUBLE)) AS b FROM samples GROUP BY chan) SELECT s.chan, s.t, round(s.x - f.b - f.a * s.t, 5) AS x FROM samples s JOIN fit f ON f.chan = s.chan",
        "time_average": f"WITH {_SAMPLES}, n AS (SELECT chan, max(t) + 1 AS n FROM samples GROUP BY chan) SELECT s.chan, s.t // 16 AS t, round(avg(s.x), 6) AS x FROM samples s JOIN n ON n.chan = s.chan WHERE s.t < (n.n // 16) * 16 GROUP BY 1, 2",
        "percentiles": f"WITH {_SAMPLES} SELECT " + ", ".join(f"round(quantile_cont(x, {p}), 6) AS {n}" for n, p in (("p01", 0.01), ("p05", 0.05), ("p20", 0.2), ("p99", 0.99), ("p999", 0.999))) + " FROM samples",
        "z_score": f"WITH {_SAMPLES}, q AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM samples) SELECT chan, t, round((x - m) / s, 5) AS z FROM samples, q",
        "time_crop": f"WITH {_SAMPLES} SELECT * FROM samples WHERE t >= 68 AND t < 132",
        "sn_rescaled": f"WITH {_SAMPLES} SELECT chan, t, round(x * {_D(7.56)} / greatest(max(x) OVER (PARTITION BY chan), {_D(1e-6)}), 6) AS x FROM samples",
        "dedisperse_dm0": f"WITH {_SERIES} SELECT beam, t, round(sum(x), 4) + 0 AS x FROM series GROUP BY beam, t",
        "dedisperse_shift": f"""WITH {_SERIES}, nu AS (SELECT *, {_D(150)} - series_id * {_D(0.01)} AS nu FROM series), top AS (SELECT beam, max(nu) AS nu_max FROM nu GROUP BY beam),
 lag AS (SELECT n.beam, n.t, n.x, CAST(round_even({_D(60.7)} * (power(nu, -2) - power(nu_max, -2)) / {_D(2.41e-4)} / {_D(_TSAMP)}, 0) AS BIGINT) AS lag FROM nu n JOIN top ON top.beam = n.beam)
 SELECT beam, ((t - lag) % 64 + 64) % 64 AS t, round(sum(x), 4) + 0 AS x FROM lag GROUP BY 1, 2""",
        "spectrum_fold": f"WITH {_SERIES} SELECT series_id, t % 16 AS t, round(sum(x), 5) + 0 AS x FROM series GROUP BY 1, 2",
        "matched_filter": f"WITH {_FILTER} SELECT series_id, filter_width, t, round(sn, 4) + 0 AS sn FROM response",
        "matched_filter_detections": f"WITH {_FILTER} SELECT series_id, filter_width, count(*) AS n, round(max(sn), 4) AS max_sn FROM response WHERE sn >= {_D(2.5)} GROUP BY 1, 2",
        "peak_window": f"WITH {_SERIES} SELECT series_id, t, x FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY x DESC, t) AS k FROM series WHERE t BETWEEN 30 AND 50) q WHERE k = 1",
        "nearest_sample": f"WITH {_SERIES} SELECT series_id, t, t * {_D(0.25)} AS time FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY abs(t * {_D(0.25)} - {_D(7.375)}), t) AS k FROM series) q WHERE k = 1",
        "nearest_beams": f"WITH {_CANDS} SELECT beam, CAST(k AS INTEGER) AS rank FROM (SELECT beam, row_number() OVER (ORDER BY abs(beam - 30), beam) AS k FROM (SELECT DISTINCT beam FROM cands) d) q WHERE k <= 20",
        "beam_offsets": f"""WITH {_CANDS}, {_CATALOGUE}, sn AS (SELECT beam, max(sn) AS sn FROM cands GROUP BY beam), pos AS (SELECT ord // 10 AS beam, ra_deg, dec_deg FROM catalogue),
 placed AS (SELECT sn.beam, sn.sn, ra_deg, dec_deg FROM sn JOIN pos ON pos.beam = sn.beam), c AS (SELECT avg(ra_deg) AS r, avg(dec_deg) AS d, max(sn) AS m FROM placed)
 SELECT beam, sn, round((ra_deg - r) * 60 * cos(radians(d)), 4) AS x_arcmin, round((dec_deg - d) * 60, 4) AS y_arcmin, round(sn / m, 4) AS level FROM placed, c""",
        "packed_to_sexagesimal": f"""WITH {_PACKED} SELECT o_orderkey, printf('%02d:%02d:%05.2f', rh, m, rs) AS ra_text, CASE WHEN dec >= 0 THEN '+' ELSE '-' END || printf('%02d:%02d:%05.2f', dd, m, ds) AS dec_text,
 round((rh + m / {_D(60)} + rs / 3600) * 15, 6) AS ra_deg, round((dd + m / {_D(60)} + ds / 3600) * sign(dec), 6) AS dec_deg, round(((dd * 60 + m) * 60 + ds) * sign(dec) * {_D(repr(ARCSEC_RAD))}, 6) AS dec_rad FROM parts""",
        "sexagesimal_to_degrees": f"""WITH q AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END AS s, c_custkey % 90 AS d, c_custkey % 60 AS m, c_custkey % 59 AS ss FROM customer)
 SELECT c_custkey, CASE WHEN s > 0 THEN '+' ELSE '-' END || printf('%02d:%02d:%02d', d, m, ss) AS text, round(s * (d + m / {_D(60)} + ss / {_D(3600)}), 6) AS deg FROM q""",
        "galactic_coordinates": f"WITH {_CATALOGUE}, v AS (SELECT ord, {galactic(GALACTIC[0])} AS x, {galactic(GALACTIC[1])} AS y, {galactic(GALACTIC[2])} AS z FROM catalogue) SELECT ord, round(CASE WHEN y < 0 THEN degrees(atan2(y, x)) + 360 ELSE degrees(atan2(y, x)) END, 5) AS l_deg, round(degrees(asin(greatest(-1, least(1, z)))), 5) AS b_deg FROM v",
        "mjd_to_iso": "SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'Unknown' ELSE strftime(TIMESTAMP '1970-01-01 00:00:00' + to_hours(CAST(24 * (o_orderkey % 20000) + 3 * (o_custkey % 8) AS INTEGER)), '%Y-%m-%d %H:%M:%S') || '.000' END AS iso FROM orders",
        "iso_to_mjd": f"SELECT o_orderkey, round(epoch_us(o_orderdate) / {_D(86400000000)} + 40587, 6) AS mjd FROM orders",
        "file_names": f"""SELECT o_orderkey, CAST(o_orderkey % 74 AS INTEGER) AS beam, CAST(regexp_extract('_B' || lpad(CAST(o_orderkey % 74 AS VARCHAR), 3, '0'), '_B([0-9]+)', 1) AS INTEGER) AS beam_short,
 'L' || o_orderkey || '_SAP' || lpad(CAST(o_orderkey % 3 AS VARCHAR), 3, '0') || '_B' || lpad(CAST(o_orderkey % 74 AS VARCHAR), 3, '0') || '_x' AS clean,
 CAST((o_orderkey % 9000) || '.' || (o_orderkey % 10) AS DOUBLE) AS dm, CASE WHEN o_orderkey % 1200 < 1000 THEN CAST(o_orderkey % 1200 AS INTEGER) ELSE CAST(substr(CAST(o_orderkey % 1200 AS VARCHAR), 1, 3) AS INTEGER) END AS trigger,
 {name} NOT LIKE '%BEAM12\\_%' ESCAPE '\\' AS searched, 'L' || o_orderkey AS obsid, CAST(o_orderkey % 3 AS INTEGER) AS sap, CAST(o_orderkey % 74 AS INTEGER) AS obs_beam FROM orders""",
        "unpack_2bit": f"""WITH b AS (SELECT o_orderkey, CAST(o_orderkey % 256 AS INTEGER) AS byte FROM orders), u AS (SELECT o_orderkey, CAST(k.k AS INTEGER) AS k, ((byte // CAST(power(4, 3 - k.k) AS INTEGER)) % 4) * 64 AS raw FROM b, range(0, 4) k(k))
 SELECT o_orderkey, k, raw, (raw * {_D(0.5)} + k) * CASE WHEN o_orderkey % 7 = 0 THEN {_D(0)} ELSE {_D(1)} END AS x, least(greatest(raw * 3 - 100, 0), 255) AS clipped FROM u""",
        "output_headers": f"""WITH raw AS (SELECT p_partkey, {_D(130)} + p_size AS obsfreq, {_D(0.1953125)} / (p_partkey % 16 + 1) + {_D(0.00001)} AS bw, p_size * 16 AS nchan, {_D(5.12e-6)} * (p_partkey % 100 + 1) AS tbin FROM part),
 snapped AS (SELECT *, {_D(0.1953125)} / round_even({_D(0.1953125)} / abs(bw), 0) AS b, round_even(tbin * 16 / {_D(5.12e-6)}, 0) * {_D(5.12e-6)} AS tsamp, nchan // 4 AS nchans FROM raw),
 h AS (SELECT *, -b * 4 AS foff, obsfreq - b * nchan / 2 + b * nchan AS fch1 FROM snapped)
 SELECT p_partkey, round(foff, 6) AS foff, round(fch1, 6) AS fch1, round(tsamp, 6) AS tsamp, nchans, round(least(fch1, fch1 + foff * (nchans - 1)), 6) AS freq_min, round(greatest(fch1, fch1 + foff * (nchans - 1)), 6) AS freq_max, round(p_partkey * tsamp, 6) AS duration_s, round(abs(foff) * nchans, 6) AS bandwidth_mhz FROM h""",
        "run_log_latest": "SELECT id, outcome, highest_snr FROM (SELECT l_orderkey AS id, l_linestatus AS outcome, l_quantity AS highest_snr, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS k FROM lineitem) q WHERE k = 1",
        "header_compare": """WITH a AS (SELECT p_partkey AS key, p_size AS value FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_partkey AS key, CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS value FROM part WHERE p_partkey % 5 <> 0)
 SELECT coalesce(a.key, b.key) AS key, a.value AS value_a, b.value AS value_b, CASE WHEN b.key IS NULL THEN 'only_a' WHEN a.key IS NULL THEN 'only_b' ELSE 'changed' END AS state FROM a FULL OUTER JOIN b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL OR a.value <> b.value""",
        "spectrum_compare": f"WITH {_SAMPLES}, fit AS (SELECT chan, regr_slope(x, CAST(t AS DOUBLE)) AS a, regr_intercept(x, CAST(t AS DOUBLE)) AS b FROM samples GROUP BY chan) SELECT round(max(abs(f.b + f.a * s.t)), 5) AS max_diff, round(avg(abs(f.b + f.a * s.t)), 5) AS mean_diff, count(*) AS n FROM samples s JOIN fit f ON f.chan = s.chan",
        "staging_progress": """SELECT event_type, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, count(*) AS n FROM events WHERE event_type IS DISTINCT FROM 'view' GROUP BY 1, 2""",
    }
