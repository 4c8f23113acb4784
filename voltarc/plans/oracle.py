"""SQL for every query of ``queries``, for DuckDB over the driver's tables; written apart from the operators."""

from __future__ import annotations

from ..config import ocv_curve
from .queries import SECOND_CUT, TODAY, _columns

_W = "OVER (PARTITION BY device_id ORDER BY ts)"


def _interp(v: str, chemistry: str = "NMC") -> str:
    """Inverse lookup of a chemistry's curve in SQL."""
    axis, volts = ocv_curve(chemistry)
    xs, ys = f"{list(volts)}::DOUBLE[]", f"{list(axis)}::DOUBLE[]"
    k = f"len(list_filter({xs}, lambda x: x <= {v}))"
    return f"(CASE WHEN {k} = 0 THEN {axis[0]} WHEN {k} >= {len(axis)} THEN {axis[-1]} ELSE ({ys})[{k}] + ({v} - ({xs})[{k}]) * (({ys})[{k} + 1] - ({ys})[{k}]) / (({xs})[{k} + 1] - ({xs})[{k}]) END)"


def _nearest(c: str, q: float) -> str:
    return f"list_extract(list({c} ORDER BY {c}) FILTER (WHERE {c} IS NOT NULL), CAST(round((count({c}) - 1) * {q}::DOUBLE) AS INTEGER) + 1)"


#: Each common table expression: name and text; those before it may be used.
CTES: dict[str, str] = {
    "t": f"SELECT {', '.join(_columns(False))}, epoch_us(ts) // 1000000 AS sec FROM events",
    "signed": "SELECT * EXCLUDE (current), CASE WHEN device_id IN (7, 9) THEN -current ELSE current END AS cur, device_id IN (7, 9) AS current_reversed FROM t",
    "offs": "SELECT *, avg(CASE WHEN abs(cur) <= 1 THEN cur END) OVER (PARTITION BY device_id) AS o FROM signed",
    "cl": f"SELECT * EXCLUDE (o), cur - coalesce(o, 0) AS i, coalesce(abs(o) > 2, false) AS drift, coalesce(sec - lag(sec) {_W} > 21600, true) AS time_gap, sec - lag(sec) {_W} AS dt FROM offs",
    "r1": "SELECT *, abs(i) < 0.8 AND coalesce(dt <= 21600, true) AS is_rest FROM cl",
    "r2": f"SELECT *, (is_rest AND NOT coalesce(lag(is_rest) {_W}, false))::INT AS st FROM r1",
    "r3": "SELECT *, sum(st) OVER (PARTITION BY device_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM r2",
    "r4": "SELECT *, CASE WHEN is_rest THEN sec - min(CASE WHEN is_rest THEN sec END) OVER (PARTITION BY device_id, run) ELSE 0 END AS rest_s FROM r3",
    "rr": f"SELECT *, is_rest AND rest_s >= 7200 AND NOT coalesce(lead(is_rest) {_W}, false) AS run_end, lag(i) {_W} AS ip FROM r4",
    "ab": "SELECT *, soc > 0.95 AND voltage > 88.2 * 0.99 AND i > 0 AND i < 5 AS a, coalesce(ip > 5, false) AND abs(i) < 0.8 AND soc >= 0.98 AND voltage < 88.2 * 0.99 AS b, soc < 0.1 AND voltage < 63.0 * 1.05 AND i < 0 AS c, run_end AS d FROM rr",
    "an": f"""SELECT *, CASE WHEN b THEN 'SWAP_FULL' WHEN c THEN 'EMPTY_END' WHEN a THEN 'FULL_END' WHEN d THEN 'OCV' ELSE 'NONE' END AS anchor_type,
        CASE WHEN d THEN least(greatest({_interp('voltage / 21.0')}, 0.02), 0.98) WHEN a THEN greatest(soc, 0.95) WHEN c THEN greatest(soc, 0.02) WHEN b THEN 1.0 END::DOUBLE AS soc_anchor,
        a::INT + b::INT + c::INT + d::INT > 1 AS conflict FROM ab""",
    "rb": "SELECT channel, device_id, floor(remaining_ah / soc / 0.5) * 0.5 AS bin, count(*) AS n FROM cl WHERE soc > 0.05 AND remaining_ah > 0 GROUP BY ALL",
    "nom": "SELECT channel, device_id, arg_max(bin, n * 1000000 - bin) + 0.25 AS c_nom_bms, sum(n)::BIGINT AS n_rows FROM rb GROUP BY ALL",
    "fall": "SELECT coalesce(nullif(median(c_nom_bms), 0), 40) AS f FROM an JOIN nom USING (channel, device_id) WHERE soc_anchor > 0",
    "c1": "SELECT an.*, coalesce(c_nom_bms, f) AS c_nom_bms, remaining_ah / soc_anchor AS capacity_raw FROM an LEFT JOIN nom USING (channel, device_id) CROSS JOIN fall WHERE anchor_type <> 'NONE'",
    "c2": "SELECT *, capacity_raw * (1 + 0.0025::DOUBLE * (25 - temperature)) AS cc FROM c1",
    "ca": """SELECT *, cc AS capacity_corrected, cc < c_nom_bms * 0.65 OR cc > c_nom_bms * 1.10 AS out_of_range, temperature < 5 OR temperature > 45 AS temp_out,
        (anchor_type = 'EMPTY_END' AND voltage / 21.0 > 3.0 * 1.25) OR (anchor_type = 'FULL_END' AND voltage / 21.0 < 4.2 * 0.9) AS v_inconsistent FROM c2""",
    "nb": """SELECT *, lag(cc) OVER k AS p, lead(cc) OVER k AS n, (ts::DATE - lag(ts::DATE) OVER w) AS d1, (lead(ts::DATE) OVER w - ts::DATE) AS d2 FROM ca
        WINDOW k AS (PARTITION BY device_id, anchor_type ORDER BY ts), w AS (PARTITION BY device_id ORDER BY ts)""",
    "fl": """SELECT *, cc < c_nom_bms * 0.5 OR cc > c_nom_bms * 1.2 AS f_out_of_range,
        coalesce(abs(cc - p) > abs(p) * 0.3, false) OR coalesce(abs(cc - n) > abs(n) * 0.3, false) AS f_contradiction FROM nb""",
    "se": "SELECT *, f_out_of_range OR v_inconsistent OR conflict OR f_contradiction AS severe FROM fl",
    "qs": """SELECT *, (CASE anchor_type WHEN 'SWAP_FULL' THEN 20 WHEN 'EMPTY_END' THEN 20 WHEN 'FULL_END' THEN 15 ELSE 10 END
        + CASE WHEN temperature BETWEEN 15 AND 35 THEN 5 WHEN temp_out THEN -10 ELSE 0 END
        + CASE WHEN cc >= c_nom_bms * 0.75 AND cc <= c_nom_bms THEN 10 WHEN f_out_of_range THEN -20 ELSE 0 END
        + CASE WHEN v_inconsistent THEN -15 ELSE 10 END + CASE WHEN f_contradiction THEN -15 ELSE 0 END + CASE WHEN drift THEN -10 ELSE 0 END)::DOUBLE AS quality_score FROM se""",
    "ti": "SELECT *, CASE WHEN quality_score >= 30 AND NOT severe AND (coalesce(d1, 9999) <= 7 OR coalesce(d2, 9999) <= 7) THEN 1 WHEN quality_score >= 10 THEN 2 ELSE 3 END AS cap_tier FROM qs",
    "sc": """SELECT *, CASE anchor_type WHEN 'SWAP_FULL' THEN 1.0 WHEN 'EMPTY_END' THEN 1.0 WHEN 'FULL_END' THEN 0.8 ELSE 0.5 END::DOUBLE
        * CASE cap_tier WHEN 1 THEN 1.0 WHEN 2 THEN 0.3 ELSE 0 END::DOUBLE AS stat_weight, strftime(ts, '%Y-%m') AS ym FROM ti""",
    "m1": "SELECT *, median(cc) OVER g AS md, count(*) OVER g AS nn FROM sc WHERE cap_tier <= 2 WINDOW g AS (PARTITION BY channel, device_id, ym)",
    "m2": "SELECT *, median(abs(cc - md)) OVER (PARTITION BY channel, device_id, ym) * 1.4826 AS sca FROM m1",
    "m3": "SELECT *, count(*) OVER (PARTITION BY channel, device_id, ym) AS nk FROM m2 WHERE nn < 3 OR sca <= 1e-12 OR abs(cc - md) <= 3 * sca",
    "m4": "SELECT *, sum(stat_weight) OVER (PARTITION BY channel, device_id, ym ORDER BY cc, stat_weight, ts ROWS UNBOUNDED PRECEDING) AS cw, sum(stat_weight) OVER (PARTITION BY channel, device_id, ym) AS tw FROM m3 WHERE nk >= 3",
    "mo": """SELECT 'n' || c_nationkey AS channel, o_custkey AS device_id, strftime(o_orderdate, '%Y-%m') AS ym, sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / 900000.0 AS cap, count(*) AS capacity_count
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "mm": """SELECT *, substr(ym, 1, 4)::INT * 12 + substr(ym, 6, 2)::INT AS mi, 'm' || (device_id % 4) AS model,
        ((substr(ym, 1, 4)::INT * 12 + substr(ym, 6, 2)::INT - 23940) * 10 + device_id % 10)::DOUBLE AS loop_median FROM mo""",
    "l1": "SELECT *, max((cap / 37.0 >= 0.9)::INT) OVER (PARTITION BY device_id ORDER BY ym ROWS UNBOUNDED PRECEDING) = 1 AS o FROM mm",
    "l2": "SELECT *, median(CASE WHEN o THEN cap / 37.0 END) OVER (PARTITION BY device_id) AS rest FROM l1",
    "lt": "SELECT * EXCLUDE (o, rest), row_number() OVER (PARTITION BY device_id ORDER BY ym) AS rn FROM l2 WHERE o OR NOT coalesce(rest >= 0.9, false)",
    "w1": "SELECT x.device_id, x.ym, any_value(x.cap) AS cap, any_value(x.capacity_count) AS cnt, count(*) AS n, median(y.cap) AS md, list(y.cap) AS near FROM lt x JOIN lt y ON x.device_id = y.device_id AND abs(x.rn - y.rn) <= 3 GROUP BY ALL",
    "w2": "SELECT *, 1.4826 * list_median(list_transform(near, lambda v: abs(v - md))) AS sca FROM w1",
    "w3": "SELECT *, cnt >= 2 AND n >= 3 AND CASE WHEN sca <= 1e-12 THEN abs(cap - md) > 1e-9 ELSE abs(cap - md) > 3 * sca END AS is_spike FROM w2",
    "w4": "SELECT lt.*, is_spike FROM lt JOIN w3 USING (device_id, ym)",
    "w5": "SELECT x.device_id, x.ym, median(y.cap) FILTER (WHERE NOT y.is_spike) AS rep FROM w4 x JOIN w4 y ON x.device_id = y.device_id AND abs(x.rn - y.rn) <= 3 GROUP BY ALL",
    "cv": "SELECT w4.*, CASE WHEN is_spike THEN coalesce(rep, cap) ELSE cap END AS v, greatest(capacity_count, 1)::DOUBLE AS w FROM w4 JOIN w5 USING (device_id, ym)",
    "p1": "SELECT s.device_id, s.rn AS s, e.rn AS e, sum(x.v * x.w) / sum(x.w) AS av FROM cv s JOIN cv e ON s.device_id = e.device_id AND s.rn <= e.rn JOIN cv x ON x.device_id = s.device_id AND x.rn BETWEEN s.rn AND e.rn GROUP BY ALL",
    "p2": "SELECT i.device_id, i.rn, p.s, max(p.av) AS best FROM cv i JOIN p1 p ON i.device_id = p.device_id AND p.s <= i.rn AND p.e >= i.rn GROUP BY ALL",
    "p3": "SELECT device_id, rn, min(best) AS smooth FROM p2 GROUP BY ALL",
    "so": "SELECT cv.*, smooth, smooth / 37.0 AS soh, cap / 37.0 AS soh_raw FROM cv JOIN p3 USING (device_id, rn)",
    "ex": "SELECT channel, device_id FROM so GROUP BY ALL HAVING count(*) >= 2 AND max(soh) < 0.9",
    "kept": "SELECT * FROM so WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.channel IS NOT DISTINCT FROM so.channel AND ex.device_id IS NOT DISTINCT FROM so.device_id)",
    "dc": """SELECT channel, device_id, CASE WHEN count(*) >= 3 THEN round(regr_slope(soh, mi) * 100, 4) END AS dm,
        CASE WHEN count(*) >= 3 AND regr_syy(soh, mi) > 0 THEN round(coalesce(regr_r2(soh, mi), 0), 4) END AS r2 FROM kept GROUP BY ALL""",
    "az": "SELECT kept.*, dm, r2, dm * 12 AS dy, loop_median + 5 - device_id % 10 + device_id % 10 AS loop_max FROM kept JOIN dc USING (channel, device_id)",
    "f1": """SELECT channel, device_id, arg_max(soh, ym) AS soh_latest, max(ym) AS ye, max(mi) AS me, any_value(model) AS model, arg_max(loop_max, ym) AS loops, count(*) AS n, regr_slope(soh, mi) AS m,
        avg(mi) AS x, avg(soh) AS y, regr_syy(soh, mi) - coalesce(regr_slope(soh, mi), 0) * regr_sxy(soh, mi) AS ss, CASE WHEN regr_syy(soh, mi) > 0 THEN coalesce(regr_r2(soh, mi), 0) ELSE 0 END AS r2 FROM az GROUP BY ALL""",
    "fc": """SELECT *, CASE WHEN soh_latest >= 0.85 THEN '健康' WHEN soh_latest >= 0.75 THEN '关注' WHEN soh_latest >= 0.65 THEN '预警' ELSE '退役' END AS health_level,
        CASE WHEN n >= 3 AND m < -1e-12 THEN CAST(round_even(x + (0.8 - y) / m, 0) AS BIGINT) END AS pm, CASE WHEN n >= 3 THEN round(r2, 4) END AS rr FROM f1""",
    "ci": """SELECT *, CASE WHEN pm IS NOT NULL THEN CAST(round_even(x + (0.8 + sp - y) / m, 0) AS BIGINT) END AS cl, CASE WHEN pm IS NOT NULL THEN CAST(round_even(x + (0.8 - sp - y) / m, 0) AS BIGINT) END AS ch
        FROM (SELECT *, 1.96::DOUBLE * sqrt(greatest(ss, 0) / greatest(n - 2, 1)) AS sp FROM fc)""",
    "rt": "SELECT model, median(dy) AS rate FROM az GROUP BY ALL",
    "al": "SELECT median(dy) AS rate FROM az",
    "rm": """SELECT model, channel, device_id, CASE WHEN rr >= 0.6 AND pm IS NOT NULL THEN pm WHEN soh_latest <= 0.8 THEN me
        ELSE me + CAST(round_even((soh_latest - 0.8) / greatest(abs(coalesce(nullif(rt.rate, 0), al.rate)) / 1200, 1e-6), 0) AS BIGINT) END AS retire_mi FROM fc JOIN rt USING (model) CROSS JOIN al""",
    "inw": f"SELECT * FROM rm WHERE retire_mi BETWEEN {TODAY} AND {TODAY} + 71",
    "sp": f"SELECT model, unnest(generate_series({TODAY}, max(retire_mi)))::INT AS mi FROM inw GROUP BY model",
    "s2": "SELECT sp.model, sp.mi, count(inw.retire_mi) AS new_retire FROM sp LEFT JOIN inw ON inw.model = sp.model AND inw.retire_mi = sp.mi GROUP BY ALL",
    "sd": "SELECT *, ((mi - 1) // 12) || '-' || lpad(((mi - 1) % 12 + 1)::VARCHAR, 2, '0') AS ym, sum(new_retire) OVER (PARTITION BY model ORDER BY mi ROWS UNBOUNDED PRECEDING)::BIGINT AS cum_retire FROM s2",
    "ag": "SELECT *, min(mi) OVER (PARTITION BY device_id) AS birth, mi - min(mi) OVER (PARTITION BY device_id) AS age_month, CAST(floor(loop_median / 25) AS BIGINT) AS loop_bin FROM az",
    "tm": "SELECT model, mi, median(loop_median) AS l FROM az GROUP BY model, mi",
    "ta": f"SELECT model, age_month AS x, median(soh) AS y, median(loop_median) AS l, {_nearest('loop_median', 0.25)} AS loop_p25, {_nearest('loop_median', 0.75)} AS loop_p75, {_nearest('birth', 0.25)} AS birth_p25, {_nearest('birth', 0.75)} AS birth_p75 FROM ag GROUP BY model, age_month",
    "tl": f"SELECT model, loop_bin * 25 AS x, {_nearest('age_month', 0.25)} AS age_p25, {_nearest('age_month', 0.75)} AS age_p75, {_nearest('birth', 0.25)} AS birth_p25, {_nearest('birth', 0.75)} AS birth_p75 FROM ag GROUP BY model, loop_bin",
    "st": "SELECT model, health_level, device_id, loops, soh_latest AS soh FROM fc",
}


def _month(mi: str) -> str:
    return f"(({mi} - 1) // 12) || '-' || lpad((({mi} - 1) % 12 + 1)::VARCHAR, 2, '0')"


def _ticks(t: str, first: int, step: int, shown: str) -> str:
    """Nearest points of the table ``t`` (model, x, ...) to ticks."""
    return f"""WITH k AS (SELECT unnest(generate_series({first}, (SELECT greatest({first}, max(x)) FROM {t}), {step})) AS tick), o AS (SELECT model, min(x) AS a, max(x) AS b FROM {t} GROUP BY model),
        n AS (SELECT model, tick, {shown}, row_number() OVER (PARTITION BY model, tick ORDER BY abs(x - tick), x) AS r FROM k JOIN o ON tick >= (SELECT min(x) FROM {t}) - 0.5 AND tick BETWEEN a - 0.5 AND b + 0.5 JOIN {t} USING (model))
        SELECT model, tick, {shown} FROM n WHERE r = 1"""


def _uses(text: str, known: list[str]) -> list[str]:
    import re

    found = [n for n in known if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)]
    out: list[str] = []
    for n in found:
        for x in [*_uses(CTES[n], known[: known.index(n)]), n]:
            if x not in out:
                out.append(x)
    return sorted(out, key=known.index)


def _sql(text: str) -> str:
    names = _uses(text, list(CTES))
    return ("WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in names) + " " if names else "") + text


_QUARTILES = f"round(median(soh), 9) AS soh_median, round({_nearest('soh', 0.10)}, 9) AS soh_p10, round({_nearest('soh', 0.90)}, 9) AS soh_p90"
_SOH = f"{_QUARTILES}, count(DISTINCT device_id) AS device_count, round(median(soh) * median(37.0::DOUBLE), 9) AS capacity_ah"


_AXES = (("mi", "a1", "b1", "s1"), ("capacity_median", "a2", "b2", "s2"), ("loop_max", "a3", "b3", "s3"))


def _step(lo: str, hi: str) -> str:
    """The smallest of 1, 2, 5 times a power of ten that isn't under a sixth of the span."""
    raw = f"(CASE WHEN {hi} > {lo} THEN {hi} - {lo} ELSE greatest(abs({hi}), 1) END / 6)"
    return f"list_min(list_filter(flatten(list_transform(range(-9, 12), lambda e: [10.0::DOUBLE ** e, 2 * 10.0::DOUBLE ** e, 5 * 10.0::DOUBLE ** e])), lambda x: x >= {raw} * (1 - 1e-12)))"


_RAW_MONTHS = """WITH b AS (SELECT user_id AS device_id, strftime(ts, '%Y-%m') AS ym, value AS v, event_id, CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.75 WHEN 'error' THEN 0.75 ELSE 0.5 END::DOUBLE AS w FROM events),
        c AS (SELECT *, median(v) OVER g AS md, count(*) OVER g AS n FROM b WINDOW g AS (PARTITION BY device_id, ym)),
        d AS (SELECT *, 1.4826 * median(abs(v - md)) OVER (PARTITION BY device_id, ym) AS s FROM c),
        e AS (SELECT * FROM d WHERE n < 3 OR s <= 1e-12 OR abs(v - md) <= 3 * s),
        f AS (SELECT *, count(*) OVER (PARTITION BY device_id, ym) AS k, sum(w) OVER (PARTITION BY device_id, ym ORDER BY v, w, event_id ROWS UNBOUNDED PRECEDING) AS cw, sum(w) OVER (PARTITION BY device_id, ym) AS tw FROM e)
        SELECT device_id, ym, round(min(CASE WHEN cw >= tw * 0.5 THEN v END), 9) AS capacity_median, count(*) AS capacity_count, round(avg(v), 9) AS value_mean FROM f WHERE k >= 3 GROUP BY ALL"""

_RAW: dict[str, str] = {
    "monthly_weighted_median": _RAW_MONTHS,
    "weighted_median_by_brand": """WITH a AS (SELECT p_brand, l_extendedprice AS v, sum(l_quantity) OVER (PARTITION BY p_brand ORDER BY l_extendedprice, l_quantity, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS cw, sum(l_quantity) OVER (PARTITION BY p_brand) AS tw
        FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT p_brand, round(min(CASE WHEN cw >= tw * 0.5 THEN v END), 9) AS price FROM a GROUP BY ALL""",
    "gap_flags": "SELECT event_id, time_gap FROM cl",
    "cleaned": "SELECT event_id, loop_count, voltage, temperature, round(i, 9) + 0 AS current, false AS invalid_loopnum, false AS invalid_sensor, current_reversed, drift AS current_sensor_drift, time_gap FROM cl",
    "rest_runs": "SELECT event_id, is_rest, rest_s, run_end FROM rr",
    "anchor_classify": "SELECT event_id, anchor_type, round(soc_anchor, 9) AS soc_anchor, CASE WHEN conflict AND drift THEN 'anchor_conflict,sensor_drift' WHEN conflict THEN 'anchor_conflict' WHEN drift THEN 'sensor_drift' ELSE '' END AS flags FROM an",
    "capacity_points": "SELECT event_id, round(c_nom_bms, 9) AS c_nom_bms, round(capacity_raw, 9) AS capacity_raw, round(capacity_corrected, 9) AS capacity_corrected, out_of_range, temp_out, v_inconsistent FROM ca",
    "score_tier_weight": "SELECT event_id, f_out_of_range, v_inconsistent AS f_voltage_inconsistent, temp_out AS f_temp_out, conflict AS f_anchor_conflict, drift AS f_sensor_drift, f_contradiction, severe, quality_score, cap_tier, round(stat_weight, 9) AS stat_weight FROM sc",
    "plot_points": "SELECT channel, device_id, anchor_type, cap_tier, round(cc / c_nom_bms, 9) AS soh_point FROM sc WHERE cap_tier <= 2",
    "monthly_capacity": """SELECT channel, device_id, ym, round(CASE WHEN max(tw) > 0 THEN min(CASE WHEN cw >= tw * 0.5 THEN cc END) ELSE median(cc) END, 9) AS capacity_median, count(*) AS capacity_count,
        count(*) FILTER (WHERE cap_tier = 1) AS tier1_count, count(*) FILTER (WHERE cap_tier = 2) AS tier2_count, round(avg(temperature), 9) AS temp_mean, round(avg(quality_score), 9) AS score_mean,
        round(median(remaining_ah / c_nom_bms), 9) AS soh_bms, median(loop_count) AS loop_median, max(loop_count) AS loop_max, 'unknown' AS model, substr(ym, 1, 4)::BIGINT AS year, substr(ym, 6, 2)::BIGINT AS month FROM m4 GROUP BY channel, device_id, ym""",
    "mode_bin": "WITH b AS (SELECT user_id, floor(value / 0.5) * 0.5 AS bin, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, arg_max(bin, n * 1000000 - bin) + 0.25 AS mode, sum(n)::BIGINT AS n_rows FROM b GROUP BY ALL",
    "r_statistics": "R1 SELECT device_id, round(stddev_pop(r) / avg(r), 9) AS cv, round(CASE WHEN count(*) >= 12 THEN coalesce(regr_slope(r, x), 0) ELSE 0 END, 9) AS slope, round(median(r), 9) AS r_med FROM xr GROUP BY device_id HAVING count(*) >= 30",
    "gap_quantiles": f"G1 SELECT count(*) AS n, round(count(*) FILTER (WHERE g < 30)::DOUBLE / count(*), 9) AS frac_lt_30, {_nearest('g', 0.05)} AS p05, {_nearest('g', 0.5)} AS p50, {_nearest('g', 0.95)} AS p95 FROM gg",
    "sign_and_zero": "S1 SELECT device_id, count(*) AS n, round(median(i3), 9) + 0 AS median_i3, round(avg((i3 < 0)::INT), 9) AS frac_negative, avg((i3 < 0)::INT) > 0.8 AS reversed FROM sg WHERE d > 0.03 AND i3 IS NOT NULL GROUP BY device_id HAVING count(*) >= 5",
    "profile_figures": f"""R1 SELECT (SELECT round(avg((d < 0)::INT), 9) FROM (SELECT loop_count - lag(loop_count) {_W} AS d FROM t) WHERE d IS NOT NULL) AS frac_negative,
        (SELECT round(avg((abs(current) < 1)::INT), 9) FROM t) AS frac_near_zero,
        (SELECT round(avg(n), 9) FROM (SELECT count(*) AS n FROM t WHERE (soc > 0.95 AND voltage > 88.2 * 0.99) OR (soc < 0.1 AND voltage < 63.0 * 1.05) OR abs(current) < 0.8 GROUP BY device_id, strftime(ts, '%Y-%m'))) AS density,
        (SELECT round(median(cv), 5) FROM rs) AS cv_median, (SELECT round(median(slope), 5) FROM rs) AS slope_median, (SELECT round(avg((cv > 0.02)::INT), 4) FROM rs) AS frac_dynamic, (SELECT count(*) FROM rs) AS devices""",
    "nominal_capacity": "WITH t0 AS (SELECT * FROM t), b AS (SELECT channel, device_id, floor(remaining_ah / soc / 0.5) * 0.5 AS bin, count(*) AS n FROM t0 WHERE soc > 0.05 AND remaining_ah > 0 GROUP BY ALL) SELECT channel, device_id, round(arg_max(bin, n * 1000000 - bin) + 0.25, 9) AS c_nom_bms, sum(n)::BIGINT AS n_rows FROM b GROUP BY ALL",
    "platform_slopes": "SELECT device_id, round(regr_slope(voltage, soc) / 21.0, 9) AS slope FROM t WHERE soc BETWEEN 0.2 AND 0.8 AND abs(current) < 1 GROUP BY device_id HAVING count(*) >= 10 AND regr_slope(voltage, soc) IS NOT NULL",
    "series_inference": """WITH v AS (SELECT c_mktsegment AS model, max(voltage) AS vmax, min(voltage) AS vmin FROM (SELECT * FROM t) JOIN customer ON device_id = c_custkey GROUP BY ALL),
        o AS (SELECT * FROM (VALUES ('LFP', 0, 3.65::DOUBLE, 2.6::DOUBLE), ('NMC', 1, 4.2::DOUBLE, 3.0::DOUBLE)) a(chemistry, ord, vf, vc) CROSS JOIN (SELECT unnest([16, 17, 20, 21, 24, 25]) AS series)),
        e AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY abs(vmax / series - vf) + abs(vmin / series - vc), ord, series) AS k FROM v CROSS JOIN o)
        SELECT model, vmax, vmin, chemistry, series FROM e WHERE k = 1""",
    "rolling_mad": """WITH mx AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ym) AS rn FROM (SELECT * FROM mm)),
        a AS (SELECT x.device_id, x.ym, x.rn, any_value(x.cap) AS cap, count(*) AS n, median(y.cap) AS md, list(y.cap) AS near FROM mx x JOIN mx y ON x.device_id = y.device_id AND abs(x.rn - y.rn) <= 3 GROUP BY ALL),
        b AS (SELECT *, 1.4826 * list_median(list_transform(near, lambda v: abs(v - md))) AS s FROM a),
        c AS (SELECT *, n >= 3 AND CASE WHEN s <= 1e-12 THEN abs(cap - md) > 1e-9 ELSE abs(cap - md) > 3 * s END AS is_spike FROM b),
        d AS (SELECT x.device_id, x.ym, any_value(x.cap) AS cap, any_value(x.is_spike) AS is_spike, median(y.cap) FILTER (WHERE NOT y.is_spike) AS rep FROM c x JOIN c y ON x.device_id = y.device_id AND abs(x.rn - y.rn) <= 3 GROUP BY ALL)
        SELECT device_id, ym, is_spike, round(CASE WHEN is_spike THEN coalesce(rep, cap) ELSE cap END, 9) AS cleaned FROM d""",
    "pava_monthly": """WITH mx AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ym) AS rn FROM (SELECT * FROM mm)),
        a AS (SELECT s.device_id, s.rn AS s, e.rn AS e, sum(x.cap * x.capacity_count) / sum(x.capacity_count) AS av FROM mx s JOIN mx e ON s.device_id = e.device_id AND s.rn <= e.rn JOIN mx x ON x.device_id = s.device_id AND x.rn BETWEEN s.rn AND e.rn GROUP BY ALL),
        b AS (SELECT i.device_id, i.ym, a.s, max(a.av) AS best FROM mx i JOIN a ON i.device_id = a.device_id AND a.s <= i.rn AND a.e >= i.rn GROUP BY ALL)
        SELECT device_id, ym, round(min(best), 9) AS fitted FROM b GROUP BY ALL""",
    "leading_trim": "SELECT device_id, ym, round(cap, 9) AS capacity_median FROM lt",
    "soh_series": "SELECT channel, device_id, ym, round(smooth, 9) AS capacity_smoothed, round(soh, 9) AS soh, round(soh_raw, 9) AS soh_raw, is_spike, 37.0::DOUBLE AS c_nom_soh FROM so",
    "excluded_devices": """SELECT channel, device_id, arg_min(model, ym) AS model, count(*) AS reliable_months, round(arg_min(soh, ym), 9) AS soh_first_reliable, round(list_extract(list(soh ORDER BY ym), 2), 9) AS soh_second_reliable,
        round((max(cap) - min(cap)) / arg_min(cap, ym), 9) AS spread_ratio, arg_min(loop_median, ym) AS loop_first, min(ym) AS ym_first, max(ym) AS ym_last, 'bms_swap' AS reasons FROM so GROUP BY channel, device_id HAVING count(*) >= 2 AND max(soh) < 0.9""",
    "ols_decay": "SELECT channel, device_id, dm AS decay_rate_pct_month, r2 AS r_squared, round(dm * 12, 9) AS decay_rate_pct_year FROM dc",
    "soh_drop_alerts": "D1 SELECT channel, device_id, 'SOH月跌幅异常' AS alert_type, ym || ' 跌幅 ' || round(d * 100, 2)::VARCHAR || '%/月' AS alert_detail, NULL::VARCHAR AS detected_at FROM dd WHERE d < -0.05",
    "anchor_rate_alerts": "SELECT channel, device_id, '数据质量差' AS alert_type, '有效锚点率 ' || round(count(*) FILTER (WHERE cap_tier = 1)::DOUBLE / count(*) * 100, 1)::VARCHAR || '% < 20%' AS alert_detail, NULL::VARCHAR AS detected_at FROM sc GROUP BY channel, device_id HAVING count(*) FILTER (WHERE cap_tier = 1)::DOUBLE / count(*) < 0.2",
    "channel_dashboard": """C1 SELECT tot.channel, anchor_total, nullif(t1, 0) AS tier1_count, round(t1::DOUBLE / anchor_total, 9) AS anchor_rate, round(md, 9) AS median_decay_pct_year, device_count, round(worst, 9) AS worst_mom_drop
        FROM tot LEFT JOIN dv USING (channel) LEFT JOIN wd USING (channel)""",
    "group_consistency": """G2 SELECT channel, device_id, round(CASE WHEN count(*) >= 4 AND stddev_pop(soh) >= 1e-9 AND stddev_pop(mean) >= 1e-9 THEN corr(soh, mean) END, 4) AS corr_with_group,
        coalesce(CASE WHEN count(*) >= 4 AND stddev_pop(soh) >= 1e-9 AND stddev_pop(mean) >= 1e-9 THEN corr(soh, mean) END < 0.3, false) AS lagging FROM gm WHERE channel IN (SELECT channel FROM gm GROUP BY channel HAVING count(DISTINCT ym) >= 4) GROUP BY channel, device_id""",
    "full_vs_empty": """F1 SELECT device_id, round(fm, 9) AS full_median, round(em, 9) AS empty_median, round(fm / em - 1, 9) AS ratio, CASE WHEN abs(fm / em - 1) < 0.05 THEN 'ok' WHEN fm / em > 1 THEN 'full_high' ELSE 'empty_high' END AS verdict
        FROM fe WHERE (SELECT count(*) FROM fe) >= 3""",
    "r_drift": "R2 SELECT device_id, round(regr_slope(capacity_raw, x), 9) AS slope FROM rx GROUP BY device_id HAVING count(*) >= 4 AND regr_slope(capacity_raw, x) IS NOT NULL",
    "retire_forecast": f"""SELECT channel, device_id, round(soh_latest, 9) AS soh_latest, health_level, CASE WHEN pm IS NOT NULL THEN {_month('pm')} END AS predicted_retire_month, rr AS r_squared,
        CASE WHEN pm IS NOT NULL THEN {_month('cl')} END AS retire_ci_low, CASE WHEN pm IS NOT NULL THEN {_month('ch')} END AS retire_ci_high,
        CASE WHEN n < 3 THEN '数据不足' WHEN NOT coalesce(m < -1e-12, false) THEN CASE WHEN r2 >= 0.6 THEN '无衰退趋势' ELSE '无衰退趋势（R²低）' END WHEN r2 < 0.6 THEN 'R²=' || round(r2, 3)::VARCHAR || '<0.6，仅供参考' ELSE '' END AS note FROM ci""",
    "cohort_months": f"SELECT model, ym, {_SOH}, median(loop_median) AS loop_median, max(loop_max) AS loop_max FROM az GROUP BY model, ym",
    "cohort_decay": f"""E1 SELECT model, round(median(dy), 9) + 0 AS decay_pct_year_median, round({_nearest('dy', 0.25)}, 9) + 0 AS decay_pct_year_p25, round({_nearest('dy', 0.75)}, 9) + 0 AS decay_pct_year_p75,
        any_value(dc_) AS device_count, round(any_value(s), 9) AS soh_start, round(any_value(l), 9) AS soh_latest FROM az JOIN en USING (model) GROUP BY model""",
    "cohort_age": f"""SELECT model, age_month, {_SOH}, {_nearest('birth', 0.25)} AS birth_p25, {_nearest('birth', 0.75)} AS birth_p75, median(loop_median) AS loop_median, {_nearest('loop_median', 0.25)} AS loop_p25, {_nearest('loop_median', 0.75)} AS loop_p75 FROM ag GROUP BY model, age_month""",
    "cohort_loops": f"""SELECT model, loop_bin, {_SOH}, {_nearest('age_month', 0.25)} AS age_p25, {_nearest('age_month', 0.75)} AS age_p75, {_nearest('birth', 0.25)} AS birth_p25, {_nearest('birth', 0.75)} AS birth_p75, loop_bin * 25 AS loop_from, (loop_bin + 1) * 25 AS loop_to FROM ag GROUP BY model, loop_bin""",
    "cohort_stages": f"SELECT model, health_level, count(DISTINCT device_id) AS device_count, median(loops) AS loops_median, {_nearest('loops', 0.10)} AS loops_p10, {_nearest('loops', 0.90)} AS loops_p90, round(median(soh), 9) AS soh_median, CASE health_level WHEN '健康' THEN 0 WHEN '关注' THEN 1 WHEN '预警' THEN 2 WHEN '退役' THEN 3 ELSE 4 END AS stage_order FROM st GROUP BY model, health_level",
    "fleet_figures": f"L1 SELECT model, count(*) AS devices, min(e) AS first_month, min(s) AS data_from, {_QUARTILES}, count(*) FILTER (WHERE soh < 0.8) AS below_line, median(l) AS loop_median FROM la GROUP BY model",
    "retire_schedule": "SELECT model, mi, new_retire, ym, cum_retire FROM sd",
    "schedule_quarters": """Q1 SELECT model, quarter, new_retire, sum(new_retire) OVER (PARTITION BY model ORDER BY quarter ROWS UNBOUNDED PRECEDING)::BIGINT AS cum_retire FROM qq""",
    "schedule_milestones": "H1 SELECT model, arg_max(ym, new_retire * 1000000 - mi) AS peak_ym, max(new_retire) AS peak_new, arg_min(ym, abs(cum_retire - 0.5 * tot) * 1000000 + mi) AS half_ym FROM hh GROUP BY model",
    "retire_outside": f"SELECT model, count(*) FILTER (WHERE retire_mi > {TODAY} + 71) AS beyond, count(*) FILTER (WHERE retire_mi < {TODAY}) AS earlier FROM rm GROUP BY model",
    "loop_caps": "B1 SELECT model, greatest(100, (floor(coalesce(max(CASE WHEN share <= 0.98 THEN (loop_bin + 1) * 25 END), 0) / 50)::BIGINT + 1) * 50) AS loop_cap FROM bb GROUP BY model",
    "crossing_80": """X1 SELECT device_id, round(arg_min(CASE WHEN py = y THEN px ELSE px + (0.8 - py) * (x - px) / (y - py) END, x), 9) AS x_cross FROM cx WHERE (py - 0.8) * (y - 0.8) <= 0 GROUP BY device_id""",
    "worst_mom_drop": "WITH a AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS ym, avg((o_orderstatus = 'F')::INT) AS r FROM orders GROUP BY ALL), b AS (SELECT *, r - lag(r) OVER (PARTITION BY o_orderpriority ORDER BY ym) AS d FROM a) SELECT o_orderpriority, round(min(d), 9) AS worst_mom_drop FROM b WHERE d < 0 GROUP BY ALL",
    "null_safe_exclusion": """WITH a AS (SELECT CASE WHEN device_id % 3 > 0 THEN channel END AS channel, device_id, capacity_count FROM (SELECT * FROM mm)), g AS (SELECT DISTINCT channel, device_id FROM a WHERE device_id % 7 = 0)
        SELECT channel, count(*) AS n, sum(capacity_count)::BIGINT AS orders FROM a WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.channel IS NOT DISTINCT FROM a.channel AND g.device_id = a.device_id) GROUP BY channel""",
    "row_checks": "SELECT count(*) AS n_rows, avg((l_quantity IS NULL)::INT)::DOUBLE AS null_l_quantity, avg((l_discount IS NULL)::INT)::DOUBLE AS null_l_discount, count(*) FILTER (WHERE NOT l_discount BETWEEN 0.01::DOUBLE AND 0.09::DOUBLE) AS discount_out, count(*) FILTER (WHERE l_extendedprice <= 1000) AS price_low, count(*) FILTER (WHERE NOT l_quantity BETWEEN 2 AND 49) AS quantity_out FROM lineitem",
    "ocv_interp": f"SELECT event_id, round({_interp('(3.0::DOUBLE + value / 250.0::DOUBLE)')}, 9) AS soc FROM events",
    "sample_mod": "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 25 = 0",
    "bucket_counts": "SELECT (c_custkey % 32)::INT AS bucket, count(*) AS n FROM customer GROUP BY ALL",
    "cleaned_nulls": f"""WITH e AS (SELECT * EXCLUDE (voltage, temperature, current, loop_count), CASE WHEN event_id % 11 > 0 THEN voltage END AS voltage, CASE WHEN event_id % 17 > 0 THEN temperature END AS temperature,
            CASE WHEN event_id % 7 > 0 THEN CASE WHEN device_id IN (3, 5, 7, 9) THEN -current ELSE current END END AS cur, CASE WHEN event_id % 19 > 0 THEN loop_count END AS loops FROM (SELECT * FROM t) WHERE event_id % 13 > 0),
        o AS (SELECT *, avg(CASE WHEN abs(cur) <= 1 THEN cur END) OVER (PARTITION BY device_id) AS o FROM e)
        SELECT event_id, coalesce(loops, 0) AS loop_count, voltage, temperature, round(cur - coalesce(o, 0), 9) + 0 AS current, loops IS NULL AS invalid_loopnum, voltage IS NULL OR temperature IS NULL OR cur IS NULL AS invalid_sensor,
        device_id IN (3, 5, 7, 9) AS current_reversed, coalesce(abs(o) > 2, false) AS current_sensor_drift, coalesce(sec - lag(sec) {_W} > 21600, true) AS time_gap FROM o""",
    "model_check": f"""WITH d AS (SELECT c_mktsegment AS model, device_id, max(voltage) AS vmax, min(voltage) AS vmin, CASE WHEN count(*) >= 3 THEN regr_slope(voltage, soc) END AS slope FROM (SELECT * FROM t) JOIN customer ON device_id = c_custkey WHERE soc BETWEEN 0.2 AND 0.8 AND abs(current) < 1 GROUP BY ALL),
        m AS (SELECT model, median(vmax) AS vmax, {_nearest('vmin', 0.05)} AS vmin, coalesce(median(slope), 0) / CASE model WHEN 'BUILDING' THEN 24 ELSE 1 END AS pc FROM d GROUP BY model),
        c AS (SELECT *, CASE WHEN pc < 0.35 THEN 'LFP' ELSE 'NMC' END AS chemistry FROM m),
        o AS (SELECT * FROM (VALUES ('LFP', 3.65::DOUBLE, 2.6::DOUBLE), ('NMC', 4.2::DOUBLE, 3.0::DOUBLE)) a(chemistry, vf, vc) CROSS JOIN (SELECT unnest([16, 17, 20, 21, 24, 25]) AS series)),
        r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY abs(vmax / series - vf) + abs(vmin / series - vc), series) AS k FROM c JOIN o USING (chemistry))
        SELECT model, chemistry, series, round(pc, 4) + 0 AS slope_per_cell, CASE WHEN model = 'BUILDING' THEN 'LFP' END AS sheet_chemistry, CASE WHEN model = 'BUILDING' THEN 24 END AS sheet_series, model = 'BUILDING' AND chemistry = 'LFP' AND series = 24 AS ok FROM r WHERE k = 1""",
    "level_counts": "SELECT channel, " + ", ".join(f"count(*) FILTER (WHERE health_level = '{x}') AS \"{x}\"" for x in ("健康", "关注", "预警", "退役", "unknown")) + " FROM fc GROUP BY channel",
    "kpis": f"""L1 SELECT (SELECT coalesce(sum(new_retire), 0)::BIGINT FROM s2 WHERE mi < {TODAY} + 12) AS next_12, (SELECT coalesce(sum(new_retire), 0)::BIGINT FROM s2) AS window_total,
        (SELECT round(sum(q * n) / sum(n), 9) FROM (SELECT median(soh) AS q, count(*) AS n FROM la GROUP BY model)) AS soh_mean""",
    "drift_verdict": """R2 SELECT count(*) AS devices, round(avg((s >= 0)::INT), 9) AS nonneg_share, CASE WHEN avg((s >= 0)::INT) > 0.7 THEN 'absolute_untrusted' ELSE 'ok' END AS verdict
        FROM (SELECT regr_slope(capacity_raw, x) AS s FROM rx GROUP BY device_id HAVING count(*) >= 4 AND regr_slope(capacity_raw, x) IS NOT NULL)""",
    "loop_axis": """WITH e AS (SELECT model, mi::DOUBLE AS x, l, lag(mi::DOUBLE) OVER w AS px, lag(l) OVER w AS pl FROM tm WINDOW w AS (PARTITION BY model ORDER BY mi)), k AS (SELECT unnest(generate_series(100, 5000, 100)) AS h)
        SELECT model, h AS loops, round(arg_min(px + (h - pl) / (l - pl) * (x - px), x), 9) AS x_cross FROM e JOIN k ON pl <> l AND (pl - h) * (l - h) <= 0 GROUP BY model, h""",
    "model_crossing_80": """WITH e AS (SELECT model, x::DOUBLE AS x, y, lag(x::DOUBLE) OVER w AS px, lag(y) OVER w AS py FROM ta WINDOW w AS (PARTITION BY model ORDER BY x)),
        c AS (SELECT model, arg_min(px + (0.97 - py) / (y - py) * (x - px), x) AS xc FROM e WHERE py <> y AND (py - 0.97) * (y - 0.97) <= 0 GROUP BY model),
        p AS (SELECT model, x::DOUBLE AS x, l, lead(x::DOUBLE) OVER w AS nx, lead(l) OVER w AS nl, row_number() OVER w AS f FROM ta WINDOW w AS (PARTITION BY model ORDER BY x))
        SELECT model, round(xc, 9) AS x_cross, round(l + coalesce(least(greatest((xc - x) / (nx - x), 0), 1), 0) * (coalesce(nl, l) - l), 9) AS loops_at FROM c JOIN p USING (model) WHERE (x <= xc OR f = 1) AND (nx IS NULL OR xc < nx)""",
    "age_ticks": _ticks("ta", 0, 2, "loop_p25, loop_p75, birth_p25, birth_p75"),
    "loop_ticks": _ticks("tl", 50, 50, "age_p25, age_p75, birth_p25, birth_p75"),
    "model_descriptions": "SELECT DISTINCT model, CASE model WHEN 'm0' THEN '铁锂 24S' WHEN 'm2' THEN '三元 21S' ELSE '' END AS description, CASE model WHEN 'm0' THEN 40.0 WHEN 'm2' THEN 36.5 ELSE 37.0 END::DOUBLE AS c_nom FROM mm",
    "dedup_events": "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id, event_type",
    "bucketed_dedup": "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id, event_type",
    "monthly_from_weights": _RAW_MONTHS,
    "chart_scales": f"""SELECT model, {', '.join(f"round(floor({lo} / {st}) * {st}, 9) + 0.0 AS {c}_low, round(ceil({hi} / {st}) * {st}, 9) + 0.0 AS {c}_high, round({st}, 9) AS {c}_step" for c, lo, hi, st in _AXES)}
        FROM (SELECT model, {', '.join(f"{_step(lo, hi)} AS {st}, {lo}, {hi}" for _, lo, hi, st in _AXES)} FROM (SELECT model, min(mi)::DOUBLE AS a1, max(mi)::DOUBLE AS b1, min(cap) AS a2, max(cap) AS b2, min(loop_median + 5) AS a3, max(loop_median + 5) AS b3 FROM mm GROUP BY model))""",
    "chart_curves": """SELECT channel, device_id, count(*)::INT AS n, true AS bounded, round(max(cap), 9) AS highest, round(min(cap), 9) AS lowest, min(mi)::DOUBLE AS x0, round(arg_min(cap, mi), 9) AS y0, max(mi)::DOUBLE AS x1, round(arg_max(cap, mi), 9) AS y1
        FROM mm GROUP BY channel, device_id""",
    "sign_of_dense": """WITH e AS (SELECT device_id % 5 AS device_id, event_id, soc, current FROM t),
        f AS (SELECT device_id, soc - lag(soc) OVER w AS d, CASE WHEN count(current) OVER (w ROWS 2 PRECEDING) = 3 THEN avg(current) OVER (w ROWS 2 PRECEDING) END AS i3 FROM e WINDOW w AS (PARTITION BY device_id ORDER BY event_id))
        SELECT device_id, count(*) AS n, round(median(i3), 9) + 0 AS median_i3, round(avg((i3 < 0)::INT), 9) AS frac_negative, avg((i3 < 0)::INT) > 0.8 AS reversed FROM f WHERE d > 0.03 AND i3 IS NOT NULL GROUP BY device_id HAVING count(*) >= 20""",
    "slopes_of_dense": "SELECT device_id % 5 AS device_id, round(regr_slope(voltage, soc) / 21.0, 9) AS slope FROM t WHERE soc BETWEEN 0.2 AND 0.8 AND abs(current) < 1 GROUP BY 1 HAVING count(*) >= 50 AND regr_slope(voltage, soc) IS NOT NULL",
    "default_loop_caps": "B1 SELECT model, greatest(800, (floor(coalesce(max(CASE WHEN share <= 0.98 THEN (loop_bin + 1) * 25 END), 0) / 50)::BIGINT + 1) * 50) AS loop_cap FROM bb GROUP BY model",
    "default_crossing": """WITH u AS (SELECT model, x, y * 0.82::DOUBLE AS y, l FROM ta), e AS (SELECT model, x::DOUBLE AS x, y, lag(x::DOUBLE) OVER w AS px, lag(y) OVER w AS py FROM u WINDOW w AS (PARTITION BY model ORDER BY x)),
        c AS (SELECT model, arg_min(px + (0.8 - py) / (y - py) * (x - px), x) AS xc FROM e WHERE py <> y AND (py - 0.8) * (y - 0.8) <= 0 GROUP BY model),
        p AS (SELECT model, x::DOUBLE AS x, l, lead(x::DOUBLE) OVER w AS nx, lead(l) OVER w AS nl, row_number() OVER w AS f FROM u WINDOW w AS (PARTITION BY model ORDER BY x))
        SELECT model, round(xc, 9) AS x_cross, round(l + coalesce(least(greatest((xc - x) / (nx - x), 0), 1), 0) * (coalesce(nl, l) - l), 9) AS loops_at FROM c JOIN p USING (model) WHERE (x <= xc OR f = 1) AND (nx IS NULL OR xc < nx)""",
    "nominal_span": """WITH b AS (SELECT channel, device_id, floor(remaining_ah / soc / 0.5) * 0.5 AS bin, count(*) AS n FROM t WHERE soc > 0.05 AND remaining_ah > 0 GROUP BY ALL), s AS (SELECT channel, device_id, min(ts) AS t0, max(ts) AS t1 FROM t GROUP BY ALL)
        SELECT channel, device_id, arg_max(bin, n * 1000000 - bin) + 0.25 AS c_nom_bms, any_value(t0) AS t0, any_value(t1) AS t1 FROM b JOIN s USING (channel, device_id) GROUP BY ALL""",
    "anchors_by_model": f"""WITH k0 AS (SELECT *, CASE model WHEN 'm0' THEN 87.6 ELSE 88.2 END::DOUBLE AS vf, CASE model WHEN 'm0' THEN 62.4 ELSE 63.0 END::DOUBLE AS vc, CASE model WHEN 'm0' THEN 24 ELSE 21 END::DOUBLE AS ser,
            CASE model WHEN 'm2' THEN 36.5 ELSE 40 END * 0.02::DOUBLE AS ra FROM (SELECT *, 'm' || (device_id % 4) AS model FROM cl)),
        k1 AS (SELECT *, abs(i) < ra AND coalesce(dt <= 21600, true) AS q FROM k0), k2 AS (SELECT *, (q AND NOT coalesce(lag(q) {_W}, false))::INT AS st FROM k1),
        k3 AS (SELECT *, sum(st) OVER (PARTITION BY device_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM k2),
        k4 AS (SELECT *, CASE WHEN q THEN sec - min(CASE WHEN q THEN sec END) OVER (PARTITION BY device_id, run) ELSE 0 END AS rest_s FROM k3),
        k5 AS (SELECT *, q AND rest_s >= 7200 AND NOT coalesce(lead(q) {_W}, false) AS d, lag(i) {_W} AS ip FROM k4),
        k6 AS (SELECT *, soc > 0.95 AND voltage > vf * 0.99 AND i > 0 AND i < 5 AS a, coalesce(ip > 5, false) AND abs(i) < ra AND soc >= 0.98 AND voltage < vf * 0.99 AS b, soc < 0.1 AND voltage < vc * 1.05 AND i < 0 AS c FROM k5),
        k7 AS (SELECT *, CASE WHEN b THEN 'SWAP_FULL' WHEN c THEN 'EMPTY_END' WHEN a THEN 'FULL_END' WHEN d THEN 'OCV' ELSE 'NONE' END AS kind,
            CASE WHEN d THEN least(greatest(CASE model WHEN 'm0' THEN {_interp('voltage / 24.0', 'LFP')} ELSE {_interp('voltage / 21.0')} END, 0.02), 0.98) WHEN a THEN greatest(soc, 0.95) WHEN c THEN greatest(soc, 0.02) WHEN b THEN 1.0 END::DOUBLE AS sa FROM k6),
        k8 AS (SELECT k7.*, o.c_nom_bms AS own, remaining_ah / sa AS raw FROM k7 LEFT JOIN (SELECT * FROM nom WHERE device_id % 3 > 0) o USING (channel, device_id) WHERE kind <> 'NONE'),
        k9 AS (SELECT *, coalesce(own, nullif(median(own) FILTER (WHERE sa > 0) OVER (PARTITION BY model), 0), 40) AS nom_, raw * (1 + CASE model WHEN 'm0' THEN 0.005 ELSE 0.0025 END::DOUBLE * (25 - temperature)) AS cap_ FROM k8)
        SELECT event_id, model, kind AS anchor_type, round(sa, 9) AS soc_anchor, round(nom_, 9) AS c_nom_bms, round(raw, 9) AS capacity_raw, round(cap_, 9) AS capacity_corrected, coalesce(cap_ < nom_ * 0.65 OR cap_ > nom_ * 1.10, false) AS out_of_range,
            (kind = 'EMPTY_END' AND voltage / ser > CASE model WHEN 'm0' THEN 2.6 ELSE 3.0 END::DOUBLE * 1.25) OR (kind = 'FULL_END' AND voltage / ser < CASE model WHEN 'm0' THEN 3.65 ELSE 4.2 END::DOUBLE * 0.9) AS v_inconsistent FROM k9""",
    "mixed_schemas": """SELECT device_id, count(*) AS n, round(sum(voltage), 9) AS voltage, round(sum(current), 9) AS current, count(CASE WHEN event_id % 3 > 0 THEN temperature END) AS temperatures,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, max(loop_count) AS loops FROM t GROUP BY device_id""",
    "bucketed_runs": "SELECT device_id, c_nationkey AS nation, count(*) AS n, count(*) FILTER (WHERE is_rest) AS resting, sum(rest_s)::BIGINT AS rest_s, count(*) FILTER (WHERE run_end) AS ends FROM rr JOIN customer ON device_id = c_custkey GROUP BY ALL",
    "device_rows": "SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 100 = 7)",
    "incremental_anchors": f"""SELECT event_id, anchor_type, round(soc_anchor, 9) AS soc_anchor, CASE WHEN conflict AND drift THEN 'anchor_conflict,sensor_drift' WHEN conflict THEN 'anchor_conflict' WHEN drift THEN 'sensor_drift' ELSE '' END AS flags,
        round(c_nom_bms, 9) AS c_nom_bms, round(capacity_corrected, 9) AS capacity_corrected FROM ca WHERE ts >= TIMESTAMP '{SECOND_CUT}'""",
}

#: Expressions that single queries need besides; a query names its first by a short mark.
_MORE = {
    "R1": {"xr": "SELECT device_id, remaining_ah / soc AS r, floor((sec - min(sec) OVER (PARTITION BY device_id)) / 86400) / 30.44 AS x FROM t WHERE soc > 0.05 AND remaining_ah > 0",
           "rs": "SELECT device_id, stddev_pop(r) / avg(r) AS cv, CASE WHEN count(*) >= 12 THEN coalesce(regr_slope(r, x), 0) ELSE 0 END AS slope FROM xr GROUP BY device_id HAVING count(*) >= 30"},
    "G1": {"gg": f"SELECT g FROM (SELECT (sec - lag(sec) {_W}) // 60 AS g FROM t) WHERE g > 0"},
    "S1": {"sg": f"SELECT device_id, soc - lag(soc) {_W} AS d, CASE WHEN count(current) OVER (PARTITION BY device_id ORDER BY ts ROWS 2 PRECEDING) = 3 THEN avg(current) OVER (PARTITION BY device_id ORDER BY ts ROWS 2 PRECEDING) END AS i3 FROM t"},
    "D1": {"dd": "SELECT *, soh - lag(soh) OVER (PARTITION BY channel, device_id ORDER BY ym) AS d FROM az"},
    "C1": {"tot": "SELECT channel, count(*) AS anchor_total, count(*) FILTER (WHERE cap_tier = 1) AS t1 FROM sc GROUP BY channel",
           "dv": "SELECT 'c' || (device_id % 5) AS channel, median(dm * 12) AS md, count(DISTINCT device_id) AS device_count FROM dc GROUP BY ALL",
           "mr": "SELECT channel, ym, count(*) FILTER (WHERE cap_tier = 1)::DOUBLE / count(*) AS r FROM sc GROUP BY ALL",
           "wd": "SELECT channel, min(d) AS worst FROM (SELECT channel, r - lag(r) OVER (PARTITION BY channel ORDER BY ym) AS d FROM mr) WHERE d < 0 GROUP BY channel"},
    "G2": {"gm": "SELECT channel, device_id, ym, soh, avg(soh) OVER (PARTITION BY channel, ym) AS mean FROM so"},
    "F1": {"fe": "SELECT device_id, median(cc) FILTER (WHERE anchor_type IN ('FULL_END', 'SWAP_FULL')) AS fm, median(cc) FILTER (WHERE anchor_type = 'EMPTY_END') AS em FROM sc GROUP BY device_id HAVING fm IS NOT NULL AND em IS NOT NULL"},
    "R2": {"rx": "SELECT device_id, capacity_raw, floor((sec - min(sec) OVER (PARTITION BY device_id)) / 86400) / 30.44 AS x FROM sc"},
    "E1": {"en": "SELECT model, count(*) AS dc_, median(a) AS s, median(b) AS l FROM (SELECT model, device_id, arg_min(soh, ym) AS a, arg_max(soh, ym) AS b FROM az GROUP BY ALL) GROUP BY model"},
    "L1": {"la": "SELECT model, device_id, max(ym) AS e, min(ym) AS s, arg_max(soh, ym) AS soh, arg_max(loop_median, ym) AS l FROM az GROUP BY ALL"},
    "Q1": {"qq": "SELECT model, ((mi - 1) // 12) || ' Q' || ((mi - 1) % 12 // 3 + 1) AS quarter, sum(new_retire)::BIGINT AS new_retire FROM sd GROUP BY ALL"},
    "H1": {"hh": "SELECT *, max(cum_retire) OVER (PARTITION BY model) AS tot FROM sd"},
    "B1": {"bb": "SELECT model, loop_bin, sum(n) OVER (PARTITION BY model ORDER BY loop_bin ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(n) OVER (PARTITION BY model) AS share FROM (SELECT model, loop_bin, count(DISTINCT device_id) AS n FROM ag GROUP BY ALL)"},
    "X1": {"cx": "SELECT device_id, (mi - 23940)::DOUBLE AS x, cap / 37.0 AS y, lag((mi - 23940)::DOUBLE) OVER w AS px, lag(cap / 37.0) OVER w AS py FROM mm WINDOW w AS (PARTITION BY device_id ORDER BY mi)"},
}


def _whole(text: str) -> str:
    if text[:2] in _MORE and text[2] == " ":
        mark, text = text[:2], text[3:]
        for n, x in _MORE[mark].items():
            CTES.setdefault(n, x)
    if text.startswith("WITH "):  # own expressions first need those they build on
        names = _uses(text, list(CTES))
        return ("WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in names) + ", " + text[5:]) if names else text
    return _sql(text)


SQL: dict[str, str] = {k: _whole(v) for k, v in _RAW.items()}
