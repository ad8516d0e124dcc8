"""DuckDB SQL for the correctness oracle, assembled from shared CTE fragments.

Each fragment mirrors a Spark operator's *semantics* (not its plan): calendars from
``generate_series``, fills with ``last_value/first_value IGNORE NULLS``, the ACF as a self-join
on lags, the periodogram as brute-force trig sums, the as-of fill as an ``ASOF JOIN``.
Every float is rounded to 6 digits in the final projection, dates/timestamps are rendered as text.
"""

from __future__ import annotations

import math

from tidewise.plans.stl_oracle import stl_ctes
from tidewise.sources.tables import readings_sql

TWO_PI = repr(2.0 * math.pi)
FOUR_PI = repr(4.0 * math.pi)


def rnd(c: str, alias: str | None = None) -> str:
    return f"ROUND(CAST({c} AS DOUBLE), 6) + 0.0 AS {alias or c.split('.')[-1]}"


def txt(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS VARCHAR) AS {alias or c.split('.')[-1]}"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def bin_expr(freq: str) -> str:
    return {
        "D": "CAST(ts AS DATE)",
        "W": "CAST(ts AS DATE) + CAST(7 - isodow(ts) AS INTEGER)",
        "M": "last_day(CAST(ts AS DATE))",
        "H": "date_trunc('hour', ts)",
    }[freq]


def cal_expr(freq: str) -> str:
    if freq == "M":
        return ("SELECT sensor, last_day(CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), "
                "CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)) AS bin FROM bnd")
    step = {"D": "INTERVAL 1 DAY", "W": "INTERVAL 7 DAY", "H": "INTERVAL 1 HOUR"}[freq]
    cast = "TIMESTAMP" if freq == "H" else "DATE"
    return (f"SELECT sensor, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {step})) AS {cast}) AS bin "
            "FROM bnd")


def grid_ctes(table: str = "orders", freq: str = "D", method: str = "mean", shared: bool = False) -> list[str]:
    """r (readings), agg, bnd, cal, grid(sensor, bin, value)."""
    r = f"r AS ({readings_sql(table)})"
    if method in ("mean", "median"):
        fn = "avg" if method == "mean" else "median"
        agg = f"agg AS (SELECT sensor, {bin_expr(freq)} AS bin, {fn}(value) AS value FROM r GROUP BY 1, 2)"
    else:
        agg = f"agg AS (SELECT sensor, {bin_expr(freq)} AS bin FROM r GROUP BY 1, 2)"
    if shared:
        bnd = ("bnd AS (SELECT s.sensor, (SELECT min(bin) FROM agg) AS lo, (SELECT max(bin) FROM agg) AS hi "
               "FROM (SELECT DISTINCT sensor FROM agg) s)")
    else:
        bnd = "bnd AS (SELECT sensor, min(bin) AS lo, max(bin) AS hi FROM agg GROUP BY sensor)"
    cal = f"cal AS ({cal_expr(freq)})"
    if method in ("mean", "median"):
        grid = ("grid AS (SELECT cal.sensor, cal.bin, agg.value FROM cal LEFT JOIN agg "
                "ON cal.sensor = agg.sensor AND cal.bin = agg.bin)")
        return [r, agg, bnd, cal, grid]
    # ffill: as-of join at the label instant; equal timestamps resolve to the largest value
    dd = "dd AS (SELECT sensor, ts, max(value) AS value FROM r GROUP BY sensor, ts)"
    lab = "lab AS (SELECT sensor, bin, CAST(bin AS TIMESTAMP) AS lt FROM cal)"
    grid = ("grid AS (SELECT lab.sensor, lab.bin, dd.value FROM lab ASOF LEFT JOIN dd "
            "ON lab.sensor = dd.sensor AND lab.lt >= dd.ts)")
    return [r, agg, bnd, cal, dd, lab, grid]


def neighbours_cte(src: str = "grid", name: str = "nb", x: str = "CAST(row_number() OVER (PARTITION BY sensor ORDER BY bin) AS DOUBLE)") -> list[str]:
    return [
        f"{name}0 AS (SELECT *, {x} AS x, row_number() OVER (PARTITION BY sensor ORDER BY bin) AS i FROM {src})",
        f"""{name} AS (SELECT *,
            last_value(value IGNORE NULLS) OVER wb AS pv,
            last_value(CASE WHEN value IS NOT NULL THEN x END IGNORE NULLS) OVER wb AS px,
            last_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER wb AS pi,
            first_value(value IGNORE NULLS) OVER wf AS nv,
            first_value(CASE WHEN value IS NOT NULL THEN x END IGNORE NULLS) OVER wf AS nx,
            first_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER wf AS ni
          FROM {name}0
          WINDOW wb AS (PARTITION BY sensor ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 wf AS (PARTITION BY sensor ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    ]


INNER = "pv + (nv - pv) * ((x - px) / NULLIF(nx - px, 0))"


def fill_expr(direction: str = "forward", limit: int | None = None) -> str:
    filled = {"forward": f"COALESCE({INNER}, pv)", "backward": f"COALESCE({INNER}, nv)",
              "both": f"COALESCE({INNER}, pv, nv)"}[direction]
    if limit is not None:
        near = {"forward": f"(i - pi) <= {limit}", "backward": f"(ni - i) <= {limit}",
                "both": f"((i - pi) <= {limit} OR (ni - i) <= {limit})"}[direction]
        filled = f"CASE WHEN COALESCE({near}, false) THEN {filled} END"
    return f"CASE WHEN value IS NOT NULL THEN value ELSE {filled} END"


def filled_ctes(table: str = "orders", freq: str = "D") -> list[str]:
    """grid + forward linear fill (the run path) -> filled(sensor, bin, value)."""
    return grid_ctes(table, freq) + neighbours_cte("grid", "nb") + [
        f"filled AS (SELECT sensor, bin, {fill_expr('forward')} AS value FROM nb)"
    ]


def clean_ctes(src: str = "filled", gate: bool = True, unit: str = "day") -> list[str]:
    out = []
    base = src
    if gate:
        out.append(f"elig AS (SELECT sensor FROM {src} GROUP BY sensor HAVING count(value) >= 100)")
        out.append(f"ge AS (SELECT * FROM {src} WHERE sensor IN (SELECT sensor FROM elig))")
        base = "ge"
    out.append(
        f"""c AS (SELECT sensor, bin, value,
              row_number() OVER (PARTITION BY sensor ORDER BY bin) AS pos,
              count(*) OVER (PARTITION BY sensor) AS n,
              CAST(date_diff('{unit}', min(bin) OVER (PARTITION BY sensor), bin) AS DOUBLE) AS t
            FROM {base} WHERE value IS NOT NULL)"""
    )
    return out


def periods_values(periods) -> str:
    return "(VALUES " + ", ".join(f"({int(p)})" for p in periods) + ") pp(period)"


def r2_case(vsy="vsy", vcy="vcy", vss="vss", vcc="vcc", vsc="vsc", vyy="vyy") -> str:
    d = f"({vss} * {vcc} - {vsc} * {vsc})"
    return (f"CASE WHEN {vyy} <= 0 THEN 0.0 "
            f"WHEN {d} > 1e-12 THEN ({vsy} * {vsy} * {vcc} - 2.0 * {vsy} * {vcy} * {vsc} + {vcy} * {vcy} * {vss}) / ({d} * {vyy}) "
            f"WHEN {vss} > 1e-12 THEN {vsy} * {vsy} / ({vss} * {vyy}) "
            f"WHEN {vcc} > 1e-12 THEN {vcy} * {vcy} / ({vcc} * {vyy}) ELSE 0.0 END")


def harmonic_ctes(periods=(7, 30, 365), threshold: float = 0.1) -> list[str]:
    ang = f"({TWO_PI} * t / CAST(period AS DOUBLE))"
    d = "(vss * vcc - vsc * vsc)"
    return [
        f"""hm AS (SELECT sensor, period, covar_pop(sin({ang}), value) AS vsy, covar_pop(cos({ang}), value) AS vcy,
              var_pop(sin({ang})) AS vss, var_pop(cos({ang})) AS vcc, covar_pop(sin({ang}), cos({ang})) AS vsc,
              var_pop(value) AS vyy
            FROM c, {periods_values(periods)} GROUP BY sensor, period)""",
        f"""hr AS (SELECT sensor, period, {r2_case()} AS r2,
              CASE WHEN {d} > 1e-12 THEN (vsy * vcc - vcy * vsc) / {d} WHEN vss > 1e-12 THEN vsy / vss ELSE 0.0 END AS sin_coef,
              CASE WHEN {d} > 1e-12 THEN (vcy * vss - vsy * vsc) / {d} WHEN NOT (vss > 1e-12) AND vcc > 1e-12 THEN vcy / vcc ELSE 0.0 END AS cos_coef,
              vyy FROM hm)""",
        f"""det_fourier AS (SELECT sensor, 'fourier' AS method, CAST(period AS BIGINT) AS period,
              least(greatest(r2 * 10.0, 0.0), 1.0) AS score, r2 > {threshold} AS significant,
              CASE WHEN vyy <= 0 THEN 'zero_variance' END AS error, r2, sin_coef, cos_coef FROM hr)""",
    ]


def acf_ctes(periods=(7, 30, 365), tol: int = 3, max_lag: int = 400, peak: float = 0.3) -> list[str]:
    lags = sorted({k for p in periods for k in range(max(1, p - tol), p + tol + 1) if k <= max_lag})
    lag_vals = "(VALUES " + ", ".join(f"({k})" for k in lags) + ") ll(lag)"
    return [
        "cx AS (SELECT sensor, pos, n, value - avg(value) OVER (PARTITION BY sensor) AS dx FROM c)",
        "den AS (SELECT sensor, max(n) AS n, sum(dx * dx) AS den, least(400, max(n) // 2 - 1) AS max_lag FROM cx GROUP BY sensor)".replace("400", str(max_lag)),
        f"""lagsum AS (SELECT a.sensor, ll.lag, sum(a.dx * b.dx) AS s FROM cx a CROSS JOIN {lag_vals}
              JOIN cx b ON b.sensor = a.sensor AND b.pos = a.pos + ll.lag GROUP BY a.sensor, ll.lag)""",
        "acfv AS (SELECT d.sensor, ll.lag, d.n, d.den, d.max_lag, COALESCE(s.s, 0.0) / NULLIF(d.den, 0) AS acf "
        f"FROM den d CROSS JOIN {lag_vals} LEFT JOIN lagsum s ON s.sensor = d.sensor AND s.lag = ll.lag WHERE d.max_lag >= 10)",
        f"""cand AS (SELECT a.*, pp.period, row_number() OVER (PARTITION BY a.sensor, pp.period ORDER BY abs(a.acf) DESC, a.lag) AS rk
              FROM acfv a JOIN {periods_values(periods)} ON a.lag BETWEEN greatest(1, pp.period - {tol}) AND least(a.max_lag, pp.period + {tol}))""",
        f"""acfp AS (SELECT d.sensor, pp.period, d.n, d.den, d.max_lag, b.acf AS peak, b.lag AS actual_lag
              FROM den d CROSS JOIN {periods_values(periods)} LEFT JOIN (SELECT * FROM cand WHERE rk = 1) b
              ON b.sensor = d.sensor AND b.period = pp.period WHERE d.max_lag >= 10)""",
        f"""det_acf AS (SELECT sensor, 'acf' AS method, CAST(period AS BIGINT) AS period,
              CASE WHEN period > max_lag OR den <= 0 OR peak IS NULL THEN 0.0 ELSE abs(peak) END AS score,
              COALESCE(NOT (period > max_lag) AND NOT (den <= 0) AND abs(peak) > 1.96 / sqrt(CAST(n AS DOUBLE)) AND abs(peak) > {peak}, false) AS significant,
              CASE WHEN period > max_lag THEN 'period_exceeds_max_lag' WHEN den <= 0 THEN 'zero_variance' END AS error,
              CASE WHEN NOT period > max_lag THEN peak END AS peak_value,
              CASE WHEN NOT period > max_lag THEN actual_lag END AS actual_lag,
              1.96 / sqrt(CAST(n AS DOUBLE)) AS conf_int, max_lag FROM acfp)""",
    ]


def periodogram_ctes(periods=(7, 30, 365), min_period: int = 2, max_period: int = 500, spp: int = 10,
                     fap_threshold: float = 0.05) -> list[str]:
    fmin = 1.0 / max_period
    fmax = 1.0 / min_period
    ang = f"({TWO_PI} * f * t)"
    lg = "lgamma"
    return [
        "st AS (SELECT sensor, count(value) AS n, max(t) AS span, avg(value) AS mean_y, var_pop(value) AS vyy, "
        "var_pop(t) AS var_t FROM c GROUP BY sensor)",
        f"""bf0 AS (SELECT sensor, span, 1.0 / ({float(spp)!r} * span) AS df,
              CAST(round_even({fmax - fmin!r} / (1.0 / ({float(spp)!r} * span)), 0) AS BIGINT) + 1 AS nf, pp.period
            FROM st CROSS JOIN {periods_values(periods)} WHERE span > 0)""",
        f"""bf1 AS (SELECT *, CAST(greatest(floor((1.0 / (period * CAST(1.2 AS DOUBLE)) - {fmin!r}) / df) - 1, 0) AS BIGINT) AS k_lo,
              CAST(least(ceil((1.0 / (period * CAST(0.8 AS DOUBLE)) - {fmin!r}) / df) + 1, nf - 1) AS BIGINT) AS k_hi FROM bf0)""",
        f"""bf AS (SELECT sensor, period, k, {fmin!r} + k * df AS f FROM (SELECT *, unnest(generate_series(k_lo, k_hi)) AS k
              FROM bf1 WHERE k_hi >= k_lo) WHERE 1.0 / ({fmin!r} + k * df) > period * CAST(0.8 AS DOUBLE) AND 1.0 / ({fmin!r} + k * df) < period * CAST(1.2 AS DOUBLE))""",
        f"""bp0 AS (SELECT bf.sensor, bf.period, bf.k, bf.f, covar_pop(sin({ang}), c.value - st.mean_y) AS vsy,
              covar_pop(cos({ang}), c.value - st.mean_y) AS vcy, var_pop(sin({ang})) AS vss, var_pop(cos({ang})) AS vcc,
              covar_pop(sin({ang}), cos({ang})) AS vsc
            FROM bf JOIN c ON c.sensor = bf.sensor JOIN st ON st.sensor = bf.sensor GROUP BY bf.sensor, bf.period, bf.k, bf.f)""",
        f"bp AS (SELECT bp0.sensor, period, k, f, {r2_case(vyy='st.vyy')} AS power FROM bp0 JOIN st ON st.sensor = bp0.sensor)",
        "pk AS (SELECT sensor, period, power, 1.0 / f AS actual_period FROM (SELECT *, row_number() OVER "
        "(PARTITION BY sensor, period ORDER BY power DESC, k) AS rk FROM bp) WHERE rk = 1)",
        f"""pg0 AS (SELECT st.*, pp.period, pk.power, pk.actual_period,
              CAST(n AS DOUBLE) - 1.0 AS nh, CAST(n AS DOUBLE) - 3.0 AS nk,
              1.0 / (5.0 * span) AS df5
            FROM st CROSS JOIN {periods_values(periods)} LEFT JOIN pk ON pk.sensor = st.sensor AND pk.period = pp.period)""",
        f"""pg1 AS (SELECT *, 0.5 * df5 + df5 * ((round_even(((5.0 * 0.5 * CAST(n AS DOUBLE) / span) - 0.5 * df5) / df5, 0) + 1.0) - 1.0) AS fmax,
              greatest(1.0 - power, 0.0) AS om FROM pg0)""",
        f"""pg2 AS (SELECT *, sqrt(2.0 / nh) * exp({lg}(nh / 2.0) - {lg}((nh - 1.0) / 2.0)) * (fmax * sqrt({FOUR_PI} * var_t))
              * pow(om, (nk - 1.0) / 2.0) * sqrt(nh * power / 2.0) AS tau FROM pg1)""",
        "pg3 AS (SELECT *, 1.0 - (1.0 - pow(om, nk / 2.0)) * exp(-tau) AS fap FROM pg2)",
        f"""det_periodogram AS (SELECT sensor, 'periodogram' AS method, CAST(period AS BIGINT) AS period,
              CASE WHEN power IS NOT NULL THEN least(power, 1.0) ELSE 0.0 END AS score,
              CASE WHEN power IS NOT NULL THEN fap < {fap_threshold} ELSE false END AS significant,
              CASE WHEN power IS NULL THEN 'period_out_of_range' END AS error, power, actual_period,
              CASE WHEN power IS NOT NULL THEN fap END AS fap FROM pg3)""",
    ]


def detections_ctes(methods=("stl", "acf", "periodogram", "fourier"), periods=(7, 30, 365)) -> list[str]:
    ctes = filled_ctes("orders") + clean_ctes("filled", gate=True)
    parts = []
    if "stl" in methods:
        ctes += stl_ctes(periods)
        ctes.append("det_stl AS (SELECT sensor, 'stl' AS method, period, score, score > 0.5 AS significant, error FROM stl)")
        parts.append("SELECT sensor, method, period, score, significant, error FROM det_stl")
    if "acf" in methods:
        ctes += acf_ctes(periods)
        parts.append("SELECT sensor, method, period, score, significant, error FROM det_acf")
    if "periodogram" in methods:
        ctes += periodogram_ctes(periods)
        parts.append("SELECT sensor, method, period, score, significant, error FROM det_periodogram")
    if "fourier" in methods:
        ctes += harmonic_ctes(periods)
        parts.append("SELECT sensor, method, period, score, significant, error FROM det_fourier")
    ctes.append("det AS (" + " UNION ALL ".join(parts) + ")")
    return ctes


def combine_ctes(methods, periods) -> list[str]:
    n = float(len(methods))
    order = " ".join(f"WHEN {int(p)} THEN {i}" for i, p in enumerate(periods))
    return [
        f"""comb AS (SELECT s.sensor, CAST(pp.period AS BIGINT) AS period, COALESCE(x.ssum, 0.0) / {n!r} AS combined_score
              FROM (SELECT DISTINCT sensor FROM det) s CROSS JOIN {periods_values(periods)}
              LEFT JOIN (SELECT sensor, period, sum(score) AS ssum FROM det GROUP BY 1, 2) x
              ON x.sensor = s.sensor AND x.period = pp.period)""",
        f"""best AS (SELECT sensor, period AS best_period, combined_score AS max_combined_score FROM (
              SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY combined_score DESC, CASE period {order} END) AS rk
              FROM comb) WHERE rk = 1)""",
    ]


def scores_ctes(methods=("stl", "acf", "periodogram", "fourier"), periods=(7, 30, 365), w=(0.3, 0.3, 0.4), thresholds=(0.5, 0.3, 0.1)) -> list[str]:
    ctes = detections_ctes(methods, periods) + combine_ctes(methods, periods)
    cols = []
    for m in methods:
        for p in periods:
            cols.append(f"COALESCE(max(CASE WHEN method = '{m}' AND period = {p} THEN score END), 0.0) AS {m}_{p}")
    ms = "ms AS (SELECT sensor, " + ", ".join(cols) + " FROM det GROUP BY sensor)"
    maxes = [f"greatest(0.0, {', '.join(f'{m}_{p}' for p in periods)}) AS {m}_max" for m in methods]
    for m in ("stl", "acf", "fourier"):
        if m not in methods:
            maxes.append(f"0.0 AS {m}_max")
    ms2 = "ms2 AS (SELECT *, " + ", ".join(maxes) + " FROM ms)"
    cw = ("cw AS (SELECT b.sensor, b.best_period, b.max_combined_score, "
          + ", ".join(f"max(CASE WHEN c.period = {p} THEN c.combined_score END) AS combined_{p}" for p in periods)
          + " FROM best b JOIN comb c ON c.sensor = b.sensor GROUP BY 1, 2, 3)")
    comp = f"{w[0]} * stl_max + {w[1]} * acf_max + {w[2]} * least(fourier_max * 10.0, 1.0)"
    above = [f"{m}_max > {x!r}" for m, x in zip(("stl", "acf", "fourier"), thresholds)]
    strict = "(" + " + ".join(f"CASE WHEN {a} THEN 1 ELSE 0 END" for a in above) + ")"
    sig = "(stl_max > 0.2 OR acf_max > 0.15 OR fourier_max > 0.05)"
    strong = "(" + " OR ".join(above) + ")"
    weak = f"(stl_max > {0.2 * 0.5!r} OR acf_max > {0.15 * 0.5!r} OR fourier_max > {0.05 * 0.5!r})"
    sc = (f"""scores AS (SELECT ms2.*, cw.best_period, cw.max_combined_score, {', '.join(f'cw.combined_{p}' for p in periods)},
             {comp} AS composite_score,
             CASE {strict} WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' ELSE 'None' END AS confidence_strict,
             CASE WHEN {sig} AND {strong} THEN 'High' WHEN {sig} THEN 'Medium' WHEN {weak} THEN 'Low' ELSE 'None' END AS confidence_exploratory
           FROM ms2 JOIN cw ON cw.sensor = ms2.sensor)""")
    return ctes + [ms, ms2, cw, sc]


def score_columns(methods=("stl", "acf", "periodogram", "fourier"), periods=(7, 30, 365)) -> list[str]:
    cols = [f"{m}_{p}" for m in methods for p in periods] + [f"{m}_max" for m in methods]
    for m in ("stl", "acf", "fourier"):
        if m not in methods:
            cols.append(f"{m}_max")
    cols += [f"combined_{p}" for p in periods] + ["max_combined_score", "composite_score"]
    return cols
