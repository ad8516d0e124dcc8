"""DuckDB SQL of the seasonal-trend decomposition (STL), for the oracle.

The published algorithm stated relationally: one recursive step is one pass of the inner loop over the rows
(sensor, period, i, y, trend, seasonal, weight). A LOESS is a join of the points with a table of tricube weights per (query
point, neighbour) and one sum per query point; the moving averages are window frames; every second step the
bisquare weights follow from the residuals. It shares no code or plan with the numpy kernel.
"""

from __future__ import annotations

SEASONAL = 7
INNER, OUTER = 2, 15


def _odd(x: str) -> str:
    return f"({x} + 1 - ({x}) % 2)"


def _geometry(name: str, source: str, key: str, length: str, span: str, lo: str, hi: str) -> str:
    """(key, x, j, w, d): weights of the neighbours j of each query point x in a series of ``length`` points."""
    return f"""{name} AS MATERIALIZED (SELECT {key}, x, j, j - x AS d,
        CASE WHEN abs(j - x) <= 0.001 * h THEN 1.0 ELSE pow(1.0 - pow(abs(j - x) / h, 3), 3) END AS w
      FROM (SELECT *, unnest(generate_series(nl, nl + win - 1)) AS j FROM (
        SELECT *, greatest(x - nl, nl + win - 1 - x) + CASE WHEN {span} > {length} THEN ({span} - {length}) // 2 ELSE 0 END::DOUBLE AS h FROM (
          SELECT *, least({span}, {length}) AS win, greatest(1, least(x - ({span} - 1) // 2, {length} - least({span}, {length}) + 1)) AS nl
          FROM (SELECT *, unnest(generate_series({lo}, {hi})) AS x FROM {source}))))
      WHERE abs(j - x) <= 0.999 * h)"""


def _fit(length: str) -> str:
    """Value of the local line at the query point, from the sums s0 s1 s2 (weights) and t0 t1 (weighted values)."""
    centre, spread = "(s1 / s0)", "(s2 / s0 - (s1 / s0) * (s1 / s0))"
    slope = (f"CASE WHEN sqrt(greatest({spread}, 0.0)) > 0.001 * ({length} - 1) THEN -{centre} / {spread} "
             "ELSE 0.0 END")
    return f"CASE WHEN s0 > 1e-12 THEN t0 / s0 + ({slope}) * (t1 / s0 - {centre} * t0 / s0) END"


_SUMS = "sum(w * rw) AS s0, sum(w * rw * d) AS s1, sum(w * rw * d * d) AS s2, sum(w * rw * v) AS t0, sum(w * rw * d * v) AS t1"


def stl_ctes(periods=(7, 30, 365), source: str = "c") -> list[str]:
    """stl_rows(sensor, period, i, y, trend, seasonal) and stl(sensor, period, f, score, ...) of the points in ``source``
    (sensor, pos, n, value)."""
    values = "(VALUES " + ", ".join(f"({int(p)})" for p in periods) + ") pp(period)"
    step = f"""SELECT sensor, period, n, i, y, trend, seasonal, it,
        CASE WHEN it % {INNER} > 0 THEN rw WHEN cmad <= 0 OR r <= 0.001 * cmad THEN 1.0 WHEN r <= 0.999 * cmad THEN pow(1.0 - pow(r / cmad, 2), 2) ELSE 0.0 END AS rw
      FROM (SELECT *, 6.0 * median(r) OVER (PARTITION BY sensor, period) AS cmad FROM (SELECT *, abs(y - seasonal - trend) AS r FROM (
        SELECT z.sensor, z.period, z.n, z.i, z.y, z.rw, z.it, z.seasonal, coalesce({_fit('z.n')}, z.y - z.seasonal) AS trend
        FROM deseason z JOIN (SELECT a.sensor, a.period, g.x, {_SUMS}
          FROM (SELECT sensor, period, n, i, rw, y - seasonal AS v FROM deseason) a JOIN stl_gt g ON g.n = a.n AND g.period = a.period AND g.j = a.i
          GROUP BY ALL) f ON f.sensor = z.sensor AND f.period = z.period AND f.x = z.i)))"""
    recursive = f"""stl_run AS (
      SELECT sensor, period, n, i, y, 0.0::DOUBLE AS trend, 0.0::DOUBLE AS seasonal, 0 AS it, 1.0::DOUBLE AS rw FROM stl_in
      UNION ALL
      (WITH here AS MATERIALIZED (SELECT * FROM stl_run WHERE it < {INNER * (OUTER + 1)}),
      sub AS (SELECT sensor, period, n, (i - 1) % period AS m, (i - 1) // period + 1 AS k, (n - 1 - (i - 1) % period) // period + 1 AS len, y - trend AS v, rw FROM here),
      subfit AS (SELECT f.sensor, f.period, f.n, f.m + f.period * f.x AS c, f.x, f.m, coalesce({_fit('f.len')}, s.v) AS v
        FROM (SELECT a.sensor, a.period, a.n, a.m, a.len, g.x, {_SUMS} FROM sub a JOIN stl_gs g ON g.len = a.len AND g.j = a.k GROUP BY ALL) f
        LEFT JOIN sub s ON s.sensor = f.sensor AND s.period = f.period AND s.m = f.m AND s.k = f.x),
      cyc AS MATERIALIZED (SELECT sensor, period, n, c, coalesce(v, lead(v) OVER ends, lag(v) OVER ends) AS v FROM subfit WINDOW ends AS (PARTITION BY sensor, period, m ORDER BY x)),
      ma1 AS (SELECT sensor, period, n, c, avg(v) OVER (PARTITION BY sensor, period ORDER BY c ROWS BETWEEN CURRENT ROW AND period - 1 FOLLOWING) AS v FROM cyc),
      ma2 AS (SELECT sensor, period, n, c, avg(v) OVER (PARTITION BY sensor, period ORDER BY c ROWS BETWEEN CURRENT ROW AND period - 1 FOLLOWING) AS v FROM ma1 WHERE c <= n + period),
      ma3 AS (SELECT sensor, period, n, c, avg(v) OVER (PARTITION BY sensor, period ORDER BY c ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS v, 1.0 AS rw FROM ma2 WHERE c <= n + 1),
      low AS (SELECT sensor, period, x AS i, {_fit('n')} AS v FROM (SELECT a.sensor, a.period, a.n, g.x, {_SUMS} FROM ma3 a JOIN stl_gl g ON g.n = a.n AND g.period = a.period AND g.j = a.c + 1 WHERE a.c < a.n GROUP BY ALL)),
      mid AS (SELECT sensor, period, (c - period + 1)::BIGINT AS i, v FROM cyc),
      deseason AS MATERIALIZED (SELECT h.sensor, h.period, h.n, h.i, h.y, h.rw, h.it + 1 AS it, mid.v - low.v AS seasonal
        FROM here h JOIN mid USING (sensor, period, i) JOIN low USING (sensor, period, i))
      {step}))"""
    return [
        f"stl_in AS MATERIALIZED (SELECT sensor, period::BIGINT AS period, n, pos AS i, value AS y FROM {source}, {values} WHERE n >= 2 * period)",
        f"stl_par AS (SELECT DISTINCT n, period, {_odd(f'ceil(1.5 * period / (1.0 - 1.5 / {SEASONAL}))::INT')} AS nt, {_odd('(period + 1)')} AS nl_span FROM stl_in)",
        "stl_len AS (SELECT DISTINCT (n - 1 - m) // period + 1 AS len FROM (SELECT *, unnest(generate_series(0, period - 1)) AS m FROM stl_par))",
        _geometry("stl_gt", "stl_par", "n, period", "n", "nt", "1", "n"),
        _geometry("stl_gl", "stl_par", "n, period", "n", "nl_span", "1", "n"),
        _geometry("stl_gs", "stl_len", "len", "len", str(SEASONAL), "0", "len + 1"),
        recursive,
        f"stl_rows AS MATERIALIZED (SELECT sensor, period, i, y, trend, seasonal, y - seasonal - trend AS residual FROM stl_run WHERE it = {INNER * (OUTER + 1)})",
        """stl_var AS (SELECT sensor, period, var_pop(seasonal) AS vs, var_pop(residual) AS vr, var_pop(trend) AS vt FROM stl_rows GROUP BY 1, 2)""",
        f"""stl AS (SELECT s.sensor, CAST(s.period AS BIGINT) AS period, v.vs, v.vr, CASE WHEN v.vr > 0 THEN v.vs / v.vr WHEN v.vr = 0 THEN 0.0 END AS f_season,
        CASE WHEN v.vr > 0 THEN v.vs / v.vr / (v.vs / v.vr + 1.0) ELSE 0.0 END AS score,
        CASE WHEN v.vr > 0 THEN v.vt / v.vr / (v.vt / v.vr + 1.0) WHEN v.vr = 0 THEN 0.0 END AS trend_strength,
        CASE WHEN v.vr IS NULL THEN 'insufficient_data' END AS error
      FROM (SELECT DISTINCT sensor, period FROM {source}, {values}) s LEFT JOIN stl_var v ON v.sensor = s.sensor AND v.period = s.period)""",
    ]
