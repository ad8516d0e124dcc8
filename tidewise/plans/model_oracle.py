"""DuckDB SQL of the model fits, for the oracle: the joint regression by elimination, the PACF by recursion, changepoints by
dynamic programming, splines by a sweep."""

from __future__ import annotations

from tidewise.plans.oracle import TWO_PI


def joint_ctes(periods=(7, 30, 365), source: str = "c") -> list[str]:
    """joint(sensor, n, r2, intercept, b0 ..): least squares on sines and cosines of all periods, the normal equations
    eliminated column by column (the design has full rank)."""
    xs = [f"{f}({TWO_PI} * t / {float(p)!r})" for p in periods for f in ("sin", "cos")]
    k = len(xs)
    rows = f"jx AS (SELECT sensor, value, {', '.join(f'{x} AS x{i}' for i, x in enumerate(xs))} FROM {source})"
    cols = [f"covar_pop(x{i}, x{j}) AS a{i}_{j}" for i in range(k) for j in range(i, k)] + [f"covar_pop(x{i}, value) AS a{i}_{k}" for i in range(k)]
    moments = (f"jm AS (SELECT sensor, count(*) AS n, avg(value) AS my, var_pop(value) AS vyy, {', '.join(f'avg(x{i}) AS m{i}' for i in range(k))}, "
               f"{', '.join(f'covar_pop(x{i}, value) AS cy{i}' for i in range(k))}, {', '.join(cols)} FROM jx GROUP BY sensor)")
    ctes, src = [rows, moments], "jm"
    for p in range(k - 1):
        done = [f"a{i}_{j}" for i in range(p + 1) for j in range(i, k + 1)]
        left = [f"a{i}_{j} - a{p}_{i} * a{p}_{j} / a{p}_{p} AS a{i}_{j}" for i in range(p + 1, k) for j in range(i, k + 1)]
        keep = ["sensor", "n", "my", "vyy"] + [f"m{i}" for i in range(k)] + [f"cy{i}" for i in range(k)]
        ctes.append(f"je{p} AS (SELECT {', '.join(keep + done + left)} FROM {src})")
        src = f"je{p}"
    for i in range(k - 1, -1, -1):
        known = "".join(f" - a{i}_{j} * b{j}" for j in range(i + 1, k))
        ctes.append(f"jb{i} AS (SELECT *, (a{i}_{k}{known}) / a{i}_{i} AS b{i} FROM {src})")
        src = f"jb{i}"
    ctes.append(f"joint AS (SELECT sensor, n, ({' + '.join(f'b{i} * cy{i}' for i in range(k))}) / vyy AS r2, "
                f"my - ({' + '.join(f'b{i} * m{i}' for i in range(k))}) AS intercept, {', '.join(f'b{i}' for i in range(k))} FROM {src})")
    return ctes


def pacf_ctes(nlags: int = 50, source: str = "c") -> list[str]:
    """pacf(sensor, lag, pacf) by Levinson-Durbin on the biased autocorrelations, one order per recursive step."""
    return [
        f"px AS (SELECT sensor, pos, n, value - avg(value) OVER (PARTITION BY sensor) AS dx FROM {source})",
        f"pl AS (SELECT sensor, unnest(generate_series(0, least({nlags}, max(n) // 2 - 1))) AS lag, sum(dx * dx) AS den FROM px GROUP BY sensor)",
        "pr AS (SELECT l.sensor, l.lag, sum(a.dx * b.dx) / max(l.den) AS r FROM pl l JOIN px a ON a.sensor = l.sensor JOIN px b ON b.sensor = a.sensor AND b.pos = a.pos + l.lag GROUP BY 1, 2)",
        "ps AS MATERIALIZED (SELECT sensor, list(r ORDER BY lag) AS r, CAST(max(lag) AS BIGINT) AS last FROM pr GROUP BY sensor)",  # r[k + 1]: lag k
        """plev AS (SELECT sensor, r, last, 1::BIGINT AS k, [r[2]] AS phi, 1.0 - r[2] * r[2] AS v FROM ps
          UNION ALL SELECT sensor, r, last, k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - f * phi[k + 1 - i]), f), v * (1.0 - f * f)
          FROM (SELECT *, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 2 - i]))) / v AS f FROM plev WHERE k < last))""",
        "pacf AS (SELECT sensor, 0::BIGINT AS lag, 1.0::DOUBLE AS pacf FROM ps UNION ALL SELECT sensor, k, phi[k] FROM plev)",
    ]


def _partition_ctes(costs: str, penalty: float, source: str, min_size: int, jump: int) -> list[str]:
    """cps(sensor, cp_bin): the partition of least cost by dynamic programming over the ends, with the pruning of PELT (a start
    whose total exceeds the best by more than the penalty is given up). ``costs`` defines cost(sensor, si, ei, fresh, cost)
    for start number si and end number ei; a start joins at its ``fresh`` end. Each step adds one end to the lists of best totals
    and of their starts."""
    return [
        f"""cend AS MATERIALIZED (SELECT sensor, max(n) AS n, list_append(list_filter(range(0, max(n), {jump}), lambda e: e >= {min_size}), max(n)) AS ends
          FROM {source} GROUP BY sensor HAVING max(n) >= {2 * min_size})""",
        # starts: 0 and every end but the last; number 1 is 0
        "cst AS MATERIALIZED (SELECT sensor, n, ends, list_prepend(0, ends[:-2]) AS starts FROM cend)",
        "cse AS MATERIALIZED (SELECT sensor, ei, e, unnest(generate_series(1, len(starts))) AS si, starts FROM "
        "(SELECT sensor, starts, unnest(generate_series(1, len(ends))) AS ei, unnest(ends) AS e FROM cst))",
        f"cpair AS MATERIALIZED (SELECT sensor, si, starts[si] AS s, ei, e, starts[si] = (e - {min_size}) // {jump} * {jump} AS fresh FROM cse WHERE e - starts[si] >= {min_size})",
        costs,
        f"""cdp AS (SELECT sensor, 1::BIGINT AS k, [0.0::DOUBLE] AS f, [0::BIGINT] AS came, CAST([] AS BIGINT[]) AS alive, len(ends) AS m FROM cst
          UNION ALL SELECT d.sensor, d.k + 1, list_append(d.f, b.best.c), list_append(d.came, b.best.si),
            list_transform(list_filter(b.tried, lambda x: x.c <= b.best.c + {penalty!r}), lambda x: x.si), d.m
          FROM cdp d JOIN (SELECT sensor, min(t) AS best, list(t) AS tried FROM (SELECT d.sensor, {{'c': d.f[x.si] + x.cost + {penalty!r}, 'si': x.si}} AS t
            FROM cdp d JOIN cost x ON x.sensor = d.sensor AND x.ei = d.k WHERE x.fresh OR list_contains(d.alive, x.si)) GROUP BY sensor) b
          ON b.sensor = d.sensor WHERE d.k <= d.m)""",
        "cfin AS (SELECT sensor, came, k FROM cdp WHERE k = m + 1)",
        # walk back from the last end: entry si of the starts is the end number si - 1
        """cwalk AS (SELECT sensor, came, came[k] AS si FROM cfin UNION ALL SELECT sensor, came, came[si] FROM cwalk WHERE si > 1)""",
        f"cps AS (SELECT w.sensor, c.bin AS cp_bin FROM cwalk w JOIN cst s ON s.sensor = w.sensor JOIN {source} c ON c.sensor = w.sensor AND c.pos = s.starts[w.si] WHERE w.si > 1)",
    ]


def pelt_l2_ctes(penalty: float, min_size: int = 30, jump: int = 5, source: str = "c") -> list[str]:
    cost = f"""csum AS MATERIALIZED (SELECT sensor, pos, sum(value) OVER w AS c1, sum(value * value) OVER w AS c2 FROM (SELECT sensor, pos, value FROM {source} UNION ALL SELECT DISTINCT sensor, 0, 0.0 FROM {source})
          WINDOW w AS (PARTITION BY sensor ORDER BY pos)),
        cost AS MATERIALIZED (SELECT p.sensor, p.si, p.ei, p.fresh, (b.c2 - a.c2) - (b.c1 - a.c1) * (b.c1 - a.c1) / (p.e - p.s) AS cost
          FROM cpair p JOIN csum a ON a.sensor = p.sensor AND a.pos = p.s JOIN csum b ON b.sensor = p.sensor AND b.pos = p.e)"""
    return _partition_ctes(cost, penalty, source, min_size, jump)


def rbf_scale_ctes(source: str = "c") -> list[str]:
    """rg(sensor, g): one over the median of all squared distances."""
    return [f"rg AS MATERIALIZED (SELECT a.sensor, 1.0 / median((a.value - b.value) * (a.value - b.value)) AS g FROM {source} a JOIN {source} b ON b.sensor = a.sensor AND b.pos > a.pos GROUP BY a.sensor)"]


_KERNEL = "exp(-least(greatest(g.g * (a.value - b.value) * (a.value - b.value), 0.01), 100.0))"


def pelt_rbf_ctes(penalty: float, min_size: int = 30, jump: int = 5, source: str = "c") -> list[str]:
    """The kernel is summed over cells of ``jump`` points, then over segments by two-dimensional running sums."""
    cost = f"""kc AS MATERIALIZED (SELECT a.sensor, (a.pos - 1) // {jump} AS i, (b.pos - 1) // {jump} AS j, sum({_KERNEL}) AS k
          FROM {source} a JOIN {source} b ON b.sensor = a.sensor JOIN rg g ON g.sensor = a.sensor GROUP BY 1, 2, 3),
        kr AS (SELECT sensor, i, j, sum(k) OVER (PARTITION BY sensor, i ORDER BY j) AS k FROM kc),
        ks AS MATERIALIZED (SELECT sensor, i + 1 AS i, j + 1 AS j, sum(k) OVER (PARTITION BY sensor, j ORDER BY i) AS k FROM kr),
        cost AS MATERIALIZED (SELECT p.sensor, p.si, p.ei, p.fresh, (p.e - p.s) * exp(-0.01::DOUBLE) - (ee.k - COALESCE(se.k, 0) - COALESCE(es.k, 0) + COALESCE(ss.k, 0)) / (p.e - p.s) AS cost
          FROM (SELECT *, (s + {jump} - 1) // {jump} AS sc, (e + {jump} - 1) // {jump} AS ec FROM cpair) p
          JOIN ks ee ON ee.sensor = p.sensor AND ee.i = p.ec AND ee.j = p.ec LEFT JOIN ks se ON se.sensor = p.sensor AND se.i = p.sc AND se.j = p.ec
          LEFT JOIN ks es ON es.sensor = p.sensor AND es.i = p.ec AND es.j = p.sc LEFT JOIN ks ss ON ss.sensor = p.sensor AND ss.i = p.sc AND ss.j = p.sc)"""
    return rbf_scale_ctes(source) + _partition_ctes(cost, penalty, source, min_size, jump)


def window_rbf_ctes(penalty: float, width: int = 50, min_size: int = 30, jump: int = 5, source: str = "c") -> list[str]:
    half, order = width // 2, max(max(width, 2 * min_size) // (2 * jump), 1)
    return rbf_scale_ctes(source) + [
        f"wt AS (SELECT sensor, unnest(range(0, max(n), {jump})) AS t, max(n) AS n FROM {source} GROUP BY sensor HAVING max(n) >= {2 * min_size})",
        f"""wk AS (SELECT t.sensor, t.t, sum(CASE WHEN (a.pos <= t.t) = (b.pos <= t.t) THEN {_KERNEL} ELSE 0 END) / {half} - sum({_KERNEL}) / {2 * half} AS gain
          FROM wt t JOIN {source} a ON a.sensor = t.sensor AND a.pos BETWEEN t.t - {half} + 1 AND t.t + {half}
          JOIN {source} b ON b.sensor = t.sensor AND b.pos BETWEEN t.t - {half} + 1 AND t.t + {half} JOIN rg g ON g.sensor = t.sensor
          WHERE t.t >= {half} AND t.t < t.n - {half} GROUP BY 1, 2)""",
        f"""wp AS (SELECT *, max(gain) OVER (PARTITION BY sensor ORDER BY t ROWS BETWEEN {order} PRECEDING AND 1 PRECEDING) AS lm,
          max(gain) OVER (PARTITION BY sensor ORDER BY t ROWS BETWEEN 1 FOLLOWING AND {order} FOLLOWING) AS rm FROM wk)""",
        f"""cps AS (SELECT w.sensor, c.bin AS cp_bin FROM wp w JOIN {source} c ON c.sensor = w.sensor AND c.pos = w.t
          WHERE gain > {penalty!r} AND gain > COALESCE(lm, '-inf'::DOUBLE) AND gain > COALESCE(rm, '-inf'::DOUBLE))""",
    ]


def _sweep(rows: str) -> list[str]:
    """tx(sensor, i, x): solution of the tridiagonal systems trow(sensor, i, lo, di, up, rhs), i = 1 .. by elimination forward and
    substitution back, one row per recursive step."""
    return [
        f"trow AS MATERIALIZED ({rows})",
        """tf AS (SELECT sensor, i, up / di AS u, rhs / di AS r FROM trow WHERE i = 1
          UNION ALL SELECT t.sensor, t.i, t.up / (t.di - t.lo * f.u), (t.rhs - t.lo * f.r) / (t.di - t.lo * f.u) FROM tf f JOIN trow t ON t.sensor = f.sensor AND t.i = f.i + 1)""",
        "tfm AS MATERIALIZED (SELECT *, max(i) OVER (PARTITION BY sensor) AS last FROM tf)",
        "tx AS (SELECT sensor, i, r AS x FROM tfm WHERE i = last UNION ALL SELECT f.sensor, f.i, f.r - f.u * x.x FROM tx x JOIN tfm f ON f.sensor = x.sensor AND f.i = x.i - 1)",
    ]


_POINTS = ["sp0 AS (SELECT sensor, bin, value, CAST(date_diff('day', min(bin) OVER (PARTITION BY sensor), bin) AS DOUBLE) AS x FROM grid)",
           "sp AS MATERIALIZED (SELECT sensor, x, value AS y, row_number() OVER (PARTITION BY sensor ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY sensor) AS m FROM sp0 WHERE value IS NOT NULL)",
           "sn AS MATERIALIZED (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lag(x) OVER w AS x_1, lag(y) OVER w AS y_1, lead(x, 2) OVER w AS x2, lag(x, 2) OVER w AS x_2 FROM sp WINDOW w AS (PARTITION BY sensor ORDER BY i))",
           "sq AS (SELECT g.sensor, g.bin, g.value, g.x, (SELECT max(i) FROM sp WHERE sp.sensor = g.sensor AND sp.x <= g.x) AS prev FROM sp0 g)"]


def cubic_spline_ctes() -> list[str]:
    """filled(sensor, bin, value): the grid's gaps after the first known point filled by the cubic not-a-knot spline, by its second
    derivatives at the known points."""
    left, right = "(x - x_1)", "(x1 - x)"
    rows = f"""SELECT sensor, i, CASE WHEN i = m - 2 THEN ({left} * {left} - {right} * {right}) / {left} ELSE {left} END AS lo,
        CASE WHEN i = 1 THEN ({left} + {right}) * ({left} + 2 * {right}) / {right} WHEN i = m - 2 THEN ({left} + {right}) * ({right} + 2 * {left}) / {left} ELSE 2 * ({left} + {right}) END AS di,
        CASE WHEN i = 1 THEN ({right} * {right} - {left} * {left}) / {right} ELSE {right} END AS up,
        6 * ((y1 - y) / {right} - (y - y_1) / {left}) AS rhs FROM sn WHERE i BETWEEN 1 AND m - 2"""
    return [*_POINTS, *_sweep(rows),
            """sm AS MATERIALIZED (SELECT s.sensor, s.i, s.m, s.x, s.y, s.x1, s.y1, CASE WHEN s.i = 0 THEN a.x - (s.x1 - s.x) / (s.x2 - s.x1) * (b.x - a.x)
                WHEN s.i = s.m - 1 THEN c.x + (s.x - s.x_1) / (s.x_1 - s.x_2) * (c.x - d.x) ELSE t.x END AS mm
              FROM sn s LEFT JOIN tx t ON t.sensor = s.sensor AND t.i = s.i LEFT JOIN tx a ON a.sensor = s.sensor AND a.i = 1 AND s.i = 0 LEFT JOIN tx b ON b.sensor = s.sensor AND b.i = 2 AND s.i = 0
              LEFT JOIN tx c ON c.sensor = s.sensor AND c.i = s.m - 2 AND s.i = s.m - 1 LEFT JOIN tx d ON d.sensor = s.sensor AND d.i = s.m - 3 AND s.i = s.m - 1)""",
            "sl AS (SELECT *, lead(mm) OVER (PARTITION BY sensor ORDER BY i) AS mm1, x1 - x AS h FROM sm)",
            """filled AS (SELECT q.sensor, q.bin, CASE WHEN q.value IS NOT NULL OR q.prev IS NULL THEN q.value ELSE
                s.mm * pow(s.x1 - q.x, 3) / (6 * s.h) + s.mm1 * pow(q.x - s.x, 3) / (6 * s.h) + (s.y / s.h - s.mm * s.h / 6) * (s.x1 - q.x) + (s.y1 / s.h - s.mm1 * s.h / 6) * (q.x - s.x) END AS value
              FROM sq q LEFT JOIN sl s ON s.sensor = q.sensor AND s.i = least(q.prev, s.m - 2))"""]


def quadratic_spline_ctes() -> list[str]:
    """filled(sensor, bin, value): inner gaps filled by the quadratic spline with its knots half way between the known points (not at the
    first and last half). Coefficient i belongs to known point i; its three neighbours' basis values at a point follow from four knots."""
    knots = """kn AS MATERIALIZED (SELECT sensor, m, list(x ORDER BY i) AS xs FROM sp GROUP BY sensor, m)"""
    # knots of the interval that holds point i: first x three times, the middles but the first and last, last x three times
    seq = ("kt AS MATERIALIZED (SELECT sensor, m, xs, list_concat(list_concat([xs[1], xs[1], xs[1]], list_transform(range(2, m - 1), lambda j: (xs[j] + xs[j + 1]) / 2)), [xs[m], xs[m], xs[m]]) AS t FROM kn)")
    at = "greatest(3, least(len(list_filter(t, lambda k: k <= x)), len(t) - 3))"  # number (from 1) of the last knot <= x

    def basis(v: str) -> str:
        return (f"pow(t[j + 1] - {v}, 2) / ((t[j + 1] - t[j]) * (t[j + 1] - t[j - 1])) AS n0, "
                f"pow({v} - t[j], 2) / ((t[j + 1] - t[j]) * (t[j + 2] - t[j])) AS n2")

    return [*_POINTS, knots, seq,
            f"ka AS (SELECT s.sensor, s.i, s.y, s.x, t, {at} AS j FROM sp s JOIN kt ON kt.sensor = s.sensor)",
            f"kb AS (SELECT sensor, i, y, j, {basis('x')} FROM ka)",
            # the three coefficients at a point are numbers j - 3, j - 2, j - 1 (from 0)
            "kc AS MATERIALIZED (SELECT sensor, i, y, u.c, u.v FROM (SELECT sensor, i, y, unnest([{'c': j - 3, 'v': n0}, {'c': j - 2, 'v': 1 - n0 - n2}, {'c': j - 1, 'v': n2}]) AS u FROM kb))",
            *_sweep("SELECT sensor, i + 1 AS i, sum(v) FILTER (WHERE c = i - 1) AS lo, sum(v) FILTER (WHERE c = i) AS di, COALESCE(sum(v) FILTER (WHERE c = i + 1), 0) AS up, max(y) AS rhs FROM kc GROUP BY 1, 2"),
            f"qa AS (SELECT q.sensor, q.bin, q.value, q.x, t, {at} AS j, prev < m - 1 AND prev IS NOT NULL AS inner_gap FROM sq q JOIN kt ON kt.sensor = q.sensor)",
            f"qb AS (SELECT *, {basis('x')} FROM qa)",
            """filled AS (SELECT q.sensor, q.bin, CASE WHEN q.value IS NOT NULL OR NOT q.inner_gap THEN q.value ELSE q.n0 * a.x + (1 - q.n0 - q.n2) * b.x + q.n2 * c.x END AS value
              FROM qb q LEFT JOIN tx a ON a.sensor = q.sensor AND a.i = q.j - 2 LEFT JOIN tx b ON b.sensor = q.sensor AND b.i = q.j - 1 LEFT JOIN tx c ON c.sensor = q.sensor AND c.i = q.j)"""]
