"""The registered queries in SQL, built from shared table expressions.

They follow the definitions by another road than the library does: calendars
are joined, recursions run as recursive queries or closed forms, and forecasts
meet actuals in a join.
"""

from __future__ import annotations

from checks.datasets import DENSE, RECENT, SHORT, SPARSE, SUPPLIERS, WEEKLY, Dataset
from checks.queries import profiled_models
from panelcast.functions.ets import EtsSettings
from panelcast.functions.smoothing import COARSE, FINE
from panelcast.operators.models import least_lengths

STEPS = 21
DAMPED = EtsSettings(forms=("AAdA",), weights=(0.3, 0.05, 0.1, 0.9))
SEARCHED = EtsSettings(refine=False)


def panel(d: Dataset) -> str:
    """Table expressions ``daily``, ``panel`` (with index ``i`` from 1, ``n`` and ``split``)."""
    k, s, c = d.keys, d.spec, d.cut
    return f"""
    daily AS (
      SELECT {k}, CAST({s.time} AS DATE) AS t, ROUND(COALESCE(SUM({s.value}), 0), 2) AS y
      FROM {d.from_sql}
      WHERE {s.time} >= DATE '{c.start}' AND {s.time} < DATE '{c.execution_date}'
      GROUP BY {k}, CAST({s.time} AS DATE)),
    span AS (SELECT {k}, MIN(t) AS start FROM daily GROUP BY {k}),
    grid AS (
      SELECT {k}, start, CAST(UNNEST(generate_series(start, DATE '{c.end}', INTERVAL 1 DAY)) AS DATE) AS t
      FROM span),
    panel AS (
      SELECT {k}, start, t, COALESCE(y, 0) AS y,
        CAST(t - start + 1 AS BIGINT) AS i,
        CAST(DATE '{c.end}' - start + 1 AS BIGINT) AS n,
        CASE WHEN t > DATE '{c.train_end}' THEN 'test' ELSE 'train' END AS split
      FROM grid LEFT JOIN daily USING ({k}, t))"""


def history(d: Dataset, which: str, name: str = "h") -> str:
    """Table expression of one history: ``keys, i, n, y`` and ``origin``, its last day."""
    if which == "full":
        return f"{name} AS (SELECT {d.keys}, t, i, n, y, DATE '{d.cut.end}' AS origin FROM panel)"
    return f"""{name} AS (SELECT {d.keys}, t, i, CAST(DATE '{d.cut.train_end}' - start + 1 AS BIGINT) AS n, y,
      DATE '{d.cut.train_end}' AS origin FROM panel WHERE split = 'train')"""


def steps(h: int) -> str:
    return f"(SELECT UNNEST(generate_series(1, {h})) AS s)"


# Forecasts: table expressions ``<name>(keys, s, v)`` over a history ``h``.


def naive_mean(d: Dataset, h: int, src: str, name: str) -> str:
    return f"{name} AS (SELECT {d.keys}, s, v FROM (SELECT {d.keys}, AVG(y) AS v FROM {src} GROUP BY {d.keys}), {steps(h)})"


def naive_seasonal(d: Dataset, h: int, src: str, name: str, m: int = 7) -> str:
    return f"""{name} AS (SELECT {d.keys}, s, y AS v FROM {src}, {steps(h)}
      WHERE n >= {m} AND i = n - {m} + 1 + (s - 1) % {m})"""


def naive_drift(d: Dataset, h: int, src: str, name: str) -> str:
    return f"""{name} AS (SELECT {d.keys}, s, last + (last - first) / (n - 1) * s AS v FROM
      (SELECT {d.keys}, n, MAX(CASE WHEN i = 1 THEN y END) AS first, MAX(CASE WHEN i = n THEN y END) AS last
       FROM {src} GROUP BY {d.keys}, n HAVING n >= 2), {steps(h)})"""


def moving_average(d: Dataset, h: int, src: str, name: str, k: int = 7) -> str:
    return f"""{name}_r AS (
      SELECT {d.keys}, 0 AS s, LIST(y ORDER BY i) AS buf FROM {src} WHERE n >= {k} AND i > n - {k} GROUP BY {d.keys}
      UNION ALL
      SELECT {d.keys}, s + 1, list_append(buf[2:], list_sum(buf) / {k}) FROM {name}_r WHERE s < {h}),
    {name} AS (SELECT {d.keys}, s, buf[{k}] AS v FROM {name}_r WHERE s > 0)"""


def croston(d: Dataset, h: int, src: str, name: str, version: str, a: float = 0.1) -> str:
    """Exponential smoothing written out as a weighted sum over the ranked demands."""
    weight = f"CASE WHEN r = 1 THEN POW({1 - a}, m - 1) ELSE {a} * POW({1 - a}, m - r) END"
    chance = f"CASE WHEN i = 1 THEN POW({1 - a}, n - 1) ELSE {a} * POW({1 - a}, n - i) END"
    level = {"classic": "z / p", "sba": f"{1 - a / 2} * z / p", "tsb": "z * q"}[version]
    return f"""{name}_d AS (
      SELECT {d.keys}, y, i - LAG(i, 1, 0) OVER w AS gap, ROW_NUMBER() OVER w AS r,
        COUNT(*) OVER (PARTITION BY {d.keys}) AS m
      FROM {src} WHERE y <> 0 WINDOW w AS (PARTITION BY {d.keys} ORDER BY i)),
    {name}_z AS (SELECT {d.keys}, SUM({weight} * y) AS z, SUM({weight} * gap) AS p FROM {name}_d GROUP BY {d.keys}),
    {name}_q AS (
      SELECT {d.keys}, SUM(CASE WHEN y <> 0 THEN {chance} ELSE 0 END) AS q FROM {src} GROUP BY {d.keys}),
    {name} AS (
      SELECT {d.keys}, s, COALESCE({level}, 0) AS v
      FROM {name}_q LEFT JOIN {name}_z USING ({d.keys}), {steps(h)})"""


def croston_optimized(d: Dataset, h: int, src: str, name: str) -> str:
    """Every weight of the grid by recursion over the ranked demands; the least error wins."""

    def pick(value: str) -> str:
        return f"""{name}_{value}_r AS (
          SELECT {d.keys}, wa, m, r, CAST({value} AS DOUBLE) AS level, CAST(0 AS DOUBLE) AS sse FROM {name}_d, {name}_w WHERE r = 1
          UNION ALL
          SELECT {d.keys}, f.wa, f.m, x.r, f.level + f.wa * (x.{value} - f.level), f.sse + POW(x.{value} - f.level, 2)
          FROM {name}_{value}_r f JOIN {name}_d x USING ({d.keys}) WHERE x.r = f.r + 1),
        {name}_{value} AS (SELECT {d.keys}, level AS {value} FROM {name}_{value}_r WHERE r = m
          QUALIFY ROW_NUMBER() OVER (PARTITION BY {d.keys} ORDER BY sse, level) = 1)"""

    return f"""{name}_d AS (
      SELECT {d.keys}, y AS z, i - LAG(i, 1, 0) OVER w AS p, ROW_NUMBER() OVER w AS r,
        COUNT(*) OVER (PARTITION BY {d.keys}) AS m
      FROM {src} WHERE y <> 0 WINDOW w AS (PARTITION BY {d.keys} ORDER BY i)),
    {name}_w AS (SELECT CAST(0.1 + 0.01 * UNNEST(generate_series(0, 20)) AS DOUBLE) AS wa),
    {pick('z')}, {pick('p')},
    {name} AS (
      SELECT {d.keys}, s, COALESCE(z / p, 0) AS v FROM (SELECT DISTINCT {d.keys} FROM {src})
      LEFT JOIN {name}_z USING ({d.keys}) LEFT JOIN {name}_p USING ({d.keys}), {steps(h)})"""


def smoothed(d: Dataset, src: str, name: str, params: str, m: int = 7) -> str:
    """``<name>``: level, trend, season and squared error after the last value, per row of ``params(keys, wa, wb, wg)``."""
    return f"""{name}_0 AS (
      SELECT {d.keys}, n, AVG(CASE WHEN i <= {m} THEN y END) AS l,
        (AVG(CASE WHEN i > {m} THEN y END) - AVG(CASE WHEN i <= {m} THEN y END)) / {m} AS b,
        LIST(y ORDER BY i) FILTER (i <= {m}) AS ys
      FROM {src} WHERE n >= {2 * m} AND i <= {2 * m} GROUP BY {d.keys}, n),
    {name}_r AS (
      SELECT {d.keys}, wa, wb, wg, n, CAST({m} AS BIGINT) AS i, l, b, list_transform(ys, lambda y: y - l) AS c,
        CAST(0 AS DOUBLE) AS sse
      FROM {name}_0 JOIN {params} USING ({d.keys})
      UNION ALL
      SELECT {d.keys}, wa, wb, wg, n, i, l, b, list_append(c[2:], c[1] + wg * (y - l - c[1])), sse FROM (
        SELECT {d.keys}, wa, wb, wg, n, i, y, c, l, b0 + wb * (l - l0 - b0) AS b, sse + e * e AS sse FROM (
          SELECT *, l0 + b0 + wa * e AS l FROM (
            SELECT {d.keys}, wa, wb, wg, x.n, x.i, x.y, r.c, r.sse, r.l AS l0, r.b AS b0, x.y - r.l - r.b - r.c[1] AS e
            FROM {name}_r r JOIN {src} x USING ({d.keys}) WHERE x.i = r.i + 1)))),
    {name} AS (SELECT * FROM {name}_r WHERE i = n)"""


def carried_on(d: Dataset, h: int, src: str, name: str, m: int = 7) -> str:
    return f"{name} AS (SELECT {d.keys}, s, l + b * s + c[(s - 1) % {m} + 1] AS v FROM {src}, {steps(h)})"


def holt_winters(d: Dataset, h: int, src: str, name: str, a: float, b: float, g: float) -> str:
    weights = f"{name}_p AS (SELECT DISTINCT {d.keys}, {a} AS wa, {b} AS wb, {g} AS wg FROM {src})"
    return ", ".join([weights, smoothed(d, src, f"{name}_e", f"{name}_p"), carried_on(d, h, f"{name}_e", name)])


def exp_smoothing(d: Dataset, h: int, src: str, name: str) -> str:
    """The weights with the least squared error on a coarse grid, then on a fine one around it."""

    def best(of: str) -> str:
        return f"(SELECT * FROM {of} QUALIFY ROW_NUMBER() OVER (PARTITION BY {d.keys} ORDER BY sse) = 1)"

    def values(candidates) -> str:
        rows = ", ".join(f"({x}, {y}, {z})" for x, y, z in candidates)
        return f"(SELECT * FROM (VALUES {rows}) AS w(fa, fb, fg))"

    def clipped(w: str, f: str) -> str:
        return f"LEAST(GREATEST({w} * {f}, 0.0), 1.0) AS {w}"

    coarse = f"""{name}_p AS (SELECT {d.keys}, CAST(fa AS DOUBLE) AS wa, CAST(fb AS DOUBLE) AS wb, CAST(fg AS DOUBLE) AS wg
      FROM (SELECT DISTINCT {d.keys} FROM {src}), {values(COARSE)})"""
    fine = f"""{name}_f AS (SELECT {d.keys}, {clipped('wa', 'fa')}, {clipped('wb', 'fb')}, {clipped('wg', 'fg')}
      FROM {best(f'{name}_c')}, {values(FINE)})"""
    parts = [coarse, smoothed(d, src, f"{name}_c", f"{name}_p"), fine, smoothed(d, src, f"{name}_e", f"{name}_f")]
    return ", ".join([*parts, carried_on(d, h, best(f"{name}_e"), name)])


def ar1(d: Dataset, h: int, src: str, name: str) -> str:
    return f"""{name}_x AS (SELECT {d.keys}, i, n, y, LAG(y) OVER (PARTITION BY {d.keys} ORDER BY i) AS x FROM {src}),
    {name}_r AS (
      SELECT {d.keys}, 0 AS s, REGR_SLOPE(y, x) AS b, REGR_INTERCEPT(y, x) AS a,
        MAX(CASE WHEN i = n THEN y END) AS v FROM {name}_x GROUP BY {d.keys}
      UNION ALL SELECT {d.keys}, s + 1, b, a, a + b * v FROM {name}_r WHERE s < {h}),
    {name} AS (SELECT {d.keys}, s, v FROM {name}_r WHERE s > 0)"""


def arima_110(d: Dataset, h: int, src: str, name: str) -> str:
    """An AR(1) on the differences, added up from the last value."""
    return f"""{name}_w AS (SELECT {d.keys}, i, n, y, y - LAG(y) OVER (PARTITION BY {d.keys} ORDER BY i) AS w FROM {src}),
    {name}_x AS (SELECT {d.keys}, i, n, y, w, LAG(w) OVER (PARTITION BY {d.keys} ORDER BY i) AS x FROM {name}_w),
    {name}_r AS (
      SELECT {d.keys}, 0 AS s, REGR_SLOPE(w, x) AS b, REGR_INTERCEPT(w, x) AS a,
        MAX(CASE WHEN i = n THEN w END) AS w, MAX(CASE WHEN i = n THEN y END) AS v FROM {name}_x GROUP BY {d.keys}
      UNION ALL SELECT {d.keys}, s + 1, b, a, a + b * w, v + a + b * w FROM {name}_r WHERE s < {h}),
    {name} AS (SELECT {d.keys}, s, v FROM {name}_r WHERE s > 0)"""


def linear_trend(d: Dataset, h: int, src: str, name: str) -> str:
    return f"""{name} AS (SELECT {d.keys}, s, a + b * (n + s) AS v FROM (
      SELECT {d.keys}, n, REGR_SLOPE(y, i) AS b, REGR_INTERCEPT(y, i) AS a FROM {src} GROUP BY {d.keys}, n), {steps(h)})"""


def weekday_means(d: Dataset, h: int, src: str, name: str) -> str:
    return f"""{name} AS (SELECT {d.keys}, s, v FROM (
      SELECT {d.keys}, origin, dayofweek(t) AS dow, AVG(y) AS v FROM {src} GROUP BY ALL), {steps(h)}
      WHERE dayofweek(CAST(origin + CAST(s AS INTEGER) AS DATE)) = dow)"""


def least_squares(d: Dataset, src: str, name: str, columns: int, penalty: str = "0") -> str:
    """``<name>(keys, beta)``: normal equations of ``src(keys, i, n, y, v)`` up to ``n``, by Gauss-Jordan elimination.

    ``penalty`` is added to the entry in row ``a`` and column ``b``.
    """
    return f"""{name}_g AS (
      SELECT {d.keys}, a, b, SUM(v[a] * CASE WHEN b <= {columns} THEN v[b] ELSE y END) + {penalty} AS g
      FROM {src}, (SELECT UNNEST(range(1, {columns + 1})) AS a), (SELECT UNNEST(range(1, {columns + 2})) AS b)
      WHERE i <= n GROUP BY {d.keys}, a, b),
    {name}_m AS (
      SELECT {d.keys}, 1 AS k, LIST(r ORDER BY a) AS m
      FROM (SELECT {d.keys}, a, LIST(g ORDER BY b) AS r FROM {name}_g GROUP BY {d.keys}, a) GROUP BY {d.keys}
      UNION ALL
      SELECT {d.keys}, k + 1, list_transform(m, lambda r, a: CASE WHEN a = k
          THEN list_transform(r, lambda e: e / m[k][k])
          ELSE list_transform(r, lambda e, b: e - r[k] / m[k][k] * m[k][b]) END)
      FROM {name}_m WHERE k <= {columns}),
    {name} AS (
      SELECT {d.keys}, list_transform(m, lambda r: r[{columns + 1}]) AS beta FROM {name}_m WHERE k = {columns + 1})"""


def decomposed(d: Dataset, h: int, src: str, name: str) -> str:
    """Trend with 25 bends, weekly and yearly waves: penalised least squares.

    For histories of more than 730 days, where both waves are on.
    """
    columns = 2 + 25 + 2 * 3 + 2 * 10
    penalty = "CASE WHEN a <> b OR a <= 2 THEN 0.0 WHEN a <= 27 THEN POW(0.1 / 0.05, 2) ELSE POW(0.1 / 10, 2) END"

    def waves(order: int, period: float) -> str:
        angle = f"2 * PI() * k * day / {period}"
        return f"flatten(list_transform(range(1, {order + 1}), lambda k: [SIN({angle}), COS({angle})]))"

    return f"""{name}_i AS (
      SELECT {d.keys}, i, n, y, day, (i - 1) / (n - 1) AS u FROM (
        SELECT {d.keys}, i, n, y, t - DATE '1970-01-01' AS day FROM {src}
        UNION ALL
        SELECT {d.keys}, n + s, n, NULL, origin + CAST(s AS INTEGER) - DATE '1970-01-01'
        FROM (SELECT DISTINCT {d.keys}, n, origin FROM {src}), {steps(h)})),
    {name}_x AS (
      SELECT {d.keys}, i, n, y, list_concat(list_concat([1.0, u],
        list_transform(range(1, 26), lambda j: GREATEST(u - 0.8 * j / 25, 0.0))),
        list_concat({waves(3, 7)}, {waves(10, 365.25)})) AS v FROM {name}_i),
    {least_squares(d, f"{name}_x", f"{name}_b", columns, penalty)},
    {name} AS (
      SELECT {d.keys}, i - n AS s, list_dot_product(v, beta) AS v FROM {name}_x JOIN {name}_b USING ({d.keys}) WHERE i > n)"""


def arma_11(d: Dataset, h: int, src: str, name: str) -> str:
    """Two-stage least squares: the residuals of a long autoregression stand in for the shocks.

    The long order is the one for about 2,500 values.
    """
    long = 18
    return f"""{name}_w AS (SELECT {d.keys}, i, n, y - AVG(y) OVER (PARTITION BY {d.keys}) AS w,
        AVG(y) OVER (PARTITION BY {d.keys}) AS centre FROM {src}),
    {name}_1 AS (
      SELECT {d.keys}, i, n, w AS y, centre, list_concat([1.0], list_reverse(LIST(w) OVER (
        PARTITION BY {d.keys} ORDER BY i ROWS BETWEEN {long} PRECEDING AND 1 PRECEDING))) AS v
      FROM {name}_w QUALIFY i > {long}),
    {least_squares(d, f"{name}_1", f"{name}_1b", long + 1)},
    {name}_e AS (
      SELECT {d.keys}, i, n, centre, y, y - list_dot_product(v, beta) AS e FROM {name}_1 JOIN {name}_1b USING ({d.keys})),
    {name}_2 AS (
      SELECT {d.keys}, i, n, y, [1.0, LAG(y) OVER w, LAG(e) OVER w] AS v FROM {name}_e
      WINDOW w AS (PARTITION BY {d.keys} ORDER BY i) QUALIFY i > {long + 1}),
    {least_squares(d, f"{name}_2", f"{name}_2b", 3)},
    {name}_r AS (
      SELECT {d.keys}, 0 AS s, centre, beta, y AS w, e FROM {name}_e JOIN {name}_2b USING ({d.keys}) WHERE i = n
      UNION ALL SELECT {d.keys}, s + 1, centre, beta, beta[1] + beta[2] * w + beta[3] * e, 0 FROM {name}_r WHERE s < {h}),
    {name} AS (SELECT {d.keys}, s, w + centre AS v FROM {name}_r WHERE s > 0)"""


def arima_orders(d: Dataset, src: str, name: str) -> str:
    """``<name>_pick``: difference by the KPSS test, then 16 orders solved one by one; the least AICc that settles.

    The long order of the first regression is the one for 1,809 to 2,980 values.
    """
    k, long, top = d.keys, 22, 3
    lags = "LEAST(CAST(FLOOR(12 * POW(n / 100.0, 0.25)) AS BIGINT), n - 1)"

    def solid(phi: str) -> str:
        """Step-down of one to three coefficients."""
        two = "(ABS({1}) < 1 AND ABS({0} / (1 - {1})) < 1)"
        third = [f"(({phi}[{i}] + {phi}[3] * {phi}[{3 - i}]) / (1 - POW({phi}[3], 2)))" for i in (1, 2)]
        return f"""CASE len({phi}) WHEN 0 THEN TRUE WHEN 1 THEN ABS({phi}[1]) < 1 WHEN 2 THEN {two.format(f'{phi}[1]', f'{phi}[2]')}
          ELSE ABS({phi}[3]) < 1 AND {two.format(*third)} END"""

    return f"""{name}_c AS (SELECT {k}, i, n, y, y - AVG(y) OVER (PARTITION BY {k}) AS e FROM {src}),
    {name}_v AS (
      SELECT a.*, {lags} AS top, lag FROM {name}_c a JOIN (SELECT UNNEST(range(0, 41)) AS lag) ON lag <= {lags}),
    {name}_a AS (
      SELECT {k}, lag, a.n, a.top, SUM(a.e * b.e) AS c FROM {name}_v a JOIN (SELECT {k}, i + 0 AS j, e FROM {name}_c) b USING ({k})
      WHERE b.j = a.i - lag GROUP BY ALL),
    {name}_s AS (
      SELECT {k}, (SUM(CASE WHEN lag = 0 THEN c ELSE 2 * (1 - lag / (top + 1)) * c END)) / n AS variance FROM {name}_a GROUP BY {k}, n),
    {name}_q AS (
      SELECT {k}, n, SUM(cum * cum) AS cums, SUM(y * y) AS power FROM (
        SELECT {k}, n, y, SUM(e) OVER (PARTITION BY {k} ORDER BY i) AS cum FROM {name}_c) GROUP BY {k}, n),
    {name}_d AS (
      SELECT {k}, CASE WHEN variance > 1e-12 * GREATEST(1, power / n) AND cums / (CAST(n AS DOUBLE) * n * variance) > 0.463 THEN 1 ELSE 0 END AS d
      FROM {name}_s JOIN {name}_q USING ({k})),
    {name}_z AS (
      SELECT {k}, d, i - d AS i, n - d AS n, y, CASE d WHEN 0 THEN y ELSE y - LAG(y) OVER (PARTITION BY {k} ORDER BY i) END AS z
      FROM {src} JOIN {name}_d USING ({k})),
    {name}_w AS (
      SELECT {k}, d, i, n, y, centre, size, (z - centre) / size AS w FROM (
        SELECT *, AVG(z) OVER (PARTITION BY {k}) AS centre, STDDEV_POP(z) OVER (PARTITION BY {k}) AS size FROM {name}_z WHERE i >= 1)),
    {name}_1 AS (
      SELECT {k}, i, n, w AS y, list_concat([1.0], list_reverse(LIST(w) OVER (
        PARTITION BY {k} ORDER BY i ROWS BETWEEN {long} PRECEDING AND 1 PRECEDING))) AS v
      FROM {name}_w QUALIFY i > {long}),
    {least_squares(d, f"{name}_1", f"{name}_1b", long + 1)},
    {name}_e AS (
      SELECT {k}, i, n, y, y - list_dot_product(v, beta) AS e FROM {name}_1 JOIN {name}_1b USING ({k})),
    {name}_2 AS (
      SELECT {k}, i, n, y, list_concat([1.0], list_concat(list_reverse(LIST(y) OVER w), list_reverse(LIST(e) OVER w))) AS v FROM {name}_e
      WINDOW w AS (PARTITION BY {k} ORDER BY i ROWS BETWEEN {top} PRECEDING AND 1 PRECEDING) QUALIFY i > {long + top}),
    {name}_g AS (
      SELECT {k}, a, b, SUM(v[a] * CASE WHEN b <= 7 THEN v[b] ELSE y END) AS g
      FROM {name}_2, (SELECT UNNEST(range(1, 8)) AS a), (SELECT UNNEST(range(1, 9)) AS b) GROUP BY {k}, a, b),
    {name}_m AS (
      SELECT {k}, LIST(r ORDER BY a) AS m FROM (SELECT {k}, a, LIST(g ORDER BY b) AS r FROM {name}_g GROUP BY {k}, a) GROUP BY {k}),
    {name}_o AS (
      SELECT *, list_concat(range(1, p + 2), range({top + 2}, {top + 2} + q)) AS use
      FROM {name}_m, (SELECT UNNEST(range(0, {top + 1})) AS p), (SELECT UNNEST(range(0, {top + 1})) AS q)),
    {name}_x AS (
      SELECT {k}, p, q, use, m AS whole, 1 AS turn,
        list_transform(use, lambda a: list_append(list_transform(use, lambda b: m[a][b]), m[a][8])) AS m FROM {name}_o
      UNION ALL
      SELECT {k}, p, q, use, whole, turn + 1, list_transform(m, lambda r, a: CASE WHEN a = turn
          THEN list_transform(r, lambda e: e / m[turn][turn])
          ELSE list_transform(r, lambda e, b: e - r[turn] / m[turn][turn] * m[turn][b]) END)
      FROM {name}_x WHERE turn <= len(use)),
    {name}_y AS (
      SELECT {k}, p, q, beta, beta[2:p + 1] AS phi, rows, power,
        GREATEST((power - list_dot_product(beta, list_transform(use, lambda a: whole[a][8]))) / rows, 1e-12 * (1 + power / rows)) AS variance
      FROM (SELECT *, list_transform(m, lambda r: r[len(use) + 1]) AS beta FROM {name}_x WHERE turn = len(use) + 1)
        JOIN (SELECT {k}, COUNT(*) AS rows, SUM(y * y) AS power FROM {name}_2 GROUP BY {k}) USING ({k})),
    {name}_pick AS (
      SELECT {k}, d, p, q, beta FROM (
        SELECT *, rows * LN(variance) + 2 * (p + q + 2) + 2 * (p + q + 2) * (p + q + 3) / GREATEST(rows - p - q - 3, 1) AS score
        FROM {name}_y) JOIN {name}_d USING ({k}) WHERE {solid("phi")}
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY score, p, q) = 1)"""


def auto_arima(d: Dataset, h: int, src: str, name: str) -> str:
    """The chosen order carried on with shocks of 0."""
    k = d.keys
    return f"""{arima_orders(d, src, name)},
    {name}_l AS (
      SELECT {k}, MAX(CASE WHEN i = n THEN y END) AS last, MAX(centre) AS centre, MAX(size) AS size, LIST(w ORDER BY i DESC) FILTER (i > n - 3) AS wb
      FROM {name}_w GROUP BY {k}),
    {name}_r AS (
      SELECT {k}, 0 AS s, wb, eb, CAST(0 AS DOUBLE) AS total FROM {name}_l
        JOIN (SELECT {k}, LIST(e ORDER BY i DESC) FILTER (i > n - 3) AS eb FROM {name}_e GROUP BY {k}) USING ({k})
      UNION ALL
      SELECT {k}, s + 1, list_prepend(w, wb[:2]), list_prepend(CAST(0 AS DOUBLE), eb[:2]), total + w * size + centre FROM (
        SELECT {k}, s, wb, eb, total, size, centre, beta[1] + list_sum(list_append(list_transform(range(1, p + 1), lambda j: beta[1 + j] * wb[j]), 0))
          + list_sum(list_append(list_transform(range(1, q + 1), lambda j: beta[1 + p + j] * eb[j]), 0)) AS w
        FROM {name}_r r JOIN {name}_pick USING ({k}) JOIN (SELECT {k}, centre, size FROM {name}_l) USING ({k}) WHERE s < {h})),
    {name} AS (
      SELECT {k}, s, CASE d WHEN 0 THEN wb[1] * size + centre ELSE last + total END AS v
      FROM (SELECT {k}, s, wb, total FROM {name}_r WHERE s > 0) JOIN {name}_pick USING ({k})
        JOIN (SELECT {k}, last, centre, size FROM {name}_l) USING ({k}))"""


def seasonal_arima(d: Dataset, h: int, src: str, name: str, m: int = 7, turns: int = 12) -> str:
    """(1, 0, 0)(1, 1, 0) on the seasonal differences: the two coefficients solved in turn."""
    k = d.keys
    lags = (0, 1, m, m + 1)
    sums = [f"SUM(w{a}) AS s{a}" for a in lags] + [f"SUM(w{a} * w{b}) AS p{a}_{b}" for a in lags for b in lags if a <= b]

    def slope(held: str, near: int, far: int) -> tuple[str, str]:
        """Slope and constant of w0 - held w_far on w_near - held w_(near + far)."""
        both, x, t = m + 1, f"(s{near} - {held} * s{m + 1})", f"(s0 - {held} * s{far})"
        xx = f"(p{near}_{near} - 2 * {held} * p{near}_{both} + {held} * {held} * p{both}_{both})"
        xt = f"(p0_{near} - {held} * p{min(near, far)}_{max(near, far)} - {held} * p0_{both} + {held} * {held} * p{far}_{both})"
        b = f"((rows * {xt} - {x} * {t}) / (rows * {xx} - {x} * {x}))"
        return b, f"(({t} - {b} * {x}) / rows)"

    return f"""{name}_z AS (
      SELECT {k}, i - {m} AS i, n - {m} AS n, y, y - LAG(y, {m}) OVER (PARTITION BY {k} ORDER BY i) AS z FROM {src}),
    {name}_w AS (
      SELECT {k}, i, n, y, centre, size, (z - centre) / size AS w FROM (
        SELECT *, AVG(z) OVER (PARTITION BY {k}) AS centre, STDDEV_POP(z) OVER (PARTITION BY {k}) AS size FROM {name}_z WHERE i >= 1)),
    {name}_g AS (
      SELECT {k}, COUNT(*) AS rows, {', '.join(sums)} FROM (
        SELECT {k}, i, w AS w0, {', '.join(f'LAG(w, {a}) OVER o AS w{a}' for a in lags if a)} FROM {name}_w WINDOW o AS (PARTITION BY {k} ORDER BY i))
      WHERE i > {m + 1} GROUP BY {k}),
    {name}_t AS (
      SELECT *, 0 AS turn, CAST(0 AS DOUBLE) AS c, CAST(0 AS DOUBLE) AS f, CAST(0 AS DOUBLE) AS g FROM {name}_g
      UNION ALL
      SELECT * REPLACE ({slope('f', m, 1)[1]} AS c, {slope('f', m, 1)[0]} AS g) FROM (
        SELECT * REPLACE (turn + 1 AS turn, {slope('g', 1, m)[0]} AS f) FROM {name}_t WHERE turn < {turns})),
    {name}_r AS (
      SELECT {k}, CAST(0 AS BIGINT) AS s, MAX(centre) AS centre, MAX(size) AS size,
        LIST(w ORDER BY i DESC) FILTER (i > n - {m + 1}) AS wb, LIST(y ORDER BY i DESC) FILTER (i > n - {m}) AS yb
      FROM {name}_w GROUP BY {k}
      UNION ALL
      SELECT {k}, s + 1, centre, size, list_prepend(w, wb[:{m}]), list_prepend(w * size + centre + yb[{m}], yb[:{m - 1}]) FROM (
        SELECT r.*, c + f * wb[1] + g * wb[{m}] - f * g * wb[{m + 1}] AS w
        FROM {name}_r r JOIN (SELECT {k}, c, f, g FROM {name}_t WHERE turn = {turns}) USING ({k}) WHERE s < {h})),
    {name} AS (SELECT {k}, s, yb[1] AS v FROM {name}_r WHERE s > 0)"""


def theta(d: Dataset, h: int, src: str, name: str, thetas: tuple, modes: tuple, m: int = 7) -> str:
    """Additive season where its autocorrelation stands out, theta lines smoothed by recursion, the least one-step error."""
    k, half = d.keys, m // 2
    forms = " UNION ALL ".join(
        f"SELECT {i} AS form, CAST({q} AS DOUBLE) AS q, '{mode}' AS mode" for i, (mode, q) in enumerate((mode, q) for mode in modes for q in thetas)
    )
    lagged = ", ".join(f"SUM(e * LAG_{j}) / SUM(e * e) AS r{j}" for j in range(1, m + 1))
    return f"""{name}_e AS (SELECT {k}, i, n, y, y - AVG(y) OVER (PARTITION BY {k}) AS e FROM {src}),
    {name}_a AS (
      SELECT {k}, n, {lagged} FROM (
        SELECT *, {', '.join(f'COALESCE(LAG(e, {j}) OVER w, 0) AS LAG_{j}' for j in range(1, m + 1))} FROM {name}_e WINDOW w AS (PARTITION BY {k} ORDER BY i))
      GROUP BY {k}, n),
    {name}_s AS (
      SELECT {k}, r{m} > 1.645 * SQRT((1 + 2 * ({' + '.join(f'r{j} * r{j}' for j in range(1, m))})) / n) AS seasonal FROM {name}_a),
    {name}_p AS (
      SELECT {k}, place, CASE WHEN seasonal THEN p - AVG(p) OVER (PARTITION BY {k}) ELSE 0 END AS p FROM (
        SELECT {k}, (i - 1) % {m} AS place, AVG(y - trend) AS p FROM (
          SELECT {k}, i, n, y, AVG(y) OVER (PARTITION BY {k} ORDER BY i ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) AS trend FROM {src})
        WHERE i > {half} AND i <= n - {half} GROUP BY {k}, (i - 1) % {m}) JOIN {name}_s USING ({k})),
    {name}_z AS (
      SELECT {k}, i, n, y - p AS z FROM (SELECT *, (i - 1) % {m} AS place FROM {src}) JOIN {name}_p USING ({k}, place)),
    {name}_l AS (
      SELECT {k}, n, MIN(z) > 0 AS above, REGR_SLOPE(z, i) AS b, REGR_INTERCEPT(z, i) AS a,
        REGR_SLOPE(CASE WHEN z > 0 THEN LN(z) END, i) AS lb, REGR_INTERCEPT(CASE WHEN z > 0 THEN LN(z) END, i) AS la
      FROM {name}_z GROUP BY {k}, n),
    {name}_f AS (
      SELECT {k}, n, form, q, CASE WHEN mode = 'exponential' AND above THEN 1 ELSE 0 END AS bent, a, b, la, lb FROM {name}_l, ({forms})),
    {name}_t AS (
      SELECT {k}, i, n, form, q, z, trend, q * z + (1 - q) * trend AS away FROM (
        SELECT {k}, i, n, form, q, z, CASE bent WHEN 1 THEN EXP(la + lb * i) ELSE a + b * i END AS trend
        FROM {name}_z JOIN (SELECT {k}, form, q, bent, a, b, la, lb FROM {name}_f) USING ({k}))),
    {name}_r AS (
      SELECT {k}, form, n, i, alpha, away AS level, CAST(0 AS DOUBLE) AS sse, ABS(z - ((1 - 1 / q) * trend + away / q)) AS off
      FROM {name}_t, (SELECT CAST(UNNEST([{', '.join(str(round(0.05 * j, 2)) for j in range(1, 20))}]) AS DOUBLE) AS alpha) WHERE i = 1
      UNION ALL
      SELECT {k}, form, x.n, x.i, r.alpha, r.level + r.alpha * (x.away - r.level), r.sse + POW(x.away - r.level, 2),
        r.off + ABS(x.z - ((1 - 1 / x.q) * x.trend + r.level / x.q))
      FROM {name}_r r JOIN {name}_t x USING ({k}, form) WHERE x.i = r.i + 1),
    {name}_b AS (
      SELECT * FROM (SELECT * FROM {name}_r WHERE i = n QUALIFY ROW_NUMBER() OVER (PARTITION BY {k}, form ORDER BY sse, alpha) = 1)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY ROUND(off / n, 9), form) = 1),
    {name} AS (
      SELECT {k}, s, (1 - 1 / q) * CASE bent WHEN 1 THEN EXP(la + lb * (n + s)) ELSE a + b * (n + s) END + level / q + p AS v
      FROM (SELECT {k}, form, n, level, s, (n + s - 1) % {m} AS place FROM {name}_b, {steps(h)}) JOIN (SELECT {k}, form, q, bent, a, b, la, lb FROM {name}_f) USING ({k}, form)
        JOIN {name}_p USING ({k}, place))"""


def state_space(d: Dataset, src: str, name: str, settings: EtsSettings) -> str:
    """``<name>_b``: form and final states with the least AICc; every form and every weight in one recursion."""
    k, m = d.keys, settings.season
    rows = []
    for j, (error, trend, season) in enumerate(settings.wanted):
        for a, b, g, phi in settings.grid(trend, season).T:
            size = 3 + 2 * (trend != "N") + (trend == "Ad") + m * (season != "N")
            rows.append(f"({j}, 'ETS({error},{trend},{season})', '{error}', '{trend[:1]}', '{season}', {a}, {b}, {g}, {phi}, {size})")
    ratio = "CASE season WHEN 'M' THEN"
    return f"""{name}_w AS (
      SELECT * FROM (VALUES {', '.join(rows)}) AS w(form, label, error, trend, season, wa, wb, wg, phi, size)),
    {name}_0 AS (
      SELECT {k}, n, LIST(y ORDER BY i) FILTER (i <= {m}) AS ys, MIN(y) > 0 AS above,
        AVG(y) FILTER (i <= {m}) AS s1, AVG(y) FILTER (i > {m} AND i <= {2 * m}) AS s2,
        AVG(y) FILTER (i <= 5) AS p1, AVG(y) FILTER (i > 5 AND i <= 10) AS p2
      FROM {src} GROUP BY {k}, n),
    {name}_r AS (
      SELECT {k}, n, CAST(0 AS BIGINT) AS i, above, form, season, CAST(wa AS DOUBLE) AS wa, CAST(wb AS DOUBLE) AS wb, CAST(wg AS DOUBLE) AS wg, CAST(phi AS DOUBLE) AS phi,
        CASE season WHEN 'N' THEN p1 ELSE s1 END AS l,
        CASE WHEN trend = 'N' THEN 0 WHEN season = 'N' THEN (p2 - p1) / 5 ELSE (s2 - s1) / {m} END AS b,
        list_transform(ys, lambda y: CASE season WHEN 'N' THEN 0 WHEN 'A' THEN y - s1 ELSE y / s1 END) AS c,
        CAST(0 AS DOUBLE) AS sse, CAST(0 AS DOUBLE) AS rel, CAST(0 AS DOUBLE) AS logs, CAST('inf' AS DOUBLE) AS low
      FROM {name}_0, {name}_w WHERE above OR (error = 'A' AND season <> 'M')
      UNION ALL
      SELECT {k}, n, i, above, form, season, wa, wb, wg, phi, base + wa * step, growth + wb * step,
        list_append(c[2:], CASE season WHEN 'N' THEN 0 WHEN 'M' THEN c[1] + wg * e / base ELSE c[1] + wg * e END),
        sse + e * e, rel + POW(e / fit, 2), logs + LN(ABS(fit)), LEAST(low, fit) FROM (
          SELECT *, y - fit AS e, {ratio} (y - fit) / c[1] ELSE y - fit END AS step FROM (
            SELECT *, {ratio} base * c[1] ELSE base + c[1] END AS fit FROM (
              SELECT r.*, x.y, r.phi * r.b AS growth, r.l + r.phi * r.b AS base, x.i AS at_i
              FROM {name}_r r JOIN {src} x USING ({k}) WHERE x.i = r.i + 1))))""".replace(
        f"SELECT {k}, n, i, above, form, season, wa, wb, wg, phi, base + wa", f"SELECT {k}, n, at_i, above, form, season, wa, wb, wg, phi, base + wa"
    ) + f""",
    {name}_b AS (
      SELECT {k}, n, label, season, l, b, c, phi FROM (
        SELECT r.*, label, error, size, CASE error WHEN 'A' THEN n * LN(sse / n) WHEN 'M' THEN n * LN(rel / n) + 2 * logs END
          + 2 * size + 2 * size * (size + 1) / GREATEST(n - size - 1, 1) AS score
        FROM {name}_r r JOIN (SELECT DISTINCT form, label, error, size FROM {name}_w) USING (form)
        WHERE i = n AND (error = 'A' OR low > 0))
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY score, form) = 1)"""


def auto_ets(d: Dataset, h: int, src: str, name: str, settings: EtsSettings) -> str:
    m = settings.season
    total = "list_sum(list_transform(range(1, s + 1), lambda j: POW(phi, j)))"
    return f"""{state_space(d, src, name, settings)},
    {name} AS (
      SELECT {d.keys}, s, CASE season WHEN 'M' THEN (l + b * {total}) * c[(s - 1) % {m} + 1] ELSE l + b * {total} + c[(s - 1) % {m} + 1] END AS v
      FROM {name}_b, {steps(h)})"""


def local_level(d: Dataset, h: int, src: str, name: str, r: float, q: float) -> str:
    """The filter of a level that walks at random, with given variances of the scaled values."""
    k = d.keys
    return f"""{name}_z AS (
      SELECT {k}, i, n, centre, size, (y - centre) / size AS z FROM (
        SELECT *, AVG(y) OVER (PARTITION BY {k}) AS centre, STDDEV_POP(y) OVER (PARTITION BY {k}) AS size FROM {src})),
    {name}_r AS (
      SELECT {k}, i, n, centre, size, 1e6 / (1e6 + {r}) * z AS x, 1e6 - 1e6 / (1e6 + {r}) * 1e6 AS p FROM {name}_z WHERE i = 1
      UNION ALL
      SELECT {k}, i, n, centre, size, x + wide / (wide + {r}) * (z - x), wide - wide / (wide + {r}) * wide FROM (
        SELECT {k}, z.i, z.n, z.centre, z.size, z.z, r.x, r.p + {q} AS wide FROM {name}_r r JOIN {name}_z z USING ({k}) WHERE z.i = r.i + 1)),
    {name} AS (SELECT {k}, s, centre + size * x AS v FROM {name}_r, {steps(h)} WHERE i = n)"""


def strongest_waves(d: Dataset, h: int, src: str, name: str, keep: int) -> str:
    """The largest terms of the discrete Fourier sum of what a line leaves, added up again past the end."""
    k = d.keys
    angle = "2 * PI() * f * (i - 1) / n"
    return f"""{name}_l AS (SELECT {k}, REGR_SLOPE(y, i) AS slope, REGR_INTERCEPT(y, i) AS start FROM {src} GROUP BY {k}),
    {name}_z AS (SELECT {k}, i, n, y - start - slope * i AS z FROM {src} JOIN {name}_l USING ({k})),
    {name}_f AS (
      SELECT {k}, n, f, SUM(z * COS({angle})) AS a, SUM(z * SIN({angle})) AS b
      FROM (SELECT *, UNNEST(range(1, n // 2 + 1)) AS f FROM {name}_z) GROUP BY {k}, n, f),
    {name}_k AS (
      SELECT *, CASE WHEN 2 * f = n THEN 1 ELSE 2 END AS twice FROM {name}_f
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY SQRT(a * a + b * b) * CASE WHEN 2 * f = n THEN 1 ELSE 2 END DESC) <= {keep}),
    {name} AS (
      SELECT {k}, s, start + slope * (n + s) + wave AS v FROM (
        SELECT {k}, n, s, SUM(twice / n * (a * COS(2 * PI() * f * (s - 1) / n) + b * SIN(2 * PI() * f * (s - 1) / n))) AS wave
        FROM {name}_k, {steps(h)} GROUP BY {k}, n, s) JOIN {name}_l USING ({k}))"""


def complex_smoothing(d: Dataset, h: int, src: str, name: str, a0: float, a1: float) -> str:
    """Level and potential as two real numbers, over the values and then past them."""
    k = d.keys
    return f"""{name}_r AS (
      SELECT {k}, CAST(0 AS BIGINT) AS i, n, y AS l, y / 2 AS c FROM {src} WHERE i = 1
      UNION ALL
      SELECT {k}, i, n, l - (1 - {a1}) * c + ({a0} - {a1}) * e, l + (1 - {a0}) * c + ({a0} + {a1}) * e FROM (
        SELECT {k}, x.i, x.n, r.l, r.c, x.y - r.l AS e FROM {name}_r r JOIN {src} x USING ({k}) WHERE x.i = r.i + 1)),
    {name}_a AS (
      SELECT {k}, 1 AS s, l, c FROM {name}_r WHERE i = n
      UNION ALL SELECT {k}, s + 1, l - (1 - {a1}) * c, l + (1 - {a0}) * c FROM {name}_a WHERE s < {h}),
    {name} AS (SELECT {k}, s, l AS v FROM {name}_a)"""


def ensemble_weights(d: Dataset, src: str, name: str, origins: int, horizon: int, m: int = 7) -> str:
    """``<name>_w(keys, w1, w2)``: naive seasonal and naive mean from earlier origins, solved in closed form."""
    k = d.keys
    return f"""{name}_o AS (SELECT *, n - j * {horizon} AS o FROM {src}, (SELECT UNNEST(range(1, {origins + 1})) AS j)),
    {name}_x AS (
      SELECT {k}, j, t.i, t.y, f1.y AS f1, mean AS f2
      FROM {name}_o t JOIN (SELECT {k}, j, AVG(y) AS mean FROM {name}_o WHERE i <= o GROUP BY {k}, j) USING ({k}, j)
        JOIN (SELECT {k}, j, i, y FROM {name}_o) f1 USING ({k}, j)
      WHERE t.i > o AND t.i <= o + {horizon} AND f1.i = o - {m} + 1 + (t.i - o - 1) % {m}),
    {name}_g AS (
      SELECT {k}, SUM(f1 * f1) AS aa, SUM(f1 * f2) AS ab, SUM(f2 * f2) AS bb, SUM(f1 * y) AS ay, SUM(f2 * y) AS b_y
      FROM {name}_x GROUP BY {k}),
    {name}_w AS (
      SELECT {k}, CASE WHEN u1 > 0 AND u2 > 0 THEN u1 WHEN ay > 0 AND (b_y <= 0 OR ay * ay / aa > b_y * b_y / bb) THEN ay / aa
          WHEN b_y > 0 THEN 0 ELSE 0.5 END AS w1,
        CASE WHEN u1 > 0 AND u2 > 0 THEN u2 WHEN ay > 0 AND (b_y <= 0 OR ay * ay / aa > b_y * b_y / bb) THEN 0
          WHEN b_y > 0 THEN b_y / bb ELSE 0.5 END AS w2
      FROM (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS u1, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS u2 FROM {name}_g))"""


def ensemble(d: Dataset, h: int, src: str, name: str, origins: int, horizon: int) -> str:
    return f"""{ensemble_weights(d, src, name, origins, horizon)},
    {naive_seasonal(d, h, src, f"{name}_1")}, {naive_mean(d, h, src, f"{name}_2")},
    {name} AS (
      SELECT {d.keys}, s, w1 * a.v + w2 * b.v AS v FROM {name}_1 a JOIN {name}_2 b USING ({d.keys}, s) JOIN {name}_w USING ({d.keys}))"""


def warped(d: Dataset) -> str:
    """``warp(model, keys, value)``: the table of path costs cell by cell, the last ``m + 1`` cells kept as [cost, steps]."""
    k = f"model, {d.keys}"
    none = "[CAST('inf' AS DOUBLE), 0]"
    return f"""pairs AS (SELECT {k}, LIST(y ORDER BY t) AS ys, LIST(p ORDER BY t) AS ps, COUNT(*) AS m FROM joined GROUP BY {k}),
    warp_r AS (
      SELECT {k}, ys, ps, m, CAST(0 AS BIGINT) AS cell, list_append(list_transform(range(1, m + 1), lambda j: {none}), [CAST(0 AS DOUBLE), 0]) AS buf FROM pairs
      UNION ALL
      SELECT {k}, ys, ps, m, cell + 1, list_prepend([low[1] + ABS(ys[cell // m + 1] - ps[cell % m + 1]), low[2] + 1], buf[:m]) FROM (
        SELECT *, list_min([CASE WHEN cell % m > 0 THEN buf[1] ELSE {none} END, CASE WHEN cell >= m THEN buf[m] ELSE {none} END,
          CASE WHEN cell = 0 THEN buf[m + 1] WHEN cell > m AND cell % m > 0 THEN buf[m + 1] ELSE {none} END]) AS low
        FROM warp_r WHERE cell < m * m)),
    warp AS (SELECT {k}, buf[1][1] / buf[1][2] AS value FROM warp_r WHERE cell = m * m)"""


def holiday_means(d: Dataset, h: int, src: str, name: str) -> str:
    """Means of the plain days and of each kind of holiday, put on the days to come."""

    def kind(t: str) -> str:
        return f"""CASE WHEN day({t}) = c_nationkey % 24 + 1 THEN 'payday'
          WHEN c_nationkey < 12 AND month({t}) = 12 AND day({t}) > 24 THEN 'year end' ELSE '' END"""

    return f"""{name}_m AS (SELECT {d.keys}, {kind('t')} AS kind, AVG(y) AS v FROM {src} GROUP BY ALL),
    {name}_d AS (
      SELECT {d.keys}, s, {kind('t')} AS kind FROM (
        SELECT DISTINCT {d.keys}, s, CAST(origin + CAST(s AS INTEGER) AS DATE) AS t FROM {src}, {steps(h)})),
    {name} AS (
      SELECT {d.keys}, s, COALESCE(m.v, p.v) AS v FROM {name}_d LEFT JOIN {name}_m m USING ({d.keys}, kind)
        JOIN (SELECT {d.keys}, v FROM {name}_m WHERE kind = '') p USING ({d.keys}))"""


def lag_trees(
    d: Dataset, h: int, src: str, name: str, lags: int, rounds: int, depth: int, rate: float, penalty: float, l1: float, floor: float
) -> str:
    """``rounds`` trees of ``depth`` levels, every cut between two values tried: running sums over sorted lags.

    Level by level a row moves from node ``o`` to ``2 o`` or ``2 o + 1``; a node
    without a gaining cut sends all its rows left.
    """
    k = d.keys

    def soft(g: str) -> str:
        return f"SIGN({g}) * GREATEST(ABS({g}) - {l1}, 0)" if l1 else g

    def score(g: str, n: str) -> str:
        return f"POW({soft(g)}, 2) / ({n} + {penalty})"

    parts = [
        f"""{name}_v AS (
      SELECT {k}, y AS x, (y + LEAD(y) OVER (PARTITION BY {k} ORDER BY y)) / 2 AS cut FROM (SELECT DISTINCT {k}, y FROM {src}))""",
        f"""{name}_x AS (
      SELECT {k}, i, y, AVG(y) OVER (PARTITION BY {k}) AS base, x FROM (
        SELECT {k}, i, y, list_reverse(LIST(y) OVER (PARTITION BY {k} ORDER BY i ROWS BETWEEN {lags} PRECEDING AND 1 PRECEDING)) AS x
        FROM {src}) WHERE i > {lags})""",
        f"{name}_p0 AS (SELECT {k}, i, y, x, base AS p FROM {name}_x)",
    ]
    for r in range(1, rounds + 1):
        t = f"{name}_{r}"
        parts.append(f"{t}_0 AS (SELECT {k}, i, x, p - y AS g, CAST(1 AS BIGINT) AS o FROM {name}_p{r - 1})")
        for level in range(depth):
            parts.append(f"""{t}_c{level} AS (
      SELECT {k}, o, j, x, SUM(g) OVER w AS gl, SUM(n) OVER w AS nl, SUM(g) OVER (PARTITION BY {k}, o, j) AS gt,
        SUM(n) OVER (PARTITION BY {k}, o, j) AS nt, SUM(gg) OVER (PARTITION BY {k}, j) AS gg
      FROM (SELECT {k}, o, j, x[j] AS x, SUM(g) AS g, COUNT(*) AS n, SUM(g * g) AS gg
        FROM {t}_{level}, (SELECT UNNEST(range(1, {lags + 1})) AS j) GROUP BY ALL)
      WINDOW w AS (PARTITION BY {k}, o, j ORDER BY x))""")
            parts.append(f"""{t}_b{level} AS (
      SELECT {k}, o, j, cut FROM (
        SELECT *, MAX(gain) OVER (PARTITION BY {k}, o) AS top FROM (
          SELECT *, {score('gl', 'nl')} + {score('(gt - gl)', '(nt - nl)')} - {score('gt', 'nt')} AS gain
          FROM {t}_c{level} WHERE nl >= {floor} AND nt - nl >= {floor}) WHERE gain > 1e-9 * gg) JOIN {name}_v USING ({k}, x)
      WHERE gain >= top - 1e-9 * gg QUALIFY ROW_NUMBER() OVER (PARTITION BY {k}, o ORDER BY j, x) = 1)""")
            parts.append(f"""{t}_{level + 1} AS (
      SELECT {k}, i, a.x, g, 2 * o + CASE WHEN a.x[j] > cut THEN 1 ELSE 0 END AS o FROM {t}_{level} a LEFT JOIN {t}_b{level} USING ({k}, o))""")
        parts.append(f"{t}_w AS (SELECT {k}, o, -({soft('SUM(g)')}) / (COUNT(*) + {penalty}) * {rate} AS w FROM {t}_{depth} GROUP BY {k}, o)")
        parts.append(f"""{name}_p{r} AS (
      SELECT {k}, i, y, x, p + w AS p FROM {name}_p{r - 1} JOIN (SELECT {k}, i, o FROM {t}_{depth}) USING ({k}, i) JOIN {t}_w USING ({k}, o))""")
    cuts = " UNION ALL ".join(f"SELECT {k}, {r} AS r, o, j, cut FROM {name}_{r}_b{lv}" for r in range(1, rounds + 1) for lv in range(depth))
    leaves = " UNION ALL ".join(f"SELECT {k}, {r} AS r, o, w FROM {name}_{r}_w" for r in range(1, rounds + 1))
    at = "CAST(1 AS BIGINT)"
    for _ in range(depth):
        at = f"(2 * {at} + CASE WHEN buf[t.j[{at}]] > t.cut[{at}] THEN 1 ELSE 0 END)"
    parts.append(f"""{name}_t AS (
      SELECT {k}, LIST({{'j': j, 'cut': cut, 'w': w}}) AS trees FROM (
        SELECT {k}, r, LIST(COALESCE(j, 1) ORDER BY o) FILTER (o < {2**depth}) AS j,
          LIST(COALESCE(cut, CAST('inf' AS DOUBLE)) ORDER BY o) FILTER (o < {2**depth}) AS cut,
          LIST(COALESCE(w, 0) ORDER BY o) AS w
        FROM (SELECT DISTINCT {k} FROM {src}) CROSS JOIN (SELECT UNNEST(range(1, {rounds + 1})) AS r)
          CROSS JOIN (SELECT UNNEST(range(1, {2 ** (depth + 1)})) AS o) LEFT JOIN ({cuts}) USING ({k}, r, o) LEFT JOIN ({leaves}) USING ({k}, r, o) GROUP BY {k}, r) GROUP BY {k})""")
    parts.append(f"""{name}_r AS (
      SELECT {k}, CAST(0 AS BIGINT) AS s, LIST(y ORDER BY i DESC) FILTER (i > n - {lags}) AS buf FROM {src} GROUP BY {k}
      UNION ALL
      SELECT {k}, s + 1, list_prepend(base + list_sum(list_transform(trees, lambda t: t.w[{at}])), buf[:{lags - 1}])
      FROM {name}_r JOIN {name}_t USING ({k}) JOIN (SELECT DISTINCT {k}, base FROM {name}_x) USING ({k}) WHERE s < {h})""")
    parts.append(f"{name} AS (SELECT {k}, s, buf[1] AS v FROM {name}_r WHERE s > 0)")
    return ", ".join(parts)


def recent_mean(d: Dataset, h: int, src: str, name: str, last: int = 28) -> str:
    return f"""{name} AS (SELECT {d.keys}, s, v FROM (
      SELECT {d.keys}, AVG(y) AS v FROM {src} WHERE i > n - {last} GROUP BY {d.keys}), {steps(h)})"""


def forecast_query(d: Dataset, model: str, body: str, which: str = "full") -> str:
    """One model's forecast rows, rounded; ``body`` defines ``fc`` over ``h``."""
    origin = d.cut.end if which == "full" else d.cut.train_end
    return f"""WITH RECURSIVE {panel(d)}, {history(d, which)}, {body}
    SELECT '{model}' AS model, {d.keys}, CAST(DATE '{origin}' + CAST(s AS INTEGER) AS DATE) AS {d.spec.time},
      ROUND(v, 4) AS {d.spec.value} FROM fc"""


def champion_parts(d: Dataset, h: int) -> str:
    """``tested`` and ``future``: five models fitted on the training days and on all days."""
    parts = [panel(d), history(d, "train", "ht"), history(d, "full", "hf")]
    for src, out, origin in (("ht", "tested", d.cut.train_end), ("hf", "future", d.cut.end)):
        made = {
            "NaiveMean": naive_mean(d, h, src, f"{out}_1"),
            "NaiveSeasonal": naive_seasonal(d, h, src, f"{out}_2"),
            "NaiveDrift": naive_drift(d, h, src, f"{out}_3"),
            "NaiveMovingAverage": moving_average(d, h, src, f"{out}_4"),
            "Croston": croston(d, h, src, f"{out}_5", "sba"),
        }
        parts += made.values()
        rows = [
            f"SELECT '{model}' AS model, {d.keys}, CAST(DATE '{origin}' + CAST(s AS INTEGER) AS DATE) AS t, v FROM {out}_{j}"
            for j, model in enumerate(made, 1)
        ]
        parts.append(f"{out} AS ({' UNION ALL '.join(rows)})")
    parts.append(
        f"joined AS (SELECT model, {d.keys}, t, y, v AS p FROM panel JOIN tested USING ({d.keys}, t) WHERE split = 'test')"
    )
    return ", ".join(parts)


METRIC_SQL = {
    "rmse": "SQRT(AVG((y - p) * (y - p)))",
    "mae": "AVG(ABS(y - p))",
    "mape": "100 * AVG(CASE WHEN y <> 0 THEN ABS((y - p) / y) END)",
    "mse": "AVG((y - p) * (y - p))",
    "smape": "200 * AVG(CASE WHEN ABS(y) + ABS(p) > 0 THEN ABS(y - p) / (ABS(y) + ABS(p)) END)",
    "bias": "AVG(p - y)",
    "ope": "100 * ABS((SUM(y) - SUM(p)) / NULLIF(SUM(y), 0))",
    "rmsle": "CASE WHEN MIN(LEAST(y, p)) > -1 THEN SQRT(AVG(POW(LN(1 + y) - LN(1 + p), 2))) END",
    "worst_error": "MAX(ABS(y - p))",
    "marre": "100 * AVG(ABS(y - p)) / NULLIF(MAX(y) - MIN(y), 0)",
    "r2_score": "CASE WHEN VAR_POP(y) > 0 THEN 1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)) END",
    "coefficient_of_variation": "100 * SQRT(AVG((y - p) * (y - p))) / NULLIF(AVG(y), 0)",
    "mape_eps": "AVG(CASE WHEN y + 1 <> 0 THEN ABS(y - p) / (y + 1) END)",
}


def metrics(d: Dataset, names: list[str]) -> str:
    rows = [
        f"SELECT model, {d.keys}, '{n}' AS metric, {METRIC_SQL[n]} AS value FROM joined GROUP BY model, {d.keys}" for n in names
    ]
    return f"metrics AS ({' UNION ALL '.join(rows)})"


def best(d: Dataset, select_on: str) -> str:
    return f"""best AS (SELECT * FROM metrics WHERE metric = '{select_on}' AND value IS NOT NULL
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {d.keys} ORDER BY ROUND(value, 9), model) = 1)"""


def oracle_sql() -> dict[str, str]:
    p, q, r, s, e, w = DENSE, SPARSE, RECENT, SUPPLIERS, SHORT, WEEKLY
    t, y = p.spec.time, p.spec.value
    champion = f"WITH RECURSIVE {champion_parts(s, STEPS)}, {metrics(s, ['mape'])}, {best(s, 'mape')}"
    dense_scores = f"WITH RECURSIVE {champion_parts(p, STEPS)}"
    chosen = f"""SELECT future.model, {s.keys}, t AS {s.spec.time}, ROUND(v, 4) AS {s.spec.value}
      FROM future JOIN best USING (model, {s.keys})"""
    sql = {
        "filter_keys": f"""SELECT {p.keys}, COUNT(*) AS n_rows, SUM({y}) AS total FROM lineitem
            WHERE l_returnflag IN ('A', 'R') GROUP BY {p.keys}""",
        "window_clip": f"""SELECT {p.keys}, COUNT(*) AS n_rows, SUM({y}) AS total,
              CAST(MIN({t}) AS DATE) AS first_day, CAST(MAX({t}) AS DATE) AS last_day FROM lineitem
            WHERE {t} >= DATE '{r.cut.start}' AND {t} < DATE '{r.cut.execution_date}' GROUP BY {p.keys}""",
        "execution_window": f"""SELECT CAST(d + 1 AS DATE) AS execution_date, CAST(d + 1 - 728 AS DATE) AS start_date,
              CAST(d - 21 AS DATE) AS train_end, d AS end_date FROM (SELECT CAST(MAX({t}) AS DATE) AS d FROM lineitem)""",
        "daily_panel": f"WITH {panel(p)} SELECT {p.keys}, t AS {t}, y AS {y} FROM daily",
        "gap_fill": f"WITH {panel(q)} SELECT {q.keys}, t AS {q.spec.time}, y AS {q.spec.value} FROM panel",
        "gap_fill_weekly": f"""WITH daily AS (SELECT {w.keys}, CAST({t} AS DATE) AS t, {y} AS y FROM lineitem
              WHERE {t} >= DATE '{w.cut.start}' AND {t} < DATE '{w.cut.execution_date}'),
            span AS (SELECT {w.keys}, MIN(t) AS start FROM daily GROUP BY {w.keys}),
            grid AS (SELECT {w.keys}, CAST(UNNEST(generate_series(start, DATE '{w.cut.execution_date}' - 7, INTERVAL 7 DAY)) AS DATE) AS t
              FROM span)
            SELECT {w.keys}, grid.t AS {t}, COALESCE(SUM(daily.y), 0) AS {y} FROM grid LEFT JOIN daily
              ON {' AND '.join(f'grid.{k} = daily.{k}' for k in w.spec.keys)}
              AND daily.t >= grid.t AND daily.t < grid.t + 7
            GROUP BY ALL""".replace(f"SELECT {w.keys}, grid.t", f"SELECT {', '.join(f'grid.{k}' for k in w.spec.keys)}, grid.t"),
        "train_test_split": f"WITH {panel(r)} SELECT {r.keys}, t AS {t}, y AS {y}, split FROM panel",
        "series_vector": f"""WITH {panel(p)} SELECT {p.keys}, start, CAST(MAX(n) AS BIGINT) AS n,
              STRING_AGG(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY i) AS ys FROM panel GROUP BY {p.keys}, start""",
        "grid_check": f"""WITH days AS (SELECT {p.keys}, CAST({t} AS DATE) AS t, COUNT(*) AS c FROM lineitem GROUP BY ALL),
            gaps AS (SELECT *, t - LAG(t) OVER (PARTITION BY {p.keys} ORDER BY t) AS gap FROM days)
            SELECT {p.keys}, CAST(SUM(c) AS BIGINT) AS n_rows, CAST(MAX(t) - MIN(t) + 1 AS BIGINT) AS n_expected,
              CAST(COUNT(*) FILTER (gap <> 1) AS BIGINT) AS irregular, CAST(SUM(c - 1) AS BIGINT) AS duplicates,
              (COUNT(*) FILTER (gap <> 1) = 0 AND SUM(c - 1) = 0) AS regular
            FROM gaps GROUP BY {p.keys}""",
        "forecast_horizon": f"""WITH {panel(q)}, {history(q, 'train')}
            SELECT {q.keys}, s AS step, CAST(origin + CAST(s AS INTEGER) AS DATE) AS {q.spec.time}
            FROM (SELECT DISTINCT {q.keys}, origin FROM h), {steps(STEPS)}""",
        "lag_features": f"""WITH {panel(q)} SELECT {q.keys}, t AS {q.spec.time}, y AS {q.spec.value},
              {', '.join(f'LAG(y, {j}) OVER w AS lag_{j}' for j in range(1, 8))} FROM panel
            WINDOW w AS (PARTITION BY {q.keys} ORDER BY t) QUALIFY i > 7""",
        "series_count": f"SELECT COUNT(*) AS n_series FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM {q.from_sql})",
        "series_profile": f"""WITH {panel(q)} SELECT {q.keys}, start AS first_day,
              MAX(CASE WHEN y <> 0 THEN t END) AS last_active_day,
              CAST(COUNT(*) FILTER (y <> 0) AS BIGINT) AS n_active, ROUND(SUM(y), 2) AS total,
              CAST(COUNT(*) AS BIGINT) AS n_points, CAST(COUNT(*) FILTER (split = 'train') AS BIGINT) AS n_train,
              ROUND(1 - COUNT(*) FILTER (y <> 0) / COUNT(*), 6) AS zero_share,
              CONCAT_WS(',', {', '.join(f"CASE WHEN COUNT(*) FILTER (split = 'train') >= {need} THEN '{m}' END" for m, need in sorted(least_lengths(profiled_models()).items()))}) AS eligible
            FROM panel GROUP BY {q.keys}, start""",
        "score_join": f"""{dense_scores} SELECT model, {p.keys}, t AS {t}, y AS {y}, ROUND(p, 4) AS prediction
            FROM joined""",
        "metrics_long": f"""{dense_scores}, {metrics(p, ['rmse', 'mae', 'mape'])}
            SELECT model, {p.keys}, metric, ROUND(value, 4) AS value FROM metrics""",
        "metrics_extra": f"""{dense_scores}, {metrics(p, ['mse', 'smape', 'bias', 'ope', 'r2_score', 'rmsle', 'coefficient_of_variation', 'marre'])}
            SELECT model, {p.keys}, metric, ROUND(value, 4) AS value FROM metrics""",
        "mape_epsilon": f"""{dense_scores}, {metrics(p, ['mape_eps'])}
            SELECT model, {p.keys}, metric, ROUND(value, 4) AS value FROM metrics""",
        "coverage": f"""{dense_scores} SELECT model, {p.keys}, COUNT(*) AS n, COUNT(*) FILTER (y = 0) AS n_zero
            FROM joined GROUP BY model, {p.keys}""",
        "best_model": f"{champion} SELECT model, {s.keys}, metric, ROUND(value, 4) AS value FROM best",
        "champion_mean_error": f"{champion} SELECT ROUND(AVG(value), 4) AS mean_error, COUNT(*) AS n_series FROM best",
        "champion_forecast": f"{champion} {chosen}",
        "champion_plan": f"{champion} {chosen}",
        "metric_plugin": f"""{dense_scores}, {metrics(p, ['mae', 'worst_error'])}
            SELECT model, {p.keys}, metric, ROUND(value, 4) AS value FROM metrics""",
        "numbered_rows": f"""WITH {panel(p)} SELECT ROW_NUMBER() OVER (ORDER BY {p.keys}, t) - 1 AS row, {p.keys}, t AS {t}, y AS {y}
            FROM daily""",
        "no_forecast": f"""WITH {panel(SPARSE)}
          SELECT {SPARSE.keys}, CASE WHEN COUNT(*) FILTER (WHERE split = 'train') = 0
              THEN 'too few training days for every model'
              ELSE 'no model has a defined mape on the test days' END AS reason
          FROM panel GROUP BY {SPARSE.keys}
          HAVING COUNT(*) FILTER (WHERE split = 'train') = 0 OR COUNT(*) FILTER (WHERE split = 'test' AND y <> 0) = 0""",
        "workflow_tables": f"{champion} {chosen}",
        "workflow_no_forecast": f"""WITH {panel(q)}, f AS (
            SELECT {q.keys}, COUNT(*) FILTER (split = 'train') AS n_train, MAX(CASE WHEN i = n THEN y END) AS last,
              COALESCE(MAX(CASE WHEN t = DATE '{q.cut.train_end}' THEN y END), 0) AS last_train, COUNT(*) FILTER (split = 'test' AND y <> 0) AS n_test
            FROM panel GROUP BY {q.keys})
          SELECT {q.keys}, CASE WHEN last = 0 THEN 'Picky: ValueError: ends idle' WHEN n_train = 0 THEN 'Picky: needs 1 values'
            WHEN last_train = 0 THEN 'Picky: ValueError: ends idle' ELSE 'no model has a defined mape on the test days' END AS reason
          FROM f WHERE last = 0 OR last_train = 0 OR n_test = 0""",
        "workflow_log": f"""WITH RECURSIVE {champion_parts(p, STEPS)}, {metrics(p, ['mape'])}, {best(p, 'mape')}
          SELECT step, CASE step WHEN 'evaluate' THEN 'mape' END AS metric, CASE step WHEN 'evaluate' THEN value END AS value, 21 AS test_size
          FROM (SELECT UNNEST(['create_database', 'ingest', 'split', 'model', 'evaluate']) AS step), (SELECT ROUND(AVG(value), 4) AS value FROM best)""",
        "table_description": f"""WITH {panel(p)}, counts AS (SELECT COUNT(l_returnflag) AS a, COUNT(l_linestatus) AS b, COUNT(t) AS c, COUNT(y) AS d FROM daily)
          SELECT 'l_returnflag' AS "column", 'string' AS type, a AS n_values, TRUE AS in_place FROM counts
          UNION ALL SELECT 'l_linestatus', 'string', b, TRUE FROM counts
          UNION ALL SELECT '{t}', 'date', c, TRUE FROM counts UNION ALL SELECT '{y}', 'double', d, TRUE FROM counts""",
        "forecast_on_test": f"""WITH RECURSIVE {champion_parts(p, STEPS)}
            SELECT model, {p.keys}, t AS {t}, ROUND(v, 4) AS {y} FROM tested""",
        "all_models_forecast": f"""WITH RECURSIVE {champion_parts(s, STEPS)}
            SELECT model, {s.keys}, t AS {s.spec.time}, ROUND(v, 4) AS {s.spec.value} FROM future""",
        "frame_diff": f"""WITH {panel(q)} SELECT 'actual' AS side, {q.keys}, t AS {q.spec.time}, y AS {q.spec.value},
              CAST(1 AS BIGINT) AS copies FROM panel WHERE y = 0
              AND NOT EXISTS (SELECT 1 FROM daily WHERE {' AND '.join(f'daily.{k} = panel.{k}' for k in q.spec.keys)}
                AND daily.t = panel.t)""",
        "arima_orders": f"""WITH RECURSIVE {panel(s)}, {history(s, 'full')}, {arima_orders(s, 'h', 'o')}
            SELECT {s.keys}, CAST(p AS INTEGER) AS ar, d AS diff, CAST(q AS INTEGER) AS ma, 0 AS season_ar, 0 AS season_diff, 0 AS season_ma
            FROM o_pick""",
        "left_out": f"""WITH f AS (SELECT *, CAST({t} AS DATE) AS t, MIN(CAST({t} AS DATE)) OVER (PARTITION BY {w.keys}) AS start FROM lineitem
              WHERE {t} >= DATE '{w.cut.start}' AND {t} < DATE '{w.cut.execution_date}')
            SELECT {w.keys}, COUNT(*) AS n_rows, SUM({y}) AS total, MIN(t) AS first_day FROM f
            WHERE t >= start + CAST((DATE '{w.cut.execution_date}' - start) // 7 * 7 AS INTEGER) GROUP BY {w.keys}""",
        "ets_forms": f"""WITH RECURSIVE {panel(p)}, {history(p, 'full')}, {state_space(p, 'h', 'e', SEARCHED)}
            SELECT {p.keys}, label AS form FROM e_b""",
        "ensemble_weights": f"""WITH {panel(s)}, {history(s, 'full')}, {ensemble_weights(s, 'h', 'e', 3, STEPS)}
            SELECT {s.keys}, 'NaiveSeasonal' AS member, ROUND(w1, 6) AS weight FROM e_w
            UNION ALL SELECT {s.keys}, 'NaiveMean', ROUND(w2, 6) FROM e_w""",
        "metric_warped": f"""{dense_scores}, {warped(p)} SELECT model, {p.keys}, 'dtw_metric' AS metric, ROUND(value, 4) AS value FROM warp""",
        "tree_windows": f"""WITH {panel(s)}, {history(s, 'train')},
            scaled AS (SELECT {s.keys}, i, y / AVG(ABS(y)) OVER (PARTITION BY {s.keys}) AS y FROM h)
            SELECT COUNT(*) AS n_windows, ROUND(SUM(y), 3) AS labels, ROUND(SUM(l7), 3) AS oldest,
              ROUND(SUM(l1), 3) AS newest, ROUND(SUM(y * l1), 3) AS with_newest
            FROM (SELECT y, LAG(y, 7) OVER w AS l7, LAG(y) OVER w AS l1 FROM scaled
              WINDOW w AS (PARTITION BY {s.keys} ORDER BY i)) WHERE l7 IS NOT NULL""",
        "csv_scan": f"""SELECT {p.keys}, COUNT(*) AS n_rows, SUM({y}) AS total, CAST(MIN({t}) AS DATE) AS first_day
            FROM lineitem GROUP BY {p.keys}""",
        "fc_plugin_report": f"""WITH {panel(q)} SELECT {q.keys},
              MAX(CASE WHEN i = n AND y <> 0 THEN y END) AS first_forecast,
              MAX(CASE WHEN i = n AND y = 0 THEN 'ValueError: ends idle' END) AS error
            FROM panel GROUP BY {q.keys}""",
    }
    forecasts = {
        "fc_naive_mean": (p, "NaiveMean", naive_mean(p, STEPS, "h", "fc")),
        "fc_seasonal_naive": (e, "NaiveSeasonal", naive_seasonal(e, STEPS, "h", "fc")),
        "fc_drift": (p, "NaiveDrift", naive_drift(p, STEPS, "h", "fc")),
        "fc_moving_average": (s, "NaiveMovingAverage", moving_average(s, STEPS, "h", "fc")),
        "fc_croston_sba": (q, "Croston", croston(q, STEPS, "h", "fc", "sba")),
        "fc_croston_classic": (q, "Croston", croston(q, STEPS, "h", "fc", "classic")),
        "fc_croston_tsb": (q, "Croston", croston(q, STEPS, "h", "fc", "tsb")),
        "fc_croston_optimized": (s, "Croston", croston_optimized(s, STEPS, "h", "fc")),
        "fc_holt_winters": (p, "ExponentialSmoothing", holt_winters(p, STEPS, "h", "fc", 0.3, 0.1, 0.2)),
        "fc_exp_smoothing": (p, "ExponentialSmoothing", exp_smoothing(p, STEPS, "h", "fc")),
        "fc_arima_110": (p, "ARIMA", arima_110(p, STEPS, "h", "fc")),
        "fc_arma_11": (p, "ARMA11", arma_11(p, STEPS, "h", "fc")),
        "fc_ar1": (p, "LinearRegressionModel", ar1(p, STEPS, "h", "fc")),
        "fc_linear_trend": (q, "Prophet", linear_trend(q, STEPS, "h", "fc")),
        "fc_decomposed": (p, "Prophet", decomposed(p, STEPS, "h", "fc")),
        "fc_weekday_means": (s, "Prophet", weekday_means(s, STEPS, "h", "fc")),
        "fc_auto_arima": (s, "AutoARIMA", auto_arima(s, STEPS, "h", "fc")),
        "fc_seasonal_arima": (p, "ARIMA", seasonal_arima(p, STEPS, "h", "fc")),
        "fc_holidays": (q, "Prophet", holiday_means(q, STEPS, "h", "fc")),
        "fc_theta": (p, "Theta", theta(p, STEPS, "h", "fc", (2.0,), ("linear",))),
        "fc_four_theta": (p, "FourTheta", theta(p, STEPS, "h", "fc", (1.0, 2.0, 3.0), ("linear", "exponential"))),
        "fc_damped": (p, "AutoETS", auto_ets(p, STEPS, "h", "fc", DAMPED)),
        "fc_auto_ets": (p, "AutoETS", auto_ets(p, STEPS, "h", "fc", SEARCHED)),
        "fc_local_level": (p, "KalmanForecaster", local_level(p, STEPS, "h", "fc", 0.8, 0.05)),
        "fc_waves": (p, "FFT", strongest_waves(p, STEPS, "h", "fc", 10)),
        "fc_complex_smoothing": (p, "AutoCES", complex_smoothing(p, STEPS, "h", "fc", 1.3, 0.98)),
        "fc_ensemble": (s, "Ensemble", ensemble(s, STEPS, "h", "fc", 3, STEPS)),
        "fc_boosted_stumps": (p, "XGBModel", lag_trees(p, STEPS, "h", "fc", 7, 5, 1, 0.3, 1, 25, 1)),
        "fc_boosted_trees": (p, "XGBModel", lag_trees(p, STEPS, "h", "fc", 5, 3, 2, 0.5, 10, 0, 30)),
        "fc_single_tree": (q, "RandomForest", lag_trees(q, STEPS, "h", "fc", 7, 1, 3, 1, 0, 0, 5)),
        "fc_plugin": (s, "RecentMean", recent_mean(s, STEPS, "h", "fc")),
    }
    return sql | {name: forecast_query(*parts) for name, parts in forecasts.items()}
