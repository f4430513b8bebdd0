"""DuckDB SQL for robust STL: the same published procedure, as a chain of materialised CTEs.

Independent of the NumPy kernel: every loess is a join of evaluation points with the rows in
their windows and one aggregation of weighted moments (distances are taken from the
evaluation point, so that sums stay small).
"""

from __future__ import annotations

import math


def _odd(x: int) -> int:
    return x if x % 2 else x + 1


def _loess(points: str, src: str, keys: str, span: int, weighted: bool) -> str:
    """``fit`` of every evaluation point. ``points``: keys, x, lo, width, n; ``src``: keys, pos, v
    and, if weighted, rw."""
    on = " AND ".join(f"e.{k} = s.{k}" for k in keys.split(", "))
    by = ", ".join(f"e.{k}" for k in keys.split(", "))
    rw = " * rw" if weighted else ""
    return f"""SELECT {keys}, x, n,
       CASE WHEN w > 0 THEN my + CASE WHEN h > 0 AND sqrt(greatest(c, 0)) > 0.001 * (n - 1) THEN -md / c * (mdy - md * my)
                                     ELSE 0 END END AS fit
FROM (SELECT *, mdd - md * md AS c FROM (
  SELECT {keys}, x, n, h, w, wd / w AS md, wdd / w AS mdd, wy / w AS my, wdy / w AS mdy FROM (
    SELECT {by}, e.x, e.n, any_value(e.h) AS h, sum(k) AS w, sum(k * d) AS wd, sum(k * d * d) AS wdd,
           sum(k * v) AS wy, sum(k * d * v) AS wdy
    FROM (SELECT {by}, e.x, e.n, e.h, s.v, CAST(s.pos - e.x AS DOUBLE) AS d,
                 CASE WHEN abs(s.pos - e.x) <= 0.001 * e.h THEN 1.0
                      WHEN abs(s.pos - e.x) <= 0.999 * e.h THEN power(1 - power(abs(s.pos - e.x) / e.h, 3), 3)
                      ELSE 0.0 END{rw} AS k
          FROM (SELECT *, greatest(x - lo, lo + width - 1 - x)
                          + CASE WHEN {span} > n THEN ({span} - n) // 2 ELSE 0 END + 0.0 AS h FROM {points}) e
          JOIN {src} s ON {on} AND s.pos BETWEEN e.lo AND e.lo + e.width - 1) e
    GROUP BY {by}, e.x, e.n)))"""


def _windows(src: str, keys: str, span: int) -> str:
    """Evaluation at every position of ``src`` (keys, pos, n)."""
    half = (span + 1) // 2
    return f"""(SELECT {keys}, pos AS x, n,
       CASE WHEN {span} >= n THEN 1 ELSE least(greatest(pos - {half} + 1, 1), n - {span} + 1) END AS lo,
       least({span}, n) AS width FROM {src})"""


def stl_ctes(filled: str, period: int, seasonal: int = 7, inner: int = 2, outer: int = 15) -> tuple[str, str]:
    """CTEs that decompose ``filled`` (metric, ts, filled), and the name of the last: metric, i,
    n, y, s (seasonal), t (trend)."""
    p = period
    trend, low = _odd(math.ceil(1.5 * p / (1 - 1.5 / seasonal))), _odd(p + 1)
    ctes = [("stl_in", f"""SELECT metric, row_number() OVER w AS i, count(*) OVER (PARTITION BY metric) AS n,
       filled AS y, 0.0 AS t, 0.0 AS s, 1.0 AS rw FROM {filled} WINDOW w AS (PARTITION BY metric ORDER BY ts)""")]

    def add(name: str, sql: str) -> str:
        ctes.append((name, sql))
        return name

    last = "stl_in"
    for k in range(outer + 1):
        for r in range(inner):
            q = f"_{k}_{r}"
            sub = add(f"sub{q}", f"""SELECT metric, (i - 1) % {p} AS phase, (i - 1) // {p} + 1 AS pos, y - t AS v, rw,
       count(*) OVER (PARTITION BY metric, (i - 1) % {p}) AS n FROM {last}""")
            ends = f"""(SELECT * FROM {_windows(sub, 'metric, phase', seasonal)}
      UNION ALL SELECT DISTINCT metric, phase, 0, n, 1, least({seasonal}, n) FROM {sub}
      UNION ALL SELECT DISTINCT metric, phase, n + 1, n, greatest(1, n - {seasonal} + 1),
                       n - greatest(1, n - {seasonal} + 1) + 1 FROM {sub})"""
            fit = add(f"fit{q}", _loess(ends, sub, "metric, phase", seasonal, True))
            cycle = add(f"cyc{q}", f"""SELECT metric, phase + {p} * x + 1 AS m,
       coalesce(g, CASE WHEN x = 0 THEN lead(g) OVER w ELSE lag(g) OVER w END) AS v
FROM (SELECT f.metric, f.phase, f.x, coalesce(f.fit, u.v) AS g
      FROM {fit} f LEFT JOIN {sub} u ON u.metric = f.metric AND u.phase = f.phase AND u.pos = f.x)
WINDOW w AS (PARTITION BY metric, phase ORDER BY x)""")
            src = cycle
            for step, length in enumerate((p, p, 3)):
                src = add(f"ma{step}{q}", f"""SELECT metric, m, v FROM (
  SELECT metric, m, avg(v) OVER w AS v, count(*) OVER w AS c FROM {src}
  WINDOW w AS (PARTITION BY metric ORDER BY m ROWS BETWEEN CURRENT ROW AND {length - 1} FOLLOWING))
WHERE c = {length}""")
            smooth = add(f"lowin{q}", f"SELECT metric, m AS pos, v, count(*) OVER (PARTITION BY metric) AS n FROM {src}")
            lows = add(f"low{q}", _loess(_windows(smooth, "metric", low), smooth, "metric", low, False))
            sea = add(f"sea{q}", f"""SELECT b.metric, b.i AS pos, b.i, b.n, b.y, b.rw, c.v - l.fit AS s, b.y - (c.v - l.fit) AS v
FROM {last} b JOIN {cycle} c ON c.metric = b.metric AND c.m = b.i + {p} JOIN {lows} l ON l.metric = b.metric AND l.x = b.i""")
            tre = add(f"tre{q}", _loess(_windows(sea, "metric", trend), sea, "metric", trend, True))
            last = add(f"dec{q}", f"""SELECT b.metric, b.i, b.n, b.y, coalesce(t.fit, b.v) AS t, b.s, b.rw
FROM {sea} b JOIN {tre} t ON t.metric = b.metric AND t.x = b.i""")
        if k < outer:
            last = add(f"rob_{k}", f"""SELECT metric, i, n, y, t, s,
       CASE WHEN r <= 0.001 * h THEN 1.0 WHEN r <= 0.999 * h THEN power(1 - power(r / h, 2), 2) ELSE 0.0 END AS rw
FROM (SELECT *, 6 * median(r) OVER (PARTITION BY metric) AS h FROM (SELECT *, abs(y - t - s) AS r FROM {last}))""")
    return ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes), last
