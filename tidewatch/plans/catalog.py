"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every query reads the given tables (or data Spark derives from them) in full. Outputs are
normalised for comparison: doubles rounded to 6 places (+0.0 folds negative zero), dates
as 'yyyy-MM-dd' text and timestamps as 'yyyy-MM-dd HH:mm:ss' text. The oracle SQL does the
same with ``round``/``strftime``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, TimestampNTZType, TimestampType

from ..functions.numeric import finite_or_null
from ..operators.rolling import detect_anomalies, rolling_stats
from ..options import DetectOptions
from ..sources.metrics import to_long
from . import tables as T
from .stl_sql import stl_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Normalise types for the side-by-side comparison."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def _unpivot_sql(cube_cte: str, metrics: list[str], ids: str = "ts") -> str:
    return (f"SELECT {ids}, metric, value FROM {cube_cte} "
            f"UNPIVOT INCLUDE NULLS (value FOR metric IN ({', '.join(metrics)}))")


def _rolling_sql(long_cte: str, w: int, mp: int, partition: str = "metric",
                 col: str = "value") -> str:
    return f"""SELECT *, CASE WHEN n_obs >= {mp} AND sd <> 0 THEN ({col} - m) / sd END AS z
FROM (SELECT *, count({col}) OVER w AS n_obs,
             CASE WHEN count({col}) OVER w >= {mp} THEN avg({col}) OVER w END AS m,
             CASE WHEN count({col}) OVER w >= {mp} THEN stddev_pop({col}) OVER w END AS sd
      FROM {long_cte}
      WINDOW w AS (PARTITION BY {partition} ORDER BY ts ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW))"""


def _anomaly_select_sql(scored: str, t: float, keys: str = "", ts_fmt: str = "day",
                        mode: str = "zscore") -> str:
    ts_expr = day("ts") if ts_fmt == "day" else "strftime(ts, '%Y-%m-%d %H:%M:%S')"
    return f"""SELECT {keys}metric, {ts_expr} AS timestamp, {r6('value')} AS actual,
       {r6('coalesce(m, 0)')} AS rolling_mean, {r6('coalesce(sd, 0)')} AS rolling_std,
       {r6('z')} AS z_score, CASE WHEN z > 0 THEN 'up' ELSE 'down' END AS direction,
       '{mode}' AS detection_mode_used
FROM {scored} WHERE value IS NOT NULL AND z IS NOT NULL AND abs(z) > {t}"""


FLAGSHIP = DetectOptions(window_size=30, z_threshold=3.0)


# ---------------------------------------------------------------------------
# core: cube, long form, rolling statistics, z-score
# ---------------------------------------------------------------------------

@register("daily_metric_cube", f"""
SELECT {day('ts')} AS ts, {r6('revenue')} AS revenue, {r6('order_count')} AS order_count,
       {r6('avg_price')} AS avg_price, {r6('max_price')} AS max_price, {r6('f_share')} AS f_share
FROM ({T.ORDERS_DAILY_SQL})""")
def q_daily_metric_cube(spark, sf_dir):
    return finish(T.orders_daily(spark, sf_dir))


@register("rolling_baseline", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
scored AS ({_rolling_sql('long', 30, 30)})
SELECT metric, {day('ts')} AS ts, {r6('value')} AS value, n_obs,
       {r6('m')} AS rolling_mean, {r6('sd')} AS rolling_std, {r6('z')} AS z
FROM scored""")
def q_rolling_baseline(spark, sf_dir):
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    return finish(rolling_stats(long, FLAGSHIP))


@register("zscore_anomalies", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
scored AS ({_rolling_sql('long', 30, 30)})
{_anomaly_select_sql('scored', 3.0)}""")
def q_zscore_anomalies(spark, sf_dir):
    anomalies = detect_anomalies(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS,
                                 options=FLAGSHIP)
    return finish(anomalies.drop("seasonal_period"))


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _sql) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_fn, sql) in REGISTRY.items() if sql is not None}


# ---------------------------------------------------------------------------
# shared pieces for the annotate / co-occurrence / suppression queries
# ---------------------------------------------------------------------------

from ..functions.text import (CO_OCCURRENCE_NOTE, IMPACT_FALLBACK, IMPACT_RULES,  # noqa: E402
                              NEAR_ZERO_TEXT, SEVERITY_BANDS, SEVERITY_FALLBACK)
from ..operators.annotate import SUMMARY_COLUMNS, summarize  # noqa: E402
from ..operators.cooccur import attach_notes, co_occurrences  # noqa: E402
from ..operators.suppress import apply_suppression, observed_from_metrics  # noqa: E402
from ..options import CoOccurrenceOptions, SuppressOptions  # noqa: E402
from ..session import cut_lineage  # noqa: E402

RUN_CUTOFF = "1998-05-01"      # run 1 sees days before it, run 2 the days from it on
RUN_TS = "2024-06-30 00:00:00"  # injected run clock
DELTA = 0.25                    # small enough for escalations in the given tables


def flagship_anomalies(spark, sf_dir, where: str | None = None):
    """Flagship anomalies, materialised once: summaries, co-occurrence self-joins and the
    suppression loop all read them, so the detection shuffle runs a single time."""
    cube = T.orders_daily(spark, sf_dir)
    if where is not None:
        cube = cube.filter(where)
    return cut_lineage(detect_anomalies(cube, "ts", T.ORDER_METRICS, options=FLAGSHIP))


def _anoms_cte(where: str = "", sfx: str = "") -> str:
    """cube/long/scored/anom CTEs of the flagship (names carry ``sfx``)."""
    cond = f"WHERE {where}" if where else ""
    return f"""cube{sfx} AS (SELECT * FROM ({T.ORDERS_DAILY_SQL}) {cond}),
long{sfx} AS ({_unpivot_sql(f'cube{sfx}', T.ORDER_METRICS)}),
scored{sfx} AS ({_rolling_sql(f'long{sfx}', 30, 30)}),
anom{sfx} AS (SELECT metric, ts, value, coalesce(m, 0) AS m, z, abs(z) AS az,
                row_number() OVER (PARTITION BY metric ORDER BY ts) AS rn
         FROM scored{sfx} WHERE value IS NOT NULL AND z IS NOT NULL AND abs(z) > 3)"""


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _severity_sql(z: str) -> str:
    parts = " ".join(f"WHEN abs({z}) >= {b} THEN {_sql_str(lbl)}" for b, lbl in SEVERITY_BANDS)
    return f"CASE {parts} ELSE {_sql_str(SEVERITY_FALLBACK)} END"


def _impact_sql(metric: str) -> str:
    whens = []
    for needles, label in IMPACT_RULES:
        cond = " OR ".join(f"contains(lower({metric}), {_sql_str(n)})" for n in needles)
        whens.append(f"WHEN {cond} THEN {_sql_str(label)}")
    return f"CASE {' '.join(whens)} ELSE {_sql_str(IMPACT_FALLBACK)} END"


def _summary_cols_sql(a: str = "a") -> str:
    pct = f"printf('%+.1f', ({a}.value - {a}.m) / {a}.m * 100.0)"
    pct_text = (f"CASE WHEN {a}.m <> 0 AND abs({a}.m) >= 1e-9 THEN {pct} || '% vs baseline' "
                f"ELSE {_sql_str(NEAR_ZERO_TEXT)} END")
    return f"""{a}.metric, strftime({a}.ts, '%Y-%m-%d') AS timestamp,
  CASE WHEN {a}.z > 0 THEN 'up' ELSE 'down' END AS direction,
  {_severity_sql(f'{a}.z')} AS severity, {r6(f'{a}.z')} AS z_score, {r6(f'{a}.value')} AS actual,
  {r6(f'{a}.m')} AS rolling_mean,
  {a}.metric || ' ' || CASE WHEN {a}.z > 0 THEN 'spiked' ELSE 'dropped' END || ' from a baseline of '
    || printf('%.2f', {a}.m) || ' to ' || printf('%.2f', {a}.value) || ' (' || {pct_text} || ') on '
    || strftime({a}.ts, '%Y-%m-%d') || '.' AS what_changed,
  'Z-score of ' || printf('%+.2f', {a}.z) || ' - this is ' || {_severity_sql(f'{a}.z')}
    || ' (threshold: ±3.0 std deviations).' AS significance,
  'Given the column name ''' || {a}.metric || ''', this likely affects ' || {_impact_sql(f'{a}.metric')}
    || '. Confirm against your internal business glossary before acting on it.' AS possible_impact"""


_NOTE_HEAD, _NOTE_TAIL = CO_OCCURRENCE_NOTE.split("{others}")


def _note_sql(others: str) -> str:
    return (f"CASE WHEN coalesce({others}, '') <> '' THEN {_sql_str(_NOTE_HEAD)} || {others} || "
            f"{_sql_str(_NOTE_TAIL)} ELSE '' END")


def _co_sql(n_days: int = 0, src: str = "anom", md: str = "md", co: str = "co") -> str:
    cond = "a.date = b.date" if n_days == 0 else \
        f"b.date BETWEEN a.date - {n_days} AND a.date + {n_days}"
    return f"""{md} AS (SELECT DISTINCT metric, CAST(ts AS DATE) AS date FROM {src}),
{co} AS (SELECT a.metric, a.date,
              coalesce(string_agg(DISTINCT b.metric, ', ' ORDER BY b.metric), '') AS others
       FROM {md} a LEFT JOIN {md} b ON {cond} AND a.metric <> b.metric GROUP BY 1, 2)"""


def with_text_lists(df, col="co_occurrences"):
    return df.withColumn(col, F.array_join(F.col(col), ", "))


# ---------------------------------------------------------------------------
# summaries and co-occurrence
# ---------------------------------------------------------------------------

@register("anomaly_summaries", f"""
WITH {_anoms_cte()}, {_co_sql(0)}
SELECT {_summary_cols_sql('a')}, co.others AS co_occurrences,
       {_note_sql('co.others')} AS correlation_note, false AS is_escalation
FROM anom a JOIN co ON co.metric = a.metric AND co.date = CAST(a.ts AS DATE)""")
def q_anomaly_summaries(spark, sf_dir):
    annotated = attach_notes(summarize(flagship_anomalies(spark, sf_dir)))
    return finish(with_text_lists(annotated.select(*SUMMARY_COLUMNS)))


@register("co_occurrence_by_date", f"""
WITH {_anoms_cte()}, {_co_sql(0)}
SELECT metric, strftime(date, '%Y-%m-%d') AS date, others AS co_occurrences FROM co""")
def q_co_occurrence_by_date(spark, sf_dir):
    co = co_occurrences(flagship_anomalies(spark, sf_dir), CoOccurrenceOptions(0, "window"))
    return finish(with_text_lists(co.withColumnRenamed("others", "co_occurrences")))


@register("co_occurrence_pm_n_days", f"""
WITH {_anoms_cte()}, {_co_sql(3)}
SELECT metric, strftime(date, '%Y-%m-%d') AS date, others AS co_occurrences FROM co""")
def q_co_occurrence_pm_n_days(spark, sf_dir):
    co = co_occurrences(flagship_anomalies(spark, sf_dir), CoOccurrenceOptions(3, "window"))
    return finish(with_text_lists(co.withColumnRenamed("others", "co_occurrences")))


@register("co_occurrence_pm_60_days", f"""
WITH {_anoms_cte()}, {_co_sql(60)}
SELECT metric, strftime(date, '%Y-%m-%d') AS date, others AS co_occurrences FROM co""")
def q_co_occurrence_pm_60_days(spark, sf_dir):
    # a window far wider than the cube's days are dense: dates meet through bins
    co = co_occurrences(flagship_anomalies(spark, sf_dir), CoOccurrenceOptions(60, "window"))
    return finish(with_text_lists(co.withColumnRenamed("others", "co_occurrences")))


@register("co_occurrence_strict", f"""
WITH {_anoms_cte()}, {_co_sql(0)}
SELECT metric, arg_max(others, date) AS co_occurrences FROM co WHERE others <> '' GROUP BY metric""")
def q_co_occurrence_strict(spark, sf_dir):
    co = co_occurrences(flagship_anomalies(spark, sf_dir), CoOccurrenceOptions(0, "strict"))
    return finish(with_text_lists(co.withColumnRenamed("others", "co_occurrences")))


# ---------------------------------------------------------------------------
# suppression / escalation over two runs
# ---------------------------------------------------------------------------

def _fold_sql(name: str, src: str, init: str | None, delta: float = DELTA) -> str:
    """Recursive fold of one run's anomalies (``src`` has metric, rn, az)."""
    if init is None:
        first_z, first_dec = "a.az", "'new'"
    else:
        prev = "coalesce(abs(s.last_alert_z), 0.0)"
        act = "s.state = 'active_anomaly'"
        first_z = f"CASE WHEN {act} THEN (CASE WHEN a.az - {prev} >= {delta} THEN a.az ELSE {prev} END) ELSE a.az END"
        first_dec = (f"CASE WHEN {act} THEN (CASE WHEN a.az - {prev} >= {delta} THEN 'escalation' "
                     f"ELSE 'suppressed' END) ELSE 'new' END")
    join = f"LEFT JOIN {init} s ON s.metric = a.metric" if init else ""
    return f"""{name}(metric, rn, lz, decision) AS (
  SELECT a.metric, a.rn, {first_z}, {first_dec} FROM {src} a {join} WHERE a.rn = 1
  UNION ALL
  SELECT a.metric, a.rn,
         CASE WHEN a.az - f.lz >= {delta} THEN a.az ELSE f.lz END,
         CASE WHEN a.az - f.lz >= {delta} THEN 'escalation' ELSE 'suppressed' END
  FROM {name} f JOIN {src} a ON a.metric = f.metric AND a.rn = f.rn + 1)"""


def _state_after_sql(fold: str, src: str, init: str | None) -> str:
    """State rows of metrics with anomalies in the run."""
    prev_at = "s.last_alert_at" if init else "CAST(NULL AS VARCHAR)"
    join = f"LEFT JOIN {init} s ON s.metric = x.metric" if init else ""
    return f"""SELECT x.metric, 'active_anomaly' AS state, x.lz AS last_alert_z,
       coalesce(k.at, {prev_at}) AS last_alert_at, x.actual AS last_value
FROM (SELECT f.metric, arg_max(f.lz, f.rn) AS lz, arg_max(a.value, f.rn) AS actual
      FROM {fold} f JOIN {src} a USING (metric, rn) GROUP BY f.metric) x
LEFT JOIN (SELECT f.metric, arg_max(strftime(a.ts, '%Y-%m-%d'), f.rn) AS at
           FROM {fold} f JOIN {src} a USING (metric, rn) WHERE f.decision <> 'suppressed'
           GROUP BY f.metric) k ON k.metric = x.metric
{join}"""


def _two_run_sql(final: str, extra_ctes: str = "") -> str:
    metrics_list = ", ".join(f"('{m}')" for m in T.ORDER_METRICS)
    a1 = _anoms_cte(f"ts < DATE '{RUN_CUTOFF}'")
    a2 = _anoms_cte(f"ts >= DATE '{RUN_CUTOFF}'", "2")
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"""WITH RECURSIVE {a1}, {a2},
{_fold_sql('fold1', 'anom', None)},
state1 AS ({_state_after_sql('fold1', 'anom', None)}),
{_fold_sql('fold2', 'anom2', 'state1')},
observed(metric) AS (VALUES {metrics_list}),
upd2 AS ({_state_after_sql('fold2', 'anom2', 'state1')}),
reset2 AS (SELECT s.metric, 'normal' AS state, CAST(NULL AS DOUBLE) AS last_alert_z,
                  CAST(NULL AS VARCHAR) AS last_alert_at, s.last_value
           FROM state1 s JOIN observed o USING (metric)
           WHERE s.state = 'active_anomaly' AND s.metric NOT IN (SELECT metric FROM anom2)),
state2 AS (SELECT * FROM upd2 UNION ALL SELECT * FROM reset2
           UNION ALL SELECT * FROM state1 WHERE metric NOT IN (SELECT metric FROM upd2)
                                            AND metric NOT IN (SELECT metric FROM reset2)){extra}
{final}"""


def _decisions_view(decisions):
    return finish(decisions.select("metric", "timestamp", "z_score", "decision", "is_escalation"))


def _state_view(state):
    return finish(state.select("metric", "state", "last_alert_z", "last_alert_at", "last_value"))


def _whole_run(spark, sf_dir, enabled: bool = True):
    """One run over all days."""
    opts = SuppressOptions(enabled=enabled, escalation_z_delta=DELTA)
    observed = observed_from_metrics(spark, T.ORDER_METRICS)
    run = attach_notes(summarize(flagship_anomalies(spark, sf_dir)))
    return apply_suppression(run, None, observed, opts, RUN_TS)


def _run1(spark, sf_dir, enabled: bool = True):
    opts = SuppressOptions(enabled=enabled, escalation_z_delta=DELTA)
    observed = observed_from_metrics(spark, T.ORDER_METRICS)
    run1 = attach_notes(summarize(flagship_anomalies(spark, sf_dir, f"ts < DATE'{RUN_CUTOFF}'")))
    return apply_suppression(run1, None, observed, opts, RUN_TS)


def _run2(spark, sf_dir, enabled: bool = True):
    opts = SuppressOptions(enabled=enabled, escalation_z_delta=DELTA)
    observed = observed_from_metrics(spark, T.ORDER_METRICS)
    _dec1, state1 = _run1(spark, sf_dir, enabled)
    state1 = cut_lineage(state1, "state")   # runs hand state over as a written table
    run2 = attach_notes(summarize(flagship_anomalies(spark, sf_dir, f"ts >= DATE'{RUN_CUTOFF}'")))
    return apply_suppression(run2, state1, observed, opts, RUN_TS)


@register("suppression_first_run", f"""
WITH RECURSIVE {_anoms_cte()},
{_fold_sql('fold', 'anom', None)}
SELECT a.metric, strftime(a.ts, '%Y-%m-%d') AS timestamp, {r6('a.z')} AS z_score, f.decision,
       f.decision = 'escalation' AS is_escalation
FROM anom a JOIN fold f USING (metric, rn)""")
def q_suppression_first_run(spark, sf_dir):
    return _decisions_view(_whole_run(spark, sf_dir)[0])


@register("suppression_second_run", _two_run_sql(f"""
SELECT a.metric, strftime(a.ts, '%Y-%m-%d') AS timestamp, {r6('a.z')} AS z_score, f.decision,
       f.decision = 'escalation' AS is_escalation
FROM anom2 a JOIN fold2 f USING (metric, rn)"""))
def q_suppression_second_run(spark, sf_dir):
    return _decisions_view(_run2(spark, sf_dir)[0])


@register("state_snapshot", _two_run_sql(f"""
SELECT metric, state, {r6('last_alert_z')} AS last_alert_z, last_alert_at,
       {r6('last_value')} AS last_value FROM state2"""))
def q_state_snapshot(spark, sf_dir):
    return _state_view(_run2(spark, sf_dir)[1])


@register("suppression_disabled", f"""
WITH {_anoms_cte()}
SELECT metric, 'active_anomaly' AS state, {r6('arg_max(az, rn)')} AS last_alert_z,
       arg_max(strftime(ts, '%Y-%m-%d'), rn) AS last_alert_at, {r6('arg_max(value, rn)')} AS last_value
FROM anom GROUP BY metric""")
def q_suppression_disabled(spark, sf_dir):
    return _state_view(_whole_run(spark, sf_dir, enabled=False)[1])


# ---------------------------------------------------------------------------
# alert digest and report tables (kept rows of a run over all days)
# ---------------------------------------------------------------------------

from ..operators.digest import alert_body_lines, alert_subject, digest_items, item_text  # noqa: E402
from ..operators.ranking import top_per_series  # noqa: E402
from ..operators.report import chart_series, report_table  # noqa: E402
from ..operators.suppress import kept_only  # noqa: E402

_NL = "chr(10)"

from ..functions.text import (DIGEST_COUNTS, DIGEST_FOOTER, DIGEST_RULE, DIGEST_TITLE,  # noqa: E402
                              ITEM_CORRELATION, ITEM_HEADER, ITEM_HEADER_ESCALATION, ITEM_IMPACT,
                              ITEM_SEVERITY, ITEM_SIGNIFICANCE, ITEM_WHAT_CHANGED,
                              SUBJECT_ESCALATIONS_ONLY, SUBJECT_MIXED, SUBJECT_NEW_ONLY)


def sql_fill(template: str, **exprs: str) -> str:
    """A ``{name}`` template as a SQL string concatenation of literals and expressions."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(_sql_str(head))
        parts.append(f"CAST({exprs[name]} AS VARCHAR)")
    if rest:
        parts.append(_sql_str(rest))
    return "(" + " || ".join(parts) + ")"


_ITEM = dict(item_no="item_no", metric="metric", timestamp="timestamp",
             direction_upper="upper(direction)", severity="severity",
             z_signed="printf('%+.2f', z_raw)", what_changed="what_changed",
             significance="significance", possible_impact="possible_impact")
_COUNTS = dict(n_items="n", n_escalations="e", n_new="(n - e)", now=_sql_str(RUN_TS))


def _kept1_sql(final: str, extra_ctes: str = "") -> str:
    """``numbered``: the kept summaries of a run over all days, with notes and item numbers."""
    ctes = f"""{_co_sql(0, 'anom', 'md1', 'co1')},
summ1 AS (SELECT {_summary_cols_sql('a')}, a.ts AS ts_raw, a.rn, a.z AS z_raw FROM anom a),
kept AS (SELECT s.*, f.decision = 'escalation' AS is_escalation, co.others,
                {_note_sql('co.others')} AS note
         FROM summ1 s JOIN fold1 f USING (metric, rn)
         JOIN co1 co ON co.metric = s.metric AND co.date = CAST(s.ts_raw AS DATE)
         WHERE f.decision <> 'suppressed'),
numbered AS (SELECT *, row_number() OVER (ORDER BY is_escalation DESC, ts_raw, metric) AS item_no
             FROM kept),
headed AS (SELECT *, CASE WHEN is_escalation THEN {sql_fill(ITEM_HEADER_ESCALATION, **_ITEM)}
                          ELSE {sql_fill(ITEM_HEADER, **_ITEM)} END AS header FROM numbered)"""
    if extra_ctes:
        ctes += f",\n{extra_ctes}"
    return f"""WITH RECURSIVE {_anoms_cte()},
{_fold_sql('fold1', 'anom', None)},
{ctes}
{final}"""


def _item_lines_sql() -> list[str]:
    return ["header", sql_fill(ITEM_SEVERITY, **_ITEM), sql_fill(ITEM_WHAT_CHANGED, **_ITEM),
            sql_fill(ITEM_SIGNIFICANCE, **_ITEM), sql_fill(ITEM_IMPACT, **_ITEM)]


_CORR_LINE = sql_fill(ITEM_CORRELATION, correlation_note="note")


def _kept_run1(spark, sf_dir):
    return kept_only(_whole_run(spark, sf_dir)[0])


@register("alert_digest_items", _kept1_sql(f"""
SELECT item_no, metric, timestamp, is_escalation,
       {f" || {_NL} || ".join(_item_lines_sql())}
       || CASE WHEN note <> '' THEN {_NL} || {_CORR_LINE} ELSE '' END AS text
FROM headed"""))
def q_alert_digest_items(spark, sf_dir):
    return finish(item_text(digest_items(_kept_run1(spark, sf_dir))))


@register("alert_subject", _kept1_sql(f"""
SELECT n AS n_items, n - e AS n_new, e AS n_escalations,
       CASE WHEN e > 0 AND n - e = 0 THEN {sql_fill(SUBJECT_ESCALATIONS_ONLY, **_COUNTS)}
            WHEN e > 0 THEN {sql_fill(SUBJECT_MIXED, **_COUNTS)}
            ELSE {sql_fill(SUBJECT_NEW_ONLY, **_COUNTS)} END AS subject,
       {sql_fill(DIGEST_TITLE, **_COUNTS)} AS title,
       {sql_fill(DIGEST_COUNTS, **_COUNTS)} AS counts
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_escalation) AS e FROM kept) WHERE n > 0"""))
def q_alert_subject(spark, sf_dir):
    return finish(alert_subject(_kept_run1(spark, sf_dir), RUN_TS))


def _body_sql() -> str:
    parts = [f"SELECT 1 AS section, item_no, {i} AS line_no, {e} AS line FROM headed"
             for i, e in enumerate(_item_lines_sql())]
    parts.append(f"SELECT 1, item_no, 5, CASE WHEN note <> '' THEN {_CORR_LINE} "
                 "ELSE '' END FROM headed")
    parts.append("SELECT 1, item_no, 6, '' FROM headed WHERE note <> ''")
    head = [f"SELECT 0, CAST(0 AS BIGINT), {i}, {e} FROM hdr" for i, e in enumerate([
        sql_fill(DIGEST_TITLE, **_COUNTS), sql_fill(DIGEST_COUNTS, **_COUNTS),
        _sql_str(DIGEST_RULE), "''"])]
    foot = [f"SELECT 2, CAST(0 AS BIGINT), 0, {_sql_str(DIGEST_FOOTER)} FROM hdr"]
    hdr = """hdr AS (SELECT n, e FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_escalation) AS e
                          FROM kept) WHERE n > 0)"""
    return _kept1_sql("\nUNION ALL ".join(parts + head + foot), hdr)


@register("alert_body_lines", _body_sql())
def q_alert_body_lines(spark, sf_dir):
    return finish(alert_body_lines(_kept_run1(spark, sf_dir), RUN_TS))


@register("report_table", _kept1_sql("""
SELECT metric, timestamp AS date, direction, severity, printf('%+.2f', z_raw) AS z_text,
       is_escalation AS escalation FROM kept"""))
def q_report_table(spark, sf_dir):
    return finish(report_table(_kept_run1(spark, sf_dir)))


@register("chart_series", _kept1_sql("""
SELECT l.metric, strftime(l.ts, '%Y-%m-%d') AS ts, round(l.value, 6) + 0.0 AS value,
       coalesce(k.flag, false) AS is_anomaly
FROM long l
LEFT JOIN (SELECT DISTINCT metric, ts_raw, true AS flag FROM kept) k
       ON k.metric = l.metric AND k.ts_raw = l.ts
WHERE l.value IS NOT NULL AND l.metric IN (SELECT metric FROM kept)"""))
def q_chart_series(spark, sf_dir):
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    return finish(chart_series(long, _kept_run1(spark, sf_dir)))


@register("top_anomalies_per_metric", f"""
WITH {_anoms_cte()}
SELECT metric, strftime(ts, '%Y-%m-%d') AS timestamp, {r6('z')} AS z_score, rank
FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY abs(z) DESC, ts) AS rank FROM anom)
WHERE rank <= 3""")
def q_top_anomalies_per_metric(spark, sf_dir):
    top = top_per_series(flagship_anomalies(spark, sf_dir), 3, F.abs(F.col("z_score")))
    return finish(top.select("metric", "timestamp", "z_score", F.col("rank").cast("long")))


# ---------------------------------------------------------------------------
# sources and shape changes
# ---------------------------------------------------------------------------

from ..operators.halo import halo_rolling_stats  # noqa: E402
from ..operators.rolling import flag_anomalies  # noqa: E402
from ..operators.seasonal import (gap_fill, history_gate, seasonal_anomalies,  # noqa: E402
                                  stl_components)
from ..sources.metrics import align_union, clean_wide, drop_all_null_rows, to_wide  # noqa: E402


@register("metrics_long_keep_nulls", f"""
WITH cube AS ({T.PRIORITY_DAILY_SQL})
SELECT metric, {day('ts')} AS ts, {r6('value')} AS value
FROM ({_unpivot_sql('cube', T.PRIORITY_METRICS)})""")
def q_metrics_long_keep_nulls(spark, sf_dir):
    return finish(to_long(T.priority_daily(spark, sf_dir), "ts", T.PRIORITY_METRICS))


@register("long_to_wide", f"""
SELECT {day('ts')} AS ts, {r6('line_count')} AS line_count, {r6('quantity')} AS quantity,
       {r6('gross')} AS gross, {r6('avg_discount')} AS avg_discount
FROM ({T.LINES_DAILY_SQL})""")
def q_long_to_wide(spark, sf_dir):
    long = to_long(T.lines_daily(spark, sf_dir), "ts", T.LINE_METRICS)
    return finish(to_wide(long, "ts", metrics=T.LINE_METRICS))


@register("clean_timestamps", """
SELECT o_orderkey, strftime(TRY_CAST(ts_text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts_text,
       round(o_totalprice, 6) + 0.0 AS o_totalprice
FROM (SELECT o_orderkey, o_totalprice,
             CASE WHEN o_orderstatus = 'P' THEN 'not a date'
                  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts_text FROM orders)
WHERE TRY_CAST(ts_text AS TIMESTAMP) IS NOT NULL""")
def q_clean_timestamps(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    raw = o.select("o_orderkey", "o_totalprice",
                   F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
                   .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ts_text"))
    wide = clean_wide(raw, "ts_text", ["o_totalprice"], keys=["o_orderkey"])
    return finish(wide.df.select("o_orderkey", "ts_text", "o_totalprice"))


@register("drop_all_null_rows", f"""
SELECT {day('ts')} AS ts, {r6('p1_urgent')} AS p1_urgent, {r6('p2_high')} AS p2_high
FROM ({T.PRIORITY_DAILY_SQL}) WHERE p1_urgent IS NOT NULL OR p2_high IS NOT NULL""")
def q_drop_all_null_rows(spark, sf_dir):
    cube = T.priority_daily(spark, sf_dir).select("ts", "p1_urgent", "p2_high")
    return finish(drop_all_null_rows(cube, ["p1_urgent", "p2_high"]))


@register("align_union_by_name", f"""
SELECT {day('ts')} AS ts, {r6('revenue')} AS revenue, {r6('order_count')} AS order_count,
       {r6('avg_price')} AS avg_price, {r6('max_price')} AS max_price, {r6('f_share')} AS f_share,
       {r6('line_count')} AS line_count, {r6('quantity')} AS quantity, {r6('gross')} AS gross,
       {r6('avg_discount')} AS avg_discount
FROM (SELECT * FROM ({T.ORDERS_DAILY_SQL}) UNION ALL BY NAME SELECT * FROM ({T.LINES_DAILY_SQL}))""")
def q_align_union_by_name(spark, sf_dir):
    return finish(align_union([T.orders_daily(spark, sf_dir), T.lines_daily(spark, sf_dir)]))


# ---------------------------------------------------------------------------
# detection variants
# ---------------------------------------------------------------------------

SPARSE = DetectOptions(window_size=30, z_threshold=3.0, min_periods=10)


@register("zscore_sparse_min_periods", f"""
WITH cube AS ({T.PRIORITY_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.PRIORITY_METRICS)}),
scored AS ({_rolling_sql('long', 30, 10)})
{_anomaly_select_sql('scored', 3.0)}""")
def q_zscore_sparse_min_periods(spark, sf_dir):
    a = detect_anomalies(T.priority_daily(spark, sf_dir), "ts", T.PRIORITY_METRICS,
                         options=SPARSE)
    return finish(a.drop("seasonal_period"))


ENTITY = DetectOptions(window_size=12, z_threshold=2.5)


@register("zscore_by_entity", f"""
WITH cube AS ({T.NATION_MONTHLY_SQL}),
long AS ({_unpivot_sql('cube', ['revenue', 'order_count'], 'nation, ts')}),
scored AS ({_rolling_sql('long', 12, 12, 'nation, metric')})
{_anomaly_select_sql('scored', 2.5, 'nation, ')}""")
def q_zscore_by_entity(spark, sf_dir):
    a = detect_anomalies(T.nation_monthly(spark, sf_dir), "ts", ["revenue", "order_count"],
                         keys=["nation"], options=ENTITY)
    return finish(a.drop("seasonal_period"))


HOURLY = DetectOptions(window_size=24, z_threshold=3.0)


@register("events_hourly_zscore", f"""
WITH cube AS ({T.EVENTS_HOURLY_SQL}),
long AS ({_unpivot_sql('cube', T.EVENT_METRICS)}),
scored AS ({_rolling_sql('long', 24, 24)})
{_anomaly_select_sql('scored', 3.0, ts_fmt='hour')}""")
def q_events_hourly_zscore(spark, sf_dir):
    a = detect_anomalies(T.events_hourly(spark, sf_dir), "ts", T.EVENT_METRICS, options=HOURLY)
    return finish(a.drop("seasonal_period"))


@register("history_gate", f"""
WITH cube AS ({T.PRIORITY_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.PRIORITY_METRICS)})
SELECT metric, count(value) AS n_valid, count(*) AS n_rows, count(value) >= 730 AS enough
FROM long GROUP BY metric""")
def q_history_gate(spark, sf_dir):
    long = to_long(T.priority_daily(spark, sf_dir), "ts", T.PRIORITY_METRICS)
    return finish(history_gate(long, 365, 2))


_FILL_SQL = """coalesce(
  last_value(value IGNORE NULLS) OVER (PARTITION BY metric ORDER BY ts
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY metric ORDER BY ts
                                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@register("gap_fill", f"""
WITH cube AS ({T.PRIORITY_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.PRIORITY_METRICS)})
SELECT metric, {day('ts')} AS ts, {r6('value')} AS value, {r6(_FILL_SQL)} AS filled FROM long""")
def q_gap_fill(spark, sf_dir):
    long = to_long(T.priority_daily(spark, sf_dir), "ts", T.PRIORITY_METRICS)
    return finish(gap_fill(long))


CLASSICAL = DetectOptions(window_size=30, z_threshold=3.0, mode="classical", seasonal_period=7)


@register("classical_seasonal_anomalies", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
g AS (SELECT metric, count(value) >= 14 AND count(*) >= 14 AS usable FROM long GROUP BY metric),
f AS (SELECT l.*, {_FILL_SQL} AS filled
      FROM long l JOIN g USING (metric) WHERE g.usable),
c AS (SELECT f.*, (row_number() OVER w0 - 1) % 7 AS phase,
             CASE WHEN count(filled) OVER w7 = 7 THEN avg(filled) OVER w7 END AS trend
      FROM f WINDOW w0 AS (PARTITION BY metric ORDER BY ts),
                    w7 AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
pm AS (SELECT metric, phase, avg(filled - trend) AS pm FROM c GROUP BY 1, 2),
sea AS (SELECT metric, phase, pm - avg(pm) OVER (PARTITION BY metric) AS seasonal FROM pm),
r AS (SELECT c.metric, c.ts, c.value, c.filled - c.trend - s.seasonal AS resid
      FROM c JOIN sea s USING (metric, phase)),
scored AS ({_rolling_sql('r', 30, 30, col='resid')}),
plain AS ({_rolling_sql('(SELECT l.* FROM long l JOIN g USING (metric) WHERE NOT g.usable)', 30, 30)})
SELECT *, 7 AS seasonal_period FROM ({_anomaly_select_sql('scored', 3.0, mode='classical')})
UNION ALL
SELECT *, CAST(NULL AS INTEGER) FROM ({_anomaly_select_sql('plain', 3.0)})""")
def q_classical_seasonal_anomalies(spark, sf_dir):
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    return finish(seasonal_anomalies(long, CLASSICAL))


STL_OPTS = DetectOptions(window_size=30, z_threshold=3.0, mode="seasonal", seasonal_period=7)


STL_CTES, STL_LAST = stl_ctes("f", 7)


def _relative(df: DataFrame, columns: list[str], to: str) -> DataFrame:
    """Columns in units of the observed value, so that six places suit every metric."""
    return df.withColumns({c: F.col(c) / F.greatest(F.abs(F.col(to)), F.lit(1.0)) for c in columns})


@register("stl_components", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
f AS (SELECT *, {_FILL_SQL} AS filled, row_number() OVER (PARTITION BY metric ORDER BY ts) AS i FROM long),
{STL_CTES}
SELECT metric, {day('ts')} AS ts, {r6('value')} AS value, {r6('filled')} AS filled,
       {r6('t / greatest(abs(filled), 1)')} AS trend, {r6('s / greatest(abs(filled), 1)')} AS seasonal,
       {r6('(y - s - t) / greatest(abs(filled), 1)')} AS resid, {r6('(t + s) / greatest(abs(filled), 1)')} AS expected
FROM f JOIN {STL_LAST} USING (metric, i)""")
def q_stl_components(spark, sf_dir):
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    parts = stl_components(gap_fill(long), 7)
    return finish(_relative(parts, ["trend", "seasonal", "resid", "expected"], "filled"))


HOUR_CTES, HOUR_LAST = stl_ctes("f", 168)


@register("stl_weekly_cycle_of_hours", f"""
WITH cube AS ({T.EVENTS_HOURLY_SQL}),
long AS ({_unpivot_sql('cube', T.EVENT_METRICS)}),
f AS (SELECT *, {_FILL_SQL} AS filled, row_number() OVER (PARTITION BY metric ORDER BY ts) AS i FROM long),
{HOUR_CTES}
SELECT metric, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {r6('value')} AS value,
       {r6('t / greatest(abs(filled), 1)')} AS trend, {r6('s / greatest(abs(filled), 1)')} AS seasonal,
       {r6('(y - s - t) / greatest(abs(filled), 1)')} AS resid
FROM f JOIN {HOUR_LAST} USING (metric, i)""")
def q_stl_weekly_cycle_of_hours(spark, sf_dir):
    """A period of 168 rows: the trend's window has 321, worked out from moments."""
    long = to_long(T.events_hourly(spark, sf_dir), "ts", T.EVENT_METRICS)
    parts = _relative(stl_components(gap_fill(long), 168), ["trend", "seasonal", "resid"], "filled")
    return finish(parts.select("metric", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "value",
                               "trend", "seasonal", "resid"))


def _stl_anomalies_select(scored: str, mode: str, period: str) -> str:
    scale = "greatest(abs(value), 1)"
    return f"""SELECT metric, {day('ts')} AS timestamp, {r6('value')} AS actual,
       {r6(f'coalesce(m, 0) / {scale}')} AS rolling_mean, {r6(f'coalesce(sd, 0) / {scale}')} AS rolling_std,
       {r6('z')} AS z_score, CASE WHEN z > 0 THEN 'up' ELSE 'down' END AS direction,
       '{mode}' AS detection_mode_used, {period} AS seasonal_period
FROM {scored} WHERE value IS NOT NULL AND z IS NOT NULL AND abs(z) > 3.0"""


@register("stl_anomalies", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
g AS (SELECT metric, count(value) >= 14 AND count(*) >= 14 AS usable FROM long GROUP BY metric),
f AS (SELECT l.*, {_FILL_SQL} AS filled, row_number() OVER (PARTITION BY metric ORDER BY ts) AS i
      FROM long l JOIN g USING (metric) WHERE g.usable),
{STL_CTES},
r AS (SELECT metric, ts, value, y - s - t AS resid FROM f JOIN {STL_LAST} USING (metric, i)),
scored AS ({_rolling_sql('r', 30, 30, col='resid')}),
plain AS ({_rolling_sql('(SELECT l.* FROM long l JOIN g USING (metric) WHERE NOT g.usable)', 30, 30)})
{_stl_anomalies_select('scored', 'seasonal', '7')}
UNION ALL
{_stl_anomalies_select('plain', 'zscore', 'CAST(NULL AS INTEGER)')}""")
def q_stl_anomalies(spark, sf_dir):
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    return finish(_relative(seasonal_anomalies(long, STL_OPTS), ["rolling_mean", "rolling_std"], "actual"))


HALO = DetectOptions(window_size=30, z_threshold=3.0, chunk_rows=64)


@register("halo_rolling_zscore", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
scored AS ({_rolling_sql('long', 30, 30)})
{_anomaly_select_sql('scored', 3.0)}""")
def q_halo_rolling_zscore(spark, sf_dir):
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    scored = halo_rolling_stats(long, HALO)
    return finish(flag_anomalies(scored, 3.0).drop("seasonal_period"))


# ---------------------------------------------------------------------------
# Structured Streaming (run to completion with availableNow, read the sink back)
# ---------------------------------------------------------------------------

from ..session import scratch_path  # noqa: E402
from ..streaming.cube import stream_metric_cube  # noqa: E402
from ..streaming.sinks import (latest_by_key, new_stream_dir, read_batches,  # noqa: E402
                               run_available_now)
from ..streaming.stateful import stream_suppression, stream_zscore  # noqa: E402


#: How far rows are out of order in the streamed folders, and the watermark's delay that covers it.
DISORDER_DAYS, DELAY = 6, "8 days"
STREAM_FILES = 5


def _disordered_files(spark, rows, ts: str, name: str, closing: dict | None = None):
    """``rows`` as a stream over several files, one for each trigger, in which days are out of order:
    a row comes up to ``DISORDER_DAYS`` before its turn. ``closing`` names the series of one last row, a month
    later, which moves the watermark past all others (it stays in the buffer itself)."""
    folder = new_stream_dir(spark, name)
    rows = cut_lineage(rows, name)
    day = F.unix_date(F.to_date(ts))
    first, last = rows.agg(F.min(day), F.max(day)).first()
    span = (last - first + DISORDER_DAYS) // STREAM_FILES + 1
    turn = F.floor((day - first + F.pmod(F.xxhash64(*rows.columns), F.lit(DISORDER_DAYS + 1))) / span)
    for k in range(STREAM_FILES):
        rows.filter(turn == k).coalesce(1).write.parquet(f"{folder}/file-{k}")
    if closing is not None:
        at = F.date_from_unix_date(F.lit(last + 30)).cast(rows.schema[ts].dataType).alias(ts)
        fields = [at if f.name == ts else F.lit(closing.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema]
        spark.range(1).select(*fields).coalesce(1).write.parquet(f"{folder}/file-{STREAM_FILES}")
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1")
            .option("recursiveFileLookup", "true").parquet(folder))


@register("stream_metric_cube", """
SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts,
       count(*) AS n_events, round(sum(value), 6) + 0.0 AS total_value
FROM events GROUP BY 1, 2""")
def q_stream_metric_cube(spark, sf_dir):
    rows = T.table(spark, sf_dir, "events").select("ts", "event_type", "value")
    stream = _disordered_files(spark, rows, "ts", "cube-input")
    cube = stream_metric_cube(stream, "ts", {"n_events": F.count(F.lit(1)),
                                            "total_value": F.sum("value")},
                              bucket="1 hour", dims=["event_type"], watermark=DELAY)
    path = run_available_now(cube, new_stream_dir(spark, "metric_cube"), "update", settings={})
    return finish(latest_by_key(spark, path, ["event_type", "ts"]))


STREAM_Z = DetectOptions(window_size=30, z_threshold=3.0)


@register("stream_zscore", f"""
WITH long AS (SELECT event_type AS metric, event_id, ts, value FROM events),
scored AS ({_rolling_sql('long', 30, 30)})
SELECT metric, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {r6('value')} AS value,
       n_obs, {r6('m')} AS rolling_mean, {r6('sd')} AS rolling_std, {r6('z')} AS z
FROM scored""")
def q_stream_zscore(spark, sf_dir):
    rows = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "event_id", "ts", "value")
    stream = _disordered_files(spark, rows, "ts", "zscore-input", {"metric": "(end)"})
    scored = stream_zscore(stream, STREAM_Z, carry=["event_id"], delay=DELAY)
    path = run_available_now(scored, new_stream_dir(spark, "zscore"), "append")
    return finish(read_batches(spark, path).drop("batch_id"))


@register("stream_suppression", f"""
WITH RECURSIVE {_anoms_cte()},
{_fold_sql('fold', 'anom', None)}
SELECT a.metric, strftime(a.ts, '%Y-%m-%d') AS timestamp, {r6('a.z')} AS z_score, f.decision,
       f.decision = 'escalation' AS is_escalation
FROM anom a JOIN fold f USING (metric, rn)""")
def q_stream_suppression(spark, sf_dir):
    # the batch job writes its anomaly table; the stream decides them in the order of event time
    anomalies = summarize(flagship_anomalies(spark, sf_dir)).select(
        "metric", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "timestamp", "z_score", "actual")
    stream = _disordered_files(spark, anomalies, "event_ts", "suppression-input", {"metric": "(end)"})
    decided = stream_suppression(stream, SuppressOptions(True, DELTA), delay=DELAY)
    path = run_available_now(decided, new_stream_dir(spark, "suppression"), "append")
    return _decisions_view(read_batches(spark, path))


# ---------------------------------------------------------------------------
# more sources: a drifted folder of files, a Spark SQL source; seasonal routing
# ---------------------------------------------------------------------------

import uuid  # noqa: E402

from ..operators.seasonal import series_routes  # noqa: E402
from ..sources.metrics import SOURCE_FILE_COL, MetricSource, read_metrics  # noqa: E402


def _drifted_folder(spark, sf_dir):
    # one file per slice, each with its own columns: A (ts, revenue, order_count),
    # B (ts, order_count, avg_price), C names its timestamp 'day' so its rows lose the
    # timestamp of the aligned table and it is listed, D has rows without any metric value
    cube = T.orders_daily(spark, sf_dir)
    folder = scratch_path(spark, "tables", f"folder-{uuid.uuid4().hex}")
    cube.filter("ts < DATE'1997-01-01'").select("ts", "revenue", "order_count") \
        .write.parquet(f"{folder}/a")
    cube.filter("ts >= DATE'1997-01-01' AND ts < DATE'2000-01-01'") \
        .select("ts", "order_count", "avg_price").write.parquet(f"{folder}/b")
    cube.filter("ts >= DATE'2000-01-01'").select(F.col("ts").alias("day"), "revenue") \
        .write.parquet(f"{folder}/c")
    cube.filter("ts >= DATE'2001-01-01'").select("ts", F.lit(None).cast("double").alias("f_share")) \
        .write.parquet(f"{folder}/d")
    return read_metrics(spark, MetricSource(kind="folder", path=f"{folder}/*", format="parquet",
                                            timestamp_column="ts"))


@register("folder_source_drift", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL})
SELECT {day('ts')} AS ts, {r6('revenue')} AS revenue, {r6('order_count')} AS order_count,
       CAST(NULL AS DOUBLE) AS avg_price, CAST(NULL AS DOUBLE) AS f_share
FROM cube WHERE ts < DATE '1997-01-01'
UNION ALL
SELECT {day('ts')}, CAST(NULL AS DOUBLE), {r6('order_count')}, {r6('avg_price')}, CAST(NULL AS DOUBLE)
FROM cube WHERE ts >= DATE '1997-01-01' AND ts < DATE '2000-01-01'
UNION ALL
SELECT {day('ts')}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM cube WHERE ts >= DATE '2001-01-01'""")
def q_folder_source_drift(spark, sf_dir):
    wide = _drifted_folder(spark, sf_dir)
    return finish(wide.df.select("ts", "revenue", "order_count", "avg_price", "f_share"))


@register("folder_quarantine", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL})
SELECT 'c' AS folder, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS valid_timestamps
FROM cube WHERE ts >= DATE '2000-01-01' HAVING count(*) > 0""")
def q_folder_quarantine(spark, sf_dir):
    bad = _drifted_folder(spark, sf_dir).quarantine
    return bad.groupBy(F.element_at(F.split(SOURCE_FILE_COL, "/"), -2).alias("folder")).agg(
        F.sum("rows").alias("rows"), F.sum("valid_timestamps").alias("valid_timestamps"))


_SQL_SOURCE = """SELECT CAST(o_orderdate AS DATE) AS ts,
       sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent,
       sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END) AS high
FROM {orders} GROUP BY 1"""


@register("sql_source_metrics", f"""
SELECT {day('ts')} AS ts, {r6('urgent')} AS urgent, {r6('high')} AS high
FROM ({_SQL_SOURCE.format(orders='orders')}) WHERE urgent IS NOT NULL OR high IS NOT NULL""")
def q_sql_source_metrics(spark, sf_dir):
    T.table(spark, sf_dir, "orders").createOrReplaceTempView("tidewatch_orders")
    wide = read_metrics(spark, MetricSource(kind="sql",
                                            query=_SQL_SOURCE.format(orders="tidewatch_orders")))
    return finish(wide.df.select("ts", "urgent", "high"))


ROUTES = DetectOptions(window_size=30, mode="seasonal", seasonal_period=7, min_cycles=2)


@register("seasonal_routes", f"""
WITH cube AS ({T.PRIORITY_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.PRIORITY_METRICS)})
SELECT metric, count(value) AS n_valid, count(*) AS n_rows,
       CASE WHEN count(value) >= 14 AND count(*) >= 14 THEN 'seasonal' ELSE 'zscore' END AS route
FROM long GROUP BY metric""")
def q_seasonal_routes(spark, sf_dir):
    long = to_long(T.priority_daily(spark, sf_dir), "ts", T.PRIORITY_METRICS)
    return finish(series_routes(long, ROUTES))


# ---------------------------------------------------------------------------
# cluster count, and entity-keyed co-occurrence / suppression
# ---------------------------------------------------------------------------

from ..operators.cooccur import cluster_count  # noqa: E402


@register("co_occurrence_clusters", f"""
WITH {_anoms_cte()}
SELECT CAST(count(*) FILTER (WHERE n >= 2) AS BIGINT) AS clusters
FROM (SELECT CAST(ts AS DATE) AS d, count(DISTINCT metric) AS n FROM anom GROUP BY 1)""")
def q_co_occurrence_clusters(spark, sf_dir):
    return finish(cluster_count(flagship_anomalies(spark, sf_dir)))


def _entity_anoms_cte() -> str:
    return f"""cube AS ({T.NATION_MONTHLY_SQL}),
long AS ({_unpivot_sql('cube', ['revenue', 'order_count'], 'nation, ts')}),
scored AS ({_rolling_sql('long', 12, 12, 'nation, metric')}),
anom AS (SELECT nation, metric, ts, value, z, abs(z) AS az,
                row_number() OVER (PARTITION BY nation, metric ORDER BY ts) AS rn
         FROM scored WHERE value IS NOT NULL AND z IS NOT NULL AND abs(z) > 2.5)"""


def entity_anomalies(spark, sf_dir):
    return cut_lineage(detect_anomalies(T.nation_monthly(spark, sf_dir), "ts",
                                        ["revenue", "order_count"], keys=["nation"],
                                        options=ENTITY))


@register("entity_co_occurrence", f"""
WITH {_entity_anoms_cte()},
md AS (SELECT DISTINCT nation, metric, CAST(ts AS DATE) AS date FROM anom)
SELECT a.nation, a.metric, strftime(a.date, '%Y-%m-%d') AS date,
       coalesce(string_agg(DISTINCT b.metric, ', ' ORDER BY b.metric), '') AS co_occurrences
FROM md a LEFT JOIN md b ON a.nation = b.nation AND a.date = b.date AND a.metric <> b.metric
GROUP BY 1, 2, 3""")
def q_entity_co_occurrence(spark, sf_dir):
    co = co_occurrences(entity_anomalies(spark, sf_dir), CoOccurrenceOptions(0, "window"),
                        keys=["nation"])
    return finish(with_text_lists(co.withColumnRenamed("others", "co_occurrences")))


@register("entity_suppression", f"""
WITH RECURSIVE {_entity_anoms_cte()},
fold(nation, metric, rn, lz, decision) AS (
  SELECT nation, metric, rn, az, 'new' FROM anom WHERE rn = 1
  UNION ALL
  SELECT a.nation, a.metric, a.rn,
         CASE WHEN a.az - f.lz >= 0.5 THEN a.az ELSE f.lz END,
         CASE WHEN a.az - f.lz >= 0.5 THEN 'escalation' ELSE 'suppressed' END
  FROM fold f JOIN anom a ON a.nation = f.nation AND a.metric = f.metric AND a.rn = f.rn + 1)
SELECT a.nation, a.metric, strftime(a.ts, '%Y-%m-%d') AS timestamp, {r6('a.z')} AS z_score,
       f.decision, f.decision = 'escalation' AS is_escalation
FROM anom a JOIN fold f USING (nation, metric, rn)""")
def q_entity_suppression(spark, sf_dir):
    events = summarize(entity_anomalies(spark, sf_dir))
    dec, _ = apply_suppression(events, None, None, SuppressOptions(True, 0.5), RUN_TS,
                               keys=["nation"])
    return finish(dec.select("nation", "metric", "timestamp", "z_score", "decision",
                             "is_escalation"))


HOT = DetectOptions(window_size=30, z_threshold=3.0, hot_series_rows=2000)


@register("hot_series_zscore", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
scored AS ({_rolling_sql('long', 30, 30)})
{_anomaly_select_sql('scored', 3.0)}""")
def q_hot_series_zscore(spark, sf_dir):
    # series longer than 2000 rows are split into halo chunks, the rest use plain windows
    a = detect_anomalies(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS, options=HOT)
    return finish(a.drop("seasonal_period"))


HOT_CLASSICAL = DetectOptions(window_size=30, z_threshold=3.0, mode="classical",
                              seasonal_period=7, hot_series_rows=1000)


@register("hot_classical_anomalies", REGISTRY["classical_seasonal_anomalies"][1])
def q_hot_classical_anomalies(spark, sf_dir):
    # series above 1000 rows are decomposed chunk by chunk (no per-series task)
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    return finish(seasonal_anomalies(long, HOT_CLASSICAL))


@register("hot_stl_anomalies", REGISTRY["stl_anomalies"][1])
def q_hot_stl_anomalies(spark, sf_dir):
    # series above 1000 rows go through STL chunk by chunk: the same results
    long = to_long(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS)
    options = DetectOptions(window_size=30, z_threshold=3.0, mode="seasonal", seasonal_period=7, hot_series_rows=1000)
    return finish(_relative(seasonal_anomalies(long, options), ["rolling_mean", "rolling_std"], "actual"))


RECENT = DetectOptions(window_size=30, z_threshold=3.0, score_from="2000-01-01")


@register("zscore_score_from", f"""
WITH cube AS ({T.ORDERS_DAILY_SQL}),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
scored AS ({_rolling_sql('long', 30, 30)})
SELECT * FROM ({_anomaly_select_sql('scored', 3.0)}) WHERE timestamp >= '2000-01-01'""")
def q_zscore_score_from(spark, sf_dir):
    # incremental run: only days from 2000-01-01 are scored, with 29 rows of lookback each
    a = detect_anomalies(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS, options=RECENT)
    return finish(a.drop("seasonal_period"))


@register("chunked_gap_fill", REGISTRY["gap_fill"][1])
def q_chunked_gap_fill(spark, sf_dir):
    # the same fill computed chunk by chunk (chunks of 500 positions) for long series
    long = to_long(T.priority_daily(spark, sf_dir), "ts", T.PRIORITY_METRICS)
    return finish(gap_fill(long, chunk_rows=500))


SUPPLIER = DetectOptions(window_size=12, z_threshold=2.5)


@register("supplier_weekly_zscore", f"""
WITH cube AS ({T.SUPPLIER_WEEKLY_SQL}),
long AS ({_unpivot_sql('cube', ['revenue', 'quantity'], 'l_suppkey, ts')}),
scored AS ({_rolling_sql('long', 12, 12, 'l_suppkey, metric')})
{_anomaly_select_sql('scored', 2.5, 'l_suppkey, ')}""")
def q_supplier_weekly_zscore(spark, sf_dir):
    # one series per (supplier, metric): thousands of series scored in parallel
    a = detect_anomalies(T.supplier_weekly(spark, sf_dir), "ts", ["revenue", "quantity"],
                         keys=["l_suppkey"], options=SUPPLIER)
    return finish(a.drop("seasonal_period"))


# ---------------------------------------------------------------------------
# sinks, records and edges of the job
# ---------------------------------------------------------------------------

from ..operators.ranking import global_row_number  # noqa: E402
from ..operators.records import anomaly_records, write_ordered  # noqa: E402
from ..operators.report import run_metadata  # noqa: E402
from ..sources.state import read_state, write_state  # noqa: E402
from ..sources.state_log import commit_state, log_entry, read_log, version_before  # noqa: E402


@register("ordered_anomalies", f"""
WITH {_anoms_cte()}
SELECT row_number() OVER (ORDER BY ts, metric) AS position, metric, {day('ts')} AS timestamp, {r6('z')} AS z_score
FROM anom""")
def q_ordered_anomalies(spark, sf_dir):
    # what the anomaly sink wrote, numbered by the names of its part files and the rows' places in them
    path = write_ordered(flagship_anomalies(spark, sf_dir), scratch_path(spark, "ordered", uuid.uuid4().hex))
    written = spark.read.parquet(path).select("metric", "timestamp", "z_score", F.col("_metadata.file_name").alias("part"),
                                              F.col("_metadata.row_index").alias("place"))
    numbered = global_row_number(written, ["part", "place"], "position")
    return finish(numbered.select("position", "metric", "timestamp", "z_score"))


@register("anomaly_records", f"""
WITH {_anoms_cte()}
SELECT metric, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, {r6('value')} AS actual, {r6('m')} AS rolling_mean,
       {r6('z')} AS z_score, CASE WHEN z > 0 THEN 'up' ELSE 'down' END AS direction,
       'zscore' AS detection_mode_used, true AS seasonal_period_is_null
FROM anom""")
def q_anomaly_records(spark, sf_dir):
    # JSON records with ISO timestamps, parsed again
    fields = ("metric string, timestamp string, actual double, rolling_mean double, z_score double, "
              "direction string, detection_mode_used string, seasonal_period int")
    records = anomaly_records(flagship_anomalies(spark, sf_dir))
    parsed = records.select(F.from_json("record", fields).alias("r")).select("r.*")
    return finish(parsed.withColumn("seasonal_period_is_null", F.col("seasonal_period").isNull()).drop("seasonal_period"))


@register("file_source_metrics", f"""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {r6('CAST(event_id AS DOUBLE)')} AS event_id,
       {r6('CAST(user_id AS DOUBLE)')} AS user_id, {r6('value')} AS value
FROM events WHERE ts IS NOT NULL AND ts >= TIMESTAMP '2024-01-02'""")
def q_file_source_metrics(spark, sf_dir):
    wide = read_metrics(spark, MetricSource(kind="file", path=f"{sf_dir}/events.parquet", timestamp_column="ts",
                                            since="2024-01-02"))
    return finish(wide.df.select("ts", *wide.metrics))


@register("state_round_trip", f"""
WITH RECURSIVE {_anoms_cte()},
{_fold_sql('fold1', 'anom', None)},
state1 AS ({_state_after_sql('fold1', 'anom', None)})
SELECT metric, state, {r6('last_alert_z')} AS last_alert_z, last_alert_at, {r6('last_value')} AS last_value FROM state1""")
def q_state_round_trip(spark, sf_dir):
    base = scratch_path(spark, "state", uuid.uuid4().hex)
    write_state(_whole_run(spark, sf_dir)[1], base, "run-000001")
    return _state_view(read_state(spark, base, before="run-000002"))


@register("report_metadata", _kept1_sql(f"""
SELECT 'run-000001' AS run_id, 'zscore' AS detection_mode, CAST(count(*) AS BIGINT) AS n_anomalies,
       {_sql_str(RUN_TS)} AS generated_at FROM kept HAVING count(*) > 0"""))
def q_report_metadata(spark, sf_dir):
    return finish(run_metadata(_kept_run1(spark, sf_dir), "run-000001", "zscore", RUN_TS))


@register("alert_subject_cases", _kept1_sql(f"""
SELECT grp, n AS n_items, n - e AS n_new, e AS n_escalations,
       CASE WHEN e > 0 AND n - e = 0 THEN {sql_fill(SUBJECT_ESCALATIONS_ONLY, **_COUNTS)}
            WHEN e > 0 THEN {sql_fill(SUBJECT_MIXED, **_COUNTS)}
            ELSE {sql_fill(SUBJECT_NEW_ONLY, **_COUNTS)} END AS subject
FROM (SELECT grp, count(*) AS n, count(*) FILTER (WHERE is_escalation) AS e
      FROM (SELECT *, 'all' AS grp FROM kept
            UNION ALL SELECT *, CASE WHEN is_escalation THEN 'escalations' ELSE 'new' END FROM kept) GROUP BY grp)
WHERE n > 0"""))
def q_alert_subject_cases(spark, sf_dir):
    # the whole run, and what it would say of its new and of its escalated items alone
    kept = cut_lineage(_kept_run1(spark, sf_dir), "kept")
    out = None
    for name, rows in (("all", kept), ("new", kept.filter("NOT is_escalation")), ("escalations", kept.filter("is_escalation"))):
        one = alert_subject(rows, RUN_TS).select(F.lit(name).alias("grp"), "n_items", "n_new", "n_escalations", "subject")
        out = one if out is None else out.unionByName(one)
    return finish(out)


@register("suppression_ties", f"""
WITH RECURSIVE {_anoms_cte()},
tied AS (SELECT metric, date_trunc('year', ts) AS ts, value, z, az,
                row_number() OVER (PARTITION BY metric ORDER BY date_trunc('year', ts), value, z) AS rn
         FROM anom),
{_fold_sql('fold', 'tied', None)}
SELECT a.metric, strftime(a.ts, '%Y-%m-%d') AS timestamp, {r6('a.z')} AS z_score, f.decision,
       f.decision = 'escalation' AS is_escalation
FROM tied a JOIN fold f USING (metric, rn)""")
def q_suppression_ties(spark, sf_dir):
    # all anomalies of a year at one time: they are decided one after the other
    anomalies = flagship_anomalies(spark, sf_dir).withColumn("timestamp", F.trunc("timestamp", "year").cast("timestamp_ntz"))
    decisions, _ = apply_suppression(summarize(anomalies), None, None, SuppressOptions(True, DELTA), RUN_TS)
    return _decisions_view(decisions)


@register("dirty_cells_zscore", f"""
WITH long AS (SELECT event_type AS metric, event_id, ts, CASE WHEN event_id % 7 < 3 THEN NULL ELSE value END AS value
              FROM events),
scored AS ({_rolling_sql('long', 30, 15)})
SELECT metric, event_id, {r6('value')} AS value, n_obs, {r6('m')} AS rolling_mean, {r6('sd')} AS rolling_std, {r6('z')} AS z
FROM scored""")
def q_dirty_cells_zscore(spark, sf_dir):
    # NaN, infinities and text that is no number count as missing cells
    text = (F.when(F.col("event_id") % 7 == 0, "NaN").when(F.col("event_id") % 7 == 1, "-Infinity")
            .when(F.col("event_id") % 7 == 2, "n/a").otherwise(F.col("value").cast("string")))
    events = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "event_id", "ts",
                                                     finite_or_null(text).alias("value"))
    scored = rolling_stats(events, DetectOptions(window_size=30, min_periods=15))
    return finish(scored.drop("ts"))


@register("empty_run", f"""
WITH {_anoms_cte()}
SELECT CAST(0 AS BIGINT) AS subjects, CAST(0 AS BIGINT) AS body_lines, CAST(0 AS BIGINT) AS reports,
       CAST(count(*) FILTER (WHERE az > 1000) AS BIGINT) AS anomalies FROM anom""")
def q_empty_run(spark, sf_dir):
    # a run that flags nothing makes no alert and no report
    none = detect_anomalies(T.orders_daily(spark, sf_dir), "ts", T.ORDER_METRICS,
                            options=DetectOptions(window_size=30, z_threshold=1000.0))
    decisions, _ = apply_suppression(attach_notes(summarize(cut_lineage(none))), None, None, SuppressOptions(), RUN_TS)
    kept = kept_only(decisions)
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return (count(alert_subject(kept, RUN_TS), "subjects")
            .join(count(alert_body_lines(kept, RUN_TS), "body_lines"))
            .join(count(run_metadata(kept, "run-000001", "zscore", RUN_TS), "reports"))
            .join(count(kept, "anomalies")))


# ---------------------------------------------------------------------------
# scheduled runs over micro-batches; resets; large windows
# ---------------------------------------------------------------------------

from ..plans.monitor import MonitorConfig  # noqa: E402
from ..streaming.scheduled import read_records, run_scheduled  # noqa: E402

RUNS = 3


@register("scheduled_runs", f"""
WITH RECURSIVE cube AS (SELECT * FROM ({T.ORDERS_DAILY_SQL})),
long AS ({_unpivot_sql('cube', T.ORDER_METRICS)}),
scored AS ({_rolling_sql('long', 30, 30)}),
points AS (SELECT metric, ts, value, z, z IS NOT NULL AND abs(z) > 3 AS flagged FROM scored WHERE value IS NOT NULL),
streaks AS (SELECT *, sum(CASE WHEN flagged THEN 0 ELSE 1 END) OVER (PARTITION BY metric ORDER BY ts) AS streak
            FROM points),
anom AS (SELECT metric, ts, value, z, abs(z) AS az, streak,
                row_number() OVER (PARTITION BY metric, streak ORDER BY ts) AS rn FROM streaks WHERE flagged),
fold(metric, streak, rn, lz, decision) AS (
  SELECT metric, streak, rn, az, 'new' FROM anom WHERE rn = 1
  UNION ALL
  SELECT a.metric, a.streak, a.rn, CASE WHEN a.az - f.lz >= {DELTA} THEN a.az ELSE f.lz END,
         CASE WHEN a.az - f.lz >= {DELTA} THEN 'escalation' ELSE 'suppressed' END
  FROM fold f JOIN anom a ON a.metric = f.metric AND a.streak = f.streak AND a.rn = f.rn + 1),
decided AS (SELECT a.*, f.decision, f.lz FROM anom a JOIN fold f USING (metric, streak, rn)),
ends AS (SELECT p.metric, arg_max(p.flagged, p.ts) AS active FROM points p GROUP BY 1),
after AS (SELECT d.metric, arg_max(d.lz, d.ts) AS lz, arg_max(d.value, d.ts) AS last_value,
                 arg_max({day('d.ts')}, d.ts) FILTER (WHERE d.decision <> 'suppressed') AS alerted
          FROM decided d GROUP BY 1)
SELECT d.metric, {day('d.ts')} AS timestamp, {r6('d.z')} AS z_score, d.decision,
       d.decision = 'escalation' AS is_escalation,
       CASE WHEN e.active THEN 'active_anomaly' ELSE 'normal' END AS state,
       CASE WHEN e.active THEN {r6('a.lz')} END AS last_alert_z,
       CASE WHEN e.active THEN a.alerted END AS last_alert_at, {r6('a.last_value')} AS last_value
FROM decided d JOIN ends e USING (metric) JOIN after a USING (metric)""")
def q_scheduled_runs(spark, sf_dir):
    # the cube in several files in time order, one run each; every window reaches into earlier runs' rows
    cube = cut_lineage(T.orders_daily(spark, sf_dir), "cube")
    day_no = F.unix_date(F.to_date("ts"))
    first, last = cube.agg(F.min(day_no), F.max(day_no)).first()
    folder = new_stream_dir(spark, "scheduled")
    for k in range(RUNS):
        part = F.floor((day_no - first) * RUNS / (last - first + 1)) == k
        cube.filter(part).coalesce(1).write.parquet(f"{folder}/input/file-{k}")
    stream = (spark.readStream.schema(cube.schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(f"{folder}/input"))
    config = MonitorConfig(detect=FLAGSHIP, suppress=SuppressOptions(True, DELTA, "point"), run_ts=RUN_TS,
                           state_base=f"{folder}/runs")
    run_scheduled(stream, "ts", T.ORDER_METRICS, config, f"{folder}/checkpoint")
    decisions = read_records(spark, config.state_base, "decisions")
    state = read_state(spark, config.state_base).select("metric", "state", "last_alert_z", "last_alert_at", "last_value")
    return finish(decisions.select("metric", "timestamp", "z_score", "decision", "is_escalation").join(state, "metric"))


@register("quiet_metrics_reset", f"""
WITH RECURSIVE {_anoms_cte()},
{_fold_sql('fold', 'anom', None)},
after AS ({_state_after_sql('fold', 'anom', None)})
SELECT metric, 'normal' AS state, CAST(NULL AS DOUBLE) AS last_alert_z, CAST(NULL AS VARCHAR) AS last_alert_at,
       {r6('last_value')} AS last_value, true AS reset FROM after""")
def q_quiet_metrics_reset(spark, sf_dir):
    # a second run over the cube's first days, too few for any window: it sees all metrics and no anomaly
    _decisions, active = _whole_run(spark, sf_dir)
    active = cut_lineage(active, "state")
    quiet = T.orders_daily(spark, sf_dir)
    quiet = quiet.filter(F.col("ts") < F.lit(quiet.agg(F.min("ts")).first()[0]) + F.expr("INTERVAL 20 DAYS"))
    none = attach_notes(summarize(detect_anomalies(quiet, "ts", T.ORDER_METRICS, options=FLAGSHIP)))
    _none, state = apply_suppression(none, active, observed_from_metrics(spark, T.ORDER_METRICS),
                                     SuppressOptions(True, DELTA), RUN_TS)
    was = active.select("metric", (F.col("state") == "active_anomaly").alias("was"))
    reset = F.col("was") & (F.col("state") == "normal")
    return finish(state.join(was, "metric").select("metric", "state", "last_alert_z", "last_alert_at", "last_value",
                                                   reset.alias("reset")))


_STATE_COLS = f"metric, state, {r6('last_alert_z')} AS last_alert_z, last_alert_at, {r6('last_value')} AS last_value"


@register("state_log_runs", _two_run_sql(f"""
SELECT 1 AS version, {_STATE_COLS}, true AS written FROM state1
UNION ALL
SELECT 2, {_STATE_COLS}, metric IN (SELECT metric FROM upd2) OR metric IN (SELECT metric FROM reset2) FROM state2
UNION ALL
SELECT 3, metric, 'normal', CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), {r6('last_value')}, state = 'active_anomaly'
FROM state2"""))
def q_state_log_runs(spark, sf_dir):
    """Three runs (days before the cutoff, the rest, the cube's first days: no anomaly, so all reset)
    that hand state on through the log; each version as read back, and which rows the run wrote."""
    base = scratch_path(spark, "state-log", uuid.uuid4().hex)
    observed = observed_from_metrics(spark, T.ORDER_METRICS)
    cube = T.orders_daily(spark, sf_dir)
    quiet = cube.filter(F.col("ts") < F.lit(cube.agg(F.min("ts")).first()[0]) + F.expr("INTERVAL 20 DAYS"))
    runs = [flagship_anomalies(spark, sf_dir, f"ts < DATE'{RUN_CUTOFF}'"),
            flagship_anomalies(spark, sf_dir, f"ts >= DATE'{RUN_CUTOFF}'"),
            detect_anomalies(quiet, "ts", T.ORDER_METRICS, options=FLAGSHIP)]
    out = None
    for k, found in enumerate(runs, 1):
        version = version_before(spark, base, f"run-{k}")
        state = read_log(spark, base, version=version) if version else None
        _decisions, after = apply_suppression(attach_notes(summarize(found)), state, observed,
                                              SuppressOptions(True, DELTA), f"2024-06-{k:02d} 00:00:00")
        commit_state(after, base, f"run-{k}", version)
        part = spark.read.schema(after.schema).parquet(f"{base}/{log_entry(spark, base, k)['parts'][-1]}")
        rows = (read_log(spark, base, version=k)
                .join(part.select("metric", F.lit(True).alias("_new")), "metric", "left")
                .select(F.lit(k).alias("version"), "metric", "state", "last_alert_z", "last_alert_at", "last_value",
                        F.coalesce("_new", F.lit(False)).alias("written")))
        out = rows if out is None else out.unionByName(rows)
    return finish(out)


#: A window of a prime number of rows: means don't end on a half of the digits that are compared.
LARGE = DetectOptions(window_size=401, z_threshold=3.0)


@register("large_window_zscore", f"""
WITH long AS (SELECT event_type AS metric, event_id, ts, value FROM events),
scored AS ({_rolling_sql('long', 401, 401)})
SELECT metric, event_id, n_obs, {r6('m')} AS rolling_mean, {r6('sd')} AS rolling_std, {r6('z')} AS z FROM scored""")
def q_large_window_zscore(spark, sf_dir):
    # windows of 401 rows: two look-ups a row
    long = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "event_id", "ts", "value")
    return finish(rolling_stats(long, LARGE).select("metric", "event_id", "n_obs", "rolling_mean", "rolling_std", "z"))
