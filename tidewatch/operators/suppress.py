"""Per-series suppress / escalate state machine with a versioned state table.

Rules (per series, anomalies in time order):
  * state normal (or unknown)  -> the anomaly alerts as ``new``; the series becomes active;
  * state active               -> ``escalation`` when ``|z| - last_alert_z >= delta``,
                                  else ``suppressed`` (last alert z/time kept);
  * a series observed in the run with no anomaly at all, and active, resets to normal.

The fold is sequential, but for a delta of at least 0 every kept row after the first is a
running maximum of |z| in its series (the stored |z| counted): all rows since the last alert
stayed below its |z| plus delta. So the anomalies are thinned to those records first, by a
prefix maximum over range-partitioned chunks (a hot series is never one task). At delta 0 the
records are the answer; otherwise a fold picks from them, at most ``FOLD_ROWS`` records of a
series at a time. Anomalies of one series at the same time are decided one after the other, in
the order of actual value, z-score and row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..options import SuppressOptions
from ..session import cut_lineage

#: Records of one series that one step of the fold takes into an array.
FOLD_ROWS = 10_000
STATE_NORMAL = "normal"
STATE_ACTIVE = "active_anomaly"
STATE_COLUMNS = ["metric", "state", "last_alert_z", "last_alert_at", "last_value", "updated_at"]
STATE_DDL = ("metric string, state string, last_alert_z double, last_alert_at string, "
             "last_value double, updated_at timestamp")


def empty_state(spark: SparkSession, keys: Sequence[str] = (), key_types: str = "") -> DataFrame:
    ddl = (key_types + ", " if key_types else "") + STATE_DDL
    df = spark.createDataFrame([], ddl)
    return df.select(*keys, *STATE_COLUMNS)


def _ts_lit(run_ts) -> F.Column:
    return F.to_timestamp(F.lit(str(run_ts)))


def apply_suppression(events: DataFrame, state: DataFrame | None, observed: DataFrame | None,
                      options: SuppressOptions = SuppressOptions(), run_ts="1970-01-01 00:00:00",
                      keys: Sequence[str] = (), order: Sequence[str] = ("event_ts",),
                      in_range: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Decide every anomaly and produce the next state version.

    events   summarised anomalies: keys, metric, ``order`` columns, timestamp (date text),
             z_score, actual.
    state    previous state table (keys, STATE_COLUMNS) or None.
    observed series seen in this run ``(keys, metric)``; None = series with anomalies.
    in_range for ``reset_scope='point'``: the run's non-anomalous observations (keys, metric,
             ``order`` columns); each one resets its series to normal.
    Returns ``(decisions, new_state)``; decisions = events + decision + is_escalation.
    """
    point = options.reset_scope == "point"
    if options.reset_scope not in ("run", "point"):
        raise ValueError(f"Unknown reset_scope: {options.reset_scope}")
    if point and in_range is None:
        raise ValueError("reset_scope='point' needs the in_range observations")
    spark = events.sparkSession
    sk = [*keys, "metric"]
    if state is None:
        fields = [events.schema[k] for k in keys] + list(empty_state(spark).schema.fields)
        state = spark.createDataFrame([], StructType(fields))
    options.validated()
    # written once: the row ids have to be the same wherever they are read
    events = cut_lineage(events.drop("decision", "is_escalation").withColumn(
        "_rid", F.monotonically_increasing_id()), "events")
    # the fold only needs a slim projection; decisions are joined back onto the full rows
    ev = (events.select(*sk, *[c for c in order if c not in sk], "timestamp", "z_score", "actual", "_rid")
          .withColumn("_ord", F.struct(*order, "actual", "z_score", "_rid"))
          .withColumn("_az", F.abs(F.col("z_score"))))
    if point:
        ev = ev.join(_segments(ev, in_range, sk, order), "_rid")
    else:
        ev = ev.withColumn("_seg", F.lit(0).cast("long"))
    init = state.select(*sk, F.col("state").alias("_s0"), F.col("last_alert_z").alias("_z0"),
                        F.col("last_alert_at").alias("_at0"), F.col("last_value").alias("_v0"))

    if options.enabled:
        kept = _escalation_chain(ev, init, sk, options.escalation_z_delta)
        decided = (ev.join(kept, "_rid", "left")
                   .withColumn("decision", F.coalesce(F.col("decision"), F.lit("suppressed"))))
    else:
        decided = ev.withColumn("decision", F.lit("kept"))
    decided = cut_lineage(decided.withColumn("is_escalation", F.col("decision") == "escalation"), "decided")

    updates = _anomalous_updates(decided, init, sk, options.enabled, run_ts)
    if point:
        updates = _end_in_range(updates, decided, in_range, sk, order)
    if observed is not None:
        updates = updates.unionByName(_resets(observed, decided, init, sk, run_ts))
    new_state = (state.join(updates.select(*sk), sk, "left_anti").select(*sk, *STATE_COLUMNS[1:])
                 .unionByName(updates.select(*sk, *STATE_COLUMNS[1:])))
    decisions = events.join(decided.select("_rid", "decision", "is_escalation"), "_rid").drop("_rid")
    return decisions, new_state


def _segments(ev: DataFrame, in_range: DataFrame, sk: list[str], order: Sequence[str]) -> DataFrame:
    """``(_rid, _seg)``: in-range observations seen before each anomaly in this run.

    seg = (position among all marked points) - (position among the anomalies). Both
    positions come from range-partitioned numbering, so a hot series is never one task; the
    final join only involves anomaly rows. In-range observations come before anomalies of
    the same time.
    """
    from .halo import series_positions
    keys, ts, tiebreak = sk[:-1], order[0], [*order[1:], "_rid"]
    cols = [*sk, *[c for c in order if c not in sk], "_rid"]
    marks = ev.select(*cols).unionByName(in_range.withColumn("_rid", F.lit(None).cast("long")).select(*cols))
    all_pos = series_positions(marks, keys, ts, tiebreak, name="_p_all").filter(F.col("_rid").isNotNull())
    anomaly_pos = series_positions(ev.select(*cols), keys, ts, tiebreak, name="_p_anomaly")
    return (anomaly_pos.select("_rid", "_p_anomaly").join(all_pos.select("_rid", "_p_all"), "_rid")
            .select("_rid", (F.col("_p_all") - F.col("_p_anomaly")).alias("_seg")))


def _end_in_range(updates: DataFrame, ev: DataFrame, in_range: DataFrame, sk: list[str],
                  order: Sequence[str]) -> DataFrame:
    """Series whose last observation of the run is in range end the run normal."""
    last_in = in_range.groupBy(*sk).agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_li"))
    last_an = ev.groupBy(*sk).agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_la"))
    ends = last_in.join(last_an, sk).filter(F.col("_li") > F.col("_la")).select(
        *sk, F.lit(True).alias("_ends_normal"))
    normal = F.coalesce(F.col("_ends_normal"), F.lit(False))
    return (updates.join(ends, sk, "left")
            .withColumn("state", F.when(normal, F.lit(STATE_NORMAL)).otherwise(F.col("state")))
            .withColumn("last_alert_z", F.when(~normal, F.col("last_alert_z")))
            .withColumn("last_alert_at", F.when(~normal, F.col("last_alert_at")))
            .drop("_ends_normal"))


def _records(ev: DataFrame, gk: list[str], start: DataFrame, strict: bool) -> DataFrame:
    """Anomalies whose |z| tops all earlier ones of their (series, segment) and the stored one.

    ``start``: (gk, _z) of segments that continue an active state. Rows are dealt out by ranges
    of the order; each part's running maximum is joined with the maximum of the parts before
    (one row for each part and segment in it). Adds ``_first``: nothing came before.
    """
    parts = cut_lineage(ev.select(*gk, "_ord", "_az", "_rid").repartitionByRange(*gk, "_ord")
                        .withColumn("_part", F.spark_partition_id()), "fold-order")
    earlier = Window.partitionBy("_part", *gk).orderBy("_ord").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*gk).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (parts.groupBy("_part", *gk).agg(F.max("_az").alias("_most"))
             .withColumn("_carry", F.max("_most").over(before)).drop("_most"))
    top = F.greatest(F.max("_az").over(earlier), F.col("_carry"), F.col("_z"))
    rows = parts.join(carry, ["_part", *gk]).join(start, gk, "left").withColumn("_top", top)
    above = F.col("_az") > F.col("_top") if strict else F.col("_az") >= F.col("_top")
    return (rows.filter(F.col("_top").isNull() | above)
            .select(*gk, "_ord", "_az", "_rid", F.col("_top").isNull().alias("_first")))


def _escalation_chain(ev: DataFrame, init: DataFrame, sk: list[str], delta: float) -> DataFrame:
    """Kept anomalies ``(_rid, decision)``, per (series, segment); only segment 0 continues from
    the stored state, later segments start normal."""
    gk = [*sk, "_seg"]
    start = (init.filter(F.col("_s0") == STATE_ACTIVE)
             .select(*sk, F.lit(0).cast("long").alias("_seg"),
                     F.coalesce(F.abs(F.col("_z0")), F.lit(0.0)).alias("_z")))
    records = _records(ev, gk, start, strict=delta > 0)
    named = F.when(F.col("_first"), F.lit("new")).otherwise(F.lit("escalation")).alias("decision")
    if delta == 0:
        return records.select("_rid", named)
    step = F.floor((F.row_number().over(Window.partitionBy(*gk).orderBy("_ord")) - 1) / FOLD_ROWS)
    records = cut_lineage(records.withColumn("_step", step), "records")
    steps = records.agg(F.max("_step")).first()[0]
    kept, last = None, start.withColumnRenamed("_z", "_last")
    for k in range((steps or 0) + 1):
        one = (records.filter(F.col("_step") == k).groupBy(*gk)
               .agg(F.sort_array(F.collect_list(F.struct("_ord", "_az", "_rid", "_first"))).alias("_rows"))
               .join(last, gk, "left"))
        begin = F.struct(F.col("_last").alias("last"), F.expr("CAST(ARRAY() AS ARRAY<BIGINT>)").alias("kept"))
        folded = F.aggregate("_rows", begin, lambda acc, r: F.when(
            acc["last"].isNull() | (r["_az"] - acc["last"] >= F.lit(float(delta))),
            F.struct(r["_az"].alias("last"), F.concat(acc["kept"], F.array(r["_rid"])).alias("kept"))).otherwise(acc))
        one = one.select(*gk, folded.alias("_f"))
        if steps:
            one = cut_lineage(one, "fold-step")
            last = (last.join(one.select(*gk), gk, "left_anti")
                    .unionByName(one.select(*gk, F.col("_f.last").alias("_last"))))
        part = one.select(F.explode("_f.kept").alias("_rid"))
        kept = part if kept is None else kept.unionAll(part)
    return records.join(kept, "_rid").select("_rid", named)


def _anomalous_updates(decisions: DataFrame, init: DataFrame, sk: list[str], enabled: bool,
                       run_ts) -> DataFrame:
    last_any = decisions.groupBy(*sk).agg(
        F.max_by(F.struct("_az", "timestamp", "actual"), "_ord").alias("la"))
    if enabled:
        last_kept = (decisions.filter(F.col("decision") != "suppressed").groupBy(*sk)
                     .agg(F.max_by(F.struct("_az", "timestamp"), "_ord").alias("lk")))
        u = last_any.join(last_kept, sk, "left").join(init, sk, "left")
        z = F.coalesce(F.col("lk._az"), F.abs(F.col("_z0")), F.lit(0.0))
        at = F.when(F.col("lk").isNotNull(), F.col("lk.timestamp")).otherwise(F.col("_at0"))
    else:
        u = last_any
        z, at = F.col("la._az"), F.col("la.timestamp")
    return u.select(*sk, F.lit(STATE_ACTIVE).alias("state"), z.alias("last_alert_z"),
                    at.alias("last_alert_at"), F.col("la.actual").alias("last_value"),
                    _ts_lit(run_ts).alias("updated_at"))


def _resets(observed: DataFrame, ev: DataFrame, init: DataFrame, sk: list[str], run_ts) -> DataFrame:
    """Observed series without anomalies in this run whose state is active -> normal."""
    quiet = observed.select(*sk).distinct().join(ev.select(*sk).distinct(), sk, "left_anti")
    return (quiet.join(init.filter(F.col("_s0") == STATE_ACTIVE), sk, "inner")
            .select(*sk, F.lit(STATE_NORMAL).alias("state"),
                    F.lit(None).cast("double").alias("last_alert_z"),
                    F.lit(None).cast("string").alias("last_alert_at"),
                    F.col("_v0").alias("last_value"), _ts_lit(run_ts).alias("updated_at")))


def observed_series(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Series present in this run's long frame (all-null series included)."""
    return long.select(*keys, "metric").distinct()


def observed_from_metrics(spark: SparkSession, metrics: Sequence[str]) -> DataFrame:
    """Observed set of a wide run: every metric column, from the schema."""
    return spark.createDataFrame([(m,) for m in metrics], "metric string")


def kept_only(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("decision") != "suppressed")
