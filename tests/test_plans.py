"""Plan-shape checks: each source is scanned once, scans read only needed columns, filters
reach the scan. Row counts come from the executed (adaptive) plan's scan metrics; a branch
that reuses an exchange shows up as 'reused' instead of a second scan."""

from pyspark.sql import functions as F

from tidewatch.operators.rolling import detect_anomalies
from tidewatch.operators.seasonal import seasonal_anomalies
from tidewatch.options import DetectOptions
from tidewatch.plans import tables as T
from tidewatch.sources.metrics import to_long

SF = "/root/testdata/sf0.001"


def executed_scans(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    final = plan.finalPhysicalPlan()
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "ReusedExchange":
            out.append("reused")
            return
        if "Scan" in name:
            out.append(node.metrics().get("numOutputRows").get().value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
        if name.endswith("QueryStage"):
            walk(node.plan())

    walk(final)
    return out


def scanned_once(scans):
    real = [s for s in scans if s != "reused"]
    return len([s for s in real if s > 0]) == 1


def test_flagship_scans_once_and_prunes(spark):
    df = detect_anomalies(T.orders_daily(spark, SF), "ts", T.ORDER_METRICS)
    assert scanned_once(executed_scans(df))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_seasonal_branches_share_one_scan(spark):
    long = to_long(T.orders_daily(spark, SF), "ts", T.ORDER_METRICS)
    for mode in ("seasonal", "classical"):
        scans = executed_scans(seasonal_anomalies(long, DetectOptions(mode=mode)))
        assert scanned_once(scans), (mode, scans)


def test_filter_reaches_scan(spark):
    o = T.table(spark, SF, "orders").filter(F.col("o_orderdate") < F.lit("1998-05-01").cast(
        "timestamp_ntz"))
    df = detect_anomalies(o.groupBy(F.to_date("o_orderdate").alias("ts"))
                          .agg(F.sum("o_totalprice").alias("revenue")), "ts", ["revenue"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan


def test_many_series_plan_has_two_shuffles(spark):
    df = detect_anomalies(T.supplier_weekly(spark, SF), "ts", ["revenue", "quantity"],
                          keys=["l_suppkey"], options=DetectOptions(window_size=12))
    assert scanned_once(executed_scans(df))
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    # partial aggregate -> exchange -> final aggregate -> Expand -> exchange by series -> Window
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in plan


def test_since_reaches_the_scan_of_a_read(spark):
    from tidewatch.sources.metrics import MetricSource, read_metrics
    wide = read_metrics(spark, MetricSource(kind="file", path="/root/testdata/sf0.001/events.parquet",
                                            timestamp_column="ts", since="2024-01-02"))
    plan = wide.df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in pushed[:pushed.index("]")]
