"""Input tables of the registered queries and the metric cubes built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cube import metric_cube, pivot_cube

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# -- daily order metrics (the flagship cube) ---------------------------------

ORDER_METRICS = ["revenue", "order_count", "avg_price", "max_price", "f_share"]

ORDERS_DAILY_SQL = """
SELECT CAST(o_orderdate AS DATE) AS ts,
       sum(o_totalprice) AS revenue,
       CAST(count(*) AS DOUBLE) AS order_count,
       avg(o_totalprice) AS avg_price,
       max(o_totalprice) AS max_price,
       avg(CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS f_share
FROM orders GROUP BY 1"""


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice", "o_orderstatus")
    return metric_cube(o, "o_orderdate", {
        "revenue": F.sum("o_totalprice"),
        "order_count": F.count(F.lit(1)).cast("double"),
        "avg_price": F.avg("o_totalprice"),
        "max_price": F.max("o_totalprice"),
        "f_share": F.avg(F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0))),
    }, bucket="day")


# -- daily shipped-line metrics (a second source with other metric names) -----

LINE_METRICS = ["line_count", "quantity", "gross", "avg_discount"]

LINES_DAILY_SQL = """
SELECT CAST(l_shipdate AS DATE) AS ts,
       CAST(count(*) AS DOUBLE) AS line_count,
       sum(l_quantity) AS quantity,
       sum(l_extendedprice) AS gross,
       avg(l_discount) AS avg_discount
FROM lineitem GROUP BY 1"""


def lines_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_quantity", "l_extendedprice",
                                                 "l_discount")
    return metric_cube(li, "l_shipdate", {
        "line_count": F.count(F.lit(1)).cast("double"),
        "quantity": F.sum("l_quantity"),
        "gross": F.sum("l_extendedprice"),
        "avg_discount": F.avg("l_discount"),
    }, bucket="day")


# -- daily revenue per order priority (sparse: empty cells are NULL) ----------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIORITY_METRICS = ["p1_urgent", "p2_high", "p3_medium", "p4_not_specified", "p5_low"]

PRIORITY_DAILY_SQL = """
SELECT CAST(o_orderdate AS DATE) AS ts,
       sum(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS p1_urgent,
       sum(o_totalprice) FILTER (WHERE o_orderpriority = '2-HIGH') AS p2_high,
       sum(o_totalprice) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS p3_medium,
       sum(o_totalprice) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS p4_not_specified,
       sum(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS p5_low
FROM orders GROUP BY 1"""


def priority_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice", "o_orderpriority")
    cube = pivot_cube(o, "o_orderdate", "o_orderpriority", PRIORITIES, F.sum("o_totalprice"))
    return cube.select("ts", *[F.col(f"`{p}`").alias(m)
                               for p, m in zip(PRIORITIES, PRIORITY_METRICS)])


# -- hourly event metrics per event type (30 days -> 720 hours) ---------------

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EVENT_METRICS = [f"{t}_value" for t in EVENT_TYPES]

EVENTS_HOURLY_SQL = """
SELECT date_trunc('hour', ts) AS ts,
       sum(value) FILTER (WHERE event_type = 'click') AS click_value,
       sum(value) FILTER (WHERE event_type = 'error') AS error_value,
       sum(value) FILTER (WHERE event_type = 'purchase') AS purchase_value,
       sum(value) FILTER (WHERE event_type = 'signup') AS signup_value,
       sum(value) FILTER (WHERE event_type = 'view') AS view_value
FROM events GROUP BY 1"""


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    cube = pivot_cube(ev, "ts", "event_type", EVENT_TYPES, F.sum("value"), bucket="hour")
    return cube.select("ts", *[F.col(t).alias(f"{t}_value") for t in EVENT_TYPES])


# -- monthly revenue per nation (entity-keyed series) -------------------------

NATION_MONTHLY_SQL = """
SELECT n.n_name AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS ts,
       sum(o.o_totalprice) AS revenue, CAST(count(*) AS DOUBLE) AS order_count
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2"""


def nation_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .select(F.col("n_name").alias("nation"), "o_orderdate", "o_totalprice"))
    cube = metric_cube(joined, "o_orderdate", {
        "revenue": F.sum("o_totalprice"),
        "order_count": F.count(F.lit(1)).cast("double"),
    }, bucket="month", dims=["nation"])
    return cube.withColumn("ts", F.to_date("ts"))


# -- weekly shipped revenue per supplier (many series) --------------------------

SUPPLIER_WEEKLY_SQL = """
SELECT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS ts,
       sum(l_extendedprice * (1 - l_discount)) AS revenue, sum(l_quantity) AS quantity
FROM lineitem GROUP BY 1, 2"""


def supplier_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice",
                                                 "l_discount", "l_quantity")
    cube = metric_cube(li, "l_shipdate", {
        "revenue": F.sum(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))),
        "quantity": F.sum("l_quantity"),
    }, bucket="week", dims=["l_suppkey"])
    return cube.withColumn("ts", F.to_date("ts"))
