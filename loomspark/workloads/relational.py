"""Relational queries over the star-schema tables: capabilities of Spark itself, kept as smoke coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.session import table
from loomspark.workloads import query


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY ALL")
def spark_pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02 00:00:00'")
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT n_name, count(DISTINCT o_orderkey) AS orders, round(sum(l_extendedprice), 2) AS price FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def spark_orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    c, o, i, n = (table(spark, d, x) for x in ("customer", "orders", "lineitem", "nation"))
    j = o.join(i, o.o_orderkey == i.l_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name").agg(F.count_distinct("o_orderkey").alias("orders"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def spark_events_by_day(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "events")
    return t.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
