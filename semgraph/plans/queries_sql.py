"""Queries of the kinds that evaluation questions ask (AGG-21, JOIN-15, SRT-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query, table


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def q_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_orderpriority FROM orders")
def q_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderpriority").distinct()


@query("SELECT c_mktsegment, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
def q_join_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT n_name, count(s_suppkey) AS suppliers FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def q_left_join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return n.join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"))


@query("SELECT p_brand, round(avg(p_retailprice), 4) AS avg_price FROM part GROUP BY p_brand")
def q_avg_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 4).alias("avg_price"))


@query("SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey ORDER BY spent DESC, o_custkey LIMIT 10")
def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return spent.orderBy(F.desc("spent"), "o_custkey").limit(10)


@query("SELECT l_returnflag, round(count(*) FILTER (WHERE l_discount > 0.05) / count(*), 6) AS share FROM lineitem GROUP BY l_returnflag")
def q_count_if_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.count_if(F.col("l_discount") > 0.05) / F.count("*"), 6).alias("share"))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def q_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("SELECT quality = 1 AS good, count(*) AS n FROM labels WHERE toxic = 0 GROUP BY quality")
def q_bool_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("toxic = 0").groupBy((F.col("quality") == 1).alias("good")).agg(F.count("*").alias("n"))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY n_name")
def q_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    joined = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
