"""Relational coverage on the star schema: joins, grouping, windows, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.plans.registry import query, table

_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


@query(f"""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty, CAST(sum({_CENTS}) AS BIGINT) AS cents, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def q_pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))  # noqa: E741
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"), F.sum(_cents("l_extendedprice")).alias("cents"), F.count(F.lit(1)).alias("n"))


@query(f"""SELECT r_name, n_name, CAST(sum({_CENTS}) AS BIGINT) AS cents, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def q_rollup_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    by_supplier = t("lineitem").groupBy("l_suppkey").agg(F.sum(_cents("l_extendedprice")).alias("cents"), F.count(F.lit(1)).alias("n"))
    place = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return by_supplier.join(place, F.col("l_suppkey") == F.col("s_suppkey")).rollup("r_name", "n_name").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def q_cube_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '5%') GROUP BY 1")
def q_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    c = table(spark, sf_dir, "customer").join(orders.where("o_orderpriority like '1%'"), "c_custkey", "left_semi").join(orders.where("o_orderpriority like '5%'"), "c_custkey", "left_anti")
    return c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT band, count(*) AS parts FROM part JOIN (VALUES ('low', 0, 1000), ('mid', 1000, 1500), ('high', 1500, 100000)) b(band, lo, hi) ON p_retailprice >= lo AND p_retailprice < hi GROUP BY band""")
def q_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = spark.createDataFrame([("low", 0, 1000), ("mid", 1000, 1500), ("high", 1500, 100000)], "band string, lo int, hi int")  # three rows
    part = table(spark, sf_dir, "part")
    return part.join(F.broadcast(bands), (F.col("p_retailprice") >= F.col("lo")) & (F.col("p_retailprice") < F.col("hi"))).groupBy("band").agg(F.count(F.lit(1)).alias("parts"))


@query("""SELECT o_custkey, o_orderkey, rank() OVER w AS price_rank, dense_rank() OVER w AS price_dense, ntile(4) OVER w AS quartile, lag(o_orderkey) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)""")
def q_window_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    o = table(spark, sf_dir, "orders")
    return o.select("o_custkey", "o_orderkey", F.rank().over(w).cast("long").alias("price_rank"), F.dense_rank().over(w).cast("long").alias("price_dense"), F.ntile(4).over(w).cast("long").alias("quartile"), F.lag("o_orderkey").over(w).alias("before"))


@query("""SELECT o_custkey, o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS last3 FROM orders""")
def q_moving_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.sum(_cents("o_totalprice")).over(w).alias("last3"))


@query("""(SELECT c_custkey AS k, 'both' AS side FROM customer INTERSECT SELECT o_custkey, 'both' FROM orders) UNION ALL (SELECT c_custkey, 'idle' FROM customer EXCEPT SELECT o_custkey, 'idle' FROM orders)""")
def q_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, buyers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return customers.intersect(buyers).withColumn("side", F.lit("both")).unionByName(customers.subtract(buyers).withColumn("side", F.lit("idle")))


@query("""SELECT p_brand, p_type, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL ORDER BY qty DESC, p_brand, p_type LIMIT 25""")
def q_top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return sold.join(part, "l_partkey").groupBy("p_brand", "p_type").agg(F.sum("qty").alias("qty")).orderBy(F.col("qty").desc(), "p_brand", "p_type").limit(25)
