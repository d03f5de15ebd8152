"""Remaining forms: SQL subqueries, table functions, ranks, three-valued sorts, maps, schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rodaje.functions.numeric import scaled_round
from rodaje.operators import tables
from rodaje.plans.book import Book
from rodaje.sources import table

BOOK = Book()


def _sql(spark: SparkSession, d: str, text: str, *names: str) -> DataFrame:
    """The text's {name} references are the tables; no views are left behind."""
    return spark.sql(text, **{n: table(spark, d, n) for n in names})


@BOOK.add("""
    SELECT c_custkey, (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(28, 2))) AS DOUBLE) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS cerrado,
           EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS urgente FROM customer""")
def i1_correlated_subqueries(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, """
        SELECT c_custkey, (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(28, 2))) AS DOUBLE) FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS cerrado,
               EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS urgente FROM {customer}""", "orders", "customer")  # fmt: skip


@BOOK.add("""
    WITH a AS (SELECT l_suppkey, l_partkey, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2), b AS (SELECT l_suppkey, avg(q) AS m FROM a GROUP BY 1)
    SELECT a.l_suppkey, count(*) AS sobre FROM a JOIN b USING (l_suppkey) WHERE q > m GROUP BY 1 HAVING count(*) > 2""")
def i2_cte_chain(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, """
        WITH a AS (SELECT l_suppkey, l_partkey, max(l_quantity) AS q FROM {lineitem} GROUP BY ALL), b AS (SELECT l_suppkey, avg(q) AS m FROM a GROUP BY ALL)
        SELECT a.l_suppkey, count(*) AS sobre FROM a JOIN b USING (l_suppkey) WHERE q > m GROUP BY 1 HAVING count(*) > 2""", "lineitem")  # fmt: skip


@BOOK.add("""
    SELECT p_partkey, palabra, CAST(orden AS INTEGER) AS orden FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS palabra, generate_subscripts(string_split(p_name, ' '), 1) AS orden FROM part)""")
def i3_table_function(spark: SparkSession, d: str) -> DataFrame:
    """A title's words by a lateral join with a table function."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    words = spark.tvf.posexplode(F.split(F.col("p_name").outer(), " "))
    return part.lateralJoin(words).select("p_partkey", F.col("col").alias("palabra"), (F.col("pos") + 1).alias("orden"))


@BOOK.add("""
    SELECT n_name, c_custkey, rank() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC) AS puesto, count(*) OVER (PARTITION BY n_name) AS de FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def i4_rank_in_group(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    own = W.partitionBy("n_name")
    return rows.select("n_name", "c_custkey", F.rank().over(own.orderBy(F.desc("c_acctbal"))).alias("puesto"), F.count(F.lit(1)).over(own).alias("de"))


@BOOK.add("""
    WITH x AS (SELECT p_partkey, p_retailprice, CASE WHEN p_size < 5 THEN NULL ELSE 30 BETWEEN p_size - 5 AND p_size + 5 END AS sirve FROM part)
    SELECT *, row_number() OVER (ORDER BY CASE WHEN sirve THEN 0 WHEN sirve IS NULL THEN 1 ELSE 2 END, p_retailprice, p_partkey) AS puesto FROM x QUALIFY puesto <= 300""")
def i5_three_valued_sort(spark: SparkSession, d: str) -> DataFrame:
    known = lambda delta: F.when(F.col("p_size") >= 5, F.col("p_size") + delta)
    x = table(spark, d, "part").select("p_partkey", "p_retailprice", tables.fits(F.lit(30), known(-5), known(5)).alias("sirve"))
    by = [F.when(F.col("sirve"), 0).when(F.col("sirve").isNull(), 1).otherwise(2), F.col("p_retailprice"), F.col("p_partkey")]
    return x.orderBy(*by).limit(300).withColumn("puesto", F.row_number().over(W.orderBy(*by)))


@BOOK.add("""
    WITH g AS (SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_size > 20 GROUP BY 1, 2)
    SELECT p_brand, '{' || string_agg('"' || p_type || '":' || n, ',' ORDER BY p_type) || '}' AS tipos FROM g GROUP BY 1""")
def i6_map_aggregate(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "part").where("p_size > 20").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return g.groupBy("p_brand").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p_type", "n"))))).alias("tipos"))


@BOOK.add("""
    SELECT p_partkey, CAST(t AS INTEGER) AS anio, round((p_retailprice * 0.1 * t + 50.0 * floor((t - 1) / 3.0 + 1)) * 100) / 100 AS acumulado FROM part, range(1, 8) AS r(t)""")
def i7_cumulative_schedule(spark: SparkSession, d: str) -> DataFrame:
    out = tables.schedule(table(spark, d, "part").select("p_partkey", "p_retailprice"), 7, F.col("p_retailprice") * 0.1, F.lit(50.0), 3)
    return out.select("p_partkey", "anio", scaled_round(F.col("acumulado"), 2).alias("acumulado"))


@BOOK.add("""
    WITH s AS (SELECT o_custkey, count(*) AS n, stddev_samp(o_totalprice) IS NULL AS uno FROM orders GROUP BY 1)
    SELECT uno, min(n) AS menos, max(n) AS mas FROM s GROUP BY 1""")
def i8_aggregate_of_aggregate(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("o_totalprice").isNull().alias("uno"))
    return s.groupBy("uno").agg(F.min("n").alias("menos"), F.max("n").alias("mas"))


@BOOK.add("SELECT k, v, k * 2 AS doble FROM (VALUES (1, 'a'), (2, NULL)) AS t(k, v)")
def i9_registered_frame(spark: SparkSession, d: str) -> DataFrame:
    """A driver-side table used from SQL."""
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    return spark.sql("SELECT k, v, k * 2 AS doble FROM {t}", t=spark.createDataFrame([(1, "a"), (2, None)], schema))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
