"""Aggregates, windows, tops and set operations over the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.functions.numeric import exact_sum, percent, safe_ratio, scaled_round, weighted_mean
from rodaje.operators import windows
from rodaje.plans.book import Book
from rodaje.sources import table

BOOK = Book()


def month(c: str) -> Column:
    return F.date_format(c, "yyyy-MM")


def rows_counted() -> Column:
    return F.count(F.lit(1))


@BOOK.add("""
    SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS proveedores, CAST(sum(CAST(l_quantity AS DECIMAL(28, 2))) AS DOUBLE) AS cantidad,
           min(l_extendedprice) AS minimo, max(l_extendedprice) AS maximo FROM lineitem GROUP BY ALL""")
def c1_grouped_basic(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        rows_counted().alias("n"), F.count_distinct("l_suppkey").alias("proveedores"), exact_sum(F.col("l_quantity")).alias("cantidad"),
        F.min("l_extendedprice").alias("minimo"), F.max("l_extendedprice").alias("maximo"),
    )


@BOOK.add("""
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS cerrados, count(*) FILTER (WHERE o_orderstatus = 'O') AS abiertos,
           median(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS mediana_f, max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS tope_p FROM orders GROUP BY 1""")
def c2_filtered_aggs(spark: SparkSession, d: str) -> DataFrame:
    of = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    orders = table(spark, d, "orders")
    closed = windows.exact_percentiles(orders.where("o_orderstatus = 'F'"), ["o_orderpriority"], "o_totalprice", {"mediana_f": 0.5}).drop("n")
    counts = orders.groupBy("o_orderpriority").agg(F.count(of("F")).alias("cerrados"), F.count(of("O")).alias("abiertos"), F.max(of("P")).alias("tope_p"))
    return counts.join(closed, "o_orderpriority", "left")


@BOOK.add("""
    SELECT l_returnflag, median(l_extendedprice) AS mediana, round(quantile_cont(l_extendedprice, 0.9) * 100) / 100 AS p90 FROM lineitem GROUP BY 1""")
def c3_medians_quantiles(spark: SparkSession, d: str) -> DataFrame:
    found = windows.exact_percentiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", {"mediana": 0.5, "p90": 0.9})
    return found.select("l_returnflag", "mediana", scaled_round(F.col("p90"), 2).alias("p90"))


@BOOK.add("""
    SELECT p_brand, first(p_type ORDER BY n DESC, p_type) AS tipo, max(n) AS veces FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY 1""")
def c4_ordered_mode(spark: SparkSession, d: str) -> DataFrame:
    return windows.ordered_mode(table(spark, d, "part"), ["p_brand"], "p_type", "tipo").withColumnRenamed("tipo_n", "veces")


@BOOK.add("""
    SELECT p_brand, arg_min(p_name, struct_pack(a := p_retailprice, b := p_partkey)) AS barata, arg_max(p_name, struct_pack(a := p_retailprice, b := p_partkey)) AS cara,
           min(p_container) AS envase FROM (SELECT *, nullif(p_type, 'PROMO') AS p_container FROM part) GROUP BY 1""")
def c5_argminmax_any(spark: SparkSession, d: str) -> DataFrame:
    by = F.struct("p_retailprice", "p_partkey")
    return table(spark, d, "part").groupBy("p_brand").agg(
        F.min_by("p_name", by).alias("barata"), F.max_by("p_name", by).alias("cara"), F.min(F.nullif("p_type", F.lit("PROMO"))).alias("envase")
    )


@BOOK.add("""
    SELECT l_partkey, bool_and(l_discount > 0) AS siempre, bool_or(l_tax = 0) AS alguna FROM lineitem GROUP BY 1
    HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0 AND count(*) FILTER (WHERE l_returnflag = 'N') > 0""")
def c6_bool_aggs_having(spark: SparkSession, d: str) -> DataFrame:
    flags = lambda f: F.count_if(F.col("l_returnflag") == f)
    return (
        table(spark, d, "lineitem").groupBy("l_partkey")
        .agg(F.bool_and(F.col("l_discount") > 0).alias("siempre"), F.bool_or(F.col("l_tax") == 0).alias("alguna"), flags("R").alias("r"), flags("N").alias("n"))
        .where("r > 0 and n > 0").drop("r", "n")
    )


@BOOK.add("""
    SELECT l_suppkey, CAST(sum(CAST(l_extendedprice * l_quantity AS DECIMAL(28, 4))) AS DOUBLE) / nullif(CAST(sum(CAST(l_quantity AS DECIMAL(28, 4))) AS DOUBLE), 0) AS precio
    FROM lineitem GROUP BY 1""")
def c7_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")).alias("precio"))


@BOOK.add("""
    WITH f AS (SELECT o_orderkey, o_totalprice, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS lineas, o_orderstatus <> 'P' AS estado FROM orders),
    u AS (SELECT 'lineas' AS fuente, lineas AS ok, o_totalprice AS peso FROM f UNION ALL SELECT 'estado', estado, o_totalprice FROM f)
    SELECT fuente, round(100e0 * count(*) FILTER (WHERE ok) / count(*) * 10) / 10 AS pct,
           round(100e0 * CAST(sum(CAST(peso AS DECIMAL(28, 2))) FILTER (WHERE ok) AS DOUBLE) / CAST(sum(CAST(peso AS DECIMAL(28, 2))) AS DOUBLE) * 10) / 10 AS pct_peso
    FROM u GROUP BY 1""")
def c8_coverage_metric(spark: SparkSession, d: str) -> DataFrame:
    has = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    f = table(spark, d, "orders").join(has, "o_orderkey", "left").select(
        "o_totalprice", F.coalesce("hit", F.lit(False)).alias("lineas"), (F.col("o_orderstatus") != "P").alias("estado")
    )
    u = f.unpivot(["o_totalprice"], ["lineas", "estado"], "fuente", "ok")
    peso = F.col("o_totalprice")
    return u.groupBy("fuente").agg(
        percent(F.count_if("ok"), rows_counted()).alias("pct"), percent(exact_sum(F.when(F.col("ok"), peso)), exact_sum(peso)).alias("pct_peso")
    )


@BOOK.add("SELECT l_returnflag, count(DISTINCT (l_partkey, l_suppkey)) AS pares FROM lineitem GROUP BY 1")
def c9_distinct_tuple(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey", "l_suppkey").alias("pares"))


@BOOK.add("""
    WITH b AS (SELECT p_brand, p_type, l_extendedprice / l_quantity AS precio, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey),
    t AS (SELECT p_type, median(precio) AS tipico FROM b GROUP BY 1 HAVING count(*) >= 3)
    SELECT p_brand, round(median(precio / tipico) * 1e6) / 1e6 AS indice, count(DISTINCT l_partkey) AS piezas FROM b JOIN t USING (p_type) GROUP BY 1
    HAVING count(DISTINCT l_partkey) >= 15""")
def c10_price_index_by_brand(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "p_brand", "p_type", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("precio")
    )
    t = windows.exact_percentiles(b, ["p_type"], "precio", {"tipico": 0.5}).where("n >= 3").drop("n")
    relative = b.join(t, "p_type").select("p_brand", "l_partkey", (F.col("precio") / F.col("tipico")).alias("razon"))
    index = windows.exact_percentiles(relative, ["p_brand"], "razon", {"indice": 0.5}).select("p_brand", scaled_round(F.col("indice"), 6).alias("indice"))
    return relative.groupBy("p_brand").agg(F.count_distinct("l_partkey").alias("piezas")).where("piezas >= 15").join(index, "p_brand")


@BOOK.add("""
    SELECT l_partkey, round(min(l_extendedprice) FILTER (WHERE l_returnflag = 'R') / nullif(min(l_extendedprice) FILTER (WHERE l_returnflag = 'N'), 0) * 1e4) / 1e4 AS razon,
           min(l_extendedprice) FILTER (WHERE l_returnflag = 'R') < min(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS revisar
    FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0 AND count(*) FILTER (WHERE l_returnflag = 'N') > 0""")
def c11_same_item_two_grades(spark: SparkSession, d: str) -> DataFrame:
    least = lambda f: F.min(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")))
    g = table(spark, d, "lineitem").groupBy("l_partkey").agg(least("R").alias("r"), least("N").alias("n")).where("r is not null and n is not null")
    return g.select("l_partkey", scaled_round(safe_ratio(F.col("r"), F.col("n")), 4).alias("razon"), (F.col("r") < F.col("n")).alias("revisar"))


@BOOK.add("""
    SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderdate, o_orderkey) AS pedidos FROM orders GROUP BY 1""")
def c12_ordered_list(spark: SparkSession, d: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(ordered, lambda x: x["o_orderkey"].cast("string")), "|").alias("pedidos"))


@BOOK.add("""
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
    FROM orders GROUP BY 1""")
def c13_pivot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@BOOK.add("SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicada FROM lineitem")
def d1_dup_flag(spark: SparkSession, d: str) -> DataFrame:
    n = rows_counted().over(W.partitionBy("l_orderkey", "l_linenumber"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (n > 1).alias("duplicada"))


@BOOK.add("""
    WITH b AS (SELECT strftime(l_shipdate, '%Y-%m') AS mes, p_brand AS marca, l_extendedprice AS precio, l_quantity AS volumen, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey),
    t AS (SELECT *, median(precio) OVER (PARTITION BY mes, marca) AS med FROM b)
    SELECT mes, marca, count(*) AS n, count(DISTINCT l_suppkey) AS bocas, median(precio) AS mediana,
           CAST(sum(CAST(precio * volumen AS DECIMAL(28, 4))) AS DOUBLE) / nullif(CAST(sum(CAST(volumen AS DECIMAL(28, 4))) AS DOUBLE), 0) AS ponderado
    FROM t WHERE precio BETWEEN med * 0.5 AND med * 2 GROUP BY 1, 2""")
def d2_outlier_trimmed_median(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        month("l_shipdate").alias("mes"), F.col("p_brand").alias("marca"), F.col("l_extendedprice").alias("precio"), F.col("l_quantity").alias("volumen"), "l_suppkey"
    )
    kept = windows.trimmed_by_median(b, ["mes", "marca"], "precio")
    medians = windows.exact_percentiles(kept, ["mes", "marca"], "precio", {"mediana": 0.5}).drop("n")
    return kept.groupBy("mes", "marca").agg(
        rows_counted().alias("n"), F.count_distinct("l_suppkey").alias("bocas"), weighted_mean(F.col("precio"), F.col("volumen")).alias("ponderado")
    ).join(medians, ["mes", "marca"])


@BOOK.add("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(DISTINCT l_suppkey) OVER (PARTITION BY l_partkey) AS proveedores FROM lineitem")
def d3_distinct_over(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return windows.count_distinct_over(rows, ["l_partkey"], "l_suppkey", "proveedores")


@BOOK.add("""
    WITH m AS (SELECT p_brand AS marca, CAST(year(l_shipdate) AS BIGINT) AS anio, median(l_extendedprice) AS med, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    j AS (SELECT b.marca, b.anio, b.med / a.med AS salto, b.n AS n FROM m b JOIN m a ON a.marca = b.marca AND a.anio = b.anio - 1 WHERE a.med > 0)
    SELECT marca, anio, round(exp(sum(ln(salto)) OVER w) * 1e6) / 1e6 AS indice, count(*) OVER w = anio - min(anio) OVER (PARTITION BY marca) + 1 AS completo,
           min(n) OVER w AS respaldo FROM j WHERE salto > 0 WINDOW w AS (PARTITION BY marca ORDER BY anio ROWS UNBOUNDED PRECEDING)""")
def d4_chained_index(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("marca"), F.year("l_shipdate").cast("long").alias("anio"), "l_extendedprice"
    )
    m = windows.exact_percentiles(rows, ["marca", "anio"], "l_extendedprice", {"med": 0.5})
    before = m.select("marca", (F.col("anio") + 1).alias("anio"), F.col("med").alias("med0"))
    jumps = m.join(before, ["marca", "anio"]).where("med0 > 0").select("marca", "anio", (F.col("med") / F.col("med0")).alias("salto"), "n")
    out = windows.chained_index(jumps, ["marca"], "anio", "salto", "n")
    return out.select("marca", "anio", scaled_round(F.col("indice"), 6).alias("indice"), "completo", "respaldo")


@BOOK.add("""
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS n FROM orders GROUP BY 1), l AS (SELECT mes, n, lag(n) OVER (ORDER BY mes) AS antes FROM m)
    SELECT mes, n, antes, abs(n - antes) > 0.2 * antes AS quiebre FROM l""")
def d5_lag_recurrence(spark: SparkSession, d: str) -> DataFrame:
    # One row per month by then.
    m = table(spark, d, "orders").groupBy(month("o_orderdate").alias("mes")).agg(rows_counted().alias("n"))
    return m.withColumn("antes", F.lag("n").over(W.orderBy("mes"))).withColumn("quiebre", F.abs(F.col("n") - F.col("antes")) > 0.2 * F.col("antes"))


@BOOK.add("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def d6_top1_per_group(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_per_group(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@BOOK.add("""
    SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2 QUALIFY count(*) FILTER (WHERE p_brand <> 'Brand#1') OVER (PARTITION BY p_type) >= 3""")
def d7_qualify_filtered_count(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "part").groupBy("p_type", "p_brand").agg(rows_counted().alias("n"))
    others = F.count_if(F.col("p_brand") != "Brand#1").over(W.partitionBy("p_type"))
    return g.withColumn("k", others).where("k >= 3").drop("k")


@BOOK.add("""
    WITH s AS (SELECT strftime(ts, '%Y-%m-%d') AS dia, CAST(sum(CAST(value AS DECIMAL(28, 2))) AS DOUBLE) AS v FROM events GROUP BY 1)
    SELECT dia, round((v / nullif(lag(v) OVER (ORDER BY dia), 0) - 1) * 1e6) / 1e6 AS cambio FROM s""")
def d8_pct_change(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dia")).agg(exact_sum(F.col("value")).alias("v"))
    return s.select("dia", scaled_round(safe_ratio(F.col("v"), F.lag("v").over(W.orderBy("dia"))) - 1, 6).alias("cambio"))


@BOOK.add("""
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'login' THEN NULL ELSE value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS vigente
    FROM events""")
def d9_forward_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("v", F.when(F.coalesce(F.col("event_type") == "login", F.lit(False)), F.lit(None)).otherwise(F.col("value")))
    return windows.forward_fill(rows, ["user_id"], ["ts", "event_id"], "v", "vigente").select("event_id", "user_id", "vigente")


@BOOK.add("""
    WITH l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
    SELECT o_orderkey, l_partkey, 'pieza #' || row_number() OVER (PARTITION BY o_orderkey ORDER BY l_partkey) AS nombre, count(*) OVER (PARTITION BY o_orderkey) AS de
    FROM orders JOIN l ON l_orderkey = o_orderkey""")
def d10_duplicate_numbering(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey").distinct().join(table(spark, d, "orders"), "o_orderkey", "left_semi")
    own = W.partitionBy("o_orderkey")
    number = F.row_number().over(own.orderBy("l_partkey"))
    return rows.select("o_orderkey", "l_partkey", F.concat(F.lit("pieza #"), number.cast("string")).alias("nombre"), rows_counted().over(own).alias("de"))


@BOOK.add("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS puesto FROM orders QUALIFY puesto <= 12")
def e1_topk(spark: SparkSession, d: str) -> DataFrame:
    top = table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(12)
    return top.withColumn("puesto", F.row_number().over(W.orderBy(F.desc("o_totalprice"), "o_orderkey")))


@BOOK.add("""
    SELECT c_custkey, saldo, row_number() OVER (ORDER BY saldo DESC NULLS LAST, c_custkey) AS puesto FROM (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_acctbal END AS saldo FROM customer WHERE c_nationkey = 7)""")
def e2_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").where("c_nationkey = 7").select("c_custkey", F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal")).alias("saldo"))
    return windows.global_rank(rows, [F.desc_nulls_last("saldo"), F.asc("c_custkey")], "puesto")


@BOOK.add("""
    (SELECT 'caros' AS lado, p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5)
    UNION ALL (SELECT 'baratos', p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 5)""")
def e3_bottom_top(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_retailprice")
    end = lambda name, by: part.orderBy(by, "p_partkey").limit(5).select(F.lit(name).alias("lado"), "p_partkey", "p_retailprice")
    return end("caros", F.desc("p_retailprice")).unionByName(end("baratos", F.asc("p_retailprice")))


@BOOK.add("""
    SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, o_totalprice, o_orderkey) AS puesto FROM orders QUALIFY puesto <= 40""")
def e4_composite_sort(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    by = ["k", "o_totalprice", "o_orderkey"]
    top = table(spark, d, "orders").select(rank.alias("k"), "o_totalprice", "o_orderkey").orderBy(*by).limit(40)
    return top.select("o_orderkey", F.row_number().over(W.orderBy(*by)).alias("puesto"))


@BOOK.add("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY md5(o_orderkey || '/7'), o_orderkey LIMIT 200")
def e5_seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """200 orders drawn by a hash of the key and a seed: the same ones on any cluster."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return rows.orderBy(F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("/7"))), "o_orderkey").limit(200)


@BOOK.add("""
    (SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')
    EXCEPT SELECT p_partkey FROM part WHERE p_size < 10""")
def e6_intersect_except(spark: SparkSession, d: str) -> DataFrame:
    keys = lambda f: table(spark, d, "lineitem").where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k"))
    return keys("R").intersect(keys("A")).subtract(table(spark, d, "part").where("p_size < 10").select("p_partkey"))


@BOOK.add("""
    SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS nivel, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def e7_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().alias("nivel"), rows_counted().alias("n"))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
