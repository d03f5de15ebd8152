"""Scans, filters and joins over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rodaje.functions.numeric import exact_sum, scaled_round
from rodaje.functions.similarity import jaro_winkler
from rodaje.functions.text import has_all_words
from rodaje.operators import joins, snapshots, windows
from rodaje.plans.book import Book
from rodaje.sources import table

BOOK = Book()


@BOOK.add("""
    SELECT l_orderkey AS pedido, l_linenumber AS renglon, l_partkey AS pieza, round(l_extendedprice * (1 - l_discount) * 100) / 100 AS neto
    FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND NOT (l_linestatus = 'O')""")
def a1_scan_project_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where(F.col("l_quantity").between(10, 20) & F.col("l_returnflag").isin("A", "R") & ~(F.col("l_linestatus") == "O"))
    return rows.select(
        F.col("l_orderkey").alias("pedido"), F.col("l_linenumber").alias("renglon"), F.col("l_partkey").alias("pieza"),
        scaled_round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("neto"),
    )


@BOOK.add("""
    SELECT 'cliente' AS origen, c_custkey AS clave, c_name AS nombre, c_mktsegment AS segmento FROM customer
    UNION ALL SELECT 'proveedor', s_suppkey, s_name, NULL FROM supplier""")
def a2_union_by_name_tagged(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.lit("cliente").alias("origen"), F.col("c_custkey").alias("clave"), F.col("c_name").alias("nombre"), F.col("c_mktsegment").alias("segmento"))
    s = table(spark, d, "supplier").select(F.col("s_name").alias("nombre"), F.col("s_suppkey").alias("clave"), F.lit("proveedor").alias("origen"))
    return c.unionByName(s, allowMissingColumns=True)


@BOOK.add("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)")
def a3_latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.latest(table(spark, d, "orders"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


@BOOK.add("""
    SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 12 MONTH FROM orders)) AS ultimos_12
    FROM orders GROUP BY o_orderpriority""")
def a4_trailing_12m(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    since = orders.select(F.max("o_orderdate") - F.expr("interval 12 months")).scalar()
    recent = F.count_if(F.col("o_orderdate") > since)
    return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), recent.alias("ultimos_12"))


@BOOK.add("""
    SELECT coalesce(nullif(lower(left(lang, 2)), 'un'), 'sin_lengua') AS lengua, count(*) AS n, count(*) FILTER (WHERE nullif(trim(text, ' '), '') IS NULL) AS sin_texto,
           count(*) FILTER (WHERE lang IS DISTINCT FROM 'es') AS otra, count(try_cast(source AS INTEGER)) AS numericas
    FROM documents WHERE NOT (source = 'N/D') GROUP BY 1""")
def a5_placeholder_null_logic(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(~(F.col("source") == "N/D"))
    lengua = F.coalesce(F.nullif(F.lower(F.left("lang", F.lit(2))), F.lit("un")), F.lit("sin_lengua"))
    return docs.groupBy(lengua.alias("lengua")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.nullif(F.trim("text"), F.lit("")).isNull()).alias("sin_texto"),
        F.count_if(~F.col("lang").eqNullSafe("es")).alias("otra"), F.count(F.col("source").try_cast("int")).alias("numericas"),
    )


@BOOK.add("SELECT p_partkey, p_name FROM part WHERE lower(p_name || ' ' || p_type) LIKE '%red%' AND lower(p_name || ' ' || p_type) LIKE '%sm%'")
def a6_text_all_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(has_all_words(F.concat_ws(" ", "p_name", "p_type"), "Réd SM")).select("p_partkey", "p_name")


@BOOK.add("SELECT DISTINCT p_brand, p_type FROM part")
def a7_distinct_projection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@BOOK.add("""
    SELECT r_name, n_name, count(*) AS pedidos, CAST(sum(CAST(o_totalprice AS DECIMAL(28, 2))) AS DOUBLE) AS monto
    FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def b1_inner_multi(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    # Orders are summed per customer before anything is joined to them.
    per = t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("o_totalprice").cast("decimal(28,2)")).alias("m"))
    nations = t("nation").join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    joined = per.join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
    return joined.groupBy("r_name", "n_name").agg(F.sum("k").alias("pedidos"), F.sum("m").cast("double").alias("monto"))


@BOOK.add("""
    SELECT coalesce(l_returnflag, 'sin_lineas') AS marca, count(DISTINCT o_orderkey) AS pedidos, count(*) AS filas
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def b2_left_sentinel(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("k"))
    joined = table(spark, d, "orders").select("o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy(F.coalesce("l_returnflag", F.lit("sin_lineas")).alias("marca")).agg(
        F.count_distinct("o_orderkey").alias("pedidos"), F.sum(F.coalesce("k", F.lit(1))).alias("filas")
    )


@BOOK.add("""
    WITH s AS (SELECT s_nationkey AS nacion, median(s_acctbal) AS med_prov FROM supplier WHERE s_acctbal > 7000 GROUP BY 1),
    c AS (SELECT c_nationkey AS nacion, median(c_acctbal) AS med_cli FROM customer WHERE c_nationkey % 3 <> 0 GROUP BY 1),
    tramos AS (SELECT * FROM (VALUES ('corto', 1.0), ('largo', 2.0)) AS t(tramo, factor))
    SELECT coalesce(s.nacion, c.nacion) AS nacion, tramo, med_prov * factor AS med_prov, med_cli * factor AS med_cli
    FROM s FULL JOIN c ON s.nacion = c.nacion CROSS JOIN tramos""")
def b3_full_outer_scaffold(spark: SparkSession, d: str) -> DataFrame:
    s = windows.exact_percentiles(table(spark, d, "supplier").where("s_acctbal > 7000").withColumn("nacion", F.col("s_nationkey")), ["nacion"], "s_acctbal", {"mp": 0.5}).drop("n")
    c = windows.exact_percentiles(table(spark, d, "customer").where("c_nationkey % 3 <> 0").withColumn("nacion", F.col("c_nationkey")), ["nacion"], "c_acctbal", {"mc": 0.5}).drop("n")
    # The scaffold is two constant rows, unrolled in place.
    steps = F.array(*[F.struct(F.lit(n).alias("tramo"), F.lit(f).alias("factor")) for n, f in (("corto", 1.0), ("largo", 2.0))])
    return s.join(c, "nacion", "full").withColumn("t", F.explode(steps)).select(
        "nacion", "t.tramo", (F.col("mp") * F.col("t.factor")).alias("med_prov"), (F.col("mc") * F.col("t.factor")).alias("med_cli")
    )


_BRACKETS = [("1-URGENT", 0.0, 100000.0, 0.0, 1.0), ("1-URGENT", 100000.0, 250000.0, 1000.0, 2.5), ("1-URGENT", 250000.0, None, 4750.0, 4.0), ("5-LOW", 0.0, 200000.0, 50.0, 0.5), ("5-LOW", 200000.0, None, 1050.0, 1.5)]


@BOOK.add(f"""
    WITH t(prioridad, desde, hasta, fijo, pct) AS (VALUES {', '.join('(' + ', '.join('NULL' if x is None else f"'{x}'" if isinstance(x, str) else f'CAST({x} AS DOUBLE)' for x in b) + ')' for b in _BRACKETS)})
    SELECT o_orderkey, round(greatest(least(fijo + (o_totalprice - desde) * pct / 100, o_totalprice * 0.03), 200) * 100) / 100 AS cargo
    FROM orders JOIN t ON o_orderpriority = prioridad AND o_totalprice > desde AND (hasta IS NULL OR o_totalprice <= hasta)""")
def b4_bracket_join(spark: SparkSession, d: str) -> DataFrame:
    scale = spark.createDataFrame(_BRACKETS, "o_orderpriority string, desde double, hasta double, fijo double, pct double")
    held = joins.bracket_join(table(spark, d, "orders"), scale, "o_totalprice", "desde", "hasta", ["o_orderpriority"])
    cargo = F.greatest(F.least(F.col("fijo") + (F.col("o_totalprice") - F.col("desde")) * F.col("pct") / 100, F.col("o_totalprice") * 0.03), F.lit(200.0))
    return held.select("o_orderkey", scaled_round(cargo, 2).alias("cargo"))


@BOOK.add("""
    WITH v AS (SELECT user_id, ts, max(value) AS visto FROM events WHERE event_type = 'view' GROUP BY 1, 2)
    SELECT e.event_id, e.user_id, v.visto FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.ts""")
def b5_asof_join(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("at"), F.col("value").alias("visto"))
    return joins.asof_join(buys, views, ["user_id"], "ts", "at", ["visto"]).select("event_id", "user_id", "visto")


@BOOK.add("""
    WITH u AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
    SELECT b.k, b.n, b.q - a.q AS salto FROM u b JOIN u a ON a.k = b.k AND a.n = b.n - 1""")
def b6_self_join_ordinal(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.max("l_quantity").alias("q"))
    before = u.select("k", (F.col("n") + 1).alias("n"), F.col("q").alias("q0"))
    return u.join(before, ["k", "n"]).select("k", "n", (F.col("q") - F.col("q0")).alias("salto"))


@BOOK.add("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def b7_semi_join(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "lineitem").where("l_quantity > 45")
    return table(spark, d, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@BOOK.add("SELECT o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL")
def b8_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@BOOK.add("""
    SELECT DISTINCT l_partkey, l_suppkey FROM lineitem a WHERE l_returnflag = 'R'
    AND NOT EXISTS (SELECT 1 FROM lineitem b WHERE (b.l_partkey, b.l_suppkey) = (a.l_partkey, a.l_suppkey) AND b.l_returnflag = 'N')""")
def b9_not_exists_tuple(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    pairs = lambda flag: lines.where(F.col("l_returnflag") == flag).select("l_partkey", "l_suppkey")
    return pairs("R").distinct().join(pairs("N"), ["l_partkey", "l_suppkey"], "left_anti")


@BOOK.add("""
    WITH a AS (SELECT nullif(o_orderstatus, 'P') AS e, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2),
    b AS (SELECT nullif(o_orderstatus, 'P') AS e, max(o_totalprice) AS tope FROM orders GROUP BY 1)
    SELECT a.e AS estado, a.p AS prioridad, n, tope FROM a JOIN b ON a.e IS NOT DISTINCT FROM b.e""")
def b10_null_safe_join(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("e", F.nullif("o_orderstatus", F.lit("P")))
    a = orders.groupBy(F.col("e").alias("estado"), F.col("o_orderpriority").alias("prioridad")).agg(F.count(F.lit(1)).alias("n"))
    b = orders.groupBy("e").agg(F.max("o_totalprice").alias("tope"))
    return a.join(b, F.col("estado").eqNullSafe(F.col("e"))).select("estado", "prioridad", "n", "tope")


@BOOK.add("""
    WITH c(centro) AS (VALUES (5.0), (17.5), (30.0), (48.0))
    SELECT p_partkey, CAST(arg_min(centro, struct_pack(a := abs(p_size - centro), b := centro)) FILTER (WHERE abs(p_size - centro) <= 5) AS DOUBLE) AS centro
    FROM part CROSS JOIN c GROUP BY p_partkey""")
def b11_nearest_centre(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", joins.nearest(F.col("p_size").cast("double"), [5.0, 17.5, 30.0, 48.0], 5.0).alias("centro"))


_NAMES = ["small ring", "old gear", "hot rod", "blue plate", "new widgit", "larg anvil"]


@BOOK.add(f"""
    WITH n AS (SELECT DISTINCT p_name FROM part), c AS (SELECT unnest({_NAMES}) AS candidato),
    s AS (SELECT p_name, candidato, round(jaro_winkler_similarity(p_name, candidato) * 1e6) / 1e6 AS parecido FROM n CROSS JOIN c)
    SELECT p_name, candidato, parecido FROM s QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY parecido DESC, candidato) = 1""")
def b12_fuzzy_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "part").select("p_name").distinct().withColumn("candidato", F.explode(F.array(*map(F.lit, _NAMES))))
    scored = pairs.withColumn("parecido", scaled_round(jaro_winkler("p_name", "candidato"), 6))
    return windows.top_per_group(scored, ["p_name"], [F.desc("parecido"), F.asc("candidato")])


@BOOK.add("""
    SELECT n_nationkey, CASE n_nationkey WHEN 3 THEN 'TRES' WHEN 9 THEN 'NUEVE' ELSE n_name END AS n_name FROM nation""")
def b16_override_join(spark: SparkSession, d: str) -> DataFrame:
    fixes = spark.createDataFrame([(3, "TRES"), (9, "NUEVE"), (4, None), (99, "X")], "n_nationkey int, n_name string")
    return joins.override_join(table(spark, d, "nation").select("n_nationkey", "n_name"), fixes, ["n_nationkey"], "n_name")


@BOOK.add("""
    SELECT p_brand, CAST(sum(CAST(l_extendedprice AS DECIMAL(28, 2))) AS DOUBLE) AS monto FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 25 GROUP BY p_brand""")
def b17_filter_below_join(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").where("p_size > 25").select("p_partkey", "p_brand")
    lines = table(spark, d, "lineitem").select("l_partkey", "l_extendedprice")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(exact_sum(F.col("l_extendedprice")).alias("monto"))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
