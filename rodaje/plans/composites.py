"""Composite analyses: cascades, scaffolds, ladders, matrices, incremental loads and the quality suite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.functions.numeric import exact_sum, scaled_round
from rodaje.operators import quality, windows
from rodaje.plans.book import Book
from rodaje.sources import table
from rodaje.sources.sinks import later_source_wins
from rodaje.streaming import events as stream

BOOK = Book()


@BOOK.add("""
    WITH c AS (SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_retailprice * 0.1 END AS a, CASE WHEN p_type <> 'PROMO' THEN p_size * 2.0 END AS b, CASE WHEN p_brand <> 'Brand#3' THEN 7.5 END AS c FROM part)
    SELECT p_partkey, round((a + b + c) * 100) / 100 AS total, round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) * 100) / 100 AS parcial,
           concat_ws(',', CASE WHEN a IS NULL THEN 'a' END, CASE WHEN b IS NULL THEN 'b' END, CASE WHEN c IS NULL THEN 'c' END) AS faltantes FROM c""")
def g1_total_with_missing(spark: SparkSession, d: str) -> DataFrame:
    """A sum that is null, and says why, when a component is missing, beside the sum of the rest."""
    parts = {
        "a": F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice") * 0.1), "b": F.when(F.col("p_type") != "PROMO", F.col("p_size") * 2.0),
        "c": F.when(F.col("p_brand") != "Brand#3", F.lit(7.5)),
    }
    rows = table(spark, d, "part").withColumns(parts)
    a, b, c = (F.col(k) for k in parts)
    zero = F.lit(0.0)
    missing = F.concat_ws(",", *[F.when(F.col(k).isNull(), k) for k in parts])
    return rows.select(
        "p_partkey", scaled_round(a + b + c, 2).alias("total"),
        scaled_round(F.coalesce(a, zero) + F.coalesce(b, zero) + F.coalesce(c, zero), 2).alias("parcial"), missing.alias("faltantes"),
    )


@BOOK.add("""
    WITH b AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 60), i(tipo, cada, unidades) AS (VALUES ('PROMO', 10.0, 1), ('SMALL', 20.0, 4), ('LARGE', 40.0, 2)),
    m AS (SELECT p_brand, p_type, median(p_retailprice) AS med FROM part WHERE p_size < 12 GROUP BY 1, 2), g AS (SELECT p_type, median(p_retailprice) AS med FROM part GROUP BY 1)
    SELECT b.p_brand, round(sum(coalesce(m.med, g.med) * unidades / cada) * 1e4) / 1e4 AS gasto, count(m.med) AS propios
    FROM b CROSS JOIN i LEFT JOIN m ON m.p_brand = b.p_brand AND m.p_type = tipo JOIN g ON g.p_type = tipo GROUP BY 1""")
def g3_scaffold_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Every group times every item of a short list, filled with own medians or else the general ones."""
    part = table(spark, d, "part")
    steps = F.array(*[F.struct(F.lit(t).alias("p_type"), F.lit(e).alias("cada"), F.lit(u).alias("unidades")) for t, e, u in (("PROMO", 10.0, 1), ("SMALL", 20.0, 4), ("LARGE", 40.0, 2))])
    b = part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).where("n > 60").select("p_brand", F.explode(steps).alias("i")).select("p_brand", "i.*")
    m = windows.exact_percentiles(part.where("p_size < 12"), ["p_brand", "p_type"], "p_retailprice", {"med": 0.5}).drop("n")
    g = windows.exact_percentiles(part, ["p_type"], "p_retailprice", {"general": 0.5}).drop("n")
    filled = b.join(m, ["p_brand", "p_type"], "left").join(g, "p_type")
    spend = F.coalesce("med", "general") * F.col("unidades") / F.col("cada")
    return filled.groupBy("p_brand").agg(scaled_round(F.sum(spend), 4).alias("gasto"), F.count("med").alias("propios"))


@BOOK.add("""
    WITH t AS (SELECT * FROM part WHERE p_partkey % 2 = 0), q AS (SELECT * FROM part WHERE p_partkey % 2 = 1),
    a AS (SELECT p_brand, p_type, p_size, median(p_retailprice) AS v FROM t GROUP BY 1, 2, 3), b AS (SELECT p_brand, p_type, median(p_retailprice) AS v FROM t WHERE p_size > 25 GROUP BY 1, 2),
    c AS (SELECT p_size, median(p_retailprice) AS v FROM t GROUP BY 1 HAVING count(*) >= 5)
    SELECT q.p_partkey, coalesce(a.v, b.v, c.v) AS estimado, CASE WHEN a.v IS NOT NULL THEN 'exacto' WHEN b.v IS NOT NULL THEN 'familia' WHEN c.v IS NOT NULL THEN 'medida' END AS nivel
    FROM q LEFT JOIN a USING (p_brand, p_type, p_size) LEFT JOIN b USING (p_brand, p_type) LEFT JOIN c USING (p_size)""")
def g4_cascade_estimate(spark: SparkSession, d: str) -> DataFrame:
    """An estimate from the closest group that has one, with the level it came from."""
    part = table(spark, d, "part")
    known, asked = part.where("p_partkey % 2 = 0"), part.where("p_partkey % 2 = 1")
    level = lambda keys, name, df: windows.exact_percentiles(df, keys, "p_retailprice", {name: 0.5})
    a = level(["p_brand", "p_type", "p_size"], "a", known).drop("n")
    b = level(["p_brand", "p_type"], "b", known.where("p_size > 25")).drop("n")
    c = level(["p_size"], "c", known).where("n >= 5").drop("n")
    joined = asked.join(a, ["p_brand", "p_type", "p_size"], "left").join(b, ["p_brand", "p_type"], "left").join(c, "p_size", "left")
    value, source = windows.fallback([("exacto", F.col("a")), ("familia", F.col("b")), ("medida", F.col("c"))])
    return joined.select("p_partkey", value.alias("estimado"), source.alias("nivel"))


@BOOK.add("""
    WITH v AS (SELECT p_brand, l_partkey, count(*) AS ventas FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY 1, 2 HAVING count(*) >= 20),
    x AS (SELECT p_brand, arg_min(l_partkey, struct_pack(a := p_retailprice, b := l_partkey)) AS l_partkey, min(p_retailprice) AS precio FROM v JOIN (SELECT p_partkey, p_retailprice FROM part) ON p_partkey = l_partkey GROUP BY 1)
    SELECT *, row_number() OVER (ORDER BY precio, l_partkey) AS puesto FROM x QUALIFY puesto <= 5""")
def g5_cheapest_per_family(spark: SparkSession, d: str) -> DataFrame:
    """The cheapest well-supported item of each family, then the five cheapest families."""
    sold = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("ventas")).where("ventas >= 20")
    parts = table(spark, d, "part").where("p_size > 10")
    best = sold.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.min(F.struct("p_retailprice", "l_partkey")).alias("m"))
    top = best.select("p_brand", "m.l_partkey", F.col("m.p_retailprice").alias("precio")).orderBy("precio", "l_partkey").limit(5)
    return top.withColumn("puesto", F.row_number().over(W.orderBy("precio", "l_partkey")))


@BOOK.add("""
    WITH i AS (SELECT DISTINCT marca, familia, version_fuente, orden_version, lower(trim(item)) AS item, valor FROM equipamiento_items WHERE item IS NOT NULL),
    u AS (SELECT marca, familia, orden_version AS n, item, max(valor) AS valor FROM i GROUP BY ALL)
    SELECT b.marca, b.familia, b.n, b.item, CASE WHEN b.valor = 'si' THEN 'agrega' ELSE 'quita' END AS cambio
    FROM u b JOIN u a ON a.marca = b.marca AND a.familia = b.familia AND a.item = b.item AND a.n = b.n - 1
    WHERE a.valor <> b.valor AND NOT (a.valor = 'opcional' AND b.valor = 'no') AND b.valor IN ('si', 'no')""")
def g6_ladder_difference(spark: SparkSession, d: str) -> DataFrame:
    """What each step of an equipment ladder adds or takes away against the one below."""
    items = table(spark, d, "equipamiento_items").where("item is not null")
    u = items.groupBy("marca", "familia", F.col("orden_version").alias("n"), F.lower(F.trim("item")).alias("item")).agg(F.max("valor").alias("valor"))
    below = u.select("marca", "familia", (F.col("n") + 1).alias("n"), "item", F.col("valor").alias("antes"))
    told = u.join(below, ["marca", "familia", "n", "item"]).where("antes <> valor and not (antes = 'opcional' and valor = 'no') and valor in ('si', 'no')")
    return told.select("marca", "familia", "n", "item", F.when(F.col("valor") == "si", "agrega").otherwise("quita").alias("cambio"))


@BOOK.add("""
    WITH x AS (SELECT marca, familia, seccion, CASE WHEN bool_or(valor = 'si') THEN 'si' WHEN bool_or(valor = 'opcional') THEN 'opcional' WHEN bool_or(valor = 'no') THEN 'no' END AS v FROM equipamiento_items GROUP BY 1, 2, 3),
    y AS (SELECT upper(seccion) AS seccion, marca, familia, min(CASE v WHEN 'si' THEN 1 WHEN 'opcional' THEN 2 WHEN 'no' THEN 3 END) AS r FROM x WHERE v IS NOT NULL GROUP BY ALL),
    z AS (SELECT marca, familia, 'CONFORT' AS seccion, 4 AS r FROM y WHERE seccion = 'SEGURIDAD' AND r = 1 AND NOT EXISTS (SELECT 1 FROM y o WHERE o.seccion = 'CONFORT' AND (o.marca, o.familia) = (y.marca, y.familia)))
    SELECT marca, familia, seccion, CASE r WHEN 1 THEN 'si' WHEN 2 THEN 'opcional' WHEN 3 THEN 'no' ELSE 'deducido' END AS valor FROM (SELECT marca, familia, seccion, r FROM y UNION ALL SELECT * FROM z)""")
def g7_comparable_matrix(spark: SparkSession, d: str) -> DataFrame:
    """One value per family and section, yes before optional before no, and one deduced where it is absent."""
    items = table(spark, d, "equipamiento_items")
    rank = F.when(F.col("valor") == "si", 1).when(F.col("valor") == "opcional", 2).when(F.col("valor") == "no", 3)
    y = items.groupBy("marca", "familia", F.upper("seccion").alias("seccion")).agg(F.min(rank).alias("r")).where("r is not null")
    of = lambda s: y.where(F.col("seccion") == s)
    deduced = of("SEGURIDAD").where("r = 1").join(of("CONFORT"), ["marca", "familia"], "left_anti").select("marca", "familia", F.lit("CONFORT").alias("seccion"), F.lit(4).alias("r"))
    name = F.element_at(F.array(*map(F.lit, ("si", "opcional", "no", "deducido"))), F.col("r"))
    return y.unionByName(deduced).select("marca", "familia", "seccion", name.alias("valor"))


@BOOK.add("""
    SELECT strftime(o_orderdate, '%Y-%m') AS mes, coalesce(n_name, 'sin_nacion') AS nacion, o_orderstatus, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(28, 2))) FILTER (WHERE o_totalprice BETWEEN 1000 AND 400000) AS DOUBLE) AS monto
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""")
def g8_market_monthly(spark: SparkSession, d: str) -> DataFrame:
    who = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    rows = table(spark, d, "orders").join(who, "o_custkey", "left")
    sane = F.when(F.col("o_totalprice").between(1000, 400000), F.col("o_totalprice"))
    return rows.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mes"), F.coalesce("n_name", F.lit("sin_nacion")).alias("nacion"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), exact_sum(sane).alias("monto")
    )


@BOOK.add("""
    WITH e AS (SELECT *, event_id % 3 AS lote FROM events), t AS (SELECT *, max(lote) OVER (PARTITION BY user_id, event_type) AS tope FROM e)
    SELECT user_id, event_type, count(*) AS n, max(lote) AS lote FROM t WHERE lote = tope GROUP BY 1, 2""")
def g9_later_source_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("lote", F.col("event_id") % 3)
    won = later_source_wins(rows, ["user_id", "event_type"], "lote")
    return won.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("lote").alias("lote"))


@BOOK.add("""
    SELECT 'lineitem unico' AS prueba, count(*) AS fallas FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'texto presente', count(*) FROM documents WHERE text IS NULL
    UNION ALL SELECT 'lengua conocida', count(*) FROM documents WHERE lang NOT IN ('es', 'pt', 'en')
    UNION ALL SELECT 'descuento en rango', count(*) FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.09
    UNION ALL SELECT 'pieza conocida', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)
    UNION ALL SELECT 'surtidor positivo', count(*) FROM combustible_precios WHERE precio_surtidor <= 0""")
def h1_quality_suite(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return quality.violations({
        "lineitem unico": quality.not_unique(t("lineitem"), ["l_orderkey", "l_linenumber"]), "texto presente": quality.nulls(t("documents"), "text"),
        "lengua conocida": quality.not_accepted(t("documents"), "lang", ["es", "pt", "en"]), "descuento en rango": quality.out_of_range(t("lineitem"), "l_discount", 0.01, 0.09),
        "pieza conocida": quality.orphans(t("lineitem"), "l_partkey", t("part").where("p_size > 2"), "p_partkey"),
        "surtidor positivo": quality.out_of_range(t("combustible_precios"), "precio_surtidor", low=0, inclusive=False),
    })


@BOOK.add("""
    SELECT 'documents' AS tabla, count(*) AS filas, count(DISTINCT familia) AS familias, round(100e0 * count(*) FILTER (WHERE text IS NULL) / count(*) * 100) / 100 AS nulos, max(length(text)) AS mas_largo FROM documents""")
def h2_profile(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1))
    return table(spark, d, "documents").agg(
        n.alias("filas"), F.count_distinct("familia").alias("familias"), scaled_round(100.0 * F.count_if(F.col("text").isNull()) / n, 2).alias("nulos"),
        F.max(F.length("text")).cast("long").alias("mas_largo"),
    ).select(F.lit("documents").alias("tabla"), "*")


@BOOK.add("""
    WITH w AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2)
    SELECT strftime(h, '%Y-%m-%d %H') AS desde, event_type, n, total FROM w WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def s1_windowed_stream(spark: SparkSession, d: str) -> DataFrame:
    """Hourly windows of the event stream that its watermark has closed."""
    schema = table(spark, d, "events").schema
    # A pattern, so that the source may be one file as well as a folder.
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")
    closed = stream.run_once(stream.windowed(events))
    return closed.select(F.date_format("desde", "yyyy-MM-dd HH").alias("desde"), "event_type", "n", F.col("total").cast("double").alias("total"))


@BOOK.add(" UNION ALL ".join(
    f"SELECT '{c}' AS columna, count(*) AS filas, count(*) FILTER (WHERE {c} IS NULL) AS nulos, count(DISTINCT {c}) AS distintos, CAST(min({c}) AS VARCHAR) AS menor, CAST(max({c}) AS VARCHAR) AS mayor, CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS mas_largo FROM valuacion_fotos"
    for c in ("vigencia", "origen", "mtm", "fab", "marca", "anio", "valor_fiscal")
))
def h8_column_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, nulls, distinct values, extremes and lengths of every column."""
    return quality.profile(table(spark, d, "valuacion_fotos").select("vigencia", "origen", "mtm", "fab", "marca", "anio", "valor_fiscal"))


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    # A pattern, so that the source may be one file as well as a folder.
    return spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")


@BOOK.add("""
    SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || lpad(CAST(event_id AS VARCHAR), 12, '0') DESC) AS r FROM events) WHERE r = 1""")
def s2_stream_upserts(spark: SparkSession, d: str) -> DataFrame:
    """The newest event per user, kept up to date by the batches of a stream."""
    order = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    rows = _event_stream(spark, d).select("user_id", "event_id", "event_type", order.alias("orden"))
    return stream.run_upserts(rows, ["user_id"], "orden").select("user_id", "event_id", "event_type")


@BOOK.add("""
    WITH g AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS antes FROM events)
    SELECT user_id, count(*) AS eventos, count(*) FILTER (WHERE antes IS NULL OR ts - antes > INTERVAL 6 HOUR) AS sesiones FROM g GROUP BY 1""")
def s3_stateful_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions per user by a state of its own that lives on between batches."""
    totals = stream.sessions(_event_stream(spark, d), "user_id", "ts", 6 * 3600)
    return stream.run_updates(totals, ["user_id"], "events").select("user_id", F.col("events").alias("eventos"), F.col("sessions").alias("sesiones"))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
