"""Text, date, number and JSON functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rodaje.functions import text as X
from rodaje.functions.numeric import as_int, piecewise, safe_ratio, scaled_round
from rodaje.functions.similarity import damerau_levenshtein, token_sort_ratio
from rodaje.operators import windows
from rodaje.plans.book import Book
from rodaje.sources import table

BOOK = Book()


@BOOK.add("""
    SELECT doc_id, trim(regexp_replace(lower(strip_accents(text || ' ' || coalesce(marca, ''))), '[^a-z0-9]+', ' ', 'g'), ' ') AS clave,
           trim(regexp_replace(lower(strip_accents(coalesce(marca, '') || ' ' || coalesce(familia, ''))), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents""")
def f1_text_keys(spark: SparkSession, d: str) -> DataFrame:
    whole = F.concat("text", F.lit(" "), F.coalesce("marca", F.lit("")))
    return table(spark, d, "documents").select("doc_id", X.text_key(whole).alias("clave"), X.slug(F.coalesce("marca", F.lit("")), F.coalesce("familia", F.lit(""))).alias("slug"))


_PROVINCES = [("01", "Puerto Hondo"), ("02", "Valle Pardo"), ("03", "Sierra Ñandú"), ("04", "Río Tordo"), ("05", "Costa Lenga"), ("06", "Estero Azul"), ("07", "Monte Quieto"), ("08", "Pampa Alta"), ("09", "Laguna Brava Norte"), ("10", "Médanos"), ("11", "Bahía Calma"), ("12", "Confín del Sur")]
_VARIANTS = [("pto hondo", "01"), ("vlle pardo", "02"), ("cta lenga", "05"), ("mte quieto", "07"), ("lag brava nte", "09"), ("confin d sur", "12")]


def province_lists(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame(_PROVINCES, "provincia_id string, nombre string"), spark.createDataFrame(_VARIANTS, "variante string, provincia_id string")


def with_province_id(df: DataFrame, column: str, name: str = "provincia_id") -> DataFrame:
    """df with the id of a spelled-out province: by the list of variants, else by the official name; null if unknown."""
    names, variants = province_lists(df.sparkSession)
    official = names.select(X.text_key(F.col("nombre")).alias("_key"), F.col("provincia_id").alias("_by_name"))
    known = variants.select(F.col("variante").alias("_key"), F.col("provincia_id").alias("_by_variant"))
    keyed = df.withColumn("_key", X.text_key(F.nullif(column, F.lit("NULL"))))
    return keyed.join(known, "_key", "left").join(official, "_key", "left").withColumn(name, F.coalesce("_by_variant", "_by_name")).drop("_key", "_by_variant", "_by_name")


_P = ", ".join(f"('{i}', '{n}')" for i, n in _PROVINCES)
_V = ", ".join(f"('{v}', '{i}')" for v, i in _VARIANTS)


@BOOK.add(f"""
    WITH p(id, nombre) AS (VALUES {_P}), v(variante, id) AS (VALUES {_V}), k(clave, id) AS (SELECT trim(regexp_replace(lower(strip_accents(nombre)), '[^a-z0-9]+', ' ', 'g'), ' '), id FROM p),
    t AS (SELECT trim(regexp_replace(lower(strip_accents(nullif(registro_seccional_provincia, 'NULL'))), '[^a-z0-9]+', ' ', 'g'), ' ') AS clave FROM tramites_dnrpa)
    SELECT coalesce(v.id, k.id) AS provincia_id, count(*) AS n FROM t LEFT JOIN v ON variante = t.clave LEFT JOIN k ON k.clave = t.clave GROUP BY 1""")
def f2_province_key(spark: SparkSession, d: str) -> DataFrame:
    keyed = with_province_id(table(spark, d, "tramites_dnrpa").select("registro_seccional_provincia"), "registro_seccional_provincia")
    return keyed.groupBy("provincia_id").agg(F.count(F.lit(1)).alias("n"))


_RULES = [(r"^(small|red) (ring|rod)\b", "aro"), (r"(gear|bolt)$", "transmision"), (r"\bplate\b", "chapa"), (r"^(hot|cold)", "clima")]


@BOOK.add(f"""
    SELECT p_partkey, CASE {' '.join(f"WHEN regexp_matches(p_name, '{p}') THEN '{v}'" for p, v in _RULES)} ELSE 'otro' END AS tipo FROM part""")
def f3_classifier_cascade(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.classify(F.col("p_name"), _RULES, "otro").alias("tipo"))


@BOOK.add(r"""
    SELECT doc_id, nullif(regexp_extract(text, '\b(19[5-9]\d|20[0-4]\d)\b', 1), '') AS anio, nullif(regexp_extract(text, '(\d[.,]\d)\s*[lL]\b', 1), '') AS cilindrada,
           CASE WHEN regexp_matches(text, '(?i)diesel|gasoil|gas oil') THEN 'diesel' WHEN regexp_matches(text, '(?i)nafta|gasolina') THEN 'nafta' END AS combustible FROM documents""")
def f4_extract_years_engine(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", X.extract(t, r"\b(19[5-9]\d|20[0-4]\d)\b").alias("anio"), X.extract(t, r"(\d[.,]\d)\s*[lL]\b").alias("cilindrada"),
        F.when(t.rlike("(?i)diesel|gasoil|gas oil"), "diesel").when(t.rlike("(?i)nafta|gasolina"), "nafta").alias("combustible"),
    )


_LABELS = [("precio", r"(?iu)precio|\$", None), ("frenos", r"(?iu)freno|pastilla|disco", r"(?iu)mano"), ("motor", r"(?iu)motor|bujía|correa", None)]


@BOOK.add("""
    SELECT doc_id, concat_ws('|', CASE WHEN regexp_matches(text, '(?i)freno|pastilla|disco') AND NOT regexp_matches(text, '(?i)mano') THEN 'frenos' END,
           CASE WHEN regexp_matches(text, '(?i)motor|bujía|correa') THEN 'motor' END, CASE WHEN regexp_matches(text, '(?i)precio|\\$') THEN 'precio' END) AS rotulos
    FROM documents WHERE text IS NOT NULL""".replace("\\\\", "\\"))
def f5_multilabel_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(X.multilabel(F.col("text"), _LABELS), "|").alias("rotulos"))


@BOOK.add("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS periodo, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mes, CAST(year(o_orderdate) AS BIGINT) AS anio,
           strftime(last_day(o_orderdate), '%Y-%m-%d') AS fin, strftime(strptime(strftime(o_orderdate, '%Y%m'), '%Y%m') - INTERVAL 3 MONTH, '%Y-%m-%d') AS antes FROM orders""")
def f6_date_functions(spark: SparkSession, d: str) -> DataFrame:
    day, text = F.col("o_orderdate"), lambda c: F.date_format(c, "yyyy-MM-dd")
    periodo = F.date_format(day, "yyyyMM")
    return table(spark, d, "orders").select(
        "o_orderkey", periodo.alias("periodo"), text(F.trunc(day, "MM")).alias("mes"), F.year(day).cast("long").alias("anio"), text(F.last_day(day)).alias("fin"),
        text(F.add_months(F.to_date(periodo, "yyyyMM"), -3)).alias("antes"),
    )


@BOOK.add("""
    SELECT l_orderkey, l_linenumber, l_partkey, round(ln(l_extendedprice) * 1e6) / 1e6 AS logaritmo, greatest(l_discount, NULL, l_tax) AS mayor, least(l_discount, l_tax) AS menor,
           l_quantity / nullif(l_tax, 0) AS razon, try_cast(l_returnflag AS INTEGER) AS numero, CASE WHEN l_tax > 0.04 THEN 'alta' END AS banda FROM lineitem""")
def f7_math_null_cast(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", scaled_round(F.log("l_extendedprice"), 6).alias("logaritmo"), F.greatest(F.col("l_discount"), F.lit(None), F.col("l_tax")).alias("mayor"),
        F.least("l_discount", "l_tax").alias("menor"), safe_ratio(F.col("l_quantity"), F.col("l_tax")).alias("razon"), as_int(F.col("l_returnflag")).alias("numero"),
        F.when(F.col("l_tax") > 0.04, "alta").alias("banda"),
    )


_TYPOS = ["smal ring", "odl gear", "bleu plate", "hot rodd", "nwe widget"]


@BOOK.add(f"""
    SELECT p_name, t AS error, CAST(damerau_levenshtein(p_name, t) AS INTEGER) AS distancia FROM (SELECT DISTINCT p_name FROM part), (SELECT unnest({_TYPOS}) AS t)""")
def f8_edit_distance(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select("p_name").distinct().withColumn("error", F.explode(F.array(*map(F.lit, _TYPOS))))
    return names.withColumn("distancia", damerau_levenshtein("p_name", "error"))


@BOOK.add()
def f9_token_sort_ratio(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select("p_name").distinct().withColumn("otro", F.lit("ring small"))
    return names.withColumn("parecido", scaled_round(token_sort_ratio("p_name", "otro"), 6))


@BOOK.add("""
    SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS suma, count(DISTINCT json_extract(props, '$.k')) AS distintos FROM events GROUP BY 1""")
def f10_json_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(k).alias("suma"), F.count_distinct(k).alias("distintos"))


@BOOK.add("""
    SELECT p_partkey, round(CASE WHEN p_size <= 10 THEN 100 + (p1 - 100) / 10 * p_size WHEN p_size <= 30 THEN p1 + (p2 - p1) / 20 * (p_size - 10) ELSE p2 END * 1e4) / 1e4 AS valor
    FROM (SELECT *, p_retailprice / 20 AS p1, p_retailprice / 40 AS p2 FROM part)""")
def f11_piecewise_curve(spark: SparkSession, d: str) -> DataFrame:
    curve = piecewise(F.col("p_size").cast("double"), [(0, F.lit(100.0)), (10, F.col("p_retailprice") / 20), (30, F.col("p_retailprice") / 40)])
    return table(spark, d, "part").select("p_partkey", scaled_round(curve, 4).alias("valor"))


@BOOK.add("""
    SELECT p_partkey, coalesce(CASE WHEN p_size > 40 THEN p_retailprice END, CASE WHEN n >= 12 THEN m END, g) AS valor,
           CASE WHEN p_size > 40 THEN 'propio' WHEN n >= 12 THEN 'marca' ELSE 'general' END AS fuente
    FROM part JOIN (SELECT p_brand, p_type, median(p_retailprice) AS m, count(*) AS n FROM part GROUP BY 1, 2) USING (p_brand, p_type) CROSS JOIN (SELECT median(p_retailprice) AS g FROM part)""")
def f12_fallback_chain(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    by = windows.exact_percentiles(part, ["p_brand", "p_type"], "p_retailprice", {"m": 0.5})
    general = windows.exact_percentiles(part.withColumn("k", F.lit(1)), ["k"], "p_retailprice", {"m": 0.5}).select("m").scalar()
    value, source = windows.fallback([
        ("propio", F.when(F.col("p_size") > 40, F.col("p_retailprice"))), ("marca", F.when(F.col("n") >= 12, F.col("m"))), ("general", general)
    ])
    return part.join(by, ["p_brand", "p_type"]).select("p_partkey", value.alias("valor"), source.alias("fuente"))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
