"""Forms of joins, subqueries, functions, scans and sinks that the car sources use, over the test tables."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.functions import dates, requests, titles
from rodaje.functions import text as X
from rodaje.functions.numeric import percent, safe_ratio, scaled_round
from rodaje.functions.similarity import swap_distance, token_sort_ratio
from rodaje.operators import geo, increments, quality, tables, units, windows
from rodaje.plans.book import Book
from rodaje.session import shared_folder
from rodaje.sources import readers, sinks, table, web

BOOK = Book()


def _v(x: str | None) -> str:
    return "NULL" if x is None else f"'{x}'"


def _sql(spark: SparkSession, d: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{n: table(spark, d, n) for n in names})


# Joins


@BOOK.add("""
    WITH r AS (SELECT l_orderkey, l_returnflag AS marca, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
    SELECT o_orderkey, a.q AS devuelta, b.q AS segun_estado FROM orders LEFT JOIN r a ON a.marca = 'R' AND a.l_orderkey = o_orderkey
    LEFT JOIN r b ON b.l_orderkey = o_orderkey AND b.marca = CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'N' END""")
def j1_constant_and_case_keys(spark: SparkSession, d: str) -> DataFrame:
    """A left join with a constant in its condition, and one whose key is a CASE expression; both stay joins of equal keys."""
    r = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("marca")).agg(F.max("l_quantity").alias("q"))
    orders = table(spark, d, "orders").withColumn("pide", F.when(F.col("o_orderstatus") == "F", "A").otherwise("N"))
    a = r.where("marca = 'R'").select("l_orderkey", F.col("q").alias("devuelta"))
    b = r.select(F.col("l_orderkey").alias("k"), F.col("marca").alias("m"), F.col("q").alias("segun_estado"))
    out = orders.join(a, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(b, (F.col("k") == F.col("o_orderkey")) & (F.col("m") == F.col("pide")), "left")
    return out.select("o_orderkey", "devuelta", "segun_estado")


@BOOK.add("""
    WITH s AS (SELECT upper(marca) AS k, count(DISTINCT registro_id) AS servicios FROM service_precios WHERE marca IS NOT NULL GROUP BY 1),
    g AS (SELECT marca, count(DISTINCT guia_id) AS versiones FROM guia_versiones WHERE marca IS NOT NULL GROUP BY 1)
    SELECT marca, versiones, servicios FROM g JOIN s ON upper(g.marca) = s.k""")
def j2_case_folded_key(spark: SparkSession, d: str) -> DataFrame:
    """Both spellings of a brand in one source meet the other's: the folded key is a column, the join is by hash."""
    s = table(spark, d, "service_precios").where("marca is not null").groupBy(F.upper("marca").alias("k")).agg(F.count_distinct("registro_id").alias("servicios"))
    g = table(spark, d, "guia_versiones").where("marca is not null").groupBy("marca").agg(F.count_distinct("guia_id").alias("versiones"))
    return g.withColumn("k", F.upper("marca")).join(s, "k").select("marca", "versiones", "servicios")


# Subqueries


@BOOK.add("""
    WITH g AS (SELECT max(p_retailprice) AS tope, min(p_retailprice) AS piso FROM part)
    SELECT p_partkey, (SELECT CASE WHEN p_size > 25 THEN tope ELSE piso END FROM g) AS referencia FROM part""")
def k1_scalar_with_outer_column(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, """
        WITH g AS (SELECT max(p_retailprice) AS tope, min(p_retailprice) AS piso FROM {part})
        SELECT p_partkey, (SELECT CASE WHEN p_size > 25 THEN tope ELSE piso END FROM g) AS referencia FROM {part}""", "part")  # fmt: skip


@BOOK.add("""
    WITH v(variante, id) AS (VALUES ('SM', 1), ('LG', 2)), t AS (SELECT DISTINCT p_type FROM part)
    SELECT p_type, coalesce((SELECT id FROM v WHERE variante = upper(substring(p_type, 1, 2))), (SELECT n_nationkey FROM nation WHERE n_nationkey = length(p_type))) AS id FROM t""")
def k2_scalar_without_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Correlated lookups of at most one row, tried in turn: left joins on the expressions."""
    t = table(spark, d, "part").select("p_type").distinct()
    v = spark.createDataFrame([("SM", 1), ("LG", 2)], "variante string, id int")
    n = table(spark, d, "nation").select("n_nationkey")
    found = t.join(v, F.col("variante") == F.upper(F.substring("p_type", 1, 2)), "left").join(n, F.col("n_nationkey") == F.length("p_type"), "left")
    return found.select("p_type", F.coalesce("id", "n_nationkey").alias("id"))


@BOOK.add("""
    SELECT 'pierde filas' AS prueba, (SELECT count(*) FROM orders) <> (SELECT count(*) FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey) AS falla
    UNION ALL SELECT 'pierde monto', (SELECT sum(CAST(o_totalprice AS DECIMAL(28, 2))) FROM orders) <> (SELECT sum(CAST(o_totalprice AS DECIMAL(28, 2))) FROM orders LEFT JOIN customer ON o_custkey = c_custkey)""")
def k3_two_scalars_compared(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, """
        SELECT 'pierde filas' AS prueba, (SELECT count(*) FROM {orders}) <> (SELECT count(*) FROM {orders} LEFT SEMI JOIN {lineitem} ON l_orderkey = o_orderkey) AS falla
        UNION ALL SELECT 'pierde monto', (SELECT sum(CAST(o_totalprice AS DECIMAL(28, 2))) FROM {orders})
            <> (SELECT sum(CAST(o_totalprice AS DECIMAL(28, 2))) FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey)""", "orders", "lineitem", "customer")  # fmt: skip


# Text, dates, numbers


@BOOK.add("""
    SELECT DISTINCT p_brand, split_part(p_brand, '#', 2) AS numero, lpad(split_part(p_brand, '#', 2), 4, '0') AS codigo, upper(p_name[1]) || p_name[2:] AS nombre, left(p_type, 2) AS corto,
           replace(p_type, 'A', '*') AS tapado, sha256(p_brand || '|' || p_name) AS huella FROM part""")
def f13_split_pad_hash(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_brand", "p_name", "p_type").distinct()
    number = F.split_part("p_brand", F.lit("#"), F.lit(2))
    return part.select(
        "p_brand", number.alias("numero"), F.lpad(number, 4, "0").alias("codigo"), X.capitalised(F.col("p_name")).alias("nombre"), F.left("p_type", F.lit(2)).alias("corto"),
        F.replace("p_type", F.lit("A"), F.lit("*")).alias("tapado"), F.sha2(F.concat_ws("|", "p_brand", "p_name"), 256).alias("huella"),
    ).distinct()


@BOOK.add("""
    WITH h AS (SELECT o_orderkey, '<p>' || o_orderpriority || ' &amp; <!-- x --><b>' || o_orderstatus || '</b>&nbsp;&lt;1</p>' AS html, o_totalprice FROM orders)
    SELECT o_orderkey, trim(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&amp;', '&'), '\\s+', ' ', 'g')) AS texto,
           '$ ' || replace(format('{:,}', CAST(round(o_totalprice) AS BIGINT)), ',', '.') AS monto FROM h""".replace("\\\\", "\\"))
def f14_html_and_money(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit("<p>"), "o_orderpriority", F.lit(" &amp; <!-- x --><b>"), "o_orderstatus", F.lit("</b>&nbsp;&lt;1</p>"))
    return table(spark, d, "orders").select("o_orderkey", X.unescape_html(html).alias("texto"), X.money_text(F.col("o_totalprice")).alias("monto"))


@BOOK.add(r"""
    WITH t AS (SELECT DISTINCT version_fuente, familia FROM equipamiento_items WHERE version_fuente IS NOT NULL)
    SELECT version_fuente, familia, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(upper(strip_accents(version_fuente)), '[A-Z]+|\d+'),
           lambda w: NOT list_contains(regexp_extract_all(upper(strip_accents(familia)), '[A-Z]+|\d+'), w)))), ' ') AS palabras FROM t""")
def f15_token_sets(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "equipamiento_items").where("version_fuente is not null and familia is not null").select("version_fuente", "familia").distinct()
    return t.select("version_fuente", "familia", F.array_join(F.array_sort(X.token_set(F.col("version_fuente"), F.col("familia"))), " ").alias("palabras"))


@BOOK.add("""
    WITH t AS (SELECT o_orderkey, o_orderpriority, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '31/02/2024' END AS texto FROM orders)
    SELECT o_orderkey, texto, strftime(coalesce(try_strptime(texto, '%d/%m/%Y'), try_strptime(texto, '%d/%m/%Y %H:%M:%S'), try_cast(texto AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS momento,
           coalesce(try_strptime(texto, '%d/%m/%Y'), try_strptime(texto, '%d/%m/%Y %H:%M:%S'), try_cast(texto AS TIMESTAMP)) <= DATE '2024-06-01' AS pasado FROM t""")
def f16_tolerant_dates(spark: SparkSession, d: str) -> DataFrame:
    """Times written in several ways; one that is no date is null. The day that counts as today is a parameter."""
    n, at = F.col("o_orderkey") % 4, F.col("o_orderdate")
    written = F.when(n == 0, F.date_format(at, "dd/MM/yyyy")).when(n == 1, F.date_format(at, "dd/MM/yyyy HH:mm:ss")).when(n == 2, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).otherwise("31/02/2024")
    rows = table(spark, d, "orders").select("o_orderkey", written.alias("texto"))
    moment = dates.tolerant_timestamp(F.col("texto"))
    return rows.select("o_orderkey", "texto", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("momento"), (moment <= F.lit("2024-06-01").cast("timestamp")).alias("pasado"))


_SAID = [("precios de agosto 2026",), ("Vigente SEPTIEMBRE de 2025",), ("3er trimestre 2026",), ("1° trimestre de 2025",), ("lista febrero 2024",), ("sin vigencia",), (None,), ("diciembre",)]


@BOOK.add("""
    SELECT * FROM (VALUES ('precios de agosto 2026', '2026-08-01', '2026-08-31'), ('Vigente SEPTIEMBRE de 2025', '2025-09-01', '2025-09-30'), ('3er trimestre 2026', '2026-07-01', '2026-09-30'),
        ('1° trimestre de 2025', '2025-01-01', '2025-03-31'), ('lista febrero 2024', '2024-02-01', '2024-02-29'), ('sin vigencia', NULL, NULL), (NULL, NULL, NULL), ('diciembre', NULL, NULL)) AS t(texto, desde, hasta)""")
def f17_validity_by_month_name(spark: SparkSession, d: str) -> DataFrame:
    said = dates.validity(F.col("texto"))
    return spark.createDataFrame(_SAID, "texto string").select("texto", said["desde"].cast("string").alias("desde"), said["hasta"].cast("string").alias("hasta"))


@BOOK.add("""
    SELECT p_partkey, ceil(log2(p_size + 1)) AS arriba, floor(log2(p_size + 1)) AS abajo, p_name LIKE 'red%' AS empieza, p_type LIKE '%' || left(p_brand, 1) || '%' AS contiene FROM part""")
def f18_log_ceil_like(spark: SparkSession, d: str) -> DataFrame:
    log = F.log2(F.col("p_size") + 1)
    return table(spark, d, "part").select(
        "p_partkey", F.ceil(log).cast("double").alias("arriba"), F.floor(log).cast("double").alias("abajo"), F.col("p_name").startswith("red").alias("empieza"),
        F.contains("p_type", F.left("p_brand", F.lit(1))).alias("contiene"),
    )


@BOOK.add("""
    SELECT count(*) AS estaciones, count(*) FILTER (WHERE latitud BETWEEN -56 AND -21 AND longitud BETWEEN -74 AND -53) AS en_el_pais,
           count(*) FILTER (WHERE ultima_informacion <= TIMESTAMP '2026-01-01') AS hasta_hoy FROM (SELECT DISTINCT * FROM estaciones)""")
def f19_box_and_not_future(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "estaciones").distinct()
    return rows.agg(
        F.count(F.lit(1)).alias("estaciones"), F.count_if(F.col("latitud").between(-56, -21) & F.col("longitud").between(-74, -53)).alias("en_el_pais"),
        F.count_if(F.col("ultima_informacion") <= F.lit("2026-01-01").cast("timestamp_ntz")).alias("hasta_hoy"),
    )


@BOOK.add("""
    WITH s AS (SELECT fecha, avg(valor) AS v FROM cambio_usd GROUP BY 1), c AS (SELECT v / lag(v) OVER (ORDER BY fecha) - 1 AS cambio FROM s)
    SELECT round(max(abs(cambio)) * 1e6) / 1e6 AS mayor_salto, count(cambio) AS dias FROM c""")
def d11_largest_daily_change(spark: SparkSession, d: str) -> DataFrame:
    """The greatest change from one day to the next; the series has one row per calendar day."""
    s = table(spark, d, "cambio_usd").groupBy("fecha").agg(F.avg("valor").alias("v"))
    change = s.select((F.col("v") / F.lag("v").over(W.orderBy("fecha")) - 1).alias("cambio"))
    return change.agg(scaled_round(F.max(F.abs("cambio")), 6).alias("mayor_salto"), F.count("cambio").alias("dias"))


# What titles say


_TITLES = [
    "Kit x2 amortiguadores delanteros Gol 2010/2015 1.6", "Juego de 4 bujias NGK Corsa 98 a 2004", "Par pastillas freno Fiat Uno", "Disco de freno (2) Peugeot 208 desde 2013",
    "Filtro de aire Ford Ka 1,0 hasta 2007", "Bujia encendido Renault Clio derecha", "Amortiguador trasero izquierdo VW Fox 2012", "Correa 6PK Chevrolet Onix 1.4/1.8", "Alfombra", None,
]
_KINDS = [(r"(?i)^filtro", "filtro"), (r"(?i)pastilla|disco", "freno"), (r"(?i)bujia", "bujia"), (r"(?i)amortiguador", "amortiguador"), (r"(?i)^correa", "correa")]
_BRANDS = {"Volkswagen": ["VW"], "Chevrolet": ["Chev"], "Fiat": [], "Ford": [], "Renault": [], "Peugeot": [], "NGK": []}


@BOOK.add("""
    SELECT * FROM (VALUES
        ('Kit x2 amortiguadores delanteros Gol 2010/2015 1.6', 'amortiguador', NULL, 2, 2, 2010, 2015, '1.6'), ('Juego de 4 bujias NGK Corsa 98 a 2004', 'bujia', 'NGK', 4, 4, 1998, 2004, NULL),
        ('Par pastillas freno Fiat Uno', 'freno', 'Fiat', 2, 2, NULL, NULL, NULL), ('Disco de freno (2) Peugeot 208 desde 2013', 'freno', 'Peugeot', NULL, 1, 2013, NULL, NULL),
        ('Filtro de aire Ford Ka 1,0 hasta 2007', 'filtro', 'Ford', NULL, 1, NULL, 2007, '1.0'), ('Bujia encendido Renault Clio derecha', 'bujia', 'Renault', NULL, 1, NULL, NULL, NULL),
        ('Amortiguador trasero izquierdo VW Fox 2012', 'amortiguador', 'Volkswagen', NULL, 1, 2012, 2012, NULL), ('Correa 6PK Chevrolet Onix 1.4/1.8', 'correa', 'Chevrolet', NULL, 1, NULL, NULL, '1.4/1.8'),
        ('Alfombra', 'otro', NULL, NULL, 1, NULL, NULL, NULL), (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)) AS t(titulo, tipo, marca, cantidad, unidades, desde, hasta, motor)""")
def r1_titles(spark: SparkSession, d: str) -> DataFrame:
    """Kind, brand, quantity, units, years and engines that product titles name."""
    t = F.col("titulo")
    kind = F.when(t.isNotNull(), X.classify(t, _KINDS, "otro"))
    years = X.years_named(t)
    units = F.when(t.isNotNull(), titles.units_of(t, kind, {"freno": 2, "amortiguador": 2, "bujia": 4}))
    return spark.createDataFrame([(x,) for x in _TITLES], "titulo string").select(
        "titulo", kind.alias("tipo"), titles.canonical_brand(t, _BRANDS).alias("marca"), titles.quantity_named(t).alias("cantidad"), units.alias("unidades"),
        years["desde"].alias("desde"), years["hasta"].alias("hasta"), X.engines_named(t).alias("motor"),
    )


@BOOK.add(r"""
    SELECT DISTINCT automotor_modelo_descripcion AS modelo, regexp_matches(upper(automotor_modelo_descripcion), '\b(AT\d?|CVT|AUT|TIPTRONIC|DSG)\b') AS automatica,
           CASE WHEN regexp_matches(automotor_tipo_descripcion, '^PICK') THEN 'pick-up' WHEN regexp_matches(automotor_tipo_descripcion, '^FURG') THEN 'furgon'
                WHEN regexp_matches(automotor_tipo_descripcion, '^(SEDAN|BERLINA)') THEN 'sedan' ELSE 'otra' END AS carroceria FROM tramites_dnrpa WHERE automotor_modelo_descripcion IS NOT NULL""")
def r2_gearbox_and_body(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tramites_dnrpa").where("automotor_modelo_descripcion is not null")
    return rows.select(F.col("automotor_modelo_descripcion").alias("modelo"), titles.automatic(F.col("automotor_modelo_descripcion")).alias("automatica"), titles.body(F.col("automotor_tipo_descripcion")).alias("carroceria")).distinct()


@BOOK.add(r"""
    WITH t AS (SELECT DISTINCT item, lower(strip_accents(item)) AS t FROM equipamiento_items WHERE item IS NOT NULL)
    SELECT item, try_cast(replace(coalesce(nullif(regexp_extract(t, '(\d{1,2}(?:[.,]\d)?)\s*(?:"|pulg|plg|in\b)', 1), ''), nullif(regexp_extract(t, '\br\s?(\d{2})\b', 1), ''),
           nullif(regexp_extract(t, '(?:pantalla|display|tablero|llanta\w*|rodado)\D{0,30}?(\d{1,2})\b', 1), '')), ',', '.') AS DOUBLE) AS pulgadas FROM t""")
def r3_inches(spark: SparkSession, d: str) -> DataFrame:
    """Inches that an equipment item names: with their unit, as a rim ('R16'), or as the number behind a screen or wheel."""
    return table(spark, d, "equipamiento_items").where("item is not null").select("item", titles.inches(F.col("item")).alias("pulgadas")).distinct()


_EDITS = [("cronos", "cronnos", 1), ("hilux", "hliux", 1), ("ca", "abc", 3), ("gol", "gol", 0), ("", "ab", 2), ("amarok", "amorak", 2), ("up", None, None)]


@BOOK.add("SELECT * FROM (VALUES " + ", ".join(f"({_v(a)}, {_v(b)}, {'NULL' if n is None else n})" for a, b, n in _EDITS) + ") AS t(a, b, distancia)")
def f22_swap_distance(spark: SparkSession, d: str) -> DataFrame:
    """Edits with swaps of neighbours where no part is edited twice: 'ca' is three from 'abc'."""
    return spark.createDataFrame([(a, b) for a, b, _ in _EDITS], "a string, b string").withColumn("distancia", swap_distance("a", "b"))


_SORTED = [("ring small", "small ring", 100.0), ("gol trend", "trend gol msi", 81.818182), ("abc", "xyz", 0.0), ("", "", 100.0), (None, "a", None)]


@BOOK.add("SELECT * FROM (VALUES " + ", ".join(f"({_v(a)}, {_v(b)}, {'NULL' if n is None else f'{n}e0'})" for a, b, n in _SORTED) + ") AS t(a, b, parecido)")
def f23_sorted_words(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of texts whose words are sorted first."""
    return spark.createDataFrame([(a, b) for a, b, _ in _SORTED], "a string, b string").withColumn("parecido", scaled_round(token_sort_ratio("a", "b"), 6))


_PRICES = [("$ 1.234.567,89", 1e6), ("ARS 307.000,00", 3e5), ("$940.000.-", 9e5), ("desde 12500", 125000.0), ("$ 3.070.000", 3e5), ("consultar", 1e5), (None, 1e5)]


@BOOK.add("""
    SELECT * FROM (VALUES ('$ 1.234.567,89', 1234567.89e0, 1234567.89e0), ('ARS 307.000,00', 307000e0, 307000e0), ('$940.000.-', 940000e0, 940000e0), ('desde 12500', 12500e0, 125000e0),
        ('$ 3.070.000', 3070000e0, 307000e0), ('consultar', NULL, NULL), (NULL, NULL, NULL)) AS t(texto, leido, reparado)""")
def f21_price_texts(spark: SparkSession, d: str) -> DataFrame:
    """Prices in local notation read from texts, and those off by ten brought back to what is usual."""
    rows = spark.createDataFrame(_PRICES, "texto string, usual double").withColumn("leido", units.amount_in(F.col("texto")).cast("double"))
    return rows.select("texto", "leido", titles.repaired_price(F.col("leido"), F.col("usual")).alias("reparado"))


_OFFERS = [("Pastillas Original Mopar", "fabrica"), ("Bujia Original NGK", "NGK"), ("Filtro oem", "Original"), ("Amortiguador monroe orig", "Monroe"), ("Correa", "Alternativo"), (None, None)]
_MAKERS = {"NGK": ["ngk"], "Monroe": ["monroe"], "Bosch": ["bosch"]}


@BOOK.add("SELECT * FROM (VALUES " + ", ".join(f"({_v(t)}, {_v(q)})" for t, q in _OFFERS) + ") AS t(titulo, calidad)")
def r5_quality(spark: SparkSession, d: str) -> DataFrame:
    """Who made a part: factory brands first, then a known maker even where the title says original, then original, else other."""
    t = F.col("titulo")
    quality_ = F.when(t.rlike(r"(?i)\b(mopar|motorcraft)\b"), "fabrica").otherwise(F.coalesce(titles.canonical_brand(t, _MAKERS), F.when(t.rlike(r"(?i)\b(original|orig|oem)\b"), "Original"), F.when(t.isNotNull(), "Alternativo")))
    return spark.createDataFrame([(x,) for x, _ in _OFFERS], "titulo string").select("titulo", quality_.alias("calidad"))


#: Label, what a text must hold, what it must not.
_FEATURES = [
    ("airbag", r"airbag|bolsas? de aire", r"rodilla"), ("airbag_rodilla", r"rodilla", None), ("camara", r"camara", r"360|perimetral"), ("vision_360", r"360|perimetral|envolvente", None),
    ("cuero", r"cuero", r"volante"), ("volante_cuero", r"volante.*cuero|leather steering", None), ("led", r"\bled\b", r"diurn|drl|dia"), ("llantas", r"llanta|rodado|alloy", r"auxilio"),
]


@BOOK.add(
    "WITH t AS (SELECT DISTINCT item, lower(strip_accents(item)) AS t FROM equipamiento_items WHERE item IS NOT NULL) SELECT item, array_to_string(list_sort(list_filter(["
    + ", ".join(f"CASE WHEN regexp_matches(t, '{must}')" + (f" AND NOT regexp_matches(t, '{veto}')" if veto else "") + f" THEN '{label}' END" for label, must, veto in _FEATURES)
    + "], lambda x: x IS NOT NULL)), '|') AS rasgos, nullif(regexp_extract(t, '(\\d{1,2})\\s*(?:\"|pulg|plg)', 1), '') AS pulgadas FROM t".replace("\\\\", "\\")
)
def r6_features(spark: SparkSession, d: str) -> DataFrame:
    """All features an equipment item names, each unless a word rules it out."""
    folded = F.lower(X.strip_accents(F.col("item")))
    items = table(spark, d, "equipamiento_items").where("item is not null").select("item").distinct().withColumn("t", folded)
    labels = X.multilabel(F.col("t"), _FEATURES)
    return items.select("item", F.array_join(labels, "|").alias("rasgos"), X.extract(F.col("t"), r'(\d{1,2})\s*(?:"|pulg|plg)').alias("pulgadas"))


_ASKED = [("camioneta gasolera, 30 mil km al año, rio tordo",), ("Zeta o Paki? 40 palos, 4 años",), ("suv hibrida automatica con originales",), ("gasto 90 mil por mes",), (None,)]


@BOOK.add("""
    SELECT * FROM (VALUES ('camioneta gasolera, 30 mil km al año, rio tordo', 30000e0, NULL, NULL::DOUBLE, 'diesel', NULL, 'pickup', NULL, '04', ''), ('Zeta o Paki? 40 palos, 4 años', NULL, 4, 40000000e0, '', NULL, '', NULL, NULL, 'Zeta,Paki'),
        ('suv hibrida automatica con originales', NULL, NULL, NULL, 'hibrido', true, 'suv', true, NULL, ''), ('gasto 90 mil por mes', NULL, NULL, NULL, '', NULL, '', NULL, NULL, ''), (NULL, NULL, NULL, NULL, '', NULL, '', NULL, NULL, ''))
        AS t(texto, km_anio, anios, presupuesto, combustible, automatica, carroceria, originales, lugar, modelos)""")
def r4_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests in words read into parameters."""
    read = requests.with_request(spark.createDataFrame(_ASKED, "texto string"), "texto", ["Zeta", "Paki"], {"Río Tordo": "04"})
    lists = {c: F.array_join(F.col(f"pedido.{c}"), ",").alias(c) for c in ("combustible", "carroceria", "modelos")}
    return read.select("texto", *[lists.get(c, F.col(f"pedido.{c}").alias(c)) for c in ("km_anio", "anios", "presupuesto", "combustible", "automatica", "carroceria", "originales", "lugar", "modelos")])


# Scans


@BOOK.add("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def a8_one_level_glob(spark: SparkSession, d: str) -> DataFrame:
    return readers.parquet_glob(spark, f"{d}/order[s].parquet").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@BOOK.add("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def a9_two_level_glob(spark: SparkSession, d: str) -> DataFrame:
    p = PurePosixPath(d)
    found = readers.parquet_glob(spark, f"{p.parent}/{p.name[:-1]}[{p.name[-1]}]/natio*.parquet", merge=True)
    return found.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@BOOK.add("""
    WITH u AS (SELECT CAST(periodo AS VARCHAR) AS periodo, marca, anio, CAST(registro_id AS BIGINT) AS registro_id, NULL::DOUBLE AS valor FROM cca_precios
        UNION ALL BY NAME SELECT periodo, bandera, precio_mediano FROM combustible_mensual)
    SELECT left(periodo, 4) AS anio_periodo, count(*) AS filas, count(marca) AS con_marca, count(bandera) AS con_bandera, count(registro_id) AS con_registro FROM u GROUP BY 1""")
def a10_union_by_name_of_files(spark: SparkSession, d: str) -> DataFrame:
    """Two files whose column periodo has different types, read as one table."""
    u = readers.union_by_name(spark, [f"{d}/cca_precios.parquet", f"{d}/combustible_mensual.parquet"])
    return u.groupBy(F.left("periodo", F.lit(4)).alias("anio_periodo")).agg(
        F.count(F.lit(1)).alias("filas"), F.count("marca").alias("con_marca"), F.count("bandera").alias("con_bandera"), F.count("registro_id").alias("con_registro")
    )


# Sinks, read back


@BOOK.add("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 UNION ALL SELECT 'P', count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'")
def w1_partition_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A second load replaces its own partition and leaves the others."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sinks.write_partitions(orders, path, "o_orderstatus")
    sinks.write_partitions(orders.where("o_orderstatus = 'P' and o_orderpriority = '5-LOW'"), path, "o_orderstatus")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@BOOK.add("SELECT CAST(capturado AS VARCHAR) AS capturado, n FROM (VALUES (DATE '2026-01-01', (SELECT count(*) FROM nation)), (DATE '2026-01-03', (SELECT count(*) FROM nation WHERE n_regionkey > 0))) AS t(capturado, n)")
def w2_snapshot_if_changed(spark: SparkSession, d: str) -> DataFrame:
    """Three deliveries, of which the second repeats the first and is not written."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    nation = table(spark, d, "nation")
    for day, df in (("2026-01-01", nation), ("2026-01-02", nation.repartition(3)), ("2026-01-03", nation.where("n_regionkey > 0"))):
        sinks.write_snapshot(df, path, day)
    return spark.read.parquet(path).groupBy(F.col("capturado").cast("string").alias("capturado")).agg(F.count(F.lit(1)).alias("n"))


@BOOK.add("SELECT n_nationkey, '[' || n_nationkey || ',\"' || n_name || '\",' || n_regionkey || ']' AS fila FROM nation")
def w3_row_json(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return sinks.row_json(nation).withColumn("n_nationkey", F.get_json_object("fila", "$[0]").cast("int")).select("n_nationkey", "fila")


@BOOK.add("SELECT r_name AS carpeta, count(*) AS n, string_agg(n_name, ',' ORDER BY n_name) AS naciones FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def w4_json_by_key(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", F.col("r_name").alias("carpeta"))
    sinks.write_json_by(rows, path, "carpeta")
    back = spark.read.schema("n_name string, carpeta string").json(path)
    return back.groupBy("carpeta").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("naciones"))


@BOOK.add("SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def w5_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table written as CSV with its header and read as text; one column typed by a declared schema."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    sinks.write_csv(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), path)
    text = readers.csv_text(spark, path)
    typed = readers.csv_typed(spark, path, "n_nationkey int, n_name string, n_regionkey int").select("n_nationkey", "n_name")
    return typed.join(text.select("n_name", "n_regionkey"), "n_name").select("n_nationkey", "n_name", "n_regionkey")


@BOOK.add("SELECT DISTINCT 'datos/' || p_brand || '/' || lower(p_type) || '.parquet' AS ruta, true AS vuelve, sha256('datos/' || p_brand || '/' || lower(p_type) || '.parquet') AS sha FROM part")
def w6_asset_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Flat names of assets that lead back to their paths, with content hashes."""
    paths = table(spark, d, "part").select(F.concat(F.lit("datos/"), "p_brand", F.lit("/"), F.lower("p_type"), F.lit(".parquet")).alias("ruta")).distinct()
    name = web.asset_name_of(F.col("ruta"))
    return paths.select("ruta", (web.path_of(name) == F.col("ruta")).alias("vuelve"), F.sha2("ruta", 256).alias("sha"))


_ROBOTS = "User-agent: *\nDisallow: /privado\nAllow: /privado/abierto\nDisallow: /*.pdf$\n"


@BOOK.add("""
    SELECT * FROM (VALUES ('/catalogo/1', true), ('/privado/x', false), ('/privado/abierto/y', true), ('/lista.pdf', false), ('/lista.pdf?x=1', true), ('/', true)) AS t(ruta, permitida)""")
def w7_robots(spark: SparkSession, d: str) -> DataFrame:
    paths = spark.createDataFrame([(p,) for p in ("/catalogo/1", "/privado/x", "/privado/abierto/y", "/lista.pdf", "/lista.pdf?x=1", "/")], "ruta string")
    return paths.select("ruta", web.allowed(F.concat(F.lit("https://x.example"), "ruta"), _ROBOTS).alias("permitida"))


# Quality and loads


@BOOK.add("""
    WITH c AS (SELECT 100e0 * count(*) FILTER (WHERE text IS NOT NULL) / count(*) AS pct FROM documents), u AS (SELECT count(*) - count(DISTINCT declaracion_id) AS dobles, count(*) AS n FROM combustible_precios)
    SELECT 'cobertura de textos' AS prueba, round(pct * 10) / 10 AS valor, CASE WHEN pct < 50 THEN 'error' WHEN pct < 99.9 THEN 'aviso' ELSE 'bien' END AS estado FROM c
    UNION ALL SELECT 'filas repetidas', dobles, CASE WHEN dobles > 0.2 * n THEN 'error' WHEN dobles > 0 THEN 'aviso' ELSE 'bien' END FROM u
    UNION ALL SELECT 'dias de atraso', date_diff('day', (SELECT max(CAST(recibido AS DATE)) FROM combustible_precios), DATE '2026-06-30'),
        CASE WHEN date_diff('day', (SELECT max(CAST(recibido AS DATE)) FROM combustible_precios), DATE '2026-06-30') > 60 THEN 'error' WHEN date_diff('day', (SELECT max(CAST(recibido AS DATE)) FROM combustible_precios), DATE '2026-06-30') > 30 THEN 'aviso' ELSE 'bien' END
    UNION ALL SELECT 'items sin seccion', (SELECT count(*) FROM equipamiento_items WHERE seccion IS NULL), CASE WHEN (SELECT count(*) FROM equipamiento_items WHERE seccion IS NULL) > 0 THEN 'aviso' ELSE 'bien' END""")
def h3_floors_freshness_and_severity(spark: SparkSession, d: str) -> DataFrame:
    """A floor on coverage, a budget of repeated rows, days since the last delivery and a warning, each with its severity."""
    prices, docs, items = table(spark, d, "combustible_precios"), table(spark, d, "documents"), table(spark, d, "equipamiento_items")
    n = F.count(F.lit(1))
    pct = 100.0 * F.count("text") / n
    twice = n - F.count_distinct("declaracion_id")
    late = F.date_diff(F.lit("2026-06-30").cast("date"), F.max(F.col("recibido").cast("date")))
    return quality.graded([
        ("cobertura de textos", docs.agg(pct.alias("v"), (pct < 50).alias("error"), (pct < 99.9).alias("warn")).withColumn("v", scaled_round(F.col("v"), 1))),
        ("filas repetidas", prices.agg(twice.alias("v"), (twice > 0.2 * n).alias("error"), (twice > 0).alias("warn"))),
        ("dias de atraso", prices.agg(late.alias("v"), (late > 60).alias("error"), (late > 30).alias("warn"))),
        ("items sin seccion", items.agg(F.count_if(F.col("seccion").isNull()).alias("v"), F.lit(False).alias("error"), (F.count_if(F.col("seccion").isNull()) > 0).alias("warn"))),
    ])


_SCALE = [("p", 0.0, 10.0, 0.0, 1.0), ("p", 10.0, 20.0, 0.1, 2.0), ("p", 20.0, None, 9.0, 3.0), ("q", 0.0, None, 0.0, 1.0)]


@BOOK.add("SELECT 'p' AS k, 20e0 AS desde, NULL::DOUBLE AS hasta, 9e0 AS fijo, 3e0 AS pct")
def h4_scale_continuity(spark: SparkSession, d: str) -> DataFrame:
    scale = spark.createDataFrame(_SCALE, "k string, desde double, hasta double, fijo double, pct double")
    return quality.not_continuous(scale, ["k"], "desde", "hasta", "fijo", "pct")


@BOOK.add("""
    WITH p AS (SELECT DISTINCT registro_id, precio, km FROM service_precios)
    SELECT * FROM (SELECT 'filas' AS regla, count(*) < 10 AS falla FROM p UNION ALL SELECT 'nulos en precio', count(*) FILTER (WHERE precio IS NULL) > 0.01 * count(*) FROM p
        UNION ALL SELECT 'km fuera de rango', bool_or(coalesce(km < 0 OR km > 1000000, false)) FROM p UNION ALL SELECT 'clave repetida', EXISTS (SELECT 1 FROM p GROUP BY registro_id HAVING count(*) > 1))""")
def h5_delivery_guards(spark: SparkSession, d: str) -> DataFrame:
    """Whether a delivery may be taken in: enough rows, few nulls, values in range, keys once."""
    p = table(spark, d, "service_precios").select("registro_id", "precio", "km").distinct()
    n = F.count(F.lit(1))
    one = p.agg((n < 10).alias("filas"), (F.count_if(F.col("precio").isNull()) > 0.01 * n).alias("nulos en precio"), F.bool_or(F.coalesce((F.col("km") < 0) | (F.col("km") > 1_000_000), F.lit(False))).alias("km fuera de rango"))
    twice = quality.not_unique(p, ["registro_id"]).agg((n > 0).alias("clave repetida"))
    return one.unpivot([], ["filas", "nulos en precio", "km fuera de rango"], "regla", "falla").unionByName(twice.unpivot([], ["clave repetida"], "regla", "falla"))


@BOOK.add("""
    WITH r AS (SELECT serie AS recurso, max(recibido) AS modificado FROM declaraciones_crudas GROUP BY 1),
    e AS (SELECT serie AS recurso, max(recibido) AS visto FROM declaraciones_crudas WHERE orden <= 6 GROUP BY 1)
    SELECT recurso, CAST(modificado AS VARCHAR) AS modificado, CAST(visto AS VARCHAR) AS visto FROM r LEFT JOIN e USING (recurso) WHERE visto IS NULL OR modificado > visto""")
def l1_changed_resources(spark: SparkSession, d: str) -> DataFrame:
    """Resources modified since they were last taken in; each is then read anew as a whole."""
    raw = table(spark, d, "declaraciones_crudas").withColumnRenamed("serie", "recurso")
    now = raw.groupBy("recurso").agg(F.max("recibido").alias("modificado"))
    state = raw.where("orden <= 6").groupBy("recurso").agg(F.max("recibido").alias("visto"))
    found = increments.changed_since(now, state, "recurso", "modificado", "visto")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return found.select("recurso", text("modificado"), text("visto"))


@BOOK.add("SELECT 'nation' AS fuente, true AS bien, (SELECT count(*) FROM nation) AS filas UNION ALL SELECT 'no_existe', false, NULL UNION ALL SELECT 'region', true, (SELECT count(*) FROM region)")
def l2_isolated_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources taken in one by one; one that fails is reported at the end and does not stop the others."""
    loads = {n: (lambda n=n: table(spark, d, n).count()) for n in ("nation", "no_existe", "region")}
    return increments.run_isolated(spark, loads).select("fuente", "bien", "filas")


# Composite tables


@BOOK.add("""
    WITH v AS (SELECT p_brand, p_partkey, p_retailprice * 0.1 AS uso, p_size * 2.0 AS guarda, CASE WHEN p_type <> 'PROMO' THEN 30.0 END AS seguro FROM part),
    r AS (SELECT *, uso + guarda + seguro AS total, row_number() OVER (PARTITION BY p_brand ORDER BY uso + guarda + seguro, p_partkey) AS puesto FROM v WHERE seguro IS NOT NULL),
    a AS (SELECT * FROM r WHERE puesto = 1), b AS (SELECT * FROM r WHERE puesto = 2)
    SELECT a.p_brand, a.p_partkey AS primero, b.p_partkey AS segundo, round((b.total - a.total) * 100) / 100 AS ahorro,
           CASE WHEN greatest(abs(b.uso - a.uso), abs(b.guarda - a.guarda), abs(b.seguro - a.seguro)) = abs(b.uso - a.uso) THEN 'uso'
                WHEN greatest(abs(b.uso - a.uso), abs(b.guarda - a.guarda), abs(b.seguro - a.seguro)) = abs(b.guarda - a.guarda) THEN 'guarda' ELSE 'seguro' END AS motivo
    FROM a JOIN b USING (p_brand)""")
def g9b_explained_choice(spark: SparkSession, d: str) -> DataFrame:
    """The two cheapest complete items of a family and the component in which they differ most."""
    parts = ["uso", "guarda", "seguro"]
    v = table(spark, d, "part").select("p_brand", "p_partkey", (F.col("p_retailprice") * 0.1).alias("uso"), (F.col("p_size") * 2.0).alias("guarda"), F.when(F.col("p_type") != "PROMO", 30.0).alias("seguro"))
    v = v.where("seguro is not null").withColumn("total", F.col("uso") + F.col("guarda") + F.col("seguro"))
    two = windows.top_per_group(v, ["p_brand"], [F.asc("total"), F.asc("p_partkey")], 2, "puesto")
    at = lambda n, c: F.max(F.when(F.col("puesto") == n, F.col(c)))
    both = two.groupBy("p_brand").agg(at(1, "p_partkey").alias("primero"), at(2, "p_partkey").alias("segundo"), *[F.abs(at(2, c) - at(1, c)).alias(c) for c in parts], (at(2, "total") - at(1, "total")).alias("ahorro"))
    reason = F.when(F.greatest(*parts) == F.col("uso"), "uso").when(F.greatest(*parts) == F.col("guarda"), "guarda").otherwise("seguro")
    return both.where("segundo is not null").select("p_brand", "primero", "segundo", scaled_round(F.col("ahorro"), 2).alias("ahorro"), reason.alias("motivo"))


@BOOK.add("""
    WITH x AS (SELECT p_brand, p_type, p_partkey, p_retailprice, CASE WHEN p_size < 5 THEN NULL ELSE p_size BETWEEN 10 AND 30 END AS sirve FROM part),
    k AS (SELECT *, coalesce(sirve, true) OR NOT bool_or(coalesce(sirve, true)) OVER (PARTITION BY p_brand, p_type) AS queda FROM x)
    SELECT p_brand, p_type, count(*) AS ofertas, min(p_retailprice) AS desde, count(*) FILTER (WHERE sirve) AS confirmadas FROM k WHERE queda GROUP BY 1, 2""")
def g10_misfits_dropped_unless_all(spark: SparkSession, d: str) -> DataFrame:
    """Offers that do not fit are dropped, unless their group would be left empty."""
    size = F.col("p_size")
    x = table(spark, d, "part").withColumn("sirve", tables.fits(size, F.when(size >= 5, 10), F.when(size >= 5, 30)))
    ok = F.coalesce("sirve", F.lit(True))
    kept = x.withColumn("queda", ok | ~F.bool_or(ok).over(W.partitionBy("p_brand", "p_type"))).where("queda")
    return kept.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("ofertas"), F.min("p_retailprice").alias("desde"), F.count_if("sirve").alias("confirmadas"))


@BOOK.add("""
    WITH x AS (SELECT p_partkey, CASE WHEN p_size >= 5 THEN 30 BETWEEN p_size - 5 AND p_size + 5 END AS por_anio,
               CASE WHEN p_type NOT IN ('PROMO', 'LARGE') THEN true WHEN p_name LIKE '%old%' THEN NULL ELSE p_name LIKE '%red%' END AS por_motor FROM part)
    SELECT p_partkey, por_anio AND por_motor AS sirve FROM x""")
def g19_fit_by_year_and_engine(spark: SparkSession, d: str) -> DataFrame:
    """Three-valued fit: what a title does not say is unknown, and the engine counts for some kinds of parts only."""
    part, size = table(spark, d, "part"), F.col("p_size")
    by_year = tables.fits(F.lit(30), F.when(size >= 5, size - 5), F.when(size >= 5, size + 5))
    by_engine = F.when(~F.col("p_type").isin("PROMO", "LARGE"), True).when(F.contains("p_name", F.lit("old")), None).otherwise(F.contains("p_name", F.lit("red")))
    return part.select("p_partkey", (by_year & by_engine).alias("sirve"))


@BOOK.add("""
    WITH m AS (SELECT p_brand, p_type, count(DISTINCT p_name) AS n FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_name) >= 2), q AS (SELECT DISTINCT p_brand FROM m WHERE p_type = 'PROMO')
    SELECT m.* FROM m WHERE p_type = 'PROMO' UNION ALL SELECT m.* FROM m WHERE p_brand NOT IN (SELECT p_brand FROM q)""")
def g11_supported_and_qualified_first(spark: SparkSession, d: str) -> DataFrame:
    """Values backed by two items or more; the qualified ones where a group has any, else all."""
    m = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count_distinct("p_name").alias("n")).where("n >= 2")
    q = m.where("p_type = 'PROMO'")
    return q.unionByName(m.join(q.select("p_brand"), "p_brand", "left_anti").select(*m.columns))


@BOOK.add("""
    WITH k AS (SELECT c_custkey, c_custkey * 7919 % 90000 AS km FROM customer), s AS (SELECT c_custkey, km, unnest([10000, 20000, 40000]) AS cada FROM k)
    SELECT c_custkey, CAST(min(cada * (km // cada + 1)) AS BIGINT) AS proximo, arg_min(cada, struct_pack(a := cada * (km // cada + 1), b := cada)) AS cada, round(min(cada * (km // cada + 1) - km) / 1250.0 * 10) / 10 AS meses FROM s GROUP BY 1""")
def g12_next_replacement(spark: SparkSession, d: str) -> DataFrame:
    """Of several parts replaced every so many kilometres, the one due first and the months until then."""
    k = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 7919 % 90000).alias("km")).withColumn("cada", F.explode(F.array(*map(F.lit, (10000, 20000, 40000)))))
    due = F.col("cada") * (F.floor(F.col("km") / F.col("cada")) + 1)
    first = k.withColumn("due", due).groupBy("c_custkey").agg(F.min(F.struct("due", "cada")).alias("m"), F.max("km").alias("km"))
    return first.select("c_custkey", F.col("m.due").cast("long").alias("proximo"), "m.cada", scaled_round((F.col("m.due") - F.col("km")) / 1250.0, 1).alias("meses"))


@BOOK.add("""
    SELECT p_partkey, CAST(km + d AS BIGINT) AS paso, CAST(veces AS INTEGER) AS veces FROM (SELECT p_partkey, p_size * 1000 AS km, d, row_number() OVER (PARTITION BY p_partkey ORDER BY d) - 1 AS veces
        FROM part, range(1, 60001) AS r(d) WHERE (p_size * 1000 + d) % 30000 IN (0, 10000, 20000) AND d <= 60000) WHERE veces < 4""")
def g13_services_on_a_cycle(spark: SparkSession, d: str) -> DataFrame:
    """The next four services of a plan of 10, 20 and 30 thousand kilometres that begins anew after its last step."""
    part = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 1000).alias("km"))
    return tables.next_on_cycle(part, F.col("km"), [10000, 20000, 30000], 4).select("p_partkey", F.col("paso").cast("long").alias("paso"), "veces")


@BOOK.add("""
    WITH u AS (SELECT upper(trim(mtm)) AS clave, anio, max(valor_fiscal) AS v FROM valuacion_fotos WHERE vigencia = (SELECT max(vigencia) FROM valuacion_fotos) AND anio > 0 AND valor_fiscal IS NOT NULL GROUP BY 1, 2)
    SELECT a.clave, a.anio, a.v AS hoy, b.v AS en_tres, round(CAST(b.v AS DOUBLE) / a.v * 1e4) / 1e4 AS conserva FROM u a LEFT JOIN u b ON b.clave = a.clave AND b.anio = a.anio - 3""")
def g14_value_in_three_years(spark: SparkSession, d: str) -> DataFrame:
    """What a version will be worth, told by the same version three years older today."""
    all_ = table(spark, d, "valuacion_fotos")
    newest = all_.select(F.max("vigencia")).scalar()
    u = all_.where((F.col("vigencia") == newest) & (F.col("anio") > 0) & F.col("valor_fiscal").isNotNull()).groupBy(F.upper(F.trim("mtm")).alias("clave"), "anio").agg(F.max("valor_fiscal").alias("hoy"))
    older = u.select("clave", (F.col("anio") + 3).alias("anio"), F.col("hoy").alias("en_tres"))
    return u.join(older, ["clave", "anio"], "left").select("clave", "anio", "hoy", "en_tres", scaled_round(safe_ratio(F.col("en_tres"), F.col("hoy")), 4).alias("conserva"))


@BOOK.add("""
    WITH i AS (SELECT DISTINCT marca, familia, version_fuente, lower(trim(item)) AS item, valor FROM equipamiento_items WHERE item IS NOT NULL AND version_fuente IS NOT NULL)
    SELECT marca, familia, item, count(DISTINCT coalesce(valor, '')) > 1 AS difiere, count(DISTINCT version_fuente) AS versiones FROM i GROUP BY 1, 2, 3""")
def q1_side_by_side(spark: SparkSession, d: str) -> DataFrame:
    """Whether the versions of a family differ in an item."""
    i = table(spark, d, "equipamiento_items").where("item is not null and version_fuente is not null")
    return i.groupBy("marca", "familia", F.lower(F.trim("item")).alias("item")).agg(
        (F.count_distinct(F.coalesce("valor", F.lit(""))) > 1).alias("difiere"), F.count_distinct("version_fuente").alias("versiones")
    )


@BOOK.add("""
    WITH i AS (SELECT DISTINCT familia, version_fuente, seccion, valor FROM equipamiento_items WHERE version_fuente IS NOT NULL AND seccion IS NOT NULL AND valor IS NOT NULL),
    n AS (SELECT familia, count(DISTINCT version_fuente) AS n FROM i GROUP BY 1), s AS (SELECT familia, seccion, count(DISTINCT valor) AS d, count(DISTINCT version_fuente) AS m FROM i GROUP BY 1, 2)
    SELECT familia, min(seccion) AS seccion FROM s JOIN n USING (familia) WHERE d = n AND m = n AND n > 1 GROUP BY 1""")
def q2_distinguishing_attribute(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "equipamiento_items").where("version_fuente is not null and seccion is not null and valor is not null").select("familia", "version_fuente", "seccion", "valor").distinct()
    return tables.distinguishing(i, ["familia"], "version_fuente", "seccion", "valor")


@BOOK.add("""
    SELECT * FROM (VALUES ('Airbag', 0, 'si'), ('Airbag', 1, 'si'), ('Airbag', 2, NULL), ('ABS', 0, 'si'), ('ABS', 1, 'no'), ('ABS', 2, 'no')) AS t(etiqueta, columna, valor)""")
def q3_stacked_cells(spark: SparkSession, d: str) -> DataFrame:
    """Stacked and merged cells of a sheet as rows."""
    sheet = spark.createDataFrame([("Airbag\nABS", "x||?\nx|no|"), (None, "x")], "etiquetas string, celdas string")
    return tables.expand_cells(sheet, "etiquetas", "celdas").select("etiqueta", "columna", "valor")


@BOOK.add("""
    WITH o AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1), p AS (SELECT p_brand, p_name, n FROM part JOIN o ON l_partkey = p_partkey),
    f AS (SELECT p_brand, p_name, CAST(sum(n) AS BIGINT) AS ventas FROM p GROUP BY 1, 2)
    SELECT p_brand, CAST(sum(ventas) AS BIGINT) AS total, string_agg(p_name || ':' || ventas, '|' ORDER BY ventas DESC, p_name) AS nombres FROM (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY ventas DESC, p_name) <= 5) GROUP BY 1""")
def x1_family_page(spark: SparkSession, d: str) -> DataFrame:
    """One row per family with its five best sellers as an ordered list."""
    o = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    f = table(spark, d, "part").join(o, "p_partkey").groupBy("p_brand", "p_name").agg(F.sum("n").alias("ventas"))
    top = windows.top_per_group(f, ["p_brand"], [F.desc("ventas"), F.asc("p_name")], 5)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("ventas")).alias("v"), F.col("p_name").alias("n"))))
    return top.groupBy("p_brand").agg(F.sum("ventas").alias("total"), F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["n"], (-x["v"]).cast("string"))), "|").alias("nombres"))


@BOOK.add("""
    WITH m AS (SELECT provincia_id, producto, right(periodo, 2) AS mes, round(avg(precio_mediano) * 100) / 100 AS p FROM combustible_mensual GROUP BY ALL)
    SELECT provincia_id, producto, string_agg(mes || '=' || CAST(p AS DECIMAL(18, 2)), ';' ORDER BY mes) AS serie FROM m GROUP BY 1, 2""")
def x2_compact_series(spark: SparkSession, d: str) -> DataFrame:
    """A matrix packed into one list per row key."""
    m = table(spark, d, "combustible_mensual").groupBy("provincia_id", "producto", F.right("periodo", F.lit(2)).alias("mes")).agg(scaled_round(F.avg("precio_mediano"), 2).alias("p"))
    cells = F.array_sort(F.collect_list(F.concat_ws("=", "mes", F.col("p").cast("decimal(18,2)").cast("string"))))
    return m.groupBy("provincia_id", "producto").agg(F.array_join(cells, ";").alias("serie"))


@BOOK.add("""
    WITH t AS (SELECT marca, descripcion, max(n) AS n FROM matching_0km GROUP BY 1, 2), b AS (SELECT * FROM t WHERE descripcion IS NOT NULL ORDER BY n DESC, marca, descripcion LIMIT 50),
    g AS (SELECT DISTINCT upper(marca) AS marca FROM guia_versiones)
    SELECT count(*) AS filas, CAST(sum(n) AS BIGINT) AS unidades, round(1000e0 * sum(n) FILTER (WHERE upper(marca) IN (SELECT marca FROM g)) / sum(n)) / 10 AS pct FROM b""")
def h6_top50_weighted_match(spark: SparkSession, d: str) -> DataFrame:
    """The share of the units of the fifty most registered versions whose brand the guide has."""
    t = table(spark, d, "matching_0km").where("descripcion is not null").groupBy("marca", "descripcion").agg(F.max("n").alias("n")).orderBy(F.desc("n"), "marca", "descripcion").limit(50)
    g = table(spark, d, "guia_versiones").select(F.upper("marca").alias("k"), F.lit(True).alias("ok")).distinct()
    known = t.withColumn("k", F.upper("marca")).join(g, "k", "left")
    return known.agg(F.count(F.lit(1)).alias("filas"), F.sum("n").alias("unidades"), percent(F.sum(F.when(F.col("ok"), F.col("n"))), F.sum("n")).alias("pct"))


@BOOK.add("SELECT 2 AS exactos, 1 AS sobran, 2 AS faltan")
def h7_label_scores(spark: SparkSession, d: str) -> DataFrame:
    gold = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, l string")
    said = spark.createDataFrame([(1, "a"), (2, "a"), (2, "z"), (4, "d")], "id int, l string")
    found = tables.score_labels(said, gold, "id", "l")
    return found.select(*[F.col(c).cast("int").alias(c) for c in ("exactos", "sobran", "faltan")])


# Points in regions


_REGIONS = {"norte": [(-21.0, -70.0), (-21.0, -55.0), (-34.0, -55.0), (-34.0, -70.0)], "triangulo": [(-30.0, -68.0), (-45.0, -72.0), (-45.0, -58.0)]}


@BOOK.add("""
    WITH s AS (SELECT nro_inscripcion AS nro, max(struct_pack(t := coalesce(ultima_informacion, TIMESTAMP '0001-01-01'), a := coalesce(latitud, -1000), o := coalesce(longitud, -1000))) AS r FROM estaciones WHERE nro_inscripcion IS NOT NULL GROUP BY 1),
    p AS (SELECT nro, r.a AS lat, r.o AS lon FROM s WHERE r.a BETWEEN -56 AND -21 AND r.o BETWEEN -74 AND -53)
    SELECT nro, 'norte' AS region FROM p WHERE lat < -21 AND lat >= -34 AND lon >= -70 AND lon < -55
    UNION ALL SELECT nro, 'triangulo' FROM p WHERE lat <= -30 AND lat > -45 AND lon > -68 - 4 * (-30 - lat) / 15 AND lon < -68 + 10 * (-30 - lat) / 15""")
def p1_regions(spark: SparkSession, d: str) -> DataFrame:
    """The regions that hold each station."""
    rings = [(n, [{"lat": a, "lon": o} for a, o in r]) for n, r in _REGIONS.items()]
    regions = spark.createDataFrame(rings, "region string, ring array<struct<lat double, lon double>>")
    found = geo.points_in_regions(geo.current_stations(table(spark, d, "estaciones")), regions, id_col="nro_inscripcion", lat="latitud", lon="longitud")
    return found.select(F.col("id").alias("nro"), "region")


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
