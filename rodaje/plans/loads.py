"""Deliveries read and written, loads planned, and tables made by Python models."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.functions.numeric import scaled_round
from rodaje.functions.text import has_all_words
from rodaje.operators import geo, increments, units, windows
from rodaje.plans.book import Book
from rodaje.session import shared_folder
from rodaje.sources import readers, sinks, table, web

BOOK = Book()


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# Files


@BOOK.add("SELECT 'lote.zip' AS archivo, CASE n_regionkey WHEN 0 THEN '2024-01.csv' ELSE '2024-02.csv' END AS miembro, count(*) AS n, max(n_name) AS ultimo FROM nation GROUP BY 1, 2")
def w8_zip_of_csvs(spark: SparkSession, d: str) -> DataFrame:
    """The members of an archive of CSV files as one table; the archive's bytes are written as any other file."""
    rows = table(spark, d, "nation").select("n_name", "n_regionkey").collect()  # a fixed list of nations
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for name, chosen in (("2024-01.csv", [r for r in rows if r.n_regionkey == 0]), ("2024-02.csv", [r for r in rows if r.n_regionkey != 0])):
            z.writestr(name, "nombre\n" + "".join(f"{r.n_name}\n" for r in chosen))
        z.writestr("leeme.txt", "-")
    path = f"{_folder(spark)}/lote.zip"
    sinks.write_bytes(spark, path, packed.getvalue())
    read = readers.zip_of_csvs(spark, path, ["nombre"])
    return read.groupBy(F.element_at(F.split("archivo", "/"), -1).alias("archivo"), "miembro").agg(F.count(F.lit(1)).alias("n"), F.max("nombre").alias("ultimo"))


@BOOK.add("SELECT ';' AS separador, 'año|nación' AS columnas, count(*) AS filas, CAST(max(n_nationkey) AS INTEGER) AS mayor, 'int' AS tipo FROM nation")
def w9_latin1_and_inferred(spark: SparkSession, d: str) -> DataFrame:
    """A CSV in Latin-1 whose separator is found in its first line, and one whose types come from all its rows."""
    path, other = _folder(spark), _folder(spark)
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("año"), F.col("n_name").alias("nación"))
    nation.coalesce(1).write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    sinks.write_csv(nation, other)
    sep = readers.sniff_separator(spark, path)
    text, typed = readers.csv_text(spark, path, sep, "ISO-8859-1"), readers.csv_inferred(spark, other)
    kind = dict(typed.dtypes)["año"]
    return text.agg(F.count(F.lit(1)).alias("filas"), F.max(F.col("año").cast("int")).alias("mayor")).select(F.lit(sep).alias("separador"), F.lit("|".join(text.columns)).alias("columnas"), "filas", "mayor", F.lit(kind).alias("tipo"))


@BOOK.add("SELECT unnest(['n_nationkey', 'n_name', 'falta']) AS columna, unnest(['INTEGER', 'VARCHAR', 'VARCHAR']) AS tipo")
def a11_schema_probe(spark: SparkSession, d: str) -> DataFrame:
    """The expected columns of a delivery without reading a row; one that is absent comes as text."""
    probe = readers.probe(table(spark, d, "nation").limit(0), ["n_nationkey", "n_name", "falta"], ["n_name"])
    kinds = {"int": "INTEGER", "string": "VARCHAR"}
    return spark.createDataFrame([(c, kinds[t]) for c, t in probe.dtypes], "columna string, tipo string")


@BOOK.add("SELECT n_regionkey, count(*) AS n, max(n_name) AS ultimo FROM nation GROUP BY 1")
def w10_materialised(spark: SparkSession, d: str) -> DataFrame:
    """A table written once and read by two later steps."""
    kept = sinks.materialised(table(spark, d, "nation").select("n_regionkey", "n_name"), _folder(spark))
    return kept.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n")).join(kept.groupBy("n_regionkey").agg(F.max("n_name").alias("ultimo")), "n_regionkey")


_CATALOG = '{"result": {"resources": [{"name": "precios", "format": "CSV", "url": "https://x.example/p.csv", "last_modified": "2026-01-03T10:00:00"}, {"name": "bocas", "format": "ZIP", "url": "https://x.example/b.zip", "last_modified": null}]}}'


@BOOK.add("SELECT * FROM (VALUES ('precios', 'csv', 'https://x.example/p.csv', '2026-01-03'), ('bocas', 'zip', 'https://x.example/b.zip', NULL)) AS t(nombre, formato, url, modificado)")
def w11_catalog_json(spark: SparkSession, d: str) -> DataFrame:
    """The resources a catalogue's JSON lists, one row each."""
    schema = "result struct<resources: array<struct<name: string, format: string, url: string, last_modified: string>>>"
    r = spark.createDataFrame([(_CATALOG,)], "t string").select(F.explode(F.from_json("t", schema)["result"]["resources"]).alias("r")).select("r.*")
    return r.select(F.col("name").alias("nombre"), F.lower("format").alias("formato"), "url", F.left("last_modified", F.lit(10)).alias("modificado"))


@BOOK.add("""
    WITH l AS (SELECT p_partkey AS k, sha256(p_name || p_type) AS h FROM part), r AS (SELECT p_partkey + 5 AS k, CASE WHEN p_partkey % 7 = 0 THEN 'otro' ELSE (SELECT h FROM l WHERE l.k = p_partkey + 5) END AS h FROM part)
    SELECT coalesce(l.k, r.k) AS ruta, CASE WHEN r.k IS NULL THEN 'subir' WHEN l.k IS NULL THEN 'borrar' WHEN l.h = r.h THEN 'igual' ELSE 'reemplazar' END AS accion FROM l FULL JOIN r ON l.k = r.k""")
def l3_sync_plan(spark: SparkSession, d: str) -> DataFrame:
    """What a store needs to be like a folder, told by two manifests of content hashes."""
    here = table(spark, d, "part").select(F.col("p_partkey").alias("ruta"), F.sha2(F.concat("p_name", "p_type"), 256).alias("sha"))
    stored = table(spark, d, "part").select((F.col("p_partkey") + 5).alias("ruta"), "p_partkey").join(here, "ruta", "left").select("ruta", F.when(F.col("p_partkey") % 7 == 0, "otro").otherwise(F.col("sha")).alias("sha"))
    return web.sync_plan(here, stored, "ruta", "sha").select("ruta", F.col("action").alias("accion"))


@BOOK.add("""
    WITH r AS (SELECT serie, max(recibido) AS u FROM declaraciones_crudas GROUP BY 1)
    SELECT serie, date_diff('day', CAST(u AS DATE), DATE '2026-06-30') AS dias FROM r WHERE date_diff('day', CAST(u AS DATE), DATE '2026-06-30') >= 200""")
def l4_due_resources(spark: SparkSession, d: str) -> DataFrame:
    """Resources last fetched at least so many days ago."""
    r = table(spark, d, "declaraciones_crudas").groupBy("serie").agg(F.max("recibido").alias("u"))
    return increments.due(r, "u", "2026-06-30", 200).select("serie", F.col("days").cast("long").alias("dias"))


# Python models and generated SQL


@BOOK.add("SELECT p_brand, CAST(count(*) AS BIGINT) AS n, round(max(p_retailprice) - min(p_retailprice), 2) AS rango FROM part GROUP BY 1")
def i10_python_model(spark: SparkSession, d: str) -> DataFrame:
    """A model that takes a table and gives a table: partial results by batch in Python, put together by the engine."""

    def model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            by = pdf.groupby("p_brand")["p_retailprice"]
            yield pd.DataFrame({"n": by.count(), "lo": by.min(), "hi": by.max()}).reset_index()

    parts = table(spark, d, "part").select("p_brand", "p_retailprice").mapInPandas(model, "p_brand string, n long, lo double, hi double")
    return parts.groupBy("p_brand").agg(F.sum("n").alias("n"), F.round(F.max("hi") - F.min("lo"), 2).alias("rango"))


_STATES = {"F": "cerrado", "O": "abierto", "P": "pendiente"}


@BOOK.add("SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{k}') AS {v}" for k, v in _STATES.items()) + " FROM orders GROUP BY 1")
def k4_generated_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns generated from a list, with a default for a parameter that is not set."""
    columns = ", ".join(f"count_if(o_orderstatus = '{k}') AS {v}" for k, v in _STATES.items())
    return spark.sql(f"SELECT o_orderpriority, {columns} FROM {{orders}} GROUP BY 1", orders=table(spark, d, "orders"))


# Sets, units, costs


@BOOK.add("""
    WITH u AS (SELECT marca AS k, lower(trim(item)) AS w FROM equipamiento_items WHERE item IS NOT NULL AND marca IS NOT NULL UNION SELECT upper(marca), lower(trim(tipo_precio)) FROM service_precios WHERE tipo_precio IS NOT NULL AND marca IS NOT NULL)
    SELECT k AS marca, count(DISTINCT w) AS palabras, string_agg(DISTINCT left(w, 1), '' ORDER BY left(w, 1)) AS iniciales FROM u GROUP BY 1""")
def c14_vocabularies(spark: SparkSession, d: str) -> DataFrame:
    """The union of two sources' values per key, each once."""
    one = table(spark, d, "equipamiento_items").where("item is not null and marca is not null").select(F.col("marca").alias("marca"), F.lower(F.trim("item")).alias("w"))
    two = table(spark, d, "service_precios").where("tipo_precio is not null and marca is not null").select(F.upper("marca").alias("marca"), F.lower(F.trim("tipo_precio")).alias("w"))
    u = one.unionByName(two).distinct()
    return u.groupBy("marca").agg(F.count(F.lit(1)).alias("palabras"), F.array_join(F.array_sort(F.collect_set(F.left("w", F.lit(1)))), "").alias("iniciales"))


@BOOK.add("""
    SELECT registro_id, unidad, CASE unidad WHEN 'miles' THEN precio_miles * 1000 WHEN 'millones' THEN precio_miles * 1000000 WHEN 'pesos' THEN precio_miles WHEN 'usd' THEN CAST(round(precio_miles * 1234.5) AS BIGINT) END AS pesos
    FROM (SELECT DISTINCT registro_id, precio_miles, CASE registro_id % 5 WHEN 0 THEN 'millones' WHEN 1 THEN 'pesos' WHEN 2 THEN 'usd' WHEN 3 THEN 'otra' ELSE 'miles' END AS unidad FROM cca_precios WHERE precio_miles < 900000)""")
def f20_scaled_units(spark: SparkSession, d: str) -> DataFrame:
    """Amounts brought to one unit; one of an unknown unit is null."""
    k = F.col("registro_id") % 5
    unit = F.when(k == 0, "millones").when(k == 1, "pesos").when(k == 2, "usd").when(k == 3, "otra").otherwise("miles")
    rows = table(spark, d, "cca_precios").where("precio_miles < 900000").select("registro_id", "precio_miles", unit.alias("unidad")).distinct()
    return rows.select("registro_id", "unidad", units.in_pesos(F.col("precio_miles"), F.col("unidad"), F.lit(1234.5)).alias("pesos"))


@BOOK.add("""
    WITH m AS (SELECT p_partkey, p_name, p_brand, p_size, CASE WHEN p_type <> 'PROMO' THEN p_retailprice * 12 END AS uso, p_size * 100.0 AS guarda FROM part WHERE lower(p_name || ' ' || p_brand) LIKE '%ri%' AND lower(p_name || ' ' || p_brand) LIKE '%brand%'),
    c AS (SELECT *, coalesce(uso, 0) + guarda AS total, uso IS NOT NULL AS completo FROM m)
    SELECT p_partkey, p_name, round(total * 100) / 100 AS total, completo, row_number() OVER (ORDER BY completo DESC, total, p_partkey) AS puesto FROM c QUALIFY puesto <= 40""")
def g15_search_cost_sort(spark: SparkSession, d: str) -> DataFrame:
    """Items found by words, costed, complete ones first, cheapest first."""
    m = table(spark, d, "part").where(has_all_words(F.concat_ws(" ", "p_name", "p_brand"), "ri brand"))
    use = F.when(F.col("p_type") != "PROMO", F.col("p_retailprice") * 12)
    c = m.select("p_partkey", "p_name", (F.coalesce(use, F.lit(0.0)) + F.col("p_size") * 100.0).alias("total"), use.isNotNull().alias("completo"))
    by = [F.desc("completo"), F.asc("total"), F.asc("p_partkey")]
    return c.orderBy(*by).limit(40).withColumn("puesto", F.row_number().over(W.orderBy(*by))).withColumn("total", scaled_round(F.col("total"), 2))


@BOOK.add("""
    WITH u AS (SELECT max(periodo) AS p FROM combustible_mensual), f AS (SELECT provincia_id, producto, min(precio_mediano) AS litro FROM combustible_mensual, u WHERE periodo = p GROUP BY 1, 2),
    v(version, producto, consumo) AS (VALUES ('a', 'Nafta súper', 7.5), ('b', 'Gasoil grado 2', 6.1), ('c', 'Electricidad', 1.0))
    SELECT version, provincia_id, round(litro * consumo * 100) / 100 AS cada_cien_km FROM v LEFT JOIN f USING (producto)""")
def g16_fuel_cost_by_place(spark: SparkSession, d: str) -> DataFrame:
    """Fuel per hundred kilometres of each version in each province; null where the fuel has no price."""
    m = table(spark, d, "combustible_mensual")
    last = m.select(F.max("periodo")).scalar()
    f = m.where(F.col("periodo") == last).groupBy("provincia_id", "producto").agg(F.min("precio_mediano").alias("litro"))
    v = spark.createDataFrame([("a", "Nafta súper", 7.5), ("b", "Gasoil grado 2", 6.1), ("c", "Electricidad", 1.0)], "version string, producto string, consumo double")
    return v.join(f, "producto", "left").select("version", "provincia_id", scaled_round(F.col("litro") * F.col("consumo"), 2).alias("cada_cien_km"))


@BOOK.add("""
    WITH s AS (SELECT l_partkey, count(*) AS ventas FROM lineitem GROUP BY 1), c AS (SELECT p_brand, p_partkey, ventas, p_type <> 'PROMO' AND p_size > 10 AS completa FROM part JOIN s ON l_partkey = p_partkey)
    SELECT p_brand, p_partkey, ventas, CASE WHEN completa THEN NULL ELSE 'sin datos completos' END AS nota FROM c QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY completa DESC, ventas DESC, p_partkey) = 1""")
def g17_best_complete_else_best(spark: SparkSession, d: str) -> DataFrame:
    """Of each family the best seller with complete data, else the best seller with a note."""
    s = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("ventas"))
    c = table(spark, d, "part").join(s, "p_partkey").select("p_brand", "p_partkey", "ventas", ((F.col("p_type") != "PROMO") & (F.col("p_size") > 10)).alias("completa"))
    best = windows.top_per_group(c, ["p_brand"], [F.desc("completa"), F.desc("ventas"), F.asc("p_partkey")])
    return best.select("p_brand", "p_partkey", "ventas", F.when(~F.col("completa"), "sin datos completos").alias("nota"))


@BOOK.add("""
    WITH y AS (SELECT upper(trim(mtm)) AS clave, anio, max(valor_fiscal) AS v FROM valuacion_fotos WHERE vigencia = (SELECT max(vigencia) FROM valuacion_fotos) AND anio > 0 AND valor_fiscal > 0 GROUP BY 1, 2)
    SELECT clave, count(*) AS anios, min(anio) AS desde, max(anio) AS hasta, CAST((2026 - min(anio)) * 15000 AS INTEGER) AS odometro, string_agg(CAST(anio AS VARCHAR), ',' ORDER BY anio DESC) AS lista,
           round((arg_max(v, anio) - arg_min(v, anio)) / (12e0 * nullif(max(anio) - min(anio), 0)) * 100) / 100 AS caida_mensual FROM y GROUP BY 1""")
def g18_years_and_monthly_loss(spark: SparkSession, d: str) -> DataFrame:
    """The years a version is valued for, a guess of its odometer, and what it loses a month between them."""
    all_ = table(spark, d, "valuacion_fotos")
    newest = all_.select(F.max("vigencia")).scalar()
    y = all_.where((F.col("vigencia") == newest) & (F.col("anio") > 0) & (F.col("valor_fiscal") > 0)).groupBy(F.upper(F.trim("mtm")).alias("clave"), "anio").agg(F.max("valor_fiscal").alias("v"))
    g = y.groupBy("clave").agg(
        F.count(F.lit(1)).alias("anios"), F.min("anio").alias("desde"), F.max("anio").alias("hasta"), F.array_join(F.reverse(F.array_sort(F.collect_list("anio"))), ",").alias("lista"),
        (F.max_by("v", "anio") - F.min_by("v", "anio")).alias("_d"),
    )
    months = F.nullif(F.col("hasta") - F.col("desde"), F.lit(0)) * 12.0
    return g.select("clave", "anios", "desde", "hasta", ((2026 - F.col("desde")) * 15000).alias("odometro"), "lista", scaled_round(F.col("_d") / months, 2).alias("caida_mensual"))


@BOOK.add("""
    WITH s AS (SELECT nro_inscripcion AS nro, max(struct_pack(t := coalesce(ultima_informacion, TIMESTAMP '0001-01-01'), a := coalesce(latitud, -1000), o := coalesce(longitud, -1000))) AS r FROM estaciones WHERE nro_inscripcion IS NOT NULL GROUP BY 1),
    l AS (SELECT nro, r.a AS lat, r.o AS lon, CAST(floor(r.a / 0.01) AS BIGINT) AS c FROM s WHERE r.a BETWEEN -56 AND -21 AND r.o BETWEEN -74 AND -53),
    n AS (SELECT a.nro, count(*) AS k FROM l a JOIN (SELECT *, unnest([c - 1, c, c + 1]) AS q FROM l) b ON a.c = b.q AND a.nro <> b.nro
          WHERE 2 * 6371000 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 150 GROUP BY 1)
    SELECT nro, coalesce(k, 0) AS vecinas FROM l LEFT JOIN n USING (nro)""")
def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """One row per station with the number of stations close to it: the form without pairs."""
    stations = geo.current_stations(table(spark, d, "estaciones"))
    near = geo.near_points(stations, 150.0, "nro_inscripcion", "latitud", "longitud")
    ends = near.select(F.explode(F.array("id_a", "id_b")).alias("nro_inscripcion")).groupBy("nro_inscripcion").agg(F.count(F.lit(1)).alias("k"))
    return stations.join(ends, "nro_inscripcion", "left").select(F.col("nro_inscripcion").alias("nro"), F.coalesce("k", F.lit(0).cast("long")).alias("vecinas"))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
