"""Staging and monthly tables over the car-ownership sources themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.functions.numeric import exact_sum, percent, safe_ratio, scaled_round, weighted_mean
from rodaje.functions.similarity import jaro_winkler
from rodaje.operators import windows
from rodaje.operators.geo import current_stations
from rodaje.operators.units import rate_of_day
from rodaje.plans.book import Book
from rodaje.sources import table

BOOK = Book()

FUEL_KEY = ["nro_inscripcion", "producto", "canal_de_comercializacion", "exentos", "periodo"]


def fuel_declarations(spark: SparkSession, d: str) -> DataFrame:
    """Fuel declarations without placeholder rows, each delivered row once, with flags for dubious repeats and complete months."""
    rows = table(spark, d, "combustible_precios").where("not (coalesce(no_movimientos, 'NO') = 'SI')").dropDuplicates(["declaracion_id"])
    last = rows.select(F.max("periodo")).scalar()
    twice = F.count(F.lit(1)).over(W.partitionBy(*FUEL_KEY)) > 1
    return rows.withColumns({"mes": F.to_date("periodo", "yyyyMM"), "cerrada": F.col("fecha_de_baja").isNotNull(), "completo": F.col("periodo") != last, "repetida": twice})


_FUEL = """
    d AS (SELECT DISTINCT ON (declaracion_id) * FROM combustible_precios WHERE NOT (coalesce(no_movimientos, 'NO') = 'SI')),
    f AS (SELECT *, fecha_de_baja IS NOT NULL AS cerrada, periodo <> (SELECT max(periodo) FROM d) AS completo,
                 count(*) OVER (PARTITION BY nro_inscripcion, producto, canal_de_comercializacion, exentos, periodo) > 1 AS repetida FROM d)"""


@BOOK.add(f"""
    WITH {_FUEL} SELECT periodo, count(*) AS filas, count(*) FILTER (WHERE repetida) AS repetidas, count(*) FILTER (WHERE cerrada) AS cerradas, bool_and(completo) AS completo FROM f GROUP BY 1""")
def m1_fuel_staging(spark: SparkSession, d: str) -> DataFrame:
    return fuel_declarations(spark, d).groupBy("periodo").agg(
        F.count(F.lit(1)).alias("filas"), F.count_if("repetida").alias("repetidas"), F.count_if("cerrada").alias("cerradas"), F.bool_and("completo").alias("completo")
    )


@BOOK.add(f"""
    WITH {_FUEL}, b AS (SELECT * FROM f WHERE canal_de_comercializacion = 'Al público' AND NOT exentos AND NOT repetida AND precio_surtidor > 0),
    t AS (SELECT *, median(precio_surtidor) OVER (PARTITION BY periodo, provincia_id, producto) AS med FROM b)
    SELECT periodo, provincia_id, producto, bandera, count(*) AS n, count(DISTINCT nro_inscripcion) AS bocas, median(precio_surtidor) AS mediana,
           CAST(sum(CAST(precio_surtidor * volumen AS DECIMAL(28, 6))) AS DOUBLE) / nullif(CAST(sum(CASE WHEN precio_surtidor IS NOT NULL THEN CAST(volumen AS DECIMAL(28, 6)) END) AS DOUBLE), 0) AS ponderado, bool_and(completo) AS completo
    FROM t WHERE precio_surtidor BETWEEN med * 0.5 AND med * 2 GROUP BY 1, 2, 3, 4""")
def m2_fuel_monthly(spark: SparkSession, d: str) -> DataFrame:
    base = fuel_declarations(spark, d).where("canal_de_comercializacion = 'Al público' and not exentos and not repetida and precio_surtidor > 0")
    kept = windows.trimmed_by_median(base, ["periodo", "provincia_id", "producto"], "precio_surtidor")
    group = ["periodo", "provincia_id", "producto", "bandera"]
    medians = windows.exact_percentiles(kept, group, "precio_surtidor", {"mediana": 0.5}).drop("n")
    return kept.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("nro_inscripcion").alias("bocas"),
        weighted_mean(F.col("precio_surtidor"), F.col("volumen"), 6).alias("ponderado"), F.bool_and("completo").alias("completo"),
    ).join(medians, group)


@BOOK.add(f"""
    WITH {_FUEL}, u AS (SELECT * FROM f WHERE precio_surtidor > 0 AND periodo = (SELECT max(periodo) FROM f WHERE completo)),
    l AS (SELECT nro_inscripcion, max(struct_pack(t := coalesce(ultima_informacion, TIMESTAMP '0001-01-01'), a := coalesce(latitud, -1000), o := coalesce(longitud, -1000))) AS s FROM estaciones WHERE nro_inscripcion IS NOT NULL GROUP BY 1),
    e AS (SELECT nro_inscripcion, s.a AS latitud, s.o AS longitud FROM l WHERE s.a BETWEEN -56 AND -21 AND s.o BETWEEN -74 AND -53),
    m AS (SELECT provincia_id, producto, median(precio_surtidor) AS med FROM u GROUP BY 1, 2)
    SELECT u.declaracion_id, u.nro_inscripcion, u.producto, latitud, longitud, round((precio_surtidor / nullif(med, 0) - 1) * 100 * 100) / 100 + 0e0 AS desvio
    FROM u JOIN e USING (nro_inscripcion) JOIN m USING (provincia_id, producto)""")
def m3_fuel_stations(spark: SparkSession, d: str) -> DataFrame:
    f = fuel_declarations(spark, d).where("precio_surtidor > 0")
    last = fuel_declarations(spark, d).where("completo").select(F.max("periodo")).scalar()
    u = f.where(F.col("periodo") == last)
    e = current_stations(table(spark, d, "estaciones"))
    m = windows.exact_percentiles(u, ["provincia_id", "producto"], "precio_surtidor", {"med": 0.5}).drop("n")
    off = scaled_round((safe_ratio(F.col("precio_surtidor"), F.col("med")) - 1) * 100, 2) + F.lit(0.0)
    return u.join(e, "nro_inscripcion").join(m, ["provincia_id", "producto"]).select("declaracion_id", "nro_inscripcion", "producto", "latitud", "longitud", off.alias("desvio"))


@BOOK.add("""
    WITH r AS (SELECT registro_id, min(precio) AS precio, min(capturado) AS capturado, min(upper(trim(marca))) AS marca, min(trim(modelo_fuente)) AS modelo, min(km) AS km, min(moneda) AS moneda FROM service_precios GROUP BY 1)
    SELECT registro_id, marca, modelo, km, round(CAST(precio AS DOUBLE) * valor) AS pesos, capturado = max(capturado) OVER (PARTITION BY marca) AS vigente
    FROM r ASOF LEFT JOIN cambio_usd ON r.capturado >= cambio_usd.fecha WHERE moneda IN ('USD', 'usd', 'US$', 'U$S', 'dólar')""")
def m4_service_in_pesos(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "service_precios").groupBy("registro_id").agg(
        F.min("precio").alias("precio"), F.min("capturado").alias("capturado"), F.min(F.upper(F.trim("marca"))).alias("marca"), F.min(F.trim("modelo_fuente")).alias("modelo"),
        F.min("km").alias("km"), F.min("moneda").alias("moneda"),
    ).where(F.col("moneda").isin("USD", "usd", "US$", "U$S", "dólar"))
    newest = F.max("capturado").over(W.partitionBy("marca"))
    priced = rate_of_day(rows, table(spark, d, "cambio_usd"), "capturado")
    return priced.select("registro_id", "marca", "modelo", "km", F.round(F.col("precio").cast("double") * F.col("rate"), 0).alias("pesos"), (F.col("capturado") == newest).alias("vigente"))


@BOOK.add("""
    WITH u AS (SELECT * FROM valuacion_fotos WHERE vigencia = (SELECT max(vigencia) FROM valuacion_fotos)),
    c AS (SELECT DISTINCT upper(trim(mtm)) AS clave, anio, fab, marca, modelo, upper(trim(descripcion)) AS descripcion, valor_fiscal FROM u WHERE valor_fiscal IS NOT NULL),
    g AS (SELECT marca, modelo, anio, count(DISTINCT valor_fiscal) AS valores FROM c GROUP BY 1, 2, 3),
    s AS (SELECT c.*, valores, round(jaro_winkler_similarity(descripcion, marca || ' ' || modelo) * 1e6) / 1e6 AS parecido FROM c JOIN g USING (marca, modelo, anio))
    SELECT marca, modelo, anio, clave, valor_fiscal, CASE WHEN valores = 1 THEN 'codigo' ELSE 'texto' END AS metodo FROM s
    QUALIFY row_number() OVER (PARTITION BY marca, modelo, anio ORDER BY parecido DESC, clave, valor_fiscal, descripcion) = 1""")
def m5_valuation_by_version(spark: SparkSession, d: str) -> DataFrame:
    all_ = table(spark, d, "valuacion_fotos")
    newest = all_.select(F.max("vigencia")).scalar()
    c = all_.where((F.col("vigencia") == newest) & F.col("valor_fiscal").isNotNull()).select(
        F.upper(F.trim("mtm")).alias("clave"), "anio", "fab", "marca", "modelo", F.upper(F.trim("descripcion")).alias("descripcion"), "valor_fiscal"
    ).distinct()
    g = c.groupBy("marca", "modelo", "anio").agg(F.count_distinct("valor_fiscal").alias("valores"))
    # Texts are scored where values differ or several codes stand for one; each pair of texts once.
    texts = c.select("marca", "modelo", "descripcion").distinct()
    texts = texts.withColumn("parecido", scaled_round(jaro_winkler("descripcion", F.concat_ws(" ", "marca", "modelo")), 6))
    s = c.join(g, ["marca", "modelo", "anio"]).join(texts, ["marca", "modelo", "descripcion"], "left")
    best = windows.top_per_group(s, ["marca", "modelo", "anio"], [F.desc_nulls_last("parecido"), F.asc("clave"), F.asc("valor_fiscal"), F.asc_nulls_last("descripcion")])
    return best.select("marca", "modelo", "anio", "clave", "valor_fiscal", F.when(F.col("valores") == 1, "codigo").otherwise("texto").alias("metodo"))


@BOOK.add("""
    WITH u AS (SELECT * FROM valuacion_fotos WHERE vigencia = (SELECT max(vigencia) FROM valuacion_fotos) AND valor_fiscal > 0),
    e AS (SELECT marca, upper(trim(mtm)) AS clave, CAST(CASE WHEN anio = 0 THEN 0 ELSE year(vigencia) - anio END AS BIGINT) AS edad, max(valor_fiscal) AS v FROM u GROUP BY ALL),
    j AS (SELECT b.marca, b.edad, median(CAST(b.v AS DOUBLE) / a.v) AS salto, count(*) AS n FROM e b JOIN e a ON a.marca = b.marca AND a.clave = b.clave AND a.edad = b.edad - 1 WHERE b.edad BETWEEN 1 AND 14 GROUP BY 1, 2)
    SELECT marca, edad, round(exp(sum(ln(salto)) OVER w) * 1e3) / 1e3 AS indice, count(*) OVER w = edad - min(edad) OVER (PARTITION BY marca) + 1 AS completo, min(n) OVER w AS respaldo
    FROM j WHERE salto > 0 WINDOW w AS (PARTITION BY marca ORDER BY edad ROWS UNBOUNDED PRECEDING)""")
def m6_value_by_age(spark: SparkSession, d: str) -> DataFrame:
    all_ = table(spark, d, "valuacion_fotos")
    newest = all_.select(F.max("vigencia")).scalar()
    age = F.when(F.col("anio") == 0, 0).otherwise(F.year("vigencia") - F.col("anio")).cast("long")
    e = all_.where((F.col("vigencia") == newest) & (F.col("valor_fiscal") > 0)).groupBy("marca", F.upper(F.trim("mtm")).alias("clave"), age.alias("edad")).agg(F.max("valor_fiscal").alias("v"))
    younger = e.select("marca", "clave", (F.col("edad") + 1).alias("edad"), F.col("v").alias("v0"))
    ratios = e.join(younger, ["marca", "clave", "edad"]).where("edad between 1 and 14").select("marca", "edad", (F.col("v").cast("double") / F.col("v0")).alias("razon"))
    j = windows.exact_percentiles(ratios, ["marca", "edad"], "razon", {"salto": 0.5})
    out = windows.chained_index(j, ["marca"], "edad", "salto", "n")
    return out.select("marca", "edad", scaled_round(F.col("indice"), 3).alias("indice"), "completo", "respaldo")


@BOOK.add("""
    WITH t AS (SELECT DISTINCT tramite_id, tramite_tipo, tramite_fecha, automotor_marca_codigo AS m, automotor_modelo_codigo AS k, automotor_marca_descripcion AS marca, automotor_modelo_descripcion AS modelo,
                      automotor_tipo_descripcion AS tipo FROM tramites_dnrpa WHERE publicado = (SELECT max(publicado) FROM tramites_dnrpa)),
    n AS (SELECT m, k, marca || ' ' || modelo AS nombre, count(*) AS c FROM t WHERE marca IS NOT NULL AND modelo IS NOT NULL GROUP BY 1, 2, 3),
    u AS (SELECT max(tramite_fecha) AS f FROM t)
    SELECT m AS marca_codigo, k AS modelo_codigo, (SELECT first(nombre ORDER BY c DESC, nombre) FROM n WHERE n.m = t.m AND n.k = t.k) AS nombre, count(*) AS tramites,
           count(*) FILTER (WHERE tramite_fecha > (SELECT f - INTERVAL 12 MONTH FROM u)) AS recientes, bool_or(regexp_matches(tipo, '^(SEDAN|PICK-UP|FURGON)')) AS liviano
    FROM t WHERE m IS NOT NULL AND k IS NOT NULL GROUP BY m, k""")
def m7_versions(spark: SparkSession, d: str) -> DataFrame:
    all_ = table(spark, d, "tramites_dnrpa")
    newest = all_.select(F.max("publicado")).scalar()
    t = all_.where(F.col("publicado") == newest).select(
        "tramite_id", "tramite_tipo", "tramite_fecha", F.col("automotor_marca_codigo").alias("marca_codigo"), F.col("automotor_modelo_codigo").alias("modelo_codigo"),
        F.concat("automotor_marca_descripcion", F.lit(" "), "automotor_modelo_descripcion").alias("nombre"), F.col("automotor_tipo_descripcion").alias("tipo"),
    ).distinct()
    since = F.add_months(t.select(F.max("tramite_fecha")).scalar(), -12)
    keys = ["marca_codigo", "modelo_codigo"]
    names = windows.ordered_mode(t, keys, "nombre", "nombre").drop("nombre_n")
    counts = t.where("marca_codigo is not null and modelo_codigo is not null").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tramites"), F.count_if(F.col("tramite_fecha") > since).alias("recientes"), F.bool_or(F.col("tipo").rlike("^(SEDAN|PICK-UP|FURGON)")).alias("liviano")
    )
    return counts.join(names, keys, "left").select(*keys, "nombre", "tramites", "recientes", "liviano")


@BOOK.add("""
    WITH t AS (SELECT DISTINCT ON (tramite_id) * FROM tramites_dnrpa WHERE publicado = (SELECT max(publicado) FROM tramites_dnrpa) ORDER BY tramite_id, tramite_fecha, automotor_anio_modelo)
    SELECT strftime(tramite_fecha, '%Y-%m') AS mes, lower(tramite_tipo) AS tramite, coalesce(nullif(automotor_modelo_codigo, '0000'), 'sin_codigo') AS modelo, count(*) AS n,
           round(CAST(sum(year(tramite_fecha) - automotor_anio_modelo) FILTER (WHERE automotor_anio_modelo BETWEEN 1950 AND year(tramite_fecha) + 1) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE automotor_anio_modelo BETWEEN 1950 AND year(tramite_fecha) + 1), 0) * 100) / 100 AS edad FROM t GROUP BY 1, 2, 3""")
def m8_market_monthly(spark: SparkSession, d: str) -> DataFrame:
    all_ = table(spark, d, "tramites_dnrpa")
    newest = all_.select(F.max("publicado")).scalar()
    rows = all_.where(F.col("publicado") == newest)
    t = windows.top_per_group(rows, ["tramite_id"], [F.asc_nulls_last("tramite_fecha"), F.asc_nulls_last("automotor_anio_modelo")])
    year = F.year("tramite_fecha")
    sane = F.when(F.col("automotor_anio_modelo").between(1950, year + 1), year - F.col("automotor_anio_modelo"))
    return t.groupBy(
        F.date_format("tramite_fecha", "yyyy-MM").alias("mes"), F.lower("tramite_tipo").alias("tramite"), F.coalesce(F.nullif("automotor_modelo_codigo", F.lit("0000")), F.lit("sin_codigo")).alias("modelo")
    ).agg(F.count(F.lit(1)).alias("n"), scaled_round(safe_ratio(F.sum(sane), F.count(sane)), 2).alias("edad"))


@BOOK.add("""
    WITH r AS (SELECT registro_seccional_codigo AS codigo, trim(registro_seccional_descripcion) AS nombre, count(*) AS n FROM tramites_dnrpa WHERE registro_seccional_codigo IS NOT NULL GROUP BY 1, 2)
    SELECT codigo, first(nombre ORDER BY n DESC, nombre) AS nombre, CAST(sum(n) AS BIGINT) AS filas FROM r GROUP BY 1""")
def m9_offices(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tramites_dnrpa").where("registro_seccional_codigo is not null").select(F.col("registro_seccional_codigo").alias("codigo"), F.trim("registro_seccional_descripcion").alias("nombre"))
    names = windows.ordered_mode(rows, ["codigo"], "nombre", "nombre").drop("nombre_n")
    return rows.groupBy("codigo").agg(F.count(F.lit(1)).alias("filas")).join(names, "codigo", "left").select("codigo", "nombre", "filas")


@BOOK.add("""
    WITH t AS (SELECT DISTINCT tramite_id, registro_seccional_provincia, automotor_modelo_codigo, automotor_anio_modelo FROM tramites_dnrpa),
    u AS (SELECT 'provincia' AS fuente, nullif(registro_seccional_provincia, 'NULL') IS NOT NULL AS ok FROM t UNION ALL SELECT 'modelo', automotor_modelo_codigo <> '0000' FROM t UNION ALL SELECT 'anio', automotor_anio_modelo IS NOT NULL FROM t)
    SELECT fuente, round(100e0 * count(*) FILTER (WHERE ok) / count(*) * 10) / 10 AS pct FROM u GROUP BY 1""")
def m10_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tramites_dnrpa").select("tramite_id", "registro_seccional_provincia", "automotor_modelo_codigo", "automotor_anio_modelo").distinct()
    flags = t.select(
        F.nullif("registro_seccional_provincia", F.lit("NULL")).isNotNull().alias("provincia"), (F.col("automotor_modelo_codigo") != "0000").alias("modelo"),
        F.col("automotor_anio_modelo").isNotNull().alias("anio"),
    )
    u = flags.unpivot([], ["provincia", "modelo", "anio"], "fuente", "ok")
    return u.groupBy("fuente").agg(percent(F.count_if("ok"), F.count(F.lit(1))).alias("pct"))


@BOOK.add("""
    SELECT producto, bandera, CAST(sum(CAST(volumen AS DECIMAL(28, 4))) FILTER (WHERE volumen > 0) AS DOUBLE) AS volumen, count(DISTINCT periodo) AS meses FROM combustible_precios GROUP BY 1, 2""")
def m11_fuel_by_brand(spark: SparkSession, d: str) -> DataFrame:
    positive = F.when(F.col("volumen") > 0, F.col("volumen"))
    return table(spark, d, "combustible_precios").groupBy("producto", "bandera").agg(exact_sum(positive, 4).alias("volumen"), F.count_distinct("periodo").alias("meses"))


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
