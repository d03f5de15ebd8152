"""Staged, linked and published tables of the car sources, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.functions import text as X
from rodaje.functions.numeric import percent, piecewise, safe_ratio, scaled_round
from rodaje.operators import geo, joins, matching, windows
from rodaje.operators.units import rate_of_day
from rodaje.plans.book import Book
from rodaje.plans.matches import _KEY, _WORDS
from rodaje.plans.scalars import _P, _V, with_province_id
from rodaje.sources import table

BOOK = Book()

_DOLLARS = ["USD", "usd", "US$", "U$S", "dólar"]
_PLACE_KEY = lambda c: f"trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g'), ' ')"
_PROVINCES = f"p(id, nombre) AS (VALUES {_P}), v(variante, id) AS (VALUES {_V}), k(clave, id) AS (SELECT {_PLACE_KEY('nombre')}, id FROM p)"


# Staged


@BOOK.add("""
    SELECT fecha, max(valor) AS valor, lead(fecha) OVER (ORDER BY fecha) AS hasta, round((max(valor) / lag(max(valor)) OVER (ORDER BY fecha) - 1) * 1e6) / 1e6 AS cambio
    FROM cambio_usd WHERE valor IS NOT NULL GROUP BY fecha""")
def stg_cambio(spark: SparkSession, d: str) -> DataFrame:
    """One rate per date and how long it holds; the series has one row per calendar day."""
    s = table(spark, d, "cambio_usd").where("valor is not null").groupBy("fecha").agg(F.max("valor").alias("valor"))
    w = W.orderBy("fecha")
    return s.select("fecha", "valor", F.lead("fecha").over(w).alias("hasta"), scaled_round(F.col("valor") / F.lag("valor").over(w) - 1, 6).alias("cambio"))


@BOOK.add(r"""
    SELECT registro_id, min(periodo) AS periodo, min(upper(trim(marca))) AS marca, min(upper(trim(modelo))) AS modelo, min(upper(trim(regexp_replace(version, '([(\[].*|\s-\s.*)$', '')))) AS version,
           min(nullif(anio, 0)) AS anio, bool_or(anio = 0) AS nuevo, min(precio_miles) AS precio_miles, min(unidad_original) AS unidad, min(periodo) = (SELECT max(periodo) FROM cca_precios) AS vigente
    FROM cca_precios GROUP BY 1""")
def stg_guia(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cca_precios")
    newest = rows.select(F.max("periodo")).scalar()
    clean = lambda c: F.upper(F.trim(c))
    return rows.groupBy("registro_id").agg(
        F.min("periodo").alias("periodo"), F.min(clean("marca")).alias("marca"), F.min(clean("modelo")).alias("modelo"),
        F.min(clean(F.regexp_replace("version", r"([(\[].*|\s-\s.*)$", ""))).alias("version"), F.min(F.nullif("anio", F.lit(0))).alias("anio"),
        F.bool_or(F.col("anio") == 0).alias("nuevo"), F.min("precio_miles").alias("precio_miles"), F.min("unidad_original").alias("unidad"),
    ).withColumn("vigente", F.col("periodo") == newest)


@BOOK.add(f"""
    WITH {_PROVINCES}, l AS (SELECT nro_inscripcion, max(struct_pack(t := coalesce(ultima_informacion, TIMESTAMP '0001-01-01'), a := coalesce(latitud, -1000), o := coalesce(longitud, -1000))) AS s FROM estaciones WHERE nro_inscripcion IS NOT NULL GROUP BY 1),
    e AS (SELECT nro_inscripcion, s.a AS latitud, s.o AS longitud FROM l WHERE s.a BETWEEN -56 AND -21 AND s.o BETWEEN -74 AND -53),
    n AS (SELECT nro_inscripcion, min({_PLACE_KEY("nullif(provincia, 'NULL')")}) AS clave, min(upper(trim(bandera))) AS bandera FROM estaciones GROUP BY 1)
    SELECT e.nro_inscripcion, latitud, longitud, coalesce(v.id, k.id) AS provincia_id, bandera FROM e JOIN n USING (nro_inscripcion) LEFT JOIN v ON variante = n.clave LEFT JOIN k ON k.clave = n.clave""")
def stg_estaciones(spark: SparkSession, d: str) -> DataFrame:
    """The place each station last reported, its province by name or variant, and its brand."""
    all_ = table(spark, d, "estaciones")
    named = all_.groupBy("nro_inscripcion").agg(F.min(X.text_key(F.nullif("provincia", F.lit("NULL")))).alias("provincia"), F.min(F.upper(F.trim("bandera"))).alias("bandera"))
    rows = geo.current_stations(all_).join(named, "nro_inscripcion")
    return with_province_id(rows, "provincia").select("nro_inscripcion", "latitud", "longitud", "provincia_id", "bandera")


@BOOK.add(f"""
    WITH {_PROVINCES}, r AS (SELECT registro_seccional_codigo AS codigo, trim(registro_seccional_descripcion) AS nombre, nullif(registro_seccional_provincia, 'NULL') AS provincia, count(*) AS n FROM tramites_dnrpa WHERE registro_seccional_codigo IS NOT NULL GROUP BY 1, 2, 3),
    m AS (SELECT codigo, first(nombre ORDER BY a DESC, nombre) AS nombre FROM (SELECT codigo, nombre, sum(n) AS a FROM r WHERE nombre IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
    q AS (SELECT codigo, {_PLACE_KEY('provincia')} AS clave, n FROM r WHERE provincia IS NOT NULL),
    i AS (SELECT codigo, coalesce(v.id, k.id) AS id, sum(n) AS a FROM q LEFT JOIN v ON variante = q.clave LEFT JOIN k ON k.clave = q.clave WHERE coalesce(v.id, k.id) IS NOT NULL GROUP BY 1, 2)
    SELECT codigo, m.nombre, (SELECT first(id ORDER BY a DESC, id) FROM i WHERE i.codigo = c.codigo) AS provincia_id FROM (SELECT DISTINCT codigo FROM r) c LEFT JOIN m USING (codigo)""")
def stg_registros(spark: SparkSession, d: str) -> DataFrame:
    """Offices with the name and the province they are most often given."""
    rows = table(spark, d, "tramites_dnrpa").where("registro_seccional_codigo is not null").select(
        F.col("registro_seccional_codigo").alias("codigo"), F.trim("registro_seccional_descripcion").alias("nombre"), "registro_seccional_provincia"
    )
    names = windows.ordered_mode(rows, ["codigo"], "nombre", "nombre").drop("nombre_n")
    counted = rows.groupBy("codigo", "registro_seccional_provincia").agg(F.count(F.lit(1)).alias("n"))
    places = with_province_id(counted, "registro_seccional_provincia").where("provincia_id is not null").groupBy("codigo", "provincia_id").agg(F.sum("n").alias("n"))
    best = places.groupBy("codigo").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("provincia_id").alias("id"))).alias("b")).select("codigo", F.col("b.id").alias("provincia_id"))
    return rows.select("codigo").distinct().join(names, "codigo", "left").join(best, "codigo", "left").select("codigo", "nombre", "provincia_id")


_FEEDS = [("INSCRIPCION INICIAL", "inscripcion"), ("TRANSFERENCIA", "transferencia"), ("PRENDA", "prenda"), ("ROBO O HURTO", "robo")]


@BOOK.add(f"""
    WITH u AS ({' UNION ALL BY NAME '.join(f"SELECT '{tag}' AS tramite, tramite_id, tramite_fecha, automotor_origen, automotor_anio_modelo{'' if tag != 'inscripcion' else ', fecha_inscripcion_inicial'} FROM tramites_dnrpa WHERE tramite_tipo = '{kind}'" for kind, tag in _FEEDS)})
    SELECT tramite, tramite_id, min(tramite_fecha) AS fecha, min(fecha_inscripcion_inicial) AS inicial, min(CASE automotor_origen WHEN 'Nacional' THEN 'N' WHEN 'Importado' THEN 'I' WHEN 'Protocolo 21' THEN 'P' END) AS origen,
           min(CASE WHEN automotor_anio_modelo BETWEEN 1900 AND 2027 THEN automotor_anio_modelo END) AS anio, count(*) AS entregas FROM u GROUP BY 1, 2""")
def stg_tramites(spark: SparkSession, d: str) -> DataFrame:
    """Four feeds under one schema, tagged; one of them has a column that the others lack."""
    all_ = table(spark, d, "tramites_dnrpa")
    shared = ["tramite_id", "tramite_fecha", "automotor_origen", "automotor_anio_modelo"]
    out = None
    for kind, tag in _FEEDS:
        feed = all_.where(F.col("tramite_tipo") == kind).select(F.lit(tag).alias("tramite"), *shared, *(["fecha_inscripcion_inicial"] if tag == "inscripcion" else []))
        out = feed if out is None else out.unionByName(feed, allowMissingColumns=True)
    origin = F.when(F.col("automotor_origen") == "Nacional", "N").when(F.col("automotor_origen") == "Importado", "I").when(F.col("automotor_origen") == "Protocolo 21", "P")
    year = F.when(F.col("automotor_anio_modelo").between(1900, 2027), F.col("automotor_anio_modelo"))
    return out.groupBy("tramite", "tramite_id").agg(
        F.min("tramite_fecha").alias("fecha"), F.min("fecha_inscripcion_inicial").alias("inicial"), F.min(origin).alias("origen"), F.min(year).alias("anio"), F.count(F.lit(1)).alias("entregas")
    )


@BOOK.add(r"""
    WITH i AS (SELECT DISTINCT * FROM equipamiento_items), m AS (SELECT marca, familia, max(capturado) AS c FROM i GROUP BY 1, 2)
    SELECT item_id, min(marca) AS marca, min(familia) AS familia, min(trim(item)) AS item, min(trim(regexp_replace(version_fuente, '\bMY\d+\b', '', 'g'))) AS version, min(try_cast(nullif(regexp_extract(version_fuente, '\bMY(\d+)\b', 1), '') AS INTEGER)) AS modelo_anio,
           min(lower(valor)) AS valor, bool_or(capturado = c) AS vigente FROM i JOIN m USING (marca, familia) GROUP BY 1""")
def stg_equipamiento(spark: SparkSession, d: str) -> DataFrame:
    """Equipment items once each, the model year taken out of the version, and whether they are of the family's last capture."""
    i = table(spark, d, "equipamiento_items").distinct()
    m = i.groupBy("marca", "familia").agg(F.max("capturado").alias("c"))
    year = X.extract(F.col("version_fuente"), r"\bMY(\d+)\b").try_cast("int")
    return i.join(m, ["marca", "familia"]).groupBy("item_id").agg(
        F.min("marca").alias("marca"), F.min("familia").alias("familia"), F.min(F.trim("item")).alias("item"), F.min(F.trim(F.regexp_replace("version_fuente", r"\bMY\d+\b", ""))).alias("version"),
        F.min(year).alias("modelo_anio"), F.min(F.lower("valor")).alias("valor"), F.bool_or(F.col("capturado") == F.col("c")).alias("vigente"),
    )


_SERVICE = f"""
    r AS (SELECT registro_id, min(precio) AS precio, min(capturado) AS capturado, min(upper(trim(marca))) AS marca, min(upper(trim(modelo_fuente))) AS modelo, min(km) AS km, min(moneda) AS moneda,
                 bool_or(coalesce(incluye_iva, true)) AS iva, min(items_cambio) AS items, min(tipo_precio) AS tipo FROM service_precios GROUP BY 1),
    s AS (SELECT r.*, coalesce(moneda IN ({', '.join(f"'{m}'" for m in _DOLLARS)}), false) AS dolares, valor FROM r ASOF LEFT JOIN cambio_usd ON r.capturado >= cambio_usd.fecha),
    t AS (SELECT *, round(CAST(precio AS DOUBLE) * CASE WHEN dolares THEN valor ELSE 1 END * CASE WHEN iva THEN 1 ELSE 1.21 END) AS pesos FROM s)"""


def _service(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "service_precios").groupBy("registro_id").agg(
        F.min("precio").alias("precio"), F.min("capturado").alias("capturado"), F.min(F.upper(F.trim("marca"))).alias("marca"), F.min(F.upper(F.trim("modelo_fuente"))).alias("modelo"),
        F.min("km").alias("km"), F.min("moneda").alias("moneda"), F.bool_or(F.coalesce("incluye_iva", F.lit(True))).alias("iva"), F.min("items_cambio").alias("items"), F.min("tipo_precio").alias("tipo"),
    )
    dollars = F.coalesce(F.col("moneda").isin(_DOLLARS), F.lit(False))
    priced = rate_of_day(rows, table(spark, d, "cambio_usd"), "capturado").withColumn("dolares", dollars)
    amount = F.col("precio").cast("double") * F.when(F.col("dolares"), F.col("rate")).otherwise(1.0) * F.when(F.col("iva"), 1.0).otherwise(1.21)
    return priced.withColumn("pesos", F.round(amount, 0))


@BOOK.add(f"""
    WITH {_SERVICE}
    SELECT registro_id, marca, modelo, km, pesos, dolares, len(string_split(items, '|')) AS trabajos, list_contains(string_split(items, '|'), 'aceite') AS con_aceite, tipo FROM t""")
def stg_service(spark: SparkSession, d: str) -> DataFrame:
    """Service prices in pesos with tax, and what work they hold."""
    work = F.split("items", r"\|")
    return _service(spark, d).select(
        "registro_id", "marca", "modelo", "km", "pesos", "dolares", F.when(F.col("items").isNotNull(), F.size(work)).cast("long").alias("trabajos"), F.array_contains(work, "aceite").alias("con_aceite"), "tipo"
    )


# Linked


_GUIDE_WORDS = f"m AS (SELECT DISTINCT {_KEY('marca')} AS clave, upper(trim(modelo)) AS modelo, {_WORDS('modelo', 'marca')} AS mp FROM (SELECT DISTINCT marca, modelo FROM cca_precios WHERE modelo IS NOT NULL))"


def _guide_models(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cca_precios").where("modelo is not null").select("marca", "modelo").distinct()
    return rows.select(X.brand_key(F.col("marca")).alias("clave"), F.upper(F.trim("modelo")).alias("modelo"), X.words_of(X.strip_brand(F.col("modelo"), F.col("marca"))).alias("mp")).distinct()


_PREFIX = r"""len(mp) > 0 AND len(mp) <= len(w) AND list_aggregate(list_transform(range(1, len(mp) + 1), lambda i: w[i] = mp[i] OR (regexp_matches(mp[i], '\d') AND starts_with(w[i], mp[i]))), 'bool_and')"""


@BOOK.add(f"""
    WITH {_GUIDE_WORDS}, f AS (SELECT DISTINCT marca, modelo_fuente FROM service_precios WHERE modelo_fuente IS NOT NULL AND marca IS NOT NULL),
    d AS (SELECT marca, modelo_fuente, {_KEY('marca')} AS clave, {_WORDS('modelo_fuente', 'marca')} AS w FROM f),
    h AS (SELECT d.*, modelo, len(mp) AS k FROM d JOIN m USING (clave) WHERE {_PREFIX}), b AS (SELECT DISTINCT marca, modelo_fuente, modelo FROM h QUALIFY k = max(k) OVER (PARTITION BY marca, modelo_fuente))
    SELECT d.marca, d.modelo_fuente, min(struct_pack(n := length(modelo), m := modelo)).m AS familia, CASE count(modelo) WHEN 0 THEN NULL WHEN 1 THEN 'prefijo' ELSE 'prefijo_ambiguo' END AS metodo
    FROM d LEFT JOIN b USING (marca, modelo_fuente) GROUP BY 1, 2""")
def int_service_familia(spark: SparkSession, d: str) -> DataFrame:
    """The guide's family of each model that service prices name."""
    f = table(spark, d, "service_precios").where("modelo_fuente is not null and marca is not null").select("marca", "modelo_fuente").distinct()
    f = f.select("marca", "modelo_fuente", X.brand_key(F.col("marca")).alias("clave"), X.words_of(X.strip_brand(F.col("modelo_fuente"), F.col("marca"))).alias("w"))
    found = matching.prefix_candidates(f, _guide_models(spark, d), "clave", "w", "modelo", "mp")
    n = F.size("candidatos")
    return found.select("marca", "modelo_fuente", F.get("candidatos", 0).alias("familia"), F.when(n == 1, "prefijo").when(n > 1, "prefijo_ambiguo").alias("metodo"))


_VERSIONS = """
    t AS (SELECT tramite_id, min(tramite_tipo) AS tipo, min(tramite_fecha) AS fecha, min(automotor_marca_codigo) AS marca_codigo, min(automotor_tipo_codigo) AS tipo_codigo, min(automotor_modelo_codigo) AS modelo_codigo,
                 min(automotor_marca_descripcion) AS marca, min(automotor_modelo_descripcion) AS modelo FROM tramites_dnrpa WHERE publicado = (SELECT max(publicado) FROM tramites_dnrpa) GROUP BY 1),
    c AS (SELECT marca_codigo, tipo_codigo, modelo_codigo, count(*) AS tramites, count(*) FILTER (WHERE tipo = 'INSCRIPCION INICIAL') AS inscripciones, max(fecha) AS ultimo FROM t WHERE marca_codigo IS NOT NULL AND modelo_codigo <> '0000' GROUP BY 1, 2, 3),
    n AS (SELECT marca_codigo, tipo_codigo, modelo_codigo, marca, modelo, count(*) AS k FROM t WHERE marca IS NOT NULL AND modelo IS NOT NULL GROUP BY ALL),
    e AS (SELECT c.*, x.marca, x.modelo FROM c LEFT JOIN (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY marca_codigo, tipo_codigo, modelo_codigo ORDER BY k DESC, marca, modelo) = 1) x
          ON x.marca_codigo = c.marca_codigo AND x.tipo_codigo IS NOT DISTINCT FROM c.tipo_codigo AND x.modelo_codigo = c.modelo_codigo)"""

_VERSION_KEY = ["marca_codigo", "tipo_codigo", "modelo_codigo"]


def _versions(spark: SparkSession, d: str) -> DataFrame:
    all_ = table(spark, d, "tramites_dnrpa")
    newest = all_.select(F.max("publicado")).scalar()
    least = lambda c, name: F.min(c).alias(name)
    t = all_.where(F.col("publicado") == newest).groupBy("tramite_id").agg(
        least("tramite_tipo", "tipo"), least("tramite_fecha", "fecha"), least("automotor_marca_codigo", "marca_codigo"), least("automotor_tipo_codigo", "tipo_codigo"),
        least("automotor_modelo_codigo", "modelo_codigo"), least("automotor_marca_descripcion", "marca"), least("automotor_modelo_descripcion", "modelo"),
    )
    c = t.where("marca_codigo is not null and modelo_codigo <> '0000'").groupBy(*_VERSION_KEY).agg(
        F.count(F.lit(1)).alias("tramites"), F.count_if(F.col("tipo") == "INSCRIPCION INICIAL").alias("inscripciones"), F.max("fecha").alias("ultimo")
    )
    names = t.where("marca is not null and modelo is not null").groupBy(*_VERSION_KEY, "marca", "modelo").agg(F.count(F.lit(1)).alias("k"))
    best = names.groupBy(*_VERSION_KEY).agg(F.min(F.struct((-F.col("k")).alias("k"), "marca", "modelo")).alias("b")).select(*[F.col(x).alias(f"_{x}") for x in _VERSION_KEY], "b.marca", "b.modelo")
    return c.join(best, windows._same(_VERSION_KEY), "left").select(*_VERSION_KEY, "tramites", "inscripciones", "ultimo", "marca", "modelo")


_REVISIONS = [("cca", 0, "REVISADO"), ("consumo", 0, "OTRO"), ("cca", 9, "NADIE")]


@BOOK.add(f"""
    WITH {_VERSIONS}, {_GUIDE_WORDS},
    u AS (SELECT marca || '-' || modelo AS k, 1 FROM e), z AS (SELECT min(marca_codigo) AS mc FROM e),
    r AS (SELECT 'cca' AS fuente, mc, 'REVISADO' AS asignado FROM z UNION ALL SELECT 'consumo', mc, 'OTRO' FROM z),
    v AS (SELECT upper(trim(marca)) AS mk, ltrim(modelo, '0') AS mo, max(valor_fiscal) FILTER (WHERE anio = 0) AS cero, max(valor_fiscal) AS tope FROM valuacion_fotos GROUP BY 1, 2),
    d AS (SELECT e.*, {_KEY('marca')} AS clave, {_WORDS('modelo', 'marca')} AS w FROM e),
    h AS (SELECT d.marca_codigo, d.tipo_codigo, d.modelo_codigo, m.modelo AS cca, len(mp) AS k FROM d JOIN m ON m.clave = d.clave WHERE {_PREFIX}),
    b AS (SELECT DISTINCT marca_codigo, tipo_codigo, modelo_codigo, cca FROM h QUALIFY k = max(k) OVER (PARTITION BY marca_codigo, tipo_codigo, modelo_codigo)),
    g AS (SELECT marca_codigo, tipo_codigo, modelo_codigo, min(struct_pack(n := length(cca), m := cca)).m AS cca, count(*) AS k FROM b GROUP BY 1, 2, 3)
    SELECT d.marca_codigo, d.tipo_codigo, d.modelo_codigo, d.marca, d.modelo, d.tramites, d.inscripciones, strftime(d.ultimo, '%Y-%m-%d') AS ultimo,
           coalesce(rc.asignado, g.cca) AS cca_modelo, CASE WHEN rc.asignado IS NOT NULL THEN 'revision_manual' WHEN g.k = 1 THEN 'prefijo' WHEN g.k > 1 THEN 'prefijo_ambiguo' END AS cca_metodo, rk.asignado AS consumo_modelo
    FROM d LEFT JOIN g ON g.marca_codigo = d.marca_codigo AND g.tipo_codigo IS NOT DISTINCT FROM d.tipo_codigo AND g.modelo_codigo = d.modelo_codigo
    LEFT JOIN r rc ON rc.fuente = 'cca' AND rc.mc = d.marca_codigo LEFT JOIN r rk ON rk.fuente = 'consumo' AND rk.mc = d.marca_codigo""")
def dim_version(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of versions with its match to the guide; manual revisions go first, joined by source and key."""
    e = _versions(spark, d)
    told = e.select("*", X.brand_key(F.col("marca")).alias("clave"), X.words_of(X.strip_brand(F.col("modelo"), F.col("marca"))).alias("w"))
    guide = _guide_models(spark, d).withColumnRenamed("modelo", "cca")
    found = matching.prefix_candidates(told, guide, "clave", "w", "cca", "mp")
    first = e.select(F.min("marca_codigo")).scalar()
    revised = lambda source: F.when(F.col("marca_codigo") == first, F.lit(next(x for s, _, x in _REVISIONS if s == source)))
    n = F.size("candidatos")
    return found.select("*", revised("cca").alias("rc"), revised("consumo").alias("consumo_modelo")).select(
        *_VERSION_KEY, "marca", "modelo", "tramites", "inscripciones", F.date_format("ultimo", "yyyy-MM-dd").alias("ultimo"), F.coalesce("rc", F.get("candidatos", 0)).alias("cca_modelo"),
        F.when(F.col("rc").isNotNull(), "revision_manual").when(n == 1, "prefijo").when(n > 1, "prefijo_ambiguo").alias("cca_metodo"), "consumo_modelo",
    )


@BOOK.add(f"""
    WITH {_GUIDE_WORDS}, r AS (SELECT DISTINCT marca, descripcion, n, valor_fiscal FROM matching_0km WHERE descripcion IS NOT NULL AND marca IS NOT NULL),
    d AS (SELECT marca, descripcion, max(n) AS n, max(valor_fiscal) AS valor, {_KEY('marca')} AS clave, {_WORDS('descripcion', 'marca')} AS w FROM r GROUP BY marca, descripcion),
    x AS (SELECT d.marca, d.descripcion, n, valor, EXISTS (SELECT 1 FROM m WHERE m.clave = d.clave AND {_PREFIX}) AS ok FROM d)
    SELECT 'filas' AS peso, round(1000e0 * count(*) FILTER (WHERE ok) / count(*)) / 10 AS pct FROM x UNION ALL SELECT 'unidades', round(1000e0 * sum(n) FILTER (WHERE ok) / sum(n)) / 10 FROM x
    UNION ALL SELECT 'valor', round(1000e0 * CAST(sum(CAST(valor AS HUGEINT) * n) FILTER (WHERE ok) AS DOUBLE) / CAST(sum(CAST(valor AS HUGEINT) * n) AS DOUBLE)) / 10 FROM x""")
def cobertura_mapeos(spark: SparkSession, d: str) -> DataFrame:
    """The share of registered versions whose model the guide has: by rows, by units and by value."""
    r = table(spark, d, "matching_0km").where("descripcion is not null and marca is not null")
    r = r.groupBy("marca", "descripcion").agg(F.max("n").alias("n"), F.max("valor_fiscal").alias("valor"))
    r = r.select("*", X.brand_key(F.col("marca")).alias("clave"), X.words_of(X.strip_brand(F.col("descripcion"), F.col("marca"))).alias("w"))
    x = matching.prefix_candidates(r, _guide_models(spark, d), "clave", "w", "modelo", "mp").withColumn("ok", F.size("candidatos") > 0)
    weights = {"unidades": F.col("n"), "valor": F.col("valor").cast("decimal(20,0)") * F.col("n")}
    sums = x.agg(percent(F.count_if("ok"), F.count(F.lit(1))).alias("filas"), *[percent(F.sum(F.when(F.col("ok"), w)), F.sum(w)).alias(k) for k, w in weights.items()])
    return sums.unpivot([], ["filas", *weights], "peso", "pct")


# Published


@BOOK.add(f"""
    WITH {_SERVICE}, u AS (SELECT * FROM t WHERE capturado >= (SELECT max(capturado) - INTERVAL 12 MONTH FROM t) AND pesos > 0)
    SELECT marca, km, count(*) AS precios, median(pesos) AS mediana, min(pesos) AS desde, count(DISTINCT modelo) AS modelos, count(*) FILTER (WHERE dolares) AS en_dolares FROM u WHERE km IS NOT NULL GROUP BY 1, 2""")
def mart_service(spark: SparkSession, d: str) -> DataFrame:
    """Service prices of the last twelve months by brand and kilometres."""
    t = _service(spark, d)
    since = F.add_months(t.select(F.max("capturado")).scalar(), -12)
    u = t.where((F.col("capturado") >= since) & (F.col("pesos") > 0) & F.col("km").isNotNull())
    medians = windows.exact_percentiles(u, ["marca", "km"], "pesos", {"mediana": 0.5}).drop("n")
    told = u.groupBy("marca", "km").agg(F.count(F.lit(1)).alias("precios"), F.min("pesos").alias("desde"), F.count_distinct("modelo").alias("modelos"), F.count_if("dolares").alias("en_dolares"))
    return told.withColumnRenamed("marca", "_marca").withColumnRenamed("km", "_km").join(medians, windows._same(["marca", "km"])).drop("_marca", "_km")


@BOOK.add("""
    WITH g AS (SELECT registro_id, min(periodo) AS periodo, min(upper(trim(marca))) AS marca, min(upper(trim(modelo))) AS modelo, min(anio) AS anio, min(precio_miles) AS p FROM cca_precios WHERE precio_miles BETWEEN 3000 AND 300000 GROUP BY 1),
    e AS (SELECT marca, modelo, periodo, CAST(CASE WHEN anio = 0 THEN 0 ELSE year(periodo) - anio END AS BIGINT) AS edad, median(p) AS m, count(*) AS n FROM g GROUP BY 1, 2, 3, 4),
    j AS (SELECT b.edad, median(b.m / a.m) AS salto, count(*) AS n FROM e b JOIN e a ON a.marca = b.marca AND a.modelo = b.modelo AND a.periodo = b.periodo AND a.edad = b.edad - 1 WHERE b.edad BETWEEN 1 AND 14 GROUP BY 1)
    SELECT edad, round(exp(sum(ln(salto)) OVER w) * 1e4) / 1e4 AS indice, count(*) OVER w = edad - (SELECT min(edad) FROM j) + 1 AS completo, min(n) OVER w AS respaldo FROM j WHERE salto > 0 WINDOW w AS (ORDER BY edad ROWS UNBOUNDED PRECEDING)""")
def mart_depreciacion_mercado(spark: SparkSession, d: str) -> DataFrame:
    """What the market's prices keep from one age to the next, chained; one row per age."""
    g = table(spark, d, "cca_precios").where("precio_miles between 3000 and 300000").groupBy("registro_id").agg(
        F.min("periodo").alias("periodo"), F.min(F.upper(F.trim("marca"))).alias("marca"), F.min(F.upper(F.trim("modelo"))).alias("modelo"), F.min("anio").alias("anio"), F.min("precio_miles").alias("p")
    )
    age = F.when(F.col("anio") == 0, 0).otherwise(F.year("periodo") - F.col("anio")).cast("long")
    e = windows.exact_percentiles(g.withColumn("edad", age), ["marca", "modelo", "periodo", "edad"], "p", {"m": 0.5}).drop("n")
    younger = e.select("marca", "modelo", "periodo", (F.col("edad") + 1).alias("edad"), F.col("m").alias("m0"))
    jumps = e.join(younger, ["marca", "modelo", "periodo", "edad"]).where("edad between 1 and 14").select(F.lit("todas").alias("k"), "edad", (F.col("m") / F.col("m0")).alias("r"))
    j = windows.exact_percentiles(jumps, ["k", "edad"], "r", {"salto": 0.5})
    out = windows.chained_index(j, ["k"], "edad", "salto", "n")
    return out.select("edad", scaled_round(F.col("indice"), 4).alias("indice"), "completo", "respaldo")


_TAX = [("N", 0.0, 10e6, 0.0, 1.0), ("N", 10e6, 30e6, 100e3, 2.0), ("N", 30e6, None, 500e3, 3.5), ("I", 0.0, 25e6, 20e3, 2.5), ("I", 25e6, None, 645e3, 4.0)]
_TAX_SQL = ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"CAST({x} AS DOUBLE)" for x in b) + ")" for b in _TAX)


@BOOK.add(f"""
    WITH t(origen, desde, hasta, fijo, pct) AS (VALUES {_TAX_SQL}),
    u AS (SELECT DISTINCT origen, upper(trim(mtm)) AS clave, anio, CAST(valor_fiscal AS DOUBLE) AS v FROM valuacion_fotos WHERE vigencia = (SELECT max(vigencia) FROM valuacion_fotos) AND valor_fiscal > 0)
    SELECT u.origen, clave, anio, v, round(greatest(least(fijo + (v - desde) * pct / 100, v * 0.03), 50000) * 100) / 100 AS anual FROM u JOIN t ON t.origen = u.origen AND v > desde AND (hasta IS NULL OR v <= hasta)""")
def mart_patente(spark: SparkSession, d: str) -> DataFrame:
    """A bracketed yearly charge on fiscal values, with a floor and a ceiling on its share."""
    all_ = table(spark, d, "valuacion_fotos")
    newest = all_.select(F.max("vigencia")).scalar()
    u = all_.where((F.col("vigencia") == newest) & (F.col("valor_fiscal") > 0)).select("origen", F.upper(F.trim("mtm")).alias("clave"), "anio", F.col("valor_fiscal").cast("double").alias("v")).distinct()
    scale = spark.createDataFrame(_TAX, "origen string, desde double, hasta double, fijo double, pct double")
    held = joins.bracket_join(u, scale, "v", "desde", "hasta", ["origen"])
    due = F.greatest(F.least(F.col("fijo") + (F.col("v") - F.col("desde")) * F.col("pct") / 100, F.col("v") * 0.03), F.lit(50000.0))
    return held.select("origen", "clave", "anio", "v", scaled_round(due, 2).alias("anual"))


@BOOK.add(f"""
    WITH {_SERVICE},
    sv AS (SELECT marca, median(pesos) AS por_servicio FROM t WHERE pesos > 0 GROUP BY 1), f AS (SELECT median(precio_mediano) AS litro FROM combustible_mensual WHERE periodo = (SELECT max(periodo) FROM combustible_mensual)),
    g AS (SELECT registro_id, min(upper(trim(marca))) AS marca, min(upper(trim(modelo))) AS modelo, min(precio_miles) AS p FROM cca_precios WHERE anio = 0 AND precio_miles BETWEEN 3000 AND 300000 GROUP BY 1),
    v AS (SELECT marca, modelo, median(p) * 1000e0 AS valor, count(*) AS n FROM g GROUP BY 1, 2),
    c AS (SELECT v.marca, v.modelo, valor, litro * 15000 * 0.08 AS combustible, por_servicio * 1.5 AS servicio, CASE WHEN n >= 2 THEN valor * 0.08 END AS caida FROM v CROSS JOIN f LEFT JOIN sv USING (marca))
    SELECT marca, modelo, round(combustible + servicio + caida) AS total, round(coalesce(combustible, 0) + coalesce(servicio, 0) + coalesce(caida, 0)) AS parcial,
           concat_ws(',', CASE WHEN combustible IS NULL THEN 'combustible' END, CASE WHEN servicio IS NULL THEN 'servicio' END, CASE WHEN caida IS NULL THEN 'caida' END) AS faltantes FROM c""")
def mart_costo_total(spark: SparkSession, d: str) -> DataFrame:
    """Yearly cost of a model for one profile: null with a missing component, beside the sum of the rest and the names of what is missing."""
    s = windows.exact_percentiles(_service(spark, d).where("pesos > 0"), ["marca"], "pesos", {"por_servicio": 0.5}).drop("n")
    months = table(spark, d, "combustible_mensual")
    last = months.select(F.max("periodo")).scalar()
    litre = windows.exact_percentiles(months.where(F.col("periodo") == last).withColumn("k", F.lit(1)), ["k"], "precio_mediano", {"litro": 0.5}).drop("n")
    g = table(spark, d, "cca_precios").where("anio = 0 and precio_miles between 3000 and 300000").groupBy("registro_id").agg(F.min(F.upper(F.trim("marca"))).alias("marca"), F.min(F.upper(F.trim("modelo"))).alias("modelo"), F.min("precio_miles").alias("p"))
    v = windows.exact_percentiles(g, ["marca", "modelo"], "p", {"m": 0.5}).withColumn("valor", F.col("m") * 1000.0).withColumn("k", F.lit(1))
    rows = v.join(litre, "k", "left").join(s, "marca", "left")
    parts = {"combustible": F.col("litro") * 15000 * 0.08, "servicio": F.col("por_servicio") * 1.5, "caida": F.when(F.col("n") >= 2, F.col("valor") * 0.08)}
    rows = rows.withColumns(parts)
    total, rest = sum((F.col(c) for c in list(parts)[1:]), F.col("combustible")), sum((F.coalesce(c, F.lit(0.0)) for c in list(parts)[1:]), F.coalesce("combustible", F.lit(0.0)))
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), c) for c in parts])
    return rows.select("marca", "modelo", F.round(total, 0).alias("total"), F.round(rest, 0).alias("parcial"), missing.alias("faltantes"))


@BOOK.add("""
    WITH k AS (SELECT DISTINCT upper(trim(mtm)) AS clave, anio, valor_fiscal AS v FROM valuacion_fotos WHERE vigencia = (SELECT max(vigencia) FROM valuacion_fotos) AND anio > 0 AND valor_fiscal > 0),
    m AS (SELECT clave, anio, max(v) AS v FROM k GROUP BY 1, 2), t AS (SELECT max(anio) AS a FROM m),
    p AS (SELECT n.clave, n.v AS nuevo, CAST(b.v AS DOUBLE) / n.v AS p1, CAST(c.v AS DOUBLE) / n.v AS p5 FROM m n CROSS JOIN t LEFT JOIN m b ON b.clave = n.clave AND b.anio = a - 1 LEFT JOIN m c ON c.clave = n.clave AND c.anio = a - 5 WHERE n.anio = a)
    SELECT clave, round(nuevo * CASE WHEN p1 IS NULL AND p5 IS NULL THEN 1 WHEN p1 IS NULL THEN 1 + (p5 - 1) * 3 / 5 WHEN p5 IS NULL THEN p1 ELSE p1 + (p5 - p1) * 2 / 4 END) AS en_tres FROM p""")
def mart_valor_futuro(spark: SparkSession, d: str) -> DataFrame:
    """Value in three years on the line between the known shares kept after one and five years; unknown points are passed over."""
    all_ = table(spark, d, "valuacion_fotos")
    newest = all_.select(F.max("vigencia")).scalar()
    m = all_.where((F.col("vigencia") == newest) & (F.col("anio") > 0) & (F.col("valor_fiscal") > 0)).groupBy(F.upper(F.trim("mtm")).alias("clave"), "anio").agg(F.max("valor_fiscal").alias("v"))
    top = m.select(F.max("anio")).scalar()
    at = lambda back, name: m.where(F.col("anio") == top - back).select("clave", F.col("v").alias(name))
    p = at(0, "nuevo").join(at(1, "v1"), "clave", "left").join(at(5, "v5"), "clave", "left")
    kept = piecewise(F.lit(3.0), [(0, F.lit(1.0)), (1, safe_ratio(F.col("v1"), F.col("nuevo"))), (5, safe_ratio(F.col("v5"), F.col("nuevo")))])
    return p.select("clave", F.round(F.col("nuevo") * kept, 0).alias("en_tres"))


@BOOK.add("""
    WITH i AS (SELECT DISTINCT marca, familia, version_fuente, orden_version, lower(trim(item)) AS item, valor FROM equipamiento_items WHERE item IS NOT NULL AND version_fuente IS NOT NULL)
    SELECT marca, familia, version_fuente, count(DISTINCT item) FILTER (WHERE valor = 'si') AS de_serie, count(DISTINCT item) FILTER (WHERE valor = 'opcional') AS opcionales,
           string_agg(DISTINCT item, '|' ORDER BY item) FILTER (WHERE valor = 'si') AS lista FROM i GROUP BY 1, 2, 3""")
def exp_equipamiento(spark: SparkSession, d: str) -> DataFrame:
    """One row per version of a sheet: how much it has, and what, as an ordered list."""
    i = table(spark, d, "equipamiento_items").where("item is not null and version_fuente is not null").withColumn("item", F.lower(F.trim("item")))
    one = i.groupBy("marca", "familia", "version_fuente", "item").agg(F.bool_or(F.coalesce(F.col("valor") == "si", F.lit(False))).alias("si"), F.bool_or(F.coalesce(F.col("valor") == "opcional", F.lit(False))).alias("op"))
    has = F.array_sort(F.array_compact(F.collect_list(F.when(F.col("si"), F.col("item")))))
    return one.groupBy("marca", "familia", "version_fuente").agg(
        F.count_if("si").alias("de_serie"), F.count_if("op").alias("opcionales"), F.when(F.count_if("si") > 0, F.array_join(has, "|")).alias("lista")
    )


@BOOK.add("""
    WITH m AS (SELECT *, row_number() OVER (PARTITION BY provincia_id, producto ORDER BY precio_mediano, bandera, periodo) AS r FROM (SELECT DISTINCT * FROM combustible_mensual) WHERE periodo = (SELECT max(periodo) FROM combustible_mensual))
    SELECT provincia_id, producto, bandera, precio_mediano, r AS puesto FROM m WHERE r <= 3""")
def exp_combustible(spark: SparkSession, d: str) -> DataFrame:
    """The three cheapest brands of each province and product in the last month."""
    m = table(spark, d, "combustible_mensual").distinct()
    last = m.select(F.max("periodo")).scalar()
    top = windows.top_per_group(m.where(F.col("periodo") == last), ["provincia_id", "producto"], [F.asc("precio_mediano"), F.asc("bandera"), F.asc("periodo")], 3, "puesto")
    return top.select("provincia_id", "producto", "bandera", "precio_mediano", "puesto")


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
