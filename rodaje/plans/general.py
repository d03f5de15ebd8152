"""Queries of the general data-preparation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rodaje.operators import drift, geo, snapshots, units
from rodaje.sources import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = geo.current_stations(table(spark, sf_dir, "estaciones"))
    pairs = geo.near_points(stations, 150.0, "nro_inscripcion", "latitud", "longitud")
    return pairs.select(F.col("id_a").alias("nro_a"), F.col("id_b").alias("nro_b"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = table(spark, sf_dir, "cambio_usd")
    guide = units.guide_amounts(table(spark, sf_dir, "cca_precios"), rates).where("unit <> 'miles'")
    service = units.service_amounts(table(spark, sf_dir, "service_precios"), rates).where("unit <> 'pesos' or only_text")
    named = lambda df, t: df.select(F.lit(t).alias("tabla"), "registro_id", "pesos")
    return named(guide, "cca_precios").unionByName(named(service, "service_precios")).where("pesos is not null")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "valuacion_fotos").select(
        F.concat(F.upper(F.trim("mtm")), F.lit("/"), F.col("anio").cast("string")).alias("clave"), "vigencia", "valor_fiscal"
    )
    filings = table(spark, sf_dir, "tramites_dnrpa").select(F.col("tramite_id").cast("string").alias("clave"), "publicado", "tramite_fecha")
    named = lambda df, t: df.select(
        F.lit(t).alias("tabla"), F.col("key").alias("clave"), F.date_format("snapshot", "yyyy-MM-dd").alias("foto"), F.col("change").alias("cambio")
    )
    return named(snapshots.changes(values, "clave", "vigencia", ["valor_fiscal"]), "valuacion_fotos").unionByName(
        named(snapshots.changes(filings, "clave", "publicado", ["tramite_fecha"]), "tramites_dnrpa")
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = drift.schema_changes(table(spark, sf_dir, "declaraciones_crudas"))
    return changed.select(F.col("file").alias("archivo_id"), F.col("field").alias("campo"), F.col("change").alias("cambio"))


def p7_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid lines under the union schema; the fields without a proper name as text 'name=value; ...'."""
    wide = drift.unified(table(spark, sf_dir, "declaraciones_crudas"), ["serie", "orden", "recibido"])
    pairs = F.array_sort(F.transform(F.map_entries("otros"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return wide.withColumn("otros", F.array_join(pairs, "; "))


def p7_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union schema of all files: each field's column type, its number of files and the JSON types it was delivered in."""
    folded = drift.union_schema(table(spark, sf_dir, "declaraciones_crudas"))
    return folded.select(F.col("field").alias("campo"), F.col("type").alias("tipo"), F.col("files").alias("archivos"), F.col("delivered").alias("entregado"))


def p7_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of a field, the field it was taken for, and by which rule."""
    told = drift.spellings(table(spark, sf_dir, "declaraciones_crudas"))
    return told.select(F.col("written").alias("escrito"), F.col("field").alias("campo"), F.col("rule").alias("regla"), F.col("files").alias("archivos"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p4_found, p7_found, p7_unified, p7_schema, p7_spellings)}

_CHANGES = """
    {name}_once AS (SELECT k, d, min(v) AS v, bool_or(v IS NULL) AS missing FROM {name} WHERE k IS NOT NULL AND d IS NOT NULL GROUP BY k, d),
    {name}_dates AS (SELECT d, lead(d) OVER (ORDER BY d) AS next FROM (SELECT DISTINCT d FROM {name}_once)),
    {name}_moves AS (
        SELECT '{table}' AS tabla, coalesce(b.k, a.k) AS clave, strftime(coalesce(b.d, a.next), '%Y-%m-%d') AS foto,
               CASE WHEN a.k IS NULL THEN 'alta' WHEN b.k IS NULL THEN 'baja' ELSE 'cambio' END AS cambio
        FROM (SELECT o.*, t.next FROM {name}_once o JOIN {name}_dates t USING (d) WHERE t.next IS NOT NULL) a
        FULL JOIN (SELECT * FROM {name}_once WHERE d > (SELECT min(d) FROM {name}_once)) b ON a.k = b.k AND a.next = b.d
        WHERE a.k IS NULL OR b.k IS NULL OR a.missing <> b.missing OR (NOT a.missing AND a.v <> b.v))"""

_ALIASES = ", ".join(f"('{a}', '{f}', {n})" for n, (f, names) in enumerate(drift.aliases().items()) for a in names)
_FLAT = r"""trim(regexp_replace(lower(strip_accents(regexp_replace(key, '([\p{Ll}\d])(\p{Lu})', '\1_\2', 'g'))), '[^a-z0-9]+', '_', 'g'), '_')"""
_FILES = rf"""
    alias(a, f, n) AS (VALUES {_ALIASES}),
    lines AS (SELECT row_number() OVER () AS rid, * FROM (SELECT archivo_id, serie, orden, linea, recibido, try_cast(registro AS JSON) AS j FROM declaraciones_crudas) WHERE json_type(j) = 'OBJECT'),
    raw AS (SELECT rid, archivo_id, unnest(json_keys(j)) AS key, j FROM lines),
    names AS (SELECT key, {_FLAT} AS flat FROM (SELECT DISTINCT key FROM raw)),
    told AS (SELECT key, coalesce((SELECT min(f) FROM alias WHERE a = flat),
                arg_min(f, n) FILTER (WHERE a = f AND length(f) >= 6 AND levenshtein(flat, f) <= 1 AND NOT starts_with(flat, f) AND NOT regexp_matches(flat, '\d')), key) AS campo,
             CASE WHEN bool_or(a = flat AND a = f) THEN 'nombre' WHEN bool_or(a = flat) THEN 'lista'
                  WHEN bool_or(a = f AND length(f) >= 6 AND levenshtein(flat, f) <= 1 AND NOT starts_with(flat, f) AND NOT regexp_matches(flat, '\d')) THEN 'errata' ELSE 'propio' END AS regla
             FROM names CROSS JOIN alias GROUP BY key, flat),
    cells AS (SELECT rid, archivo_id, key, campo, regla, json_extract_string(j, '$."' || key || '"') AS v,
                CASE json_type(json_extract(j, '$."' || key || '"')) WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'text' WHEN 'OBJECT' THEN 'text' WHEN 'ARRAY' THEN 'text' ELSE 'number' END AS kind
              FROM raw JOIN told USING (key)),
    typed AS (SELECT *, lower(trim(v)) IN ('true', 't', '1', 's', 'si', 'sí', 'false', 'f', '0', 'n', 'no') AS b, regexp_full_match(trim(v), '[+-]?\d{{1,18}}') AS i,
                regexp_full_match(trim(v), '[+-]?\d+([.,]\d+)?([eE][+-]?\d+)?') AS d, regexp_full_match(trim(v), '\d{{4}}-\d{{2}}-\d{{2}}') AND try_cast(trim(v) AS DATE) IS NOT NULL AS f FROM cells)"""


def _unified_column(field: str, kind: str) -> str:
    v = f"max(v) FILTER (WHERE campo = '{field}')"
    if kind == "boolean":
        return f"CASE WHEN lower(trim({v})) IN ('true', 't', '1', 's', 'si', 'sí') THEN true WHEN lower(trim({v})) IN ('false', 'f', '0', 'n', 'no') THEN false END AS {field}"
    return f"{v} AS {field}" if kind == "string" else f"CAST(replace(trim({v}), ',', '.') AS {kind}) AS {field}"


_UNIFIED_TYPES = {"exentos": "boolean", "no_movimientos": "boolean", "nro_inscripcion": "bigint"} | dict.fromkeys(["precio_surtidor", "volumen", "iva", "tasa_municipal"], "double")

ORACLES = {
    "p1_found": """
        WITH s AS (SELECT nro_inscripcion AS nro, arg_max(latitud, ultima_informacion) AS lat, arg_max(longitud, ultima_informacion) AS lon,
                          max(ultima_informacion) AS t FROM estaciones GROUP BY nro_inscripcion),
        l AS (SELECT DISTINCT e.nro_inscripcion AS nro, e.latitud AS lat, e.longitud AS lon FROM estaciones e JOIN s ON e.nro_inscripcion = s.nro AND e.ultima_informacion = s.t
              WHERE e.latitud BETWEEN -56 AND -21 AND e.longitud BETWEEN -74 AND -53),
        g AS (SELECT *, CAST(floor(lat / 0.01) AS BIGINT) AS c FROM l)
        SELECT DISTINCT a.nro AS nro_a, b.nro AS nro_b FROM g a JOIN (SELECT *, unnest([c - 1, c, c + 1]) AS k FROM g) b ON a.c = b.k AND a.nro < b.nro
        WHERE 2 * 6371000 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 150""",
    "p4_found": "WITH v AS (SELECT upper(trim(mtm)) || '/' || anio AS k, vigencia AS d, valor_fiscal AS v FROM valuacion_fotos),"
    + " t AS (SELECT CAST(tramite_id AS VARCHAR) AS k, publicado AS d, tramite_fecha AS v FROM tramites_dnrpa),"
    + _CHANGES.format(name="v", table="valuacion_fotos") + "," + _CHANGES.format(name="t", table="tramites_dnrpa")
    + " SELECT * FROM v_moves UNION ALL SELECT * FROM t_moves",
    "p7_found": f"""
        WITH {_FILES},
        heads AS (SELECT archivo_id, campo, string_agg(DISTINCT key, '|' ORDER BY key) AS w, CASE WHEN bool_or(kind = 'text') OR (bool_or(kind = 'boolean') AND bool_or(kind = 'number')) THEN 'text' ELSE max(kind) END AS t FROM cells GROUP BY 1, 2),
        files AS (SELECT archivo_id, serie, orden, lag(archivo_id) OVER (PARTITION BY serie ORDER BY orden, archivo_id) AS antes FROM (SELECT archivo_id, min(serie) AS serie, min(orden) AS orden FROM declaraciones_crudas GROUP BY 1)),
        a AS (SELECT files.archivo_id, campo, w, t FROM files JOIN heads ON heads.archivo_id = antes), b AS (SELECT archivo_id, campo, w, t FROM files JOIN heads USING (archivo_id) WHERE antes IS NOT NULL),
        c AS (SELECT coalesce(a.archivo_id, b.archivo_id) AS archivo_id, coalesce(a.campo, b.campo) AS campo, a.w AS w0, b.w AS w1, a.t AS t0, b.t AS t1 FROM a FULL JOIN b ON a.archivo_id = b.archivo_id AND a.campo = b.campo)
        SELECT archivo_id, campo, 'agregado' AS cambio FROM c WHERE w0 IS NULL UNION ALL SELECT archivo_id, campo, 'quitado' FROM c WHERE w1 IS NULL
        UNION ALL SELECT archivo_id, campo, 'renombrado' FROM c WHERE w0 <> w1 UNION ALL SELECT archivo_id, campo, 'tipo' FROM c WHERE t0 <> t1""",
    "p7_spellings": f"WITH {_FILES} SELECT key AS escrito, campo, regla, count(DISTINCT archivo_id) AS archivos FROM cells GROUP BY 1, 2, 3",
    "p7_schema": f"""
        WITH {_FILES}
        SELECT campo, CASE WHEN count(kind) = 0 THEN 'void' WHEN bool_and(i) FILTER (WHERE kind IS NOT NULL) THEN 'bigint' WHEN bool_and(b) FILTER (WHERE kind IS NOT NULL) THEN 'boolean'
                           WHEN bool_and(d) FILTER (WHERE kind IS NOT NULL) THEN 'double' WHEN bool_and(f) FILTER (WHERE kind IS NOT NULL) THEN 'date' ELSE 'string' END AS tipo,
               count(DISTINCT archivo_id) AS archivos, string_agg(DISTINCT kind, ',' ORDER BY kind) AS entregado FROM typed GROUP BY 1""",
    "p7_unified": f"""
        WITH {_FILES}
        SELECT archivo_id, linea, serie, orden, recibido, {', '.join(_unified_column(f, _UNIFIED_TYPES.get(f, 'string')) for f in drift.aliases())},
               string_agg(campo || '=' || v, '; ' ORDER BY campo || '=' || v) FILTER (WHERE campo NOT IN (SELECT f FROM alias)) AS otros
        FROM lines LEFT JOIN cells USING (rid, archivo_id) GROUP BY rid, archivo_id, linea, serie, orden, recibido""",
}
