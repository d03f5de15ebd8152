"""Names found in descriptions of the car tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rodaje.functions import text as X
from rodaje.operators import matching, windows
from rodaje.plans.book import Book
from rodaje.sources import table

BOOK = Book()


def _descriptions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "matching_0km").where("descripcion is not null").select("registro_id", "marca", "descripcion").distinct()
    return rows.select("registro_id", X.brand_key(F.col("marca")).alias("clave"), X.words_of(X.strip_brand(F.col("descripcion"), F.col("marca"))).alias("palabras"))


def _models(spark: SparkSession, d: str) -> DataFrame:
    """Brand key, model and its words, as the price guide writes them."""
    rows = table(spark, d, "guia_versiones").where("cca_modelo is not null").select("marca", "cca_modelo").distinct()
    return rows.select(X.brand_key(F.col("marca")).alias("clave"), F.upper(F.trim("cca_modelo")).alias("modelo"), X.words_of(X.strip_brand(F.col("cca_modelo"), F.col("marca"))).alias("mp")).distinct()


_WORDS = lambda d, b: f"list_filter(string_split({X.strip_brand_sql(d, b)}, ' '), lambda w: w <> '')"
_KEY = lambda b: f"replace({X.norm_sql(b)}, ' ', '')"
_FITS = r"""len(mp) > 0 AND len(mp) <= len(palabras) AND list_aggregate(list_transform(range(1, len(mp) + 1),
    lambda i: palabras[i] = mp[i] OR (regexp_matches(mp[i], '\d') AND starts_with(palabras[i], mp[i]))), 'bool_and')"""
_BASE = f"""
    r AS (SELECT DISTINCT registro_id, marca, descripcion FROM matching_0km WHERE descripcion IS NOT NULL),
    d AS (SELECT registro_id, {_KEY('marca')} AS clave, {_WORDS('descripcion', 'marca')} AS palabras FROM r),
    g AS (SELECT DISTINCT marca, cca_modelo FROM guia_versiones WHERE cca_modelo IS NOT NULL),
    m AS (SELECT DISTINCT {_KEY('marca')} AS clave, upper(trim(cca_modelo)) AS modelo, {_WORDS('cca_modelo', 'marca')} AS mp FROM g)"""


@BOOK.add(f"""
    WITH v AS (SELECT DISTINCT marca, descripcion FROM valuacion_fotos)
    SELECT marca, descripcion, {X.norm_sql('descripcion')} AS forma, {_KEY('marca')} AS clave, {X.strip_brand_sql('descripcion', 'marca')} AS sin_marca FROM v""")
def n1_norm(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "valuacion_fotos").select("marca", "descripcion").distinct()
    return v.select("marca", "descripcion", X.norm(F.col("descripcion")).alias("forma"), X.brand_key(F.col("marca")).alias("clave"), X.strip_brand(F.col("descripcion"), F.col("marca")).alias("sin_marca"))


@BOOK.add(f"""
    WITH {_BASE},
    h AS (SELECT registro_id, palabras, modelo, len(mp) AS k FROM d JOIN m USING (clave) WHERE {_FITS}),
    b AS (SELECT DISTINCT registro_id, palabras, modelo FROM h QUALIFY k = max(k) OVER (PARTITION BY registro_id, palabras))
    SELECT d.registro_id, array_to_string(d.palabras, ' ') AS texto, string_agg(modelo, ' | ' ORDER BY length(modelo), modelo) AS candidatos, count(modelo) AS empatados
    FROM d LEFT JOIN b ON b.registro_id = d.registro_id AND b.palabras = d.palabras GROUP BY d.registro_id, d.clave, d.palabras""")
def n2_prefix_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every model tied in the longest prefix of a description."""
    found = matching.prefix_candidates(_descriptions(spark, d), _models(spark, d), "clave", "palabras", "modelo", "mp")
    n = F.size("candidatos")
    return found.select("registro_id", F.array_join("palabras", " ").alias("texto"), F.when(n > 0, F.array_join("candidatos", " | ")).alias("candidatos"), n.cast("long").alias("empatados"))


_ALIASES = "SELECT DISTINCT clave, mp[1:1] AS aw, CASE length(mp[1]) % 3 WHEN 0 THEN '(sin familia)' WHEN 1 THEN max(modelo) OVER (PARTITION BY clave) ELSE 'OTRO' END AS target FROM m WHERE length(mp[1]) % 2 = 0 AND len(mp) > 0"


@BOOK.add(f"""
    WITH {_BASE}, a AS ({_ALIASES}),
    h AS (SELECT registro_id, palabras, modelo, len(mp) AS k FROM d JOIN m USING (clave) WHERE {_FITS}),
    b AS (SELECT DISTINCT registro_id, palabras, modelo FROM h QUALIFY k = max(k) OVER (PARTITION BY registro_id, palabras)),
    c AS (SELECT d.registro_id, d.clave, d.palabras, list(modelo ORDER BY length(modelo), modelo) FILTER (WHERE modelo IS NOT NULL) AS l FROM d LEFT JOIN b ON b.registro_id = d.registro_id AND b.palabras = d.palabras GROUP BY ALL),
    t AS (SELECT c.*, (SELECT min(target) FROM a WHERE a.clave = c.clave AND a.aw[1] = c.palabras[1]) AS target FROM c),
    k AS (SELECT *, target IN (SELECT modelo FROM m WHERE m.clave = t.clave) AS conocido FROM t)
    SELECT registro_id, array_to_string(palabras, ' ') AS texto, CASE WHEN target = '(sin familia)' THEN NULL WHEN conocido THEN target ELSE l[1] END AS modelo,
           CASE WHEN target = '(sin familia)' THEN 'excluido' WHEN conocido THEN 'alias' WHEN len(l) = 1 THEN 'prefijo' WHEN len(l) > 1 THEN 'prefijo_ambiguo' END AS metodo,
           CASE WHEN coalesce(target <> '(sin familia)', true) AND NOT coalesce(conocido, false) AND len(l) > 1 THEN array_to_string(l, ' | ') END AS candidatos FROM k""")
def n3_model_with_aliases(spark: SparkSession, d: str) -> DataFrame:
    """The model of a description: aliases first, one of which blocks; then the longest prefix."""
    m = _models(spark, d)
    first = F.col("mp")[0]
    even = m.where((F.size("mp") > 0) & (F.length(first) % 2 == 0))
    top = even.groupBy("clave").agg(F.max("modelo").alias("_top"))
    aliases = even.join(top, "clave").select(
        "clave", F.slice("mp", 1, 1).alias("alias_words"),
        F.when(F.length(first) % 3 == 0, matching.NO_ENTRY).when(F.length(first) % 3 == 1, F.col("_top")).otherwise("OTRO").alias("target"),
    ).distinct()
    found = matching.model_match(_descriptions(spark, d), m, aliases, "clave", "palabras", "modelo", "mp")
    return found.select("registro_id", F.array_join("palabras", " ").alias("texto"), "modelo", "metodo", "candidatos")


_TITLE = "list_filter(string_split(trim(regexp_replace(upper(strip_accents(text)), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"


@BOOK.add(f"""
    WITH t AS (SELECT doc_id, upper(trim(marca)) AS marca, {_TITLE} AS w FROM documents WHERE text IS NOT NULL),
    n AS (SELECT DISTINCT upper(trim(marca)) AS marca, upper(trim(familia)) AS familia FROM documents WHERE marca IS NOT NULL AND familia IS NOT NULL
          UNION SELECT DISTINCT upper(trim(marca)), upper(trim(marca)) || ' ' || upper(trim(familia)) FROM documents WHERE marca IS NOT NULL AND familia IS NOT NULL),
    u AS (SELECT familia FROM n GROUP BY 1 HAVING count(DISTINCT marca) = 1 AND list_aggregate(list_transform(string_split(familia, ' '), lambda w: length(w) >= 4 AND length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 3), 'bool_or')),
    s AS (SELECT doc_id, marca AS own, i, k, array_to_string(w[i:i + k - 1], ' ') AS run FROM t, range(1, len(w) + 1) AS a(i), range(1, 4) AS b(k) WHERE i + k - 1 <= len(w)),
    h AS (SELECT s.*, n.marca, n.familia, n.familia IN (SELECT familia FROM u) AS solo FROM s JOIN n ON run = n.familia),
    p AS (SELECT * FROM h WHERE own = marca),
    q AS (SELECT * FROM h WHERE solo),
    o AS (SELECT DISTINCT doc_id, marca, familia, 'marca' AS metodo FROM p WHERE NOT EXISTS (SELECT 1 FROM p x WHERE x.doc_id = p.doc_id AND x.i <= p.i AND x.i + x.k >= p.i + p.k AND x.k > p.k)),
    z AS (SELECT DISTINCT doc_id, marca, familia, 'unico' AS metodo FROM q WHERE doc_id NOT IN (SELECT doc_id FROM o) AND NOT EXISTS (SELECT 1 FROM q x WHERE x.doc_id = q.doc_id AND x.i <= q.i AND x.i + x.k >= q.i + q.k AND x.k > q.k))
    SELECT * FROM o UNION ALL SELECT * FROM z""")
def n4_title_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Families mentioned in a text: those of its own brand, else those that only one brand has."""
    docs = table(spark, d, "documents")
    clean = lambda c: F.upper(F.trim(c))
    words = X.words_of(F.trim(F.regexp_replace(F.upper(X.strip_accents(F.col("text"))), "[^A-Z0-9]+", " ")))
    titles = docs.where("text is not null").select("doc_id", clean("marca").alias("marca"), words.alias("w"))
    one = docs.where("marca is not null and familia is not null").select(clean("marca").alias("marca"), clean("familia").alias("familia")).distinct()
    names = one.unionByName(one.select("marca", F.concat_ws(" ", "marca", "familia").alias("familia"))).distinct().withColumn("nw", F.split("familia", " "))
    return matching.title_mentions(titles, names, "doc_id", "w", "marca", "familia", "nw", longest=3)


@BOOK.add("""
    WITH f AS (SELECT DISTINCT marca, familia, version_fuente, orden_version FROM equipamiento_items WHERE version_fuente IS NOT NULL),
    s AS (SELECT f.*, list_filter(string_split(upper(version_fuente), ' '), lambda w: w <> '' AND NOT regexp_matches(w, '^MY')) AS buscadas FROM f),
    v AS (SELECT marca, regexp_replace(upper(trim(cca_modelo)), '[^A-Z].*$', '') AS familia, guia_id, precio_miles, string_split(upper(coalesce(cca_version, '')), ' ') AS palabras FROM guia_versiones),
    c AS (SELECT s.*, guia_id, precio_miles FROM s JOIN v ON v.marca = s.marca WHERE len(buscadas) > 0 AND list_has_all(palabras, buscadas))
    SELECT marca, familia, version_fuente, orden_version, count(*) AS candidatas, arg_min(guia_id, struct_pack(a := -coalesce(precio_miles, 0), b := guia_id)) AS elegida FROM c GROUP BY 1, 2, 3, 4""")
def n5_sheet_version(spark: SparkSession, d: str) -> DataFrame:
    """The guide versions that have all words of a sheet's version, and the dearest of them."""
    f = table(spark, d, "equipamiento_items").where("version_fuente is not null").select("marca", "familia", "version_fuente", "orden_version").distinct()
    sheets = f.withColumn("buscadas", F.filter(F.split(F.upper("version_fuente"), " "), lambda w: (w != "") & ~w.rlike("^MY")))
    versions = table(spark, d, "guia_versiones").select("marca", "guia_id", "precio_miles", F.split(F.upper(F.coalesce("cca_version", F.lit(""))), " ").alias("palabras"))
    met = matching.subset_match(sheets, versions, ["marca"], "buscadas", "palabras")
    best = F.min(F.struct((-F.coalesce("precio_miles", F.lit(0))).alias("a"), F.col("guia_id").alias("b")))
    return met.groupBy("marca", "familia", "version_fuente", "orden_version").agg(F.count(F.lit(1)).alias("candidatas"), best.alias("_b")).select(
        "marca", "familia", "version_fuente", "orden_version", "candidatas", F.col("_b.b").alias("elegida")
    )


QUERIES, ORACLES = BOOK.queries, BOOK.oracles
