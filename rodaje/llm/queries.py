"""Queries over the text and matching operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rodaje.llm import linkage, packing, simjoin, sketch, spans, tokens
from rodaje.operators import windows
from rodaje.session import cut
from rodaje.sources import table

FUEL_GROUP = ["periodo", "provincia_id", "producto", "bandera"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = simjoin.reference_list(table(spark, sf_dir, "caracteristicas"), simjoin.wordings(spark))
    return simjoin.named_entries(table(spark, sf_dir, "equipamiento_items"), reference).withColumnRenamed("entry", "caracteristica_id")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that name no entry, with the number of items: what the list of wordings lacks."""
    items = table(spark, sf_dir, "equipamiento_items")
    none = p3_found(spark, sf_dir).where("caracteristica_id = 'ninguna'").select("item_id")
    return items.select("item_id", "item").distinct().join(none, "item_id").groupBy(F.trim("item").alias("item")).agg(F.count_distinct("item_id").alias("items"))


def _versions(spark: SparkSession, sf_dir: str) -> linkage.Linkage:
    return linkage.versions(table(spark, sf_dir, "matching_0km"), table(spark, sf_dir, "guia_versiones"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).pairs(0.5).select(F.col("id_a").alias("registro_id"), F.col("id_b").alias("guia_id"))


def p5_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched pairs of records with their confidence."""
    found = _versions(spark, sf_dir).pairs(0.5)
    return found.select(F.col("id_a").alias("registro_id"), F.col("id_b").alias("guia_id"), F.col("confidence").alias("confianza"))


def p5_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of classes of one model name with its votes and confidence; pares is the number of pairs of records it stands for."""
    every = _versions(spark, sf_dir).class_pairs()
    return every.select(F.col("sig_a").alias("clase_a"), F.col("sig_b").alias("clase_b"), *linkage.FUNCTIONS, F.col("weight").alias("pares"), F.col("confidence").alias("confianza"))


def p5_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each record."""
    told = _versions(spark, sf_dir).members()
    return told.select(F.when(F.col("source") == "a", "matching_0km").otherwise("guia_versiones").alias("tabla"), "id", F.col("sig").alias("clase"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.misprinted(
        table(spark, sf_dir, "combustible_precios"), table(spark, sf_dir, "combustible_mensual"),
        FUEL_GROUP, "precio_surtidor", "precio_mediano", "declaracion_id", ["canal_de_comercializacion"],
    )


PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "combustible_precios").where("precio_surtidor > 0").select("declaracion_id", *FUEL_GROUP, "precio_surtidor")
    return sketch.sketch(sketch.once(prices, "declaracion_id"), FUEL_GROUP, "precio_surtidor")


def p6_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians and tails per month, province, product and brand, each filing counted once."""
    return sketch.percentiles(_monthly(spark, sf_dir), FUEL_GROUP, PROBS)


def p6_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians and tails per product and province over all months and brands, from monthly sketches added up."""
    keys = ["provincia_id", "producto"]
    return sketch.percentiles(sketch.merge([_monthly(spark, sf_dir)], keys), keys, PROBS)


def p6_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each group's sketched quartiles lie within the stated error of the exact ones."""
    prices = table(spark, sf_dir, "combustible_precios").where("precio_surtidor > 0").select("declaracion_id", *FUEL_GROUP, "precio_surtidor")
    exact = windows.exact_percentiles(sketch.once(prices, "declaracion_id"), FUEL_GROUP, "precio_surtidor", {"e25": 0.25, "e50": 0.5, "e75": 0.75}).drop("n")
    met = p6_percentiles(spark, sf_dir).join(exact, FUEL_GROUP)
    close = lambda p: F.abs(F.col(f"p_{p}") - F.col(f"e{p}")) <= F.lit(sketch.ERROR * 1.000001) * F.col(f"e{p}")
    return met.select(*FUEL_GROUP, "n", (close("25") & close("50") & close("75")).alias("dentro"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(table(spark, sf_dir, "documents"))


def _long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a million characters and more: those of two thousand documents one behind the other, twice."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", F.floor(F.col("doc_id") / 2000).cast("long").alias("grupo"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"])
    return docs.groupBy("grupo").agg(F.array_join(ordered, " ").alias("t")).select(F.col("grupo").alias("doc_id"), F.concat_ws(" ", "t", "t").alias("text"))


def p8_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very long texts encoded in pieces by several tasks; vuelta tells whether the ids give the text back, and as many as are counted."""
    docs = cut(_long_texts(spark, sf_dir))
    ids = cut(tokens.token_ids(docs))
    back = tokens.texts_of(ids).withColumnRenamed("text", "back").join(ids.select("doc_id", F.size("ids").alias("n")), "doc_id").join(tokens.token_counts(docs).withColumnRenamed("n", "m"), "doc_id")
    same = (F.col("back") == F.col("text")) & (F.col("n") == F.col("m"))
    return docs.join(back, "doc_id").select(F.col("doc_id").alias("grupo"), F.length("text").cast("long").alias("caracteres"), same.alias("vuelta"))


def p9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(tokens.token_counts(table(spark, sf_dir, "documents")))


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the packing: every document placed whole, no container over its capacity, no overlap, little room left over."""
    docs = table(spark, sf_dir, "documents")
    sizes = cut(tokens.token_counts(docs))
    placed = cut(packing.pack(sizes))
    per = placed.groupBy("container").agg(F.sum("n_tokens").alias("used"), F.max(F.col("at") + F.col("n_tokens")).alias("upto"))
    used = per.agg(F.count_if(F.col("used") > 2048).alias("llenos_de_mas"), F.count_if(F.col("used") < F.col("upto")).alias("con_huecos"), F.count_if(F.col("used") > 0).alias("k"), F.sum("used").alias("s"))
    whole = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("m"), F.count(F.lit(1)).alias("parts"))
    kept = sizes.join(whole, "doc_id", "left").agg(
        F.count(F.lit(1)).alias("documentos"), F.count_if(~F.col("n").eqNullSafe(F.col("m"))).alias("incompletos"),
        F.count_if(F.col("parts") > F.greatest(F.ceil(F.col("n") / 2048), F.lit(1))).alias("partidos_de_mas"),
    )
    least = F.ceil(F.col("s") / 2048)
    one = F.lit(1).alias("one")  # both sides are one row
    return kept.select("*", one).join(used.select("*", one), "one").select("documentos", "incompletos", "partidos_de_mas", "llenos_de_mas", "con_huecos", (F.col("k") <= least * 1.01 + 1).alias("ajustado"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_pairs(table(spark, sf_dir, "documents"))


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.shared_share(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_chars", "shared_chars", "share")


def p10_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class of equal texts and the number of other texts it shares a passage with."""
    found = spans.shared_links(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), F.col("class").alias("clase"), F.col("copies").alias("copias"), F.col("links").alias("enlaces"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p3_found, p3_unmatched, p5_found, p5_confidence, p5_candidates, p5_members, p6_found, p6_percentiles, p6_merged, p6_within, p8_ids, p8_long, p9_packing, p9_checks, p10_found, p10_shared, p10_links)}


def oracle_sql() -> dict[str, str]:
    return {
        "p6_found": """
            WITH once AS (
                SELECT declaracion_id, min(periodo) AS periodo, min(provincia_id) AS provincia_id, min(producto) AS producto,
                       min(bandera) AS bandera, min(precio_surtidor) AS precio
                FROM combustible_precios WHERE precio_surtidor > 0 GROUP BY declaracion_id),
            m AS (SELECT periodo, provincia_id, producto, bandera, median(precio) AS mediana FROM once GROUP BY ALL)
            SELECT DISTINCT periodo, provincia_id, producto, bandera
            FROM combustible_mensual JOIN m USING (periodo, provincia_id, producto, bandera)
            WHERE abs(precio_mediano - mediana) > 0.01 * mediana""",
        "p6_within": """
            WITH once AS (SELECT DISTINCT ON (declaracion_id) * FROM combustible_precios WHERE precio_surtidor > 0)
            SELECT periodo, provincia_id, producto, bandera, count(*) AS n, true AS dentro FROM once GROUP BY ALL""",
        "p8_long": """
            SELECT CAST(floor(doc_id / 2000) AS BIGINT) AS grupo, CAST(2 * length(string_agg(text, ' ')) + 1 AS BIGINT) AS caracteres, true AS vuelta
            FROM documents WHERE text IS NOT NULL GROUP BY 1""",
        "p9_checks": """
            SELECT count(*) AS documentos, 0::BIGINT AS incompletos, 0::BIGINT AS partidos_de_mas, 0::BIGINT AS llenos_de_mas, 0::BIGINT AS con_huecos, true AS ajustado
            FROM documents""",
        "p10_links": """
            WITH t AS (SELECT DISTINCT doc_id, text FROM documents), c AS (SELECT doc_id, text, CASE WHEN length(text) >= 150 THEN min(doc_id) OVER (PARTITION BY text) ELSE doc_id END AS clase FROM t),
            d AS (SELECT DISTINCT clase, text FROM c WHERE length(text) >= 150),
            w AS (SELECT DISTINCT clase, md5(substring(text, p, 150)) AS h FROM d, range(1, length(text) - 148) AS r(p)),
            s AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1), k AS (SELECT w.* FROM w SEMI JOIN s USING (h)),
            e AS (SELECT a.clase, count(DISTINCT b.clase) AS enlaces FROM k a JOIN k b ON a.h = b.h AND a.clase <> b.clase GROUP BY 1)
            SELECT doc_id, clase, count(*) OVER (PARTITION BY clase) AS copias, CAST(coalesce(enlaces, 0) AS BIGINT) AS enlaces FROM c LEFT JOIN e USING (clase)""",
        "p10_found": """
            WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 150),
            w AS (SELECT DISTINCT doc_id, md5(substring(text, p, 150)) AS h FROM d, range(1, length(text) - 148) AS r(p)),
            s AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1), k AS (SELECT w.* FROM w SEMI JOIN s USING (h))
            SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM k a JOIN k b ON a.h = b.h AND a.doc_id < b.doc_id""",
        "p10_shared": """
            WITH d AS (SELECT doc_id, text FROM documents WHERE length(text) >= 150),
            w AS (SELECT doc_id, p, md5(substring(text, p, 150)) AS h FROM d, range(1, length(text) - 148) AS r(p)),
            s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)),
            o AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM w SEMI JOIN s USING (h)),
            c AS (SELECT doc_id, sum(CASE WHEN before IS NULL OR p - before > 150 THEN 150 ELSE p - before END) AS n FROM o GROUP BY doc_id)
            SELECT doc_id, CAST(coalesce(length(text), 0) AS BIGINT) AS n_chars, CAST(coalesce(n, 0) AS BIGINT) AS shared_chars,
                   CASE WHEN length(text) > 0 THEN CAST(coalesce(n, 0) AS DOUBLE) / length(text) ELSE 0.0 END AS share
            FROM documents LEFT JOIN c USING (doc_id)""",
    }
