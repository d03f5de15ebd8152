"""Files whose fields drift: one consistent table, and every change of schema in order."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ACCENTS = ("áéíóúüñàèìòùâêôãõç", "aeiouunaeiouaeoaoc")

#: The lattice of delivered JSON types: text takes every type in, number and boolean meet only in text, null below all.
TYPES = {"null": 0, "boolean": 1, "number": 2, "text": 3}

#: The lattice of column types: a value can be read as a set of these, a column as what all of its values can, and its type is
#: the first that is left; string if none is.
READINGS = {"bigint": 1, "boolean": 2, "double": 4, "date": 8}

SEED = Path(__file__).resolve().parent.parent / "seeds" / "campos_alias.csv"


@cache
def aliases(path: str | Path = SEED) -> dict[str, list[str]]:
    """The proper fields and the ways each is written, from a table with columns alias and campo; case, accents and punctuation don't count."""
    out: dict[str, list[str]] = {}
    with open(path, encoding="utf-8", newline="") as f:
        for row in csv.DictReader(f):
            out.setdefault(row["campo"], []).append(row["alias"])
    return out


def plain(name: Column) -> Column:
    """A field name without case, accents and punctuation; words stay apart."""
    camel = F.regexp_replace(name, r"([\p{Ll}\d])(\p{Lu})", "$1_$2")
    flat = F.translate(F.lower(F.translate(camel, "ÁÉÍÓÚÜÑÀÈÌÒÙÂÊÔÃÕÇ", ACCENTS[0])), *ACCENTS)
    return F.regexp_replace(F.regexp_replace(flat, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def proper_name(written: Column, fields: Mapping[str, Sequence[str]] | None = None) -> Column:
    """The field a written name means: an agreed spelling, or a misprint of a name of six or more letters; else as written."""
    return F.coalesce(_meaning(written, fields)["field"], written)


def _meaning(written: Column, fields: Mapping[str, Sequence[str]] | None = None) -> Column:
    """field and rule ('nombre', 'lista' or 'errata') of a written name; both null for a name of its own.

    A misprint is one letter off. A name that goes on after the proper one, or counts it (volumen2, operadora, periodos), is not one.
    """
    fields = fields or aliases()
    flat = plain(written)
    told = lambda name, rule: F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"))
    misprint = lambda name: (F.levenshtein(flat, F.lit(name)) <= 1) & ~flat.startswith(name) & ~flat.rlike(r"\d")
    tests = [(flat == name, told(name, "nombre")) for name in fields]
    tests += [(flat.isin(list(others)), told(name, "lista")) for name, others in fields.items() if others]
    tests += [(misprint(name), told(name, "errata")) for name in fields if len(name) >= 6]
    out = F.when(*tests[0])
    for test in tests[1:]:
        out = out.when(*test)
    return out


def _json_type(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", "null").when(kind == "BOOLEAN", "boolean").when(kind == "STRING", "text")
        .when(kind.rlike("^(OBJECT|ARRAY)"), "text").otherwise("number")
    )


def _cells(lines: DataFrame, file_col: str, text_col: str, extra: Sequence[str] = ()) -> DataFrame:
    """One row per field of each valid line: file, written, value (variant), and the extra columns."""
    rows = lines.select(F.col(file_col).alias("file"), *extra, F.try_parse_json(text_col).alias("v")).where(
        F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT")
    )
    spark = lines.sparkSession
    return rows.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
        "file", *extra, F.col("key").alias("written"), F.col("value")
    )


def field_headers(
    lines: DataFrame, file_col: str, text_col: str, fields: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """file, field, written, rank: the header of each file, folded from all its valid lines.

    written lists the spellings a field has in the file; rank is its type in the lattice. Lines that are null or not a
    JSON object don't count. Lines are reduced to one row per file and spelling where they are read.
    """
    heads = (
        _cells(lines, file_col, text_col).groupBy("file", "written")
        .agg(F.max(_rank(_json_type(F.col("value")))).alias("rank"), F.count_if(_json_type(F.col("value")) == "boolean").alias("_b"),
             F.count_if(_json_type(F.col("value")) == "number").alias("_n"))
        .withColumn("rank", F.when((F.col("_b") > 0) & (F.col("_n") > 0), TYPES["text"]).otherwise(F.col("rank")))
        .withColumn("field", proper_name(F.col("written"), fields))
    )
    # No field has more spellings in a file than the file has keys.
    ranks = F.collect_set("rank")
    return heads.groupBy("file", "field").agg(
        F.concat_ws("\x00", F.array_sort(F.collect_set("written"))).alias("written"),
        F.when(F.array_contains(ranks, 1) & F.array_contains(ranks, 2), TYPES["text"]).otherwise(F.max("rank")).alias("rank"),
    )


def _rank(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv]), kind)


def schema_changes(
    lines: DataFrame, file_col: str = "archivo_id", series_col: str = "serie", order_col: str = "orden", text_col: str = "registro",
    fields: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """series, order, file, field, change: each file against the one before it in its series.

    change is 'agregado', 'quitado', 'renombrado' (spelled differently) or 'tipo' (both have values and their types differ);
    a field may have the last two at once. The first file of a series has no changes. A file none of whose lines is
    valid has no fields. Files without id, series or order are left out; ties in order are broken by id.
    """
    heads = field_headers(lines, file_col, text_col, fields)
    files = lines.select(F.col(file_col).alias("file"), F.col(series_col).alias("series"), F.col(order_col).alias("order")).where(
        "file is not null and series is not null and `order` is not null"
    ).groupBy("file").agg(F.min(F.struct("series", "order")).alias("s")).select("file", "s.series", "s.order")
    place = W.partitionBy("series").orderBy("order", "file")
    files = files.select("file", "series", "order", F.lag("file").over(place).alias("before"), F.lead("file").over(place).alias("after"))
    told = heads.join(files, "file")
    # Each header speaks for its own file and for the comparison of the next one.
    now = told.where("before is not null").select("file", "field", F.lit(1).alias("turn"), "written", "rank")
    was = told.where("after is not null").select(F.col("after").alias("file"), "field", F.lit(0).alias("turn"), "written", "rank")
    at = lambda turn, c: F.max(F.when(F.col("turn") == turn, F.col(c)))
    both = now.unionByName(was).groupBy("file", "field").agg(
        at(0, "written").alias("w0"), at(1, "written").alias("w1"), at(0, "rank").alias("r0"), at(1, "rank").alias("r1")
    )
    changes = F.array(
        F.when(F.col("w0").isNull(), "agregado"),
        F.when(F.col("w1").isNull(), "quitado"),
        F.when(F.col("w0") != F.col("w1"), "renombrado"),
        F.when((F.col("r0") > 0) & (F.col("r1") > 0) & (F.col("r0") != F.col("r1")), "tipo"),
    )
    listed = both.select("file", "field", F.explode(F.array_compact(changes)).alias("change"))
    return listed.join(files.select("file", "series", "order"), "file").select("series", "order", "file", "field", "change")


def spellings(
    lines: DataFrame, file_col: str = "archivo_id", text_col: str = "registro", fields: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """written, field, rule, files: every name fields are written with, what it was taken for and why, and in how many files.

    rule is 'nombre' (the proper name but for case and punctuation), 'lista' (an agreed spelling), 'errata' (taken for a misprint) or
    'propio' (a field of its own).
    """
    names = _cells(lines, file_col, text_col).groupBy("file", "written").agg(F.lit(1).alias("_one"))
    counted = names.groupBy("written").agg(F.count(F.lit(1)).alias("files"))
    m = _meaning(F.col("written"), fields)
    return counted.select("written", F.coalesce(m["field"], F.col("written")).alias("field"), F.coalesce(m["rule"], F.lit("propio")).alias("rule"), "files")


def _readings(text: Column) -> Column:
    """The types of READINGS that a value given as text can be read as, as bits."""
    can = {t: _typed(text, t).isNotNull() for t in READINGS}
    return sum((F.when(c, READINGS[t]).otherwise(0) for t, c in can.items()), F.lit(0))


def union_schema(
    lines: DataFrame, file_col: str = "archivo_id", text_col: str = "registro", fields: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """field, type, files, delivered: the schema that holds every file.

    type is the least column type that all values of the field can be read as; 'void' if none has a value. delivered lists the JSON types
    it came in. Headers are folded where lines are read, then by file, then by field: each fold is a meet in the lattice.
    """
    text = F.try_variant_get("value", "$", "string")
    kind = _json_type(F.col("value"))
    bits = F.bit_and(F.when(kind != "null", _readings(text)))
    by_file = _cells(lines, file_col, text_col).groupBy("file", "written").agg(bits.alias("bits"), F.collect_set(F.when(kind != "null", kind)).alias("kinds"))
    by_field = by_file.groupBy(proper_name(F.col("written"), fields).alias("field")).agg(
        F.bit_and("bits").alias("bits"), F.count_distinct("file").alias("files"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))), ",").alias("delivered"),
    )
    kind_of = F.when(F.col("bits").isNull(), "void")
    for name, bit in READINGS.items():
        kind_of = kind_of.when(F.col("bits").bitwiseAND(F.lit(bit)) != 0, name)
    return by_field.select("field", kind_of.otherwise("string").alias("type"), "files", "delivered")


def unified(
    lines: DataFrame, keep: Sequence[str], file_col: str = "archivo_id", text_col: str = "registro", line_col: str = "linea",
    fields: Mapping[str, Sequence[str]] | None = None, types: Mapping[str, str] | None = None,
) -> DataFrame:
    """keep, the proper fields, and otros: every valid line of every file under one schema, row by row.

    A column has the type that `union_schema` gives its field over all files (string for a field without values), or the one
    named in types; a value that does not fit a named type is null. otros maps all other fields to their values as text, null if there
    are none. Keys of one line that mean the same field: the greatest value that is not null counts.
    """
    fields = fields or aliases()
    if types is None or set(types) < set(fields):
        # One row per proper field.
        folded = union_schema(lines, file_col, text_col, fields).where(F.col("field").isin(list(fields))).select("field", "type").collect()
        types = {r[0]: "string" if r[1] == "void" else r[1] for r in folded} | dict(types or {})
    row = [*dict.fromkeys([file_col, line_col, *keep])]
    rows = lines.select(*row, F.col(text_col).alias("_text"), F.try_parse_json(text_col).alias("_v")).where(
        F.col("_v").isNotNull() & F.schema_of_variant("_v").startswith("OBJECT")
    )
    entries = F.map_entries(F.from_json("_text", "map<string,string>"))
    rows = rows.select(*row, F.transform(entries, lambda e: F.struct(proper_name(e["key"], fields).alias("f"), e["value"].alias("v"))).alias("_e"))
    value = lambda f: F.array_max(F.transform(F.filter("_e", lambda e: e["f"] == f), lambda e: e["v"]))
    rest = F.filter("_e", lambda e: ~e["f"].isin(list(fields)) & e["v"].isNotNull())
    otros = F.map_from_entries(F.transform(rest, lambda e: F.struct(e["f"], e["v"])))
    return rows.select(*row, *[_typed(value(f), types.get(f, "string")).alias(f) for f in fields], F.when(F.size(rest) > 0, otros).alias("otros"))


def _typed(text: Column, kind: str) -> Column:
    if kind == "boolean":
        flat = F.lower(F.trim(text))
        return F.when(flat.isin("true", "t", "1", "s", "si", "sí"), True).when(flat.isin("false", "f", "0", "n", "no"), False)
    if kind == "bigint":
        return F.when(F.trim(text).rlike(r"^[+-]?\d{1,18}$"), F.trim(text).try_cast("bigint"))
    if kind == "double":
        return F.when(F.trim(text).rlike(r"^[+-]?\d+([.,]\d+)?([eE][+-]?\d+)?$"), F.regexp_replace(F.trim(text), ",", ".").try_cast("double"))
    if kind == "date":
        return F.when(F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim(text).try_cast("date"))
    return text
