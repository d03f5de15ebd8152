"""Free texts mapped to the entries of a reference list by a prefix-filtered set-similarity join.

A text is the set of its runs of two letters, repeated runs numbered. Sets are ordered by global rarity, rarest first; two sets of Jaccard
similarity t or more must share a member among their first |x| - ceil(t |x|) + 1, so only these prefixes are joined.
Lengths and positions bound the overlap before it is computed exactly.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rodaje.operators.skew import salted_join
from rodaje.session import cut

#: The table of other words for the entries of the list of characteristics.
WORDINGS = Path(__file__).resolve().parent / "seeds" / "otras_palabras.csv"

ACCENTS = ("áàâãäéèêëíìîïóòôõöúùûüñç", "aaaaaeeeeiiiiooooouuuunc")


def plain(text: Column) -> Column:
    """Lower case without accents and without remarks such as '(según versión)', '/ opcional', '- de serie', '*', '(1)'."""
    t = F.translate(F.lower(text), *ACCENTS)
    t = F.regexp_replace(t, r"\(\s*segun version\s*\)|-\s*de serie\b|/\s*opcional\b|\bnuevo\b|\(\d\)|[*•]", " ")
    t = F.regexp_replace(t, r"\bd/\s*", "de ")
    t = F.regexp_replace(t, r"\belec\.\s*(o|a|os|as)\b", "electric$1")
    return F.regexp_replace(t, r"\bsist\.", "sistema ")


def parts_of(text: Column) -> Column:
    """The parts of a text that names several things, as bare letters; every number is written 9."""
    pieces = F.split(plain(text), r"\s+y\s+|\s*[+|;]\s*")
    bare = lambda p: F.regexp_replace(
        F.regexp_replace(F.regexp_replace(p, r"^[\s\-.]*(con|incluye)\s+", ""), r"\d+", "9"), "[^a-z0-9]", ""
    )
    return F.filter(F.transform(pieces, bare), lambda p: p != "")


def grams(bare: Column, q: int = 2) -> Column:
    """The runs of q neighbouring letters, with the ends marked and a run's repetitions numbered, in no order; none of a text shorter than q - 2."""
    padded = F.concat(F.lit("^"), bare, F.lit("$"))
    starts = F.when(F.length(padded) >= q, F.sequence(F.lit(1), F.length(padded) - (q - 1)))
    runs = F.array_sort(F.transform(starts, lambda i: F.substring(padded, i, F.lit(q))))
    # In sorted order a run's repetitions follow its first place. The runs are bound by a lambda, to be made once and not per element.
    number = lambda r: F.transform(r, lambda x, i: F.concat(x, (i + 1 - F.array_position(r, x)).cast("string")))
    return F.transform(F.array(runs), number)[0]


def set_join(left: DataFrame, right: DataFrame, threshold: float, hot: int = 20_000) -> DataFrame:
    """l, r, jaccard: all pairs of rows whose sets are at least `threshold` similar.

    Both sides have columns key and members (an array of distinct strings). Members are told apart by 64 bits of hash. Rarity is counted over
    both sides. Rare members that still stand in more than `hot` prefixes are split. Null and empty sets match nothing; keys are expected once each.
    """
    hashed = lambda df: df.select("key", F.explode("members").alias("_m")).select("key", F.xxhash64("_m").alias("m"))
    exploded = {"l": hashed(left), "r": hashed(right)}
    rarity = exploded["l"].unionByName(exploded["r"]).groupBy("m").agg(F.count(F.lit(1)).alias("n"))

    def prefixes(side: str) -> DataFrame:
        ordered = (
            exploded[side].join(rarity, "m").groupBy("key")
            .agg(F.array_sort(F.collect_list(F.struct("n", "m"))).alias("o"))
            .select(F.col("key").alias(side), F.transform("o", lambda x: x["m"]).alias(f"{side}_set"))
        )
        size = F.size(f"{side}_set")
        keep = (size - F.ceil(F.lit(threshold) * size - F.lit(1e-9)) + 1).cast("int")
        return ordered.select("*", F.posexplode(F.slice(f"{side}_set", F.lit(1), keep)).alias(f"{side}_pos", "m"))

    # Written once: the join counts the left prefixes before it deals them.
    met = salted_join(cut(prefixes("l")), cut(prefixes("r")), ["m"], hot=hot, spread=["l"])
    a, b = F.size("l_set"), F.size("r_set")
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (a + b) - F.lit(1e-9))
    lengths = (a >= b * threshold - 1e-9) & (b >= a * threshold - 1e-9)
    positions = 1 + F.least(a - F.col("l_pos") - 1, b - F.col("r_pos") - 1) >= need
    # Pairs meet once per common prefix member; the first one stands for all. Its position bounds the overlap.
    before = lambda s: F.slice(f"{s}_set", F.lit(1), F.col(f"{s}_pos"))
    common = F.size(F.array_intersect("l_set", "r_set"))
    out = met.where(lengths & positions & ~F.arrays_overlap(before("l"), before("r"))).withColumn("jaccard", common / (a + b - common))
    return out.where(F.col("jaccard") >= threshold - 1e-9).select("l", "r", "jaccard")


def closest(values: DataFrame, reference: DataFrame, threshold: float = 0.25) -> DataFrame:
    """bare, entry, distance, jaccard: for each distinct value the reference text it is a spelling of, if there is one.

    values has a column bare, reference has bare and entry. A value may be off by three tenths of the longer text's
    length, two edits at least, half the length at most. An edit changes two runs of two letters, so texts of up to n letters that
    are e edits apart have a similarity of (n + 1 - 2 e) / (n + 1 + 2 e) or more: 0.25 at the default from six letters on; texts of
    four or five letters two edits apart may fall short of it. Of the pairs that the set join finds, those beyond these edits are
    dropped, and of the others the most similar counts, then the one with fewest edits, then the least entry.
    """
    left = cut(values.select("bare").where("bare <> ''").distinct())
    right = cut(reference.select("bare", "entry").where("bare <> ''").groupBy("bare").agg(F.min("entry").alias("entry")))
    # Written once: members are counted first and ordered then.
    sets = lambda df: cut(df.select(F.col("bare").alias("key"), grams(F.col("bare")).alias("members")))
    length = F.greatest(F.length("l"), F.length("r"))
    near = set_join(sets(left), sets(right), threshold).withColumn("edits", F.levenshtein("l", "r")).where(
        (F.col("edits") <= F.greatest(F.lit(2), F.floor(length * 3 / 10).cast("int"))) & (F.col("edits") * 2 <= length)
    )
    near = near.join(right.withColumnRenamed("bare", "r"), "r")
    best = near.groupBy("l").agg(F.min(F.struct((-F.col("jaccard")).alias("j"), F.col("edits"), F.col("entry"))).alias("b"), F.max(length).alias("n"))
    best = best.select(F.col("l").alias("bare"), F.col("b.entry").alias("entry"), (F.col("b.edits") / F.col("n")).alias("distance"), (-F.col("b.j")).alias("jaccard"))
    return cut(best)


def wordings(spark: SparkSession, path: str | Path = WORDINGS) -> DataFrame:
    """entry, text: other words for entries, from a small table with columns caracteristica_id and texto. In it digits stand for any number."""
    with open(path, encoding="utf-8", newline="") as f:
        rows = [(r["caracteristica_id"], r["texto"]) for r in csv.DictReader(f)]
    return spark.createDataFrame(rows, "entry string, text string")


def reference_list(entries: DataFrame, other: DataFrame | None = None, id_col: str = "caracteristica_id", name_col: str = "nombre") -> DataFrame:
    """bare, entry, parts: the entries' names, and other words for them (entry, text), in the form values are compared in.

    Words for an entry that the list does not have are left out, and so are null names.
    """
    known = entries.select(F.col(id_col).alias("entry"), F.col(name_col).alias("text"))
    if other is not None:
        known = known.unionByName(other.select("entry", "text").join(known.select("entry").distinct(), "entry", "left_semi"))
    parts = parts_of(F.col("text"))
    return known.where("entry is not null and text is not null").select(F.array_join(parts, "").alias("bare"), "entry", F.size(parts).alias("parts"))


def named_entries(
    items: DataFrame, reference: DataFrame, id_col: str = "item_id", text_col: str = "item", none: str = "ninguna", threshold: float = 0.25
) -> DataFrame:
    """id_col, entry: each entry that a text names, or one row with `none`.

    A text may join several names by 'y', '+', '|' or ';'. Every run of its parts as long as the reference list has names
    of is looked up; runs are then taken most similar first, longer first, none of them overlapping. Equal texts are looked up
    once. Null, empty and unmatched texts name none; rows without an id are left out, repeated rows count once.
    """
    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = rows.select("_text").where("_text is not null").distinct().select("_text", parts_of(F.col("_text")).alias("parts")).where(F.size("parts") > 0)
    longest = reference.agg(F.max("parts")).first()[0] or 0
    n = F.size("parts")
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.transform(
                F.sequence(i + 1, F.least(n, i + F.lit(longest))),
                lambda j: F.struct(i.alias("start"), j.alias("stop"), F.array_join(F.slice("parts", i + 1, j - i), "").alias("bare")),
            ),
        )
    )
    # Written once: the texts are parsed here and read by every step of the join.
    looked = cut(texts.select("_text", F.explode(runs).alias("run")).select("_text", "run.*"))
    hits = looked.join(closest(looked, reference, threshold), "bare")
    # Taken most similar first: a run is kept if no kept run overlaps it.
    ranked = hits.groupBy("_text").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("jaccard")).alias("j"), (F.col("start") - F.col("stop")).alias("width"), "distance", "start", "stop", "entry"))).alias("h")
    )
    kind = ranked.schema["h"].dataType.simpleString()
    kept = F.aggregate(
        "h", F.expr(f"cast(array() as {kind})"),
        lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"])), acc).otherwise(F.array_append(acc, x)),
    )
    named = ranked.select("_text", F.explode(F.array_distinct(F.transform(kept, lambda x: x["entry"]))).alias("entry"))
    found = rows.join(named, "_text").select("_id", "entry").distinct()
    rest = rows.select("_id").distinct().join(found.select("_id").distinct(), "_id", "left_anti").select("_id", F.lit(none).alias("entry"))
    return found.unionByName(rest).withColumnRenamed("_id", id_col)
