"""Names of a catalogue found in descriptions: as their first words, anywhere in a title, or as a set of words.

Every join is one of equal keys (a run of words, a rare word); equal texts are looked up once and joined back by their value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: An alias with this target says that the text names no entry of the catalogue.
NO_ENTRY = "(sin familia)"


def _run(words: Column, start: Column | int, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def _marked(words: Column) -> Column:
    """Words with digits as '#': a word may go on after the digits of the catalogue's one."""
    return F.transform(words, lambda w: F.when(w.rlike(r"\d"), "#").otherwise(w))


def prefix_candidates(left: DataFrame, catalogue: DataFrame, key: str, words: str, name: str, name_words: str) -> DataFrame:
    """left with candidatos: all catalogue names of the same key whose words begin the row's words, those with most words.

    A catalogue word with a digit also fits a longer word that begins with it. Several names are tied; they are listed shortest first,
    then by alphabet. Without any the list is empty. The first words of a row are joined to the names by equality, words with digits
    masked, and then compared word by word.
    """
    names = catalogue.where(F.size(name_words) > 0).select(key, F.col(name).alias("_name"), F.col(name_words).alias("_words")).distinct()
    names = names.withColumn("_p", _run(_marked(F.col("_words")), 1, F.size("_words")))
    texts = left.select(key, words).where(F.col(key).isNotNull() & (F.size(words) > 0)).distinct()
    longest = names.groupBy(key).agg(F.max(F.size("_words")).alias("_most"))
    texts = texts.join(longest, key)
    firsts = F.transform(F.sequence(F.lit(1), F.least(F.size(words), "_most")), lambda n: _run(_marked(F.col(words)), 1, n))
    fits = F.forall(
        F.zip_with(F.slice(words, 1, F.size("_words")), F.col("_words"), lambda a, b: (a == b) | (b.rlike(r"\d") & F.startswith(a, b))), lambda ok: ok
    )
    met = texts.withColumn("_p", F.explode(firsts)).join(names, [key, "_p"]).where(fits)
    best = met.groupBy(key, words).agg(F.max(F.size("_words")).alias("_k"), F.collect_set(F.struct(F.size("_words").alias("k"), F.length("_name").alias("n"), F.col("_name").alias("name"))).alias("_all"))
    best = best.select(
        F.col(key).alias("_key"), F.col(words).alias("_w"),
        F.transform(F.array_sort(F.filter("_all", lambda x: x["k"] == F.col("_k"))), lambda x: x["name"]).alias("candidatos"),
    )
    none = F.array().cast("array<string>")
    return left.join(best, (F.col(key) == F.col("_key")) & (F.col(words) == F.col("_w")), "left").select(*left.columns, F.coalesce("candidatos", none).alias("candidatos"))


def model_match(left: DataFrame, catalogue: DataFrame, aliases: DataFrame, key: str, words: str, name: str, name_words: str) -> DataFrame:
    """left with modelo, metodo and candidatos: the catalogue name a description begins with, unless an alias says otherwise.

    aliases has the key, alias_words and target. The longest alias whose words begin the row's counts: target '(sin familia)' leaves
    the row without a name ('excluido'), a name of the catalogue is taken ('alias'), any other target is passed over. Else the first candidate is
    taken, as 'prefijo' or, among several, 'prefijo_ambiguo'; metodo is null without one. candidatos is null unless there are several.
    """
    texts = left.select(key, words).where(F.col(key).isNotNull() & (F.size(words) > 0)).distinct()
    known = aliases.where(F.size("alias_words") > 0).select(key, F.array_join("alias_words", " ").alias("_p"), F.size("alias_words").alias("_k"), F.col("target"))
    firsts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: _run(F.col(words), 1, n))
    told = texts.withColumn("_p", F.explode(firsts)).join(known, [key, "_p"]).groupBy(key, words).agg(F.min(F.struct((-F.col("_k")).alias("k"), "target")).alias("_a"))
    names = catalogue.select(key, F.col(name).alias("target"), F.lit(True).alias("_known")).distinct()
    told = told.select(F.col(key), F.col(words).alias("_aw"), F.col("_a.target").alias("target")).join(names, [key, "target"], "left")
    told = told.select(F.col(key).alias("_ak"), "_aw", F.col("target").alias("_target"), "_known")
    rows = prefix_candidates(left, catalogue, key, words, name, name_words)
    rows = rows.join(told, (F.col(key) == F.col("_ak")) & (F.col(words) == F.col("_aw")), "left")
    out, by_alias, n = F.coalesce(F.col("_target") == NO_ENTRY, F.lit(False)), F.coalesce("_known", F.lit(False)), F.size("candidatos")
    return rows.select(
        *left.columns,
        F.when(out, None).when(by_alias, F.col("_target")).otherwise(F.get("candidatos", 0)).alias("modelo"),
        F.when(out, "excluido").when(by_alias, "alias").when(n == 1, "prefijo").when(n > 1, "prefijo_ambiguo").alias("metodo"),
        F.when(~out & ~by_alias & (n > 1), F.array_join("candidatos", " | ")).alias("candidatos"),
    )


def _uncovered(hits: DataFrame, keys: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """hits (keys, start, length, rest) that lie in no longer one of the same keys; equal places stand or fall together."""
    places = hits.groupBy(*keys, "start", "length").agg(F.collect_set(F.struct(*rest)).alias("_r"))
    before = W.partitionBy(*keys).orderBy("start", F.desc("length")).rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    kept = places.withColumn("_upto", F.max(end).over(before)).where("_upto is null or _upto < start + length")
    return kept.select(*keys, "start", "length", F.explode("_r").alias("_r")).select(*keys, "start", "length", "_r.*")


def ngram_hits(texts: DataFrame, names: DataFrame, id_col: str, words: str, name_words: str, longest: int = 6) -> DataFrame:
    """id_col, start, length and the names' columns: where a name's words stand side by side in a text.

    The runs of up to `longest` words of each text meet the names by equality.
    """
    n = F.size(words)
    runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), n - i + 1)), lambda k: F.struct(i.alias("start"), k.alias("length"), _run(F.col(words), i, k).alias("_run")),
    )))
    spread = texts.where(n > 0).select(id_col, F.explode(runs).alias("r")).select(id_col, "r.*")
    wanted = names.where(F.size(name_words) > 0).withColumn("_run", F.array_join(name_words, " ")).drop(name_words).distinct()
    return spread.join(wanted, "_run").drop("_run")


def ngram_match(texts: DataFrame, names: DataFrame, id_col: str, words: str, name: str, name_words: str, longest: int = 6) -> DataFrame:
    """id_col, start, length, name: names whose words stand side by side in the text; those inside a longer hit are dropped."""
    hits = ngram_hits(texts, names.select(F.col(name).alias("name"), name_words), id_col, words, name_words, longest)
    return _uncovered(hits, [id_col], ["name"])


def title_mentions(
    titles: DataFrame, catalogue: DataFrame, id_col: str, words: str, key: str, name: str, name_words: str, not_names: Sequence[str] = (), longest: int = 6
) -> DataFrame:
    """id_col, key, name, metodo: the catalogue names a title mentions.

    A title of a known key is searched for the names of that key ('marca'). A title that has none of them, or no key, is searched for the names
    that stand under one key only and cannot be mistaken: not a single word of `not_names`, and with a word of four characters or more that has three
    letters ('unico'). In either way, names inside a longer one are dropped.
    """
    cat = catalogue.select(F.col(key).alias("_key"), F.col(name).alias("name"), F.col(name_words).alias("_nw")).distinct()
    letters = lambda w: F.length(F.regexp_replace(w, "[^A-Za-z]", ""))
    telling = F.exists("_nw", lambda w: (F.length(w) >= 4) & (letters(w) >= 3))
    plain = ~((F.size("_nw") == 1) & F.col("_nw")[0].isin(*not_names)) if not_names else F.lit(True)
    sole = cat.where(telling & plain).join(cat.groupBy("_nw").agg(F.count_distinct("_key").alias("_n")).where("_n = 1").select("_nw"), "_nw", "left_semi").select("_nw", F.lit(True).alias("_sole")).distinct()
    cat = cat.join(sole, "_nw", "left").withColumn("_sole", F.coalesce("_sole", F.lit(False)))
    hits = ngram_hits(titles.select(id_col, words), cat, id_col, words, "_nw", longest)
    hits = hits.join(titles.select(id_col, F.col(key).alias("_own")).distinct(), id_col)
    own = _uncovered(hits.where("_own = _key"), [id_col], ["_key", "name"]).select(id_col, "_key", "name", F.lit("marca").alias("metodo"))
    other = _uncovered(hits.where("_sole"), [id_col], ["_key", "name"]).join(own.select(id_col), id_col, "left_anti")
    return own.unionByName(other.select(id_col, "_key", "name", F.lit("unico").alias("metodo"))).distinct().withColumnRenamed("_key", key).withColumnRenamed("name", name)


def subset_match(left: DataFrame, right: DataFrame, keys: Sequence[str], left_words: str, right_words: str) -> DataFrame:
    """Pairs of equal keys where every word of the left set is in the right one.

    A left set is joined to the right rows that have its rarest word, counted among the right rows of its keys. Empty and null sets, and null
    keys, match nothing.
    """
    keys = list(keys)
    sets = left.select(*keys, left_words).where(F.size(left_words) > 0).distinct()
    posted = right.withColumn("_w", F.explode(F.array_distinct(right_words)))
    counts = posted.groupBy(*keys, "_w").agg(F.count(F.lit(1)).alias("_n"))
    rare = (
        sets.withColumn("_w", F.explode(left_words)).join(counts, [*keys, "_w"], "left")
        .groupBy(*keys, left_words).agg(F.min(F.struct(F.coalesce("_n", F.lit(0).cast("long")).alias("n"), F.col("_w").alias("w"))).alias("_r"))
        .where("_r.n > 0").select(*keys, left_words, F.col("_r.w").alias("_w"))
    )
    met = rare.join(posted, [*keys, "_w"]).where(F.size(F.array_except(left_words, right_words)) == 0).drop("_w")
    return left.join(met, [*keys, left_words])
