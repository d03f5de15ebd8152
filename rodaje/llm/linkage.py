"""Records of one thing matched across sources that share no key, each pair with a confidence.

Heuristic matching functions vote on each candidate pair: for, against, or not at all. A generative model explains the votes by
an unseen class, match or not: it learns by EM how often each function is right in either class, joins functions whose
votes depend on each other beyond the class into one factor, and yields the posterior of a match. Votes are counted by pattern
first, so fitting sees at most 3^functions rows whatever the number of pairs.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rodaje.operators.skew import salted_join
from rodaje.session import cut

#: The table of marks that version texts name engines and gearboxes by.
MARKS = Path(__file__).resolve().parent / "seeds" / "motores_cajas.csv"

#: A model's name of at least this many letters may be one letter off.
LONG_NAME = 6

#: A trim is a full name if no alike one is this many times as frequent.
OFTEN = 3.0

ACCENTS = ("ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÑÇ", "AAAAAEEEEIIIIOOOOOUUUUNC")


def _flat(text: Column) -> Column:
    t = F.translate(F.upper(F.trim(text)), *ACCENTS)
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\+", " PLUS "), r"\s+", " "))


def marks(path: str | Path = MARKS) -> dict[str, list[str]]:
    """The marks of each kind ('motor', 'caja'), from a table with columns clase and marca."""
    out: dict[str, list[str]] = {"motor": [], "caja": []}
    with open(path, encoding="utf-8", newline="") as f:
        for row in csv.DictReader(f):
            out[row["clase"]].append(row["marca"])
    return out


def described(
    records: DataFrame, id_col: str, brand: str, model: Column, version: Column, year: str, price: Column, known: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """id, brand, name, number, trim, size, engine, gear, year, price: what a record says of its version, null where it is silent.

    model starts with the model's name, which may be followed by the version; version may be null then. known names the marks of engines
    and gearboxes (`marks`).
    """
    t = records.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), _flat(F.col(brand)).alias("brand"), _flat(model).alias("_m"), _flat(version).alias("_v"),
        F.col(year).cast("int").alias("_y"), F.when(price > 0, price.cast("double")).alias("price"),
    )
    led = F.coalesce(F.startswith("_m", F.concat("brand", F.lit(" "))), F.lit(False))
    t = t.withColumn("_m", F.when(led, F.substring("_m", F.length("brand") + 2, F.length("_m"))).otherwise(F.col("_m")))
    t = t.withColumn("_m", F.trim(F.regexp_replace("_m", r"\bPICK\s*-?\s*UP\b", "")))
    head = r"^([A-Z]+?)(?:[ -]?(X\d|\d{1,3}))?(?=\s|$)(.*)$"
    part = lambda c, p, g=1: F.nullif(F.regexp_extract(c, p, g), F.lit(""))
    t = t.select(
        "id", "brand", "price", "_y", part("_m", head).alias("name"), part("_m", head, 2).alias("number"),
        F.concat_ws(" ", part("_m", head, 3), "_v").alias("_r"),
    )
    known = known or marks()
    engines, gears = "|".join(known["motor"]), "|".join(known["caja"])
    size = r"(?:^|\s)(\d)[.,](\d)(?=\s|L\b|$)"
    rest = F.col("_r")
    for pattern in (r"\bAM\d\d[.,]\d\b", size, rf"\b(?:{engines})\b", rf"\b(?:{gears})\d?\b", r"\b[CD]/[SC]\b", r"\b\dP\b", r"\b4X\d\b", r"\bG\d\b", r"\b20\d\d\b", r"(?:^|\s)L\b"):
        rest = F.regexp_replace(rest, pattern, " ")
    return t.select(
        "id", "brand", "name", "number", F.nullif(F.regexp_replace(rest, "[^A-Z0-9]", ""), F.lit("")).alias("trim"),
        F.when(F.regexp_extract("_r", size, 1) != "", F.concat(F.regexp_extract("_r", size, 1), F.lit("."), F.regexp_extract("_r", size, 2))).alias("size"),
        part("_r", rf"\b({engines})\b").alias("engine"), part("_r", rf"\b({gears})\d?\b").alias("gear"),
        F.coalesce(F.col("_y"), part("_r", r"\b(20\d\d)\b").try_cast("int")).alias("year"), "price",
    )


def _abbreviates(short: str, long: str) -> str:
    pattern = f"concat('^', regexp_replace({short}, '(.)', '$1.*'))"
    return f"(length({short}) >= 2 and length({short}) < length({long}) and {long} rlike {pattern})"


def _alike(a: str, b: str) -> str:
    """SQL: two trims are one, by spelling or abbreviation."""
    least = f"least(length({a}), length({b}))"
    close = f"(least(length({a}), length({b})) >= 4 and levenshtein({a}, {b}) <= 1 + int({least} >= 5))"
    return f"({a} = {b} or {close} or {_abbreviates(a, b)} or {_abbreviates(b, a)})"


def full_trims(*sources: DataFrame, often: float = OFTEN, hot: int = 2000) -> DataFrame:
    """trim, full: each trim that is a spelling or an abbreviation of a more frequent one, with that one.

    Trims are counted over all sources. One is compared with those at least `often` times as frequent that begin or end with the same letter;
    full is the best that is itself no variant, an abbreviated name before a misspelt one, the nearest in length, then by alphabet.
    A trim that is alike only to variants takes what its best variant stands for.
    """
    every = reduce(DataFrame.unionByName, [s.select("trim") for s in sources]).where("trim is not null")
    counts = cut(every.groupBy("trim").agg(F.count(F.lit(1)).alias("n")))
    ends = F.explode(F.array_distinct(F.array(F.concat(F.lit("^"), F.left("trim", F.lit(1))), F.concat(F.right("trim", F.lit(1)), F.lit("$")))))
    short = counts.select("trim", "n", ends.alias("end"))
    long = counts.select(F.col("trim").alias("full"), F.col("n").alias("m"), ends.alias("end"))
    score = (
        f"case when {_abbreviates('trim', 'full')} then 1 + (length(full) - length(trim)) / 100.0 "
        f"when {_alike('trim', 'full')} then 1.5 + levenshtein(trim, full) end"
    )
    pairs = salted_join(short, long, ["end"], F.col("m") >= F.col("n") * often, hot=hot).select("trim", "full", F.expr(score).alias("score"))
    pairs = cut(pairs.where("score is not null").distinct())
    best = lambda df: df.groupBy("trim").agg(F.min(F.struct("score", "full")).alias("b")).select("trim", F.col("b.full").alias("full"))
    variants = pairs.select(F.col("trim").alias("full")).distinct()
    direct = best(pairs.join(variants, "full", "left_anti"))
    rest = best(pairs.join(direct.select("trim"), "trim", "left_anti"))
    through = rest.withColumnRenamed("full", "_by").join(direct.select(F.col("trim").alias("_by"), "full"), "_by").select("trim", "full")
    return direct.unionByName(through)


def with_full_trim(records: DataFrame, full: DataFrame) -> DataFrame:
    """trim replaced by the full name `full_trims` gives it; others stay."""
    return records.join(full, "trim", "left").withColumn("trim", F.coalesce("full", "trim")).drop("full")


SIGNATURE = ["brand", "name", "number", "trim", "size", "engine", "gear", "year"]
FUNCTIONS = ["v_brand", "v_number", "v_trim", "v_size", "v_engine", "v_gear", "v_year", "v_price"]


def _vote(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 1).otherwise(-1)


def aligned_names(a: DataFrame, b: DataFrame, hot: int = 2000) -> DataFrame:
    """b with misprinted model names written as in a.

    A name that only b has is taken for one that only a has if both are of one brand, have six or more letters, are one letter apart, and
    neither has another such partner. Names that share a string after dropping at most one letter meet.
    """
    names = lambda df: df.where("name is not null").select("brand", "name").distinct()
    drops = F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.concat(F.left("name", i - 1), F.substring("name", i + 1, F.length("name"))))
    cuts = lambda df, other: (
        names(df).where(F.length("name") >= LONG_NAME).join(names(other).select("name").distinct(), "name", "left_anti")
        .select("brand", "name", F.explode(F.array_distinct(F.concat(F.array("name"), drops))).alias("cut"))
    )
    met = salted_join(cuts(a, b).withColumnRenamed("name", "_a"), cuts(b, a), ["brand", "cut"], F.levenshtein("_a", "name") <= 1, hot=hot)
    met = cut(met.select("brand", "_a", "name").distinct())
    one = lambda c: met.groupBy("brand", c).count().where("count = 1").select("brand", c)
    sole = met.join(one("_a"), ["brand", "_a"]).join(one("name"), ["brand", "name"])
    return b.join(sole, ["brand", "name"], "left").withColumn("name", F.coalesce("_a", "name")).drop("_a")


TEXTS = [f for f in FUNCTIONS if f != "v_price"]


def _signed(records: DataFrame) -> DataFrame:
    return records.where("name is not null").withColumn("sig", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in SIGNATURE]))


def classes(records: DataFrame) -> DataFrame:
    """sig, SIGNATURE, n, price: the records that say the same as one, with their number and the mean of their prices' logarithms, as a price."""
    return records.groupBy("sig", *SIGNATURE).agg(F.count(F.lit(1)).alias("n"), F.exp(F.avg(F.log("price"))).alias("price"))


def class_votes(a: DataFrame, b: DataFrame, hot: int = 2000) -> DataFrame:
    """sig_a, sig_b, name, brand_a, the votes of all functions on the texts, weight, price_a, price_b: all pairs of classes of one model name.

    weight is the number of pairs of records that a pair of classes stands for.
    """
    side = lambda df, s: df.select(F.col("name"), *[F.col(c).alias(f"{c}_{s}") for c in ["sig", *SIGNATURE, "n", "price"] if c != "name"])
    met = salted_join(side(a, "a"), side(b, "b"), ["name"], hot=hot)
    votes = {f"v_{c}": _vote(F.col(f"{c}_a"), F.col(f"{c}_b")) for c in ("brand", "size", "engine", "gear", "year")}
    # A model's number is part of its name: silence on both sides agrees.
    votes["v_number"] = F.when(F.col("number_a").eqNullSafe(F.col("number_b")), 1).otherwise(-1)
    votes["v_trim"] = F.when(F.col("trim_a").isNull() | F.col("trim_b").isNull(), 0).when(F.expr(_alike("trim_a", "trim_b")), 1).otherwise(-1)
    return met.select(
        "sig_a", "sig_b", "name", "brand_a", *[votes[f].alias(f) for f in TEXTS], (F.col("n_a") * F.col("n_b")).alias("weight"), "price_a", "price_b"
    )


class PriceRatio:
    """Votes on prices by the ratio that holds for the model.

    A source may state a fixed part of the price. The ratio of a model is the median over its pairs of classes that agree on trim and
    size or engine, moved to a ratio common among all models if one is near; a model without any is held against all of these.
    How far a price may be off is learned from the same pairs.
    """

    def __init__(self, pairs: DataFrame) -> None:
        ratio = F.log(F.col("price_a") / F.col("price_b")).alias("_ratio")
        agreed = pairs.where("v_trim = 1 and (v_size = 1 or v_engine = 1) and v_size >= 0 and v_engine >= 0").select("name", "brand_a", ratio)
        agreed = agreed.where("_ratio is not null")
        # Bins of 2 % between a hundredth and a hundredfold: at most 461. A common ratio beyond is not looked for.
        near = agreed.where("abs(_ratio) <= 4.6").groupBy(F.round(F.col("_ratio") / 0.02).cast("int").alias("k")).count()
        bins = {int(r["k"]): int(r["count"]) for r in near.collect()}
        total = sum(bins.values())
        around = {k: bins.get(k - 1, 0) + bins[k] + bins.get(k + 1, 0) for k in bins}
        peaks = [k for k in around if around[k] >= 0.1 * total and all(around[k] >= around.get(k + d, 0) for d in (-2, -1, 1, 2))]
        self.modes = [sum((k + d) * bins.get(k + d, 0) for d in (-1, 0, 1)) / around[k] * 0.02 for k in peaks] or [0.0]
        self.own = cut(agreed.groupBy("name", "brand_a").agg(F.percentile_approx("_ratio", 0.5).alias("_own")))
        usual = agreed.select(F.percentile_approx(self._nearest(F.col("_ratio")), 0.5)).first()[0]
        self.most = max(0.02, 6 * (usual or 0.0))

    def _nearest(self, ratio: Column) -> Column:
        return F.array_min(F.array(*[F.abs(ratio - m) for m in self.modes]))

    def votes(self, pairs: DataFrame) -> DataFrame:
        """pairs with v_price; without name and brand_a."""
        ratio = F.log(F.col("price_a") / F.col("price_b"))
        snapped = F.array_min(F.array(*[F.struct(F.abs(F.col("_own") - m).alias("d"), F.lit(m).alias("m")) for m in self.modes]))
        held = F.when(snapped["d"] <= 0.06, snapped["m"]).otherwise(F.col("_own"))
        off = F.when(F.col("_own").isNotNull(), F.abs(ratio - held)).otherwise(self._nearest(ratio))
        own = self.own
        known = pairs.join(own, (pairs["name"] == own["name"]) & pairs["brand_a"].eqNullSafe(own["brand_a"]), "left").select(pairs["*"], "_own")
        vote = F.when(off.isNull(), 0).when(off <= self.most, 1).otherwise(-1)
        return known.withColumn("v_price", vote).drop("_own", "name", "brand_a", "price_a", "price_b")


class LabelModel:
    """A two-class generative model of votes in {-1, 0, 1}, with factors over one or two functions."""

    def __init__(self, functions: Sequence[str], rounds: int = 200, smooth: float = 0.5, dependent: float = 0.02) -> None:
        self.functions, self.rounds, self.smooth, self.dependent = list(functions), rounds, smooth, dependent

    def fit(self, patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
        """patterns: one row per distinct vote; counts: its number of pairs."""
        against, for_ = (patterns < 0).sum(axis=1), (patterns > 0).sum(axis=1)
        post = np.where(against == 0, 0.5 + 0.45 * for_ / max(1, len(self.functions)), 0.05)
        self.factors = [[i] for i in range(len(self.functions))]
        post = self._em(patterns, counts, post)
        pairs = sorted(
            ((self._information(patterns, counts, post, i, j), i, j) for i in range(len(self.functions)) for j in range(i)),
            reverse=True,
        )
        free = set(range(len(self.functions)))
        joined = []
        for gain, i, j in pairs:
            if gain > self.dependent and {i, j} <= free:
                joined.append([i, j])
                free -= {i, j}
        if joined:
            self.factors = [*joined, *[[i] for i in sorted(free)]]
            post = self._em(patterns, counts, post)
        return self

    def _codes(self, patterns: np.ndarray, factor: list[int]) -> np.ndarray:
        code = np.zeros(len(patterns), dtype=int)
        for i in factor:
            code = code * 3 + patterns[:, i] + 1
        return code

    def _em(self, patterns: np.ndarray, counts: np.ndarray, post: np.ndarray) -> np.ndarray:
        codes = [self._codes(patterns, f) for f in self.factors]
        for _ in range(self.rounds):
            weights = np.stack([counts * (1 - post), counts * post])
            self.prior = (weights.sum(axis=1) + self.smooth) / (counts.sum() + 2 * self.smooth)
            self.tables = []
            for f, c in zip(self.factors, codes):
                size = 3 ** len(f)
                t = np.stack([np.bincount(c, weights=w, minlength=size) for w in weights]) + self.smooth
                self.tables.append(t / t.sum(axis=1, keepdims=True))
            before, post = post, self.posterior(patterns)
            if np.abs(before - post).max() < 1e-6:
                break
        return post

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        log = np.log(self.prior)[:, None] + sum(np.log(t[:, self._codes(patterns, f)]) for t, f in zip(self.tables, self.factors))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))

    def _information(self, patterns: np.ndarray, counts: np.ndarray, post: np.ndarray, i: int, j: int) -> float:
        """How much two functions' votes tell of each other once the class is known, in nats."""
        gain = 0.0
        for w in (counts * post, counts * (1 - post)):
            if w.sum() <= 0:
                continue
            p = np.bincount(self._codes(patterns, [i, j]), weights=w, minlength=9).reshape(3, 3) / w.sum()
            q = p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)
            ok = p > 0
            gain += w.sum() / counts.sum() * float((p[ok] * np.log(p[ok] / q[ok])).sum())
        return gain


class Linkage:
    """The pairs of two tables made by `described`, and the model that tells how sure each is.

    Records that say the same are one class. All pairs of classes of one model name are voted on and fitted, each counted as
    often as it stands for pairs of records. Records without a model name match nothing.
    """

    def __init__(self, a: DataFrame, b: DataFrame, hot: int = 2000) -> None:
        a, b = cut(a.distinct()), cut(b.distinct())
        b = aligned_names(a, b, hot)
        full = cut(full_trims(a, b, hot=hot))
        self.hot, self.a, self.b = hot, cut(_signed(with_full_trim(a, full))), cut(_signed(with_full_trim(b, full)))
        self.met = cut(class_votes(classes(self.a), classes(self.b), hot))
        self.ratio = PriceRatio(self.met)
        rows = self.ratio.votes(self.met).groupBy(*FUNCTIONS).agg(F.sum("weight").alias("n")).collect()
        self.patterns = np.array([[r[f] for f in FUNCTIONS] for r in rows], dtype=int).reshape(-1, len(FUNCTIONS))
        self.model = LabelModel(FUNCTIONS).fit(self.patterns, np.array([r["n"] for r in rows], dtype=float)) if len(rows) else None

    def _told(self, patterns: np.ndarray) -> DataFrame:
        post = self.model.posterior(patterns) if self.model else []
        schema = ", ".join(f"{f} int" for f in FUNCTIONS) + ", confidence double"
        return self.a.sparkSession.createDataFrame([(*map(int, p), float(q)) for p, q in zip(patterns, post)], schema)

    def _every_price(self) -> np.ndarray:
        texts = np.unique(self.patterns[:, :-1], axis=0)
        return np.column_stack([np.repeat(texts, 3, axis=0), np.tile([-1, 0, 1], len(texts))])

    def pairs(self, least: float = 0.5) -> DataFrame:
        """id_a, id_b, confidence: the pairs of records with a confidence of at least `least`.

        Pairs of classes that could not reach it with any price are not written out. Repeated rows count once; of records of
        one id that differ the greater confidence counts. With no candidate at all the result is empty.
        """
        told = self._told(self._every_price())
        open_ = told.groupBy(*TEXTS).agg(F.max("confidence").alias("_c")).where(F.col("_c") >= least).drop("_c")
        classed = self.met.join(F.broadcast(open_), TEXTS).select("sig_a", "sig_b", "name", "brand_a", *TEXTS)
        left = self.a.select(F.col("sig").alias("sig_a"), F.col("id").alias("id_a"), F.col("price").alias("price_a"))
        right = self.b.select(F.col("sig").alias("sig_b"), F.col("id").alias("id_b"), F.col("price").alias("price_b"))
        half = salted_join(left, classed, ["sig_a"], hot=self.hot)
        voted = self.ratio.votes(salted_join(half, right, ["sig_b"], hot=self.hot))
        sure = voted.join(F.broadcast(told), FUNCTIONS).where(F.col("confidence") >= least)
        return sure.groupBy("id_a", "id_b").agg(F.max("confidence").alias("confidence"))

    def class_pairs(self) -> DataFrame:
        """sig_a, sig_b, the votes, weight, confidence: every pair of classes of one model name."""
        return self.ratio.votes(self.met).join(F.broadcast(self._told(self._every_price())), FUNCTIONS)

    def members(self) -> DataFrame:
        """source ('a' or 'b'), id, sig: the class of each record that names a model."""
        one = lambda df, s: df.select(F.lit(s).alias("source"), "id", "sig").distinct()
        return one(self.a, "a").unionByName(one(self.b, "b"))


def versions(matching: DataFrame, guide: DataFrame) -> Linkage:
    """The new-car lists of the registry (a) and the price guide (b)."""
    nothing = F.lit(None).cast("string")
    a = described(matching, "registro_id", "marca", F.col("descripcion"), nothing, "anio", F.col("valor_fiscal"))
    b = described(guide, "guia_id", "marca", F.col("cca_modelo"), F.col("cca_version"), "anio", F.col("precio_miles") * 1000)
    return Linkage(a, b)
