"""Text functions: folding, keys, slugs, normal forms, token sets, extraction."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and their bases, by Unicode's decompositions; marks that stand alone have none and are dropped.
_MARKED = {c: d[0] for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if len(d := unicodedata.normalize("NFD", c)) > 1 and d[0].isascii()}
ACCENTED = "".join(_MARKED) + "".join(map(chr, range(0x300, 0x370)))
BASES = "".join(_MARKED.values())

#: Words of bodies and the like that some sources write and others do not (fixed values).
NOISE = [
    "SEDAN", "PUERTAS", "PUERTA", "PTAS", "RURAL", "FURGON", "FURGONETA", "PICK", "PICKUP", "CABINA", "TODO", "TERRENO", "COUPE", "HATCHBACK",
    "NUEVO", "NUEVA",
]

#: How `norm` rewrites a text in capitals without accents, in this order (fixed values: names must come out as the sources' own normal form); both engines read these patterns alike.
NORMAL_FORMS: list[tuple[str, str]] = [
    (r"\bPICK *-? *UP\b", " "), (r"\+", " PLUS "), (r" +- +", " "), (r"(\d)[.,](\d) *L\b", r"\1,\2"), (r"(\d)\.(\d)", r"\1,\2"),
    (r"([A-Z])-(\d)", r"\1\2"), (r"(\d)-([A-Z])", r"\1\2"), (r"\b([A-Z]{1,3}) (\d{1,3})([^0-9A-Z_,]|$)", r"\1\2\3"), (r"[^A-Z0-9, /]", " "),
]


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, BASES)


def text_key(c: Column) -> Column:
    """Lower case, no accents, single blanks: for lookups in lists of names."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), r"[^a-z0-9]+", " "))


def slug(*cols: Column) -> Column:
    joined = F.lower(strip_accents(F.concat_ws(" ", *cols)))
    return F.regexp_replace(F.regexp_replace(joined, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def norm(c: Column) -> Column:
    """One spelling for model names: PLUS for +, decimal commas, digits glued to the short codes they belong to, no words of bodies. '' for null."""
    t = F.upper(strip_accents(F.coalesce(c, F.lit(""))))
    for pattern, to in NORMAL_FORMS:
        t = F.regexp_replace(t, pattern, to.replace("\\", "$"))
    return F.array_join(F.filter(F.split(F.trim(t), " +"), lambda w: (w != "") & ~w.isin(NOISE)), " ")


def norm_sql(c: str) -> str:
    """The same in SQL."""
    t = f"upper(strip_accents(coalesce({c}, '')))"
    for pattern, to in NORMAL_FORMS:
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'g')"
    return f"array_to_string(list_filter(string_split(trim({t}), ' '), lambda w: w <> '' AND NOT list_contains({NOISE}, w)), ' ')"


def words_of(c: Column) -> Column:
    """The words of a normal form; none of an empty one."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def brand_key(c: Column) -> Column:
    return F.replace(norm(c), F.lit(" "), F.lit(""))


def strip_brand(description: Column, brand: Column) -> Column:
    """The normal form of a description without the brand in front, word by word."""
    d, b = norm(description), norm(brand)
    led = (b != "") & ((d == b) | F.startswith(d, F.concat(b, F.lit(" "))))
    return F.when(led, F.substring(d, F.length(b) + 2, F.length(d))).otherwise(d)


def strip_brand_sql(description: str, brand: str) -> str:
    d, b = norm_sql(description), norm_sql(brand)
    return f"(SELECT CASE WHEN y <> '' AND (x = y OR starts_with(x, y || ' ')) THEN substring(x, length(y) + 2) ELSE x END FROM (SELECT {d} AS x, {b} AS y))"


def token_set(c: Column, drop: Column | None = None, synonyms: Mapping[str, str] | None = None) -> Column:
    """The distinct words of a text, letters apart from digits, synonyms replaced, without those of `drop`."""
    words = lambda x: F.regexp_extract_all(F.upper(strip_accents(x)), F.lit(r"[A-Z]+|\d+"), F.lit(0))
    tokens = words(c)
    if synonyms:
        known = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])
        tokens = F.transform(tokens, lambda w: F.coalesce(F.try_element_at(known, w), w))
    return F.array_distinct(F.array_except(tokens, words(drop)) if drop is not None else tokens)


def capitalised(c: Column) -> Column:
    """The first letter in upper case, the rest as it is."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substring(c, F.lit(2), F.length(c)))


def has_all_words(text: Column, query: str) -> Column:
    """Every word of the query stands somewhere in the text; case and accents don't count. True for an empty query."""
    folded = F.lower(strip_accents(text))
    words = [F.contains(folded, F.lower(strip_accents(F.lit(w)))) for w in query.split()]
    out = F.lit(True)
    for w in words:
        out = out & w
    return F.coalesce(out, F.lit(False))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null, not empty, if there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def classify(c: Column, rules: Sequence[tuple[str, str]], other: str) -> Column:
    """The label of the first rule whose pattern is found in the text."""
    out = F.when(c.rlike(rules[0][0]), rules[0][1])
    for pattern, label in rules[1:]:
        out = out.when(c.rlike(pattern), label)
    return out.otherwise(other)


def multilabel(c: Column, rules: Sequence[tuple[str, str, str | None]]) -> Column:
    """Labels of all rules (label, must, must not) that hold, sorted."""
    hits = [
        F.when(c.rlike(must) & (~c.rlike(veto) if veto else F.lit(True)), label) for label, must, veto in rules
    ]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))


def years_named(c: Column) -> Column:
    """struct(desde, hasta): the years a title names; an open end is null, and both are if it names none.

    '2010/2015', '98 a 2004', '98-04'; 'desde 98', 'a partir de 2010', '2010 en adelante', '2010>', '2010+'; 'hasta 2015', '<2015'; "mod. 98", "'98"; a
    single year of four digits. The first form that is found counts. Two digits up to 49 are of this century.
    """
    four, any_ = r"(?:19[5-9]|20[0-4])\d", r"(?:(?:19[5-9]|20[0-4])\d|[05-9]\d|[1-4]\d)"
    head, tail = r"(?<![\d.,/-])", r"(?![\d]|[.,]\d)"

    def year(pattern: str, group: int = 1) -> Column:
        n = F.regexp_extract(c, pattern, group).try_cast("int")
        return F.when(n < 50, n + 2000).when(n < 100, n + 1900).otherwise(n)

    span = rf"(?i){head}({any_})\s*(?:/|-|\ba\b|\bal\b|\bhasta\b)\s*({any_}){tail}(?![/-])"
    since = [rf"(?i)(?:\bdesde\b|\ba partir de\b|>)\s*(?:el\s+)?({any_}){tail}", rf"(?i){head}({four})\s*(?:en adelante|>|\+)"]
    until = [rf"(?i)(?:\bhasta\b|<)\s*(?:el\s+)?({any_}){tail}"]
    single = [rf"(?i)\bmod(?:elo|\.)?\s*({any_}){tail}", rf"'({any_}){tail}", rf"{head}({four}){tail}"]
    first, last = year(span), year(span, 2)
    ok = first.isNotNull() & (first <= last)
    low, high, one = (F.coalesce(*[year(p) for p in ps]) for ps in (since, until, single))
    open_ = low.isNotNull() | high.isNotNull()
    return F.struct(
        F.when(ok, first).when(open_, low).otherwise(one).alias("desde"), F.when(ok, last).when(open_, high).otherwise(one).alias("hasta")
    )


def engines_named(c: Column) -> Column:
    """Displacements that a title names, sorted and joined by a slash; null if there is none."""
    found = F.array_sort(F.array_distinct(F.transform(
        F.regexp_extract_all(c, F.lit(r"\b(\d[.,]\d)(?=[\s/]|[lL]\b|$)"), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit("."))
    )))
    return F.nullif(F.array_join(found, "/"), F.lit(""))


def fuel_named(c: Column) -> Column:
    """Kind of drive named in a version text; petrol if nothing else is."""
    t = F.upper(strip_accents(c))
    return (
        F.when(t.rlike(r"\b(HIBRID\w*|HYBRID|HEV|MHEV|PHEV|HYB)\b"), "hibrido").when(t.rlike(r"\b(ELECTRIC\w*|EV|BEV)\b"), "electrico")
        .when(t.rlike(r"\b(DIESEL|TDI|HDI|TDCI|CRDI|DCI|JTD|TD)\b"), "diesel").otherwise("nafta")
    )


def unescape_html(c: Column) -> Column:
    """Text of an HTML fragment: comments and tags dropped, the common entities resolved."""
    t = F.regexp_replace(F.regexp_replace(c, r"(?s)<!--.*?-->", " "), r"<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def money_text(c: Column, symbol: str = "$ ") -> Column:
    """Whole amounts with dots between thousands."""
    return F.concat(F.lit(symbol), F.translate(F.format_number(F.round(c, 0), 0), ",", "."))
