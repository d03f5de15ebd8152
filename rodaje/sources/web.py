"""Rules of polite reading: robots.txt and the mapping of files to stored assets. No network."""

from __future__ import annotations

import re
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def robots_allow(url: str, robots: str, agent: str = "*") -> bool:
    """Whether a robots.txt lets an agent read a URL.

    The group that names the agent counts, else that of '*'. The longest matching rule wins and Allow wins ties; '*' stands for any
    characters and a final '$' for the end. An empty Disallow forbids nothing.
    """
    groups: list[tuple[set[str], list[tuple[bool, str]]]] = []
    names: set[str] = set()
    rules: list[tuple[bool, str]] = []
    for line in robots.splitlines():
        field, sep, value = line.split("#", 1)[0].partition(":")
        field, value = field.strip().lower(), value.strip()
        if not sep:
            continue
        if field == "user-agent":
            if rules or not names:
                names, rules = set(), []
                groups.append((names, rules))
            names.add(value.lower())
        elif field in ("allow", "disallow") and names:
            rules.append((field == "allow", value))
    own = [r for n, r in groups if agent.lower() in n and agent != "*"] or [r for n, r in groups if "*" in n]
    parts = urlsplit(url)
    path = unquote(parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    best = (-1, True)
    for allow, pattern in (rule for group in own for rule in group):
        if pattern and re.match(".*".join(map(re.escape, unquote(pattern.rstrip("$")).split("*"))) + ("$" if pattern.endswith("$") else ""), path):
            best = max(best, (len(pattern), allow))
    return best[1]


def asset_name(path: str) -> str:
    """A flat, reversible name for a relative path."""
    return quote(path, safe="/").replace("_", "%5F").replace("/", "__")


def path_of_asset(name: str) -> str:
    return unquote(name.replace("__", "/"))


def allowed(url: Column, robots: str, agent: str = "*") -> Column:
    """Whether one robots.txt lets an agent read each URL, by Arrow batches; a null URL is not."""

    def check(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: u is not None and robots_allow(u, robots, agent)).astype(bool)

    return F.pandas_udf(check, "boolean")(url)


def asset_name_of(path: Column) -> Column:
    """`asset_name` as a column: percent signs, underscores and slashes written so that the name is flat and leads back."""
    marked = F.replace(F.replace(path, F.lit("%"), F.lit("%25")), F.lit("_"), F.lit("%5F"))
    return F.replace(marked, F.lit("/"), F.lit("__"))


def path_of(name: Column) -> Column:
    """The path an `asset_name_of` came from."""
    flat = F.replace(F.replace(name, F.lit("__"), F.lit("/")), F.lit("%5F"), F.lit("_"))
    return F.replace(flat, F.lit("%25"), F.lit("%"))


def manifest(spark: SparkSession, pattern: str) -> DataFrame:
    """path, length, sha of the files of a glob; each file is hashed where it is read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", "length", F.sha2("content", 256).alias("sha"))


def sync_plan(here: DataFrame, stored: DataFrame, path: str, sha: str) -> DataFrame:
    """path, action ('subir', 'borrar', 'igual' or 'reemplazar'): what makes a store like a folder, by two manifests. A hash that is null is equal to none."""
    a, b = here.select(path, F.col(sha).alias("_a"), F.lit(1).alias("_here")), stored.select(path, F.col(sha).alias("_b"), F.lit(1).alias("_there"))
    action = F.when(F.col("_there").isNull(), "subir").when(F.col("_here").isNull(), "borrar").when(F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)), "igual").otherwise("reemplazar")
    return a.join(b, path, "full").select(path, action.alias("action"))
