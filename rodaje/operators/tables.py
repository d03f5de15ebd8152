"""Small table operators: ranks, schedules, expansions, distinguishing marks, label scores, plans on a cycle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def expand_cells(df: DataFrame, label: str, cells: str, sep: str = "|", tick: str = "x") -> DataFrame:
    """One row per stacked cell of a sheet: the label's lines and the cells' lines are paired, one cell serves all lines of its label.

    A blank takes the cell before it, a tick means 'si', and what is unknown ('?') is null. Rows without label are left out.
    """
    labels, values = F.split(label, "\n"), F.split(F.coalesce(cells, F.lit("")), "\n")
    own = F.when(F.size(values) >= F.size(labels), values).otherwise(F.array_repeat(values[0], F.size(labels)))
    lines = F.posexplode(F.arrays_zip(labels.alias("etiqueta"), F.slice(own, F.lit(1), F.size(labels)).alias("celda")))
    rows = df.where(F.col(label).isNotNull()).withColumn("_row", F.monotonically_increasing_id()).select("*", lines.alias("linea", "_l"))
    cols = rows.select("*", F.posexplode(F.split(F.col("_l.celda"), F.lit("\\" + sep))).alias("columna", "_v"))
    text = F.nullif(F.trim("_v"), F.lit(""))
    filled = F.last(text, ignorenulls=True).over(W.partitionBy("_row", "linea").orderBy("columna").rowsBetween(W.unboundedPreceding, W.currentRow))
    value = F.when(F.lower(filled) == tick, "si").when(filled == "?", F.lit(None)).otherwise(filled)
    return cols.withColumn("valor", value).withColumn("etiqueta", F.trim(F.col("_l.etiqueta"))).drop("_row", "_l", "_v")


def distinguishing(df: DataFrame, group: Sequence[str], version: str, attribute: str, value: str) -> DataFrame:
    """group, attribute: the first attribute (by name) whose values tell all versions of the group apart; none if there is none."""
    sizes = df.groupBy(*group).agg(F.count_distinct(version).alias("_n"))
    per = df.groupBy(*group, attribute).agg(F.count_distinct(value).alias("_d"), F.count_distinct(version).alias("_m"))
    told = per.join(sizes, list(group)).where("_d = _n and _m = _n and _n > 1")
    return told.groupBy(*group).agg(F.min(attribute).alias(attribute))


def schedule(df: DataFrame, years: int, yearly: Column, once: Column, every: int) -> DataFrame:
    """df with anio 1..years and acumulado: what has been spent by then, `once` again after each `every` years."""
    rows = df.withColumn("anio", F.explode(F.sequence(F.lit(1), F.lit(years))))
    return rows.withColumn("acumulado", yearly * F.col("anio") + once * F.floor((F.col("anio") - 1) / every + 1))


def next_on_cycle(df: DataFrame, done: Column, steps: Sequence[int], n: int) -> DataFrame:
    """df with paso and veces: the next n services of a plan that repeats after its last step."""
    length = max(steps)
    due = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: k * length + F.floor(done / length).cast("int") * length)
    all_ = F.flatten(F.transform(due, lambda base: F.transform(F.array(*[F.lit(s) for s in sorted(steps)]), lambda s: base + s)))
    coming = F.slice(F.array_sort(F.filter(all_, lambda x: x > done)), F.lit(1), F.lit(n))
    return df.select("*", F.posexplode(coming).alias("veces", "paso"))


def fits(given: Column, low: Column, high: Column) -> Column:
    """Three-valued: true inside the bounds, false outside, null where nothing is known."""
    known = low.isNotNull() | high.isNotNull()
    return F.when(known & given.isNotNull(), (given >= F.coalesce(low, given)) & (given <= F.coalesce(high, given)))


def score_labels(predicted: DataFrame, gold: DataFrame, id_col: str, label: str) -> DataFrame:
    """exactos, sobran, faltan: items whose labels agree, labels too many, labels missing; items without labels count."""
    sets = lambda df, name: df.groupBy(id_col).agg(F.collect_set(label).alias(name))
    both = sets(gold, "g").join(sets(predicted, "p"), id_col, "full")
    empty = F.expr("cast(array() as array<string>)")
    g, p = F.coalesce("g", empty), F.coalesce("p", empty)
    more, less = F.size(F.array_except(p, g)), F.size(F.array_except(g, p))
    return both.agg(F.count_if((more == 0) & (less == 0)).alias("exactos"), F.sum(more).alias("sobran"), F.sum(less).alias("faltan"))
