"""What product titles say: quantities, sides, stock codes, unit prices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rodaje.functions.text import extract, strip_accents


def quantity_named(title: Column, least: int = 1, most: int = 8) -> Column:
    """The number of pieces a title names ('x 4', '4 unidades', 'kit de 2', 'par'); null if none, or outside the bounds."""
    t = F.lower(strip_accents(title))
    patterns = (r"\bx\s?(\d{1,2})(?![\d.,])\b", r"\b(\d{1,2})\s*(?:u\b|un\b|unid|unidades|piezas)", r"\b(?:kit|juego|set|pack)\s*(?:de|x)?\s*(\d{1,2})\b")
    named = F.coalesce(*[extract(t, p).try_cast("int") for p in patterns], F.when(t.rlike(r"\b(par|pares)\b"), 2))
    return F.when(named.between(least, most), named)


def units_of(title: Column, kind: Column, sold_in_sets: Mapping[str, int]) -> Column:
    """Pieces per sale: 1 unless the kind is sold in sets; then the number named, 1 for one side, else the set's own."""
    t = F.lower(strip_accents(title))
    usual = F.try_element_at(F.create_map(*[F.lit(x) for kv in sold_in_sets.items() for x in kv]), kind)
    one_side = t.rlike(r"\b(izquierd[oa]|derech[oa]|izq|der|unidad)\b")
    several = t.rlike(r"\b(juego|kit|set|par)\b|s$|s ")
    guess = F.when(one_side, 1).when(several, usual).otherwise(1)
    return F.when(usual.isNull(), 1).otherwise(F.coalesce(quantity_named(title), guess))


def automatic(model: Column) -> Column:
    """Whether a model's text names an automatic gearbox; null for null."""
    return F.upper(model).rlike(r"\b(AT\d?|CVT|AUT|TIPTRONIC|DSG)\b")


def body(kind: Column) -> Column:
    """The bucket of a body: pick-up, furgon, sedan or otra."""
    return F.when(kind.rlike("^PICK"), "pick-up").when(kind.rlike("^FURG"), "furgon").when(kind.rlike("^(SEDAN|BERLINA)"), "sedan").otherwise("otra")


def inches(text: Column) -> Column:
    """The inches a text names: a number with its unit, a rim ('R16'), or the number behind a screen, panel or wheel; null if none."""
    t = F.lower(strip_accents(text))
    patterns = (r'(\d{1,2}(?:[.,]\d)?)\s*(?:"|pulg|plg|in\b)', r"\br\s?(\d{2})\b", r"(?:pantalla|display|tablero|llanta\w*|rodado)\D{0,30}?(\d{1,2})\b")
    return F.replace(F.coalesce(*[extract(t, p) for p in patterns]), F.lit(","), F.lit(".")).try_cast("double")


def sku_base(sku: Column, suffixes: Sequence[str] = ()) -> Column:
    """The code without what stands behind its last dash, or without a supplier's suffix."""
    base = F.regexp_replace(sku, r"-[^-]*$", "")
    for s in suffixes:
        base = F.when(F.endswith(sku, F.lit(s)), F.substring(sku, F.lit(1), F.length(sku) - len(s))).otherwise(base)
    return base


def canonical_brand(title: Column, brands: Mapping[str, Sequence[str]]) -> Column:
    """The first listed brand whose name or other spelling stands in the title as a word; null if none does."""
    t = F.upper(strip_accents(title))
    hits = [F.when(t.rlike(r"(^|[^A-Z0-9])(" + "|".join(map(_literal, [name.upper(), *map(str.upper, others)])) + r")([^A-Z0-9]|$)"), name) for name, others in brands.items()]
    return F.coalesce(*hits)


def _literal(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != " " else c for c in s)


def repaired_price(price: Column, usual: Column, most: float = 5.0) -> Column:
    """A price that is off the usual one by a factor of 10 or 100 brought back; others as they are."""
    out = price
    for k in (100.0, 10.0, 0.1, 0.01):
        off = (price > usual * most) | (price < usual / most)
        near = (price / k).between(usual / most, usual * most)
        out = F.when(off & near & (out == price), price / k).otherwise(out)
    return out
