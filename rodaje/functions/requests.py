"""Free-text requests read into parameters: what is understood is struck out before the next reading."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that say what is asked for (fixed values of the language), as patterns.
FUELS = {"diesel": r"diesel|gasoil|gasoler[oa]s?", "nafta": r"nafter[oa]s?|nafta", "hibrido": r"hibrid[oa]s?", "electrico": r"electric[oa]s?"}
BODIES = {
    "pickup": r"pick ?up|camioneta|chata", "suv": r"suvs?|rural", "utilitario": r"utilitarios?|furgon", "sedan": r"sedan|4 puertas", "hatch": r"hatch(?:back)?|auto chico",
}
PERIODS = {"dia": 365, "diari": 365, "semana": 52, "mes": 12, "mensual": 12, "ano": 1, "anual": 1}
SCALES = {"mil": 1e3, "k": 1e3, "lucas": 1e3, "millon": 1e6, "millones": 1e6, "palos": 1e6, "m": 1e6}

NUMBER = r"(\d+(?:[.,]\d+)?)\s*"
PERIOD = r"(dia|diari|semana|mensual|mes|anual|ano)"

FIELDS = ("km_anio", "anios", "presupuesto", "seguro", "combustible", "automatica", "carroceria", "originales", "lugar", "modelos")
SCHEMA = (
    "km_anio double, anios int, presupuesto double, seguro double, combustible array<string>, automatica boolean, carroceria array<string>, originales boolean, "
    "lugar string, modelos array<string>"
)


def _plain(text: str) -> str:
    t = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    # Dots between thousands go; one million in three groups included.
    return re.sub(r"\s+", " ", re.sub(r"(?<=\d)\.(?=\d{3}(?!\d))", "", t)).strip()


def _amount(number: str, scale: str | None) -> float:
    return float(number.replace(",", ".")) * SCALES.get(scale or "", 1)


def read_request(text: str | None, models: Sequence[str] = (), places: Mapping[str, str] | Sequence[str] = ()) -> dict:
    """The parameters of a request; what is not said is None, or an empty list.

    Kilometres are turned to a year's; distances without a period count only after 'hago'. Amounts in dollars and amounts per month, but for
    insurance, are no budget. places maps spellings to what is returned (a plain list returns the spelling). Names may have one
    typo if they have five letters or more. Listed values keep the order of the text.
    """
    out: dict = dict.fromkeys(FIELDS) | {"modelos": [], "combustible": [], "carroceria": []}
    rest = _plain(text or "")

    def take(pattern: str) -> re.Match | None:
        nonlocal rest
        m = re.search(pattern, rest)
        if m:
            # Marks of the same length, so that places stay comparable.
            rest = rest[: m.start()] + ";" * (m.end() - m.start()) + rest[m.end() :]
        return m

    if m := take(rf"\bseguro (?:mensual )?(?:de )?\$?\s*{NUMBER}(mil|lucas|k)?\b"):
        out["seguro"] = _amount(m[1], m[2])
    km = rf"{NUMBER}(mil|k)?\s*(?:km|kms|kilometros)\b"
    if m := take(rf"{km}\s*(?:(?:por|al|a la|cada|/)\s*)?{PERIOD}\w*"):
        out["km_anio"] = _amount(m[1], m[2]) * PERIODS[m[3]]
    elif m := take(rf"\b(?:por|al|a la|cada|uso|todos los)\s*{PERIOD}\w*[^;?.]*?{km}"):
        out["km_anio"] = _amount(m[2], m[3]) * PERIODS[m[1]]
    elif m := take(rf"\bhago (?:unos |como )?{km}"):
        out["km_anio"] = _amount(m[1], m[2])
    take(rf"(?:u\$s|us\$|usd|dolares)\s*{NUMBER}(?:mil|k)?|{NUMBER}(?:mil|k)?\s*(?:dolares|usd)")
    take(rf"{NUMBER}(?:mil|lucas|k)?\s*(?:pesos )?(?:por|al) mes\b")
    while take(rf"{km}"):
        pass
    if m := take(rf"{NUMBER}(millones|millon|palos|m)\b"):
        out["presupuesto"] = _amount(m[1], m[2])
    elif m := take(rf"(?:\$\s*|\bhasta\s+|\bpresupuesto:?\s+(?:de\s+)?)\$?\s*{NUMBER}(mil|k)?\b(?!\s*(?:km|anos?))"):
        out["presupuesto"] = _amount(m[1], m[2])
    if m := take(r"\b(\d{1,2})\s*anos?\b"):
        out["anios"] = int(m[1])
    if take(r"\b(?:repuestos )?originales\b"):
        out["originales"] = True
    named = places if isinstance(places, Mapping) else {p: p for p in places}
    for place in sorted(named, key=len, reverse=True):
        if take(rf"\b{re.escape(_plain(place))}\b"):
            out["lugar"] = named[place]
            break
    at: list[tuple[int, str]] = []
    for name in sorted(models, key=lambda n: -len(n)):
        plain = _plain(name)
        m = take(rf"(?<![\w]){re.escape(plain)}(?![\w])") or _near(take, rest, plain)
        if m:
            at.append((m.start(), name))
    out["modelos"] = [name for _, name in sorted(at)]
    if m := re.search(r"\b(automatic[oa]s?|cvt|manual)\b", rest):
        out["automatica"] = m[1] != "manual"
    for field, words in (("combustible", FUELS), ("carroceria", BODIES)):
        hits = [(m.start(), value) for value, pattern in words.items() if (m := re.search(rf"\b(?:{pattern})\b", rest))]
        out[field] = [value for _, value in sorted(hits)]
    return out


def _near(take: Callable[[str], re.Match | None], rest: str, name: str) -> re.Match | None:
    if len(name) < 5 or " " in name:
        return None
    word = next((w for w in re.findall(r"[a-z0-9]{4,}", rest) if _one_off(w, name)), None)
    return take(rf"\b{word}\b") if word else None


def _one_off(a: str, b: str) -> bool:
    """One letter added, dropped or changed, or two neighbours swapped."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def with_request(df: DataFrame, text: str, models: Sequence[str] = (), places: Mapping[str, str] | Sequence[str] = ()) -> DataFrame:
    """df with a struct `pedido` of what its text asks for. models and places are short lists sent to the workers."""
    models = list(models)
    places = dict(places) if isinstance(places, Mapping) else list(places)

    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [read_request(t, models, places) for t in texts]
            yield pd.DataFrame({k: [f[k] for f in found] for k in FIELDS})

    return df.withColumn("pedido", F.pandas_udf(read, SCHEMA)(text))
