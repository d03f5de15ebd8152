import pytest
from pyspark.sql import functions as F

from rodaje.functions import requests, titles

MODELS = ["Corolla", "Corolla Cross", "208", "Amarok", "C3"]
PLACES = {"Puerto Hondo": "01", "hondo capital": "01", "Río Tordo": "04"}
CASES = [
    ("Quiero una camioneta diésel, hago 20.000 km por año", {"km_anio": 20000.0, "combustible": ["diesel"], "carroceria": ["pickup"]}),
    ("hasta 15 millones, automático, 5 años, en rio tordo", {"presupuesto": 15e6, "automatica": True, "anios": 5, "lugar": "04"}),
    ("corola cross o corrola? 500 km por mes", {"modelos": ["Corolla"], "km_anio": 6000.0}),
    ("Corolla Cross vs 208 nafta", {"modelos": ["Corolla Cross", "208"], "combustible": ["nafta"]}),
    ("208 o Corolla Cross, Hondo Capital", {"modelos": ["208", "Corolla Cross"], "lugar": "01"}),
    ("tengo $ 8.500.000 y 10 mil km al año", {"presupuesto": 8.5e6, "km_anio": 10000.0}),
    ("ando 35 km diarios, manual, con repuestos originales", {"km_anio": 12775.0, "automatica": False, "originales": True}),
    ("todos los días son 10 km; seguro de 70 lucas", {"km_anio": 3650.0, "seguro": 70000.0}),
    ("electrica o hibrida, suv o sedan, 48M", {"combustible": ["electrico", "hibrido"], "carroceria": ["suv", "sedan"], "presupuesto": 48e6}),
    ("tengo usd 12.000 y gasto 150 mil por mes", {}), ("lo uso hace 18000km", {}), ("hago 9000 km, lo tengo 4 años", {"km_anio": 9000.0, "anios": 4}),
    ("por semana hago 200 kilómetros", {"km_anio": 10400.0}), ("presupuesto: $ 21.500.000 pesos, auto chico", {"presupuesto": 21.5e6, "carroceria": ["hatch"]}),
    ("", {}), (None, {}),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_requests(text, want):
    got = requests.read_request(text, MODELS, PLACES)
    assert {k: v for k, v in got.items() if v not in (None, [])} == want


def test_requests_in_a_table(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: r.pedido for r in requests.with_request(df, "t", MODELS, PLACES).collect()}
    assert got[3].modelos == ["Corolla Cross", "208"] and got[0].km_anio == 20000.0 and got[len(CASES) - 1].modelos == []
    assert got[4].lugar == "01" and got[6].originales is True


def test_titles(spark):
    rows = ["Bujía x 4", "Amortiguador delantero izquierdo", "Juego de 2 pastillas", "Par de escobillas", "Filtro 1.6 x 10mm", "Kit x 12"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(titles.quantity_named(F.col("t"))).collect()] == [4, None, 2, 2, None, None]
    kind = F.when(F.col("i") == 1, "amortiguador").when(F.col("i") == 0, "bujia").otherwise("otro")
    assert [r[0] for r in df.select(titles.units_of(F.col("t"), kind, {"amortiguador": 2, "bujia": 4})).collect()] == [4, 1, 1, 1, 1, 1]
    one = spark.range(1)
    assert one.select(titles.sku_base(F.lit("AB-12-X")), titles.sku_base(F.lit("AB12VW"), ["VW"])).first()[:] == ("AB-12", "AB12")
    brands = {"Volkswagen": ["VW"], "Citroën": ["Citroen"]}
    assert [one.select(titles.canonical_brand(F.lit(t), brands)).first()[0] for t in ("Filtro vw gol", "CITROËN C3", "kvw")] == ["Volkswagen", "Citroën", None]
    assert [one.select(titles.repaired_price(F.lit(p), F.lit(100.0))).first()[0] for p in (95.0, 9500.0, 9.0, 1.1)] == [95.0, 95.0, 90.0, 110.0]
