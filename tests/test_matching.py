import pytest
from pyspark.sql import functions as F

from rodaje.functions import text as X
from rodaje.operators import matching

NORMAL = {
    "GOL 1.6": "GOL 1,6", "GOL GLI 1.8": "GOL GLI 1,8", "HB 20 AT": "HB20 AT", "S10 CD 2.8": "S10 CD 2,8", "F-100": "F100", "KA +": "KA PLUS",
    "TERRITORY TREND 1.5L HIBRIDA AT": "TERRITORY TREND 1,5 HIBRIDA AT", "TIGGO 7 PRO": "TIGGO 7 PRO", "Peugeot 208 Allure": "PEUGEOT 208 ALLURE",
    "FURGÓN": "", "RAV - 4": "RAV4", "RAV4 HEV 2.5": "RAV4 HEV 2,5", "UP!": "UP", "SAVEIRO PICK - UP CROSS": "SAVEIRO CROSS", "HILUX PICK-UP 4X4": "HILUX 4X4",
}

PREFIX = [
    ("TERRITORY TREND 1.5L HIBRIDA AT", "FORD", ["TERRITORY", "RANGER PICK - UP"], ["TERRITORY"]),
    ("YARIS CROSS XEI HEV 1.5 ECVT", "TOYOTA", ["YARIS", "YARIS CROSS"], ["YARIS CROSS"]), ("BJ30E", "BAIC", ["BJ30", "BJ40"], ["BJ30"]),
    ("KANGOO 1.6", "RENAULT", ["KA", "KANGOO"], ["KANGOO"]), ("KA FLY VIRAL 1.0L", "FORD2", ["KA +"], []),
    ("VOLKSWAGEN VENTO 2.5", "VOLKSWAGEN", ["VENTO"], ["VENTO"]), ("HB 20 AT", "HYUNDAI", ["HB20 SEDAN", "HB20"], ["HB20", "HB20 SEDAN"]),
    ("GOL 1.6", "VW", ["GOL", "GOL TREND", "GOLF"], ["GOL"]), ("", "VW", [], []), (None, "VW", [], []), ("GOL 1.6", None, [], []), ("GOL 1.6", "NADIE", [], []),
]


def test_normal_forms(spark):
    df = spark.createDataFrame([(k,) for k in NORMAL] + [(None,)], "t string").select("t", X.norm(F.col("t")).alias("n"))
    assert dict(df.collect()) == NORMAL | {None: ""}


def test_brand_keys(spark):
    df = spark.createDataFrame([("MERCEDES-BENZ",), ("Mercedes Benz",)], "m string").select(X.brand_key(F.col("m")).alias("k"))
    assert {r.k for r in df.collect()} == {"MERCEDESBENZ"}


def words(df, text, brand, name):
    return df.withColumn(name, X.words_of(X.strip_brand(F.col(text), F.col(brand))))


@pytest.fixture(scope="module")
def catalogue(spark):
    rows = [(b, m) for _, b, models, _ in PREFIX for m in models]
    return words(spark.createDataFrame(rows, "marca string, modelo string"), "modelo", "marca", "mp")


def test_prefixes_with_ties(spark, catalogue):
    rows = [(i, t, b, "clash") for i, (t, b, _, _) in enumerate(PREFIX)] * 2
    left = words(spark.createDataFrame(rows, "id int, t string, marca string, modelo string"), "t", "marca", "p").drop("modelo")
    got = [(r.id, r.candidatos) for r in matching.prefix_candidates(left, catalogue, "marca", "p", "modelo", "mp").collect()]
    assert sorted(got) == sorted([(i, want) for i, (_, _, _, want) in enumerate(PREFIX)] * 2)
    assert matching.prefix_candidates(left.limit(0), catalogue, "marca", "p", "modelo", "mp").count() == 0
    assert {tuple(r.candidatos) for r in matching.prefix_candidates(left, catalogue.limit(0), "marca", "p", "modelo", "mp").collect()} == {()}


def test_aliases_go_first_and_may_block(spark, catalogue):
    left = words(spark.createDataFrame([(1, "KANGOO 1.6", "RENAULT"), (2, "HB 20 AT", "HYUNDAI"), (3, "YARIS CROSS XEI", "TOYOTA"), (4, "BJ30E", "BAIC"), (5, "ZZ", "BAIC")], "id int, t string, marca string"), "t", "marca", "p")
    aliases = spark.createDataFrame(
        [("RENAULT", ["KANGOO"], "KA"), ("TOYOTA", ["YARIS"], "YARIS"), ("TOYOTA", ["YARIS", "CROSS"], matching.NO_ENTRY), ("BAIC", ["BJ30E"], "UNKNOWN"), (None, ["X"], "Y")],
        "marca string, alias_words array<string>, target string",
    )
    got = {r.id: (r.modelo, r.metodo, r.candidatos) for r in matching.model_match(left, catalogue, aliases, "marca", "p", "modelo", "mp").collect()}
    assert got == {1: ("KA", "alias", None), 2: ("HB20", "prefijo_ambiguo", "HB20 | HB20 SEDAN"), 3: (None, "excluido", None), 4: ("BJ30", "prefijo", None), 5: (None, None, None)}


def test_ngrams_and_titles(spark, rows):
    w = lambda c: F.split(c, " ")
    names = spark.createDataFrame([("vw", "GOL"), ("vw", "GOL TREND"), ("vw", "UP"), ("fiat", "UNO"), ("ford", "KA"), ("fiat", "PALIO"), ("x", "PLUS9"), ("y", "SAME"), ("z", "SAME")], "marca string, name string").withColumn("nw", w("name"))
    texts = spark.createDataFrame([(1, "vw", "FILTRO GOL TREND GOL"), (2, "vw", "BUJIA PALIO"), (3, None, "KA UNO PALIO SAME"), (4, "fiat", "GOL TREND"), (5, "vw", ""), (6, "vw", None)], "id int, marca string, t string").withColumn("tw", w("t"))
    hits = matching.ngram_match(texts.select("id", "tw"), names, "id", "tw", "name", "nw", longest=2)
    assert [r for r in rows(hits) if r[0] == 1] == [(1, 2, 2, "GOL TREND"), (1, 4, 1, "GOL")]
    got = rows(matching.title_mentions(texts, names, "id", "tw", "marca", "name", "nw", not_names=["PLUS9"]))
    assert got == [(1, "vw", "GOL TREND", "marca"), (1, "vw", "GOL", "marca"), (2, "fiat", "PALIO", "unico"), (3, "fiat", "PALIO", "unico"), (4, "vw", "GOL TREND", "unico")]


def test_subsets_by_their_rarest_word(spark, rows):
    left = spark.createDataFrame([("v", 1, ["MSI", "GOL"]), ("v", 2, ["GOL"]), ("v", 3, []), ("v", 4, ["NO"]), (None, 5, ["GOL"]), ("v", 1, ["MSI", "GOL"])], "marca string, id int, f array<string>")
    right = spark.createDataFrame([("v", 10, ["GOL", "TREND", "MSI"]), ("v", 11, ["GOL", "GOL"]), ("x", 12, ["GOL"]), ("v", 13, None)], "marca string, n int, w array<string>")
    assert rows(matching.subset_match(left, right, ["marca"], "f", "w").select("id", "n")) == [(1, 10), (1, 10), (2, 10), (2, 11)]
