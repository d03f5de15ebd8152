import pytest
from pyspark.sql import functions as F

from rodaje.functions import text as X
from rodaje.functions.numeric import percent, piecewise, safe_ratio, weighted_mean
from rodaje.functions.similarity import damerau_levenshtein, jaro_winkler, swap_distance, token_sort_ratio


def each(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_keys_and_slugs(spark):
    assert each(spark, ["  Río-Tordo ", "ÑANDÚ", None, ""], X.text_key) == ["rio tordo", "nandu", None, ""]
    assert each(spark, ["Citroën C4 / Lounge", "--"], X.slug) == ["citroen-c4-lounge", ""]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Pick-up Gol+ 1.6L", "GOL PLUS 1,6"), ("c 4 lounge", "C4 LOUNGE"), ("T-Cross", "T CROSS"), ("Peugeot  208 1,2", "PEUGEOT 208 1,2"), ("Nueva línea X 5", "LINEA X5")],
)
def test_normal_form(spark, raw, want):
    assert each(spark, [raw], X.norm) == [want]


def test_brand_and_tokens(spark):
    assert each(spark, ["Alfa Romeo 145"], lambda c: X.strip_brand(c, F.lit("alfa romeo"))) == ["145"]
    assert each(spark, ["X 1.0 Mt"], lambda c: X.strip_brand(c, F.lit("Y"))) == ["X 1,0 MT"]
    assert each(spark, ["Corolla XEi 2.0 at"], lambda c: X.token_set(c, F.lit("corolla"), {"AT": "AUT"})) == [["XEI", "2", "0", "AUT"]]
    assert each(spark, ["Filtro de aceite", None], lambda c: X.has_all_words(c, "ACEITE fíltro")) == [True, False]


def test_extraction(spark):
    got = each(spark, ["Gol 2010/2015", "Gol 2010 a 2012", "desde 2018", "hasta 2009", "Fox 2011", "x"], X.years_named)
    assert [(r.desde, r.hasta) for r in got] == [(2010, 2015), (2010, 2012), (2018, None), (None, 2009), (2011, 2011), (None, None)]
    assert each(spark, ["Amarok 2.0 y 3,0 L", "sin motor"], X.engines_named) == ["2.0/3.0", None]
    assert each(spark, ["1.6 HDi", "Híbrido 1.8", "eléctrico", "1.0"], X.fuel_named) == ["diesel", "hibrido", "electrico", "nafta"]
    assert each(spark, ["<b>A&amp;B</b><!-- x --> &nbsp;c"], X.unescape_html) == ["A&B c"]
    assert each(spark, ["1234567.5"], lambda c: X.money_text(c.cast("double"))) == ["$ 1.234.568"]


def test_rules(spark):
    rules = [("a", "x", None), ("b", "y", "z")]
    assert each(spark, ["xy", "xyz", "q"], lambda c: X.multilabel(c, rules)) == [["a", "b"], ["a"], []]
    assert each(spark, ["xy", "y", "q"], lambda c: X.classify(c, [("x", "1"), ("y", "2")], "0")) == ["1", "2", "0"]


def test_distances(spark):
    df = spark.createDataFrame([("martha", "marhta"), ("ca", "abc"), ("", "a"), (None, "a"), ("ab", "ba")], "a string, b string")
    got = df.select(jaro_winkler("a", "b"), damerau_levenshtein("a", "b"), swap_distance("a", "b"), token_sort_ratio("a", "b")).collect()
    assert got[0][0] == pytest.approx(0.9611, abs=1e-4)
    assert [r[1] for r in got] == [1, 2, 1, None, 1]
    assert [r[2] for r in got] == [1, 3, 1, None, 1]
    assert got[3][0] is None and got[3][3] is None


def test_numbers(spark):
    df = spark.sql("select * from values (1, 2.0D, 1.0D), (1, 4.0D, 3.0D), (2, 1.0D, 0.0D), (3, null, 5.0D) as t(k, v, w)")
    got = {r.k: r.m for r in df.groupBy("k").agg(weighted_mean(F.col("v"), F.col("w")).alias("m")).collect()}
    assert got == {1: 3.5, 2: None, 3: None}
    one = spark.range(1)
    assert one.select(safe_ratio(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(3))).first()[:] == (None, 33.3)
    curve = lambda x, *p: one.select(piecewise(F.lit(float(x)), [(a, F.lit(v).cast("double")) for a, v in p])).first()[0]
    points = ((0, 1.0), (1, 0.8), (5, None), (10, 0.2))
    assert [round(curve(x, *points), 4) for x in (0, 0.5, 1, 4, 10, 15)] == [1.0, 0.9, 0.8, 0.6, 0.2, 0.2]
    assert curve(3, (0, None), (1, None)) is None


@pytest.mark.parametrize(
    ("title", "want"),
    [
        ("Filtro Gol 2010/2015", (2010, 2015)), ("Corsa 98 a 2004", (1998, 2004)), ("Ka 98-04", (1998, 2004)), ("Fox desde 2012", (2012, None)), ("Uno a partir de 98", (1998, None)),
        ("208 2013 en adelante", (2013, None)), ("208 2013>", (2013, None)), ("Ka hasta 2007", (None, 2007)), ("Clio <2009", (None, 2009)), ("Gol mod. 95", (1995, 1995)), ("Gol '95", (1995, 1995)),
        ("Fox 2012", (2012, 2012)), ("Correa 6PK 1.4/1.8", (None, None)), ("Neumatico 205/55 R16", (None, None)), ("Peugeot 208", (None, None)), ("", (None, None)), (None, (None, None)),
    ],
)
def test_years_in_titles(spark, title, want):
    df = spark.createDataFrame([(title,)], "t string").select(X.years_named(F.col("t")).alias("y"))
    assert tuple(df.first().y) == want
