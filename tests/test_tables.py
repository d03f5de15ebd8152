from pyspark.sql import functions as F

from rodaje.operators import tables


def test_expand_cells(spark, rows):
    df = spark.createDataFrame([("Airbags\nABS", "x||no\nx|?|x"), ("Rodado", "15||17"), ("A\nB", "si"), (None, "x")], "e string, c string")
    got = rows(tables.expand_cells(df, "e", "c").select("etiqueta", "columna", "valor"))
    assert got == sorted(
        [("Airbags", 0, "si"), ("Airbags", 1, "si"), ("Airbags", 2, "no"), ("ABS", 0, "si"), ("ABS", 1, None), ("ABS", 2, "si"), ("Rodado", 0, "15"), ("Rodado", 1, "15"), ("Rodado", 2, "17"), ("A", 0, "si"), ("B", 0, "si")],
        key=repr,
    )


def test_distinguishing(spark, rows):
    df = spark.createDataFrame([("f", "XL1", "caja", "MT"), ("f", "XL2", "caja", "AT"), ("f", "XL1", "abs", "si"), ("f", "XL2", "abs", "si"), ("g", "A", "caja", "MT")], "fam string, v string, a string, x string")
    assert rows(tables.distinguishing(df, ["fam"], "v", "a", "x")) == [("f", "caja")]


def test_schedule_cycle_and_fit(spark, rows):
    one = spark.range(1)
    got = rows(tables.schedule(one, 4, F.lit(10.0), F.lit(5.0), 2).select("anio", "acumulado"))
    assert got == [(1, 15.0), (2, 25.0), (3, 40.0), (4, 50.0)]
    assert rows(tables.next_on_cycle(one, F.lit(25), [10, 20, 30], 4).select("paso")) == [(30,), (40,), (50,), (60,)]
    case = lambda g, a, b: one.select(tables.fits(F.lit(g), F.lit(a), F.lit(b))).first()[0]
    assert [case(5, 1, 9), case(5, 6, None), case(5, None, 5), case(5, None, None), case(None, 1, 2)] == [True, False, True, None, None]


def test_score_labels(spark):
    gold = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], "id int, l string")
    pred = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (4, "z")], "id int, l string")
    assert tables.score_labels(pred, gold, "id", "l").first()[:] == (1, 2, 2)
