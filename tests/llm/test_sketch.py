import random

import numpy as np
import pytest

from rodaje.llm import sketch

PROBS = [0.0, 0.1, 0.5, 0.9, 1.0]


def test_error_is_bounded_and_sketches_add_up(spark):
    rng = random.Random(0)
    data = [(g, sign * rng.lognormvariate(3, 2)) for g, sign, n in (("a", 1, 999), ("b", -1, 500), ("c", 1, 2), (None, 1, 31)) for _ in range(n)]
    df = spark.createDataFrame(data, "g string, v double")
    for error in (0.01, 0.001):
        halves = [sketch.sketch(d, ["g"], "v", error) for d in df.randomSplit([0.3, 0.7], 1)]
        got = {r.g: r for r in sketch.percentiles(sketch.merge(halves, ["g"]), ["g"], PROBS, error).collect()}
        for g in ("a", "b", "c", None):
            v = [x for k, x in data if k == g]
            assert got[g].n == len(v)
            for p in PROBS:
                assert got[g][sketch.percent(p)] == pytest.approx(float(np.quantile(v, p)), rel=error * 1.0001)


def test_zero_null_nan_and_extremes(spark):
    data = [(0.0,), (None,), (float("nan"),), (float("inf"),), (-5.0,), (5.0,), (1e300,), (1e-300,)]
    df = spark.createDataFrame(data, "v double")
    r = sketch.percentiles(sketch.sketch(df, [], "v", 0.01), [], [0.0, 0.25, 1.0], 0.01).first()
    assert r.n == 5 and r.p_0 == pytest.approx(-5, rel=0.01) and r.p_25 == 0 and r.p_100 == pytest.approx(1e300, rel=0.01)
    assert sketch.percentiles(sketch.sketch(df.limit(0), [], "v"), [], [0.5]).count() == 0


def test_misprinted_groups(spark):
    prices = [(1, "x", 100.0), (1, "x", 100.0), (2, "x", 102.0), (3, "x", -1.0), (4, "y", 50.0), (None, "y", 50.0), (5, "z", None)]
    df = spark.createDataFrame(prices, "id long, k string, v double")
    stated = spark.createDataFrame([("x", 101.1), ("y", 51.6), ("z", 3.0), ("y", None), ("w", 1.0)], "k string, m double")
    assert [r.k for r in sketch.misprinted(df, stated, ["k"], "v", "m", "id").collect()] == ["y"]


def test_percentiles_of_the_stated_groups_count_each_filing_once(spark, tmp_path):
    from rodaje.llm import queries

    rng = random.Random(2)
    rows = [(i, f"2024-0{1 + i % 2}", i % 3, "nafta", ["x", None][i // 2 % 2], rng.lognormvariate(6, 1)) for i in range(600)]
    keys = "declaracion_id long, periodo string, provincia_id int, producto string, bandera string, precio_surtidor double"
    given = [*rows, *[r for r in rows if r[5] > 400], (9999, "2024-01", 0, "nafta", "x", -1.0)]
    spark.createDataFrame(given, keys).write.parquet(str(tmp_path / "combustible_precios.parquet"))
    for query, group in ((queries.p6_percentiles, slice(1, 5)), (queries.p6_merged, slice(2, 4))):
        got = {tuple(r)[: len(rows[0][group])]: r for r in query(spark, str(tmp_path)).collect()}
        assert set(got) == {r[group] for r in rows}
        for g, r in got.items():
            v = [x[5] for x in rows if x[group] == g]
            assert r.n == len(v)
            for p in queries.PROBS:
                assert r[sketch.percent(p)] == pytest.approx(float(np.quantile(v, p)), rel=0.0005 * 1.001)
