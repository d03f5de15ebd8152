from pyspark.sql import functions as F

from rodaje.operators import joins, quality, skew, windows


def test_salted_join_is_an_inner_join(spark, rows):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 40 + [2, 2, 3, None])], "k int, a int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n"), (9, "q")], "k int, b string")
    want = rows(left.join(right, "k"))
    for hot in (2000, 5, 1):
        assert rows(skew.salted_join(left, right, ["k"], hot=hot)) == want
    assert skew.salted_join(left, right, ["k"], F.col("b") == "z", hot=5).count() == 2
    assert skew.salted_join(left.limit(0), right, ["k"]).count() == 0


def test_asof_join(spark, rows):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9), (4, None, 9), (5, "a", None), (6, "a", 7)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 5, 49), ("c", 1, 1), ("a", None, 9), (None, 1, 7), ("a", 6, None)], "k string, at int, v int")
    for hot in (1_000_000, 2):
        got = rows(joins.asof_join(left, right, ["k"], "t", "at", ["v"], hot=hot).select("id", "v"))
        assert got == [(1, 50), (2, None), (3, None), (4, None), (5, None), (6, None)]


def test_fill_and_rank_over_ranges(spark):
    import random

    rng = random.Random(1)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, None, i])) for i in range(400)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(7)
    plain = {(r.k, r.t): r.f for r in windows.forward_fill(df, ["k"], ["t"], "v", "f").collect()}
    spread = {(r.k, r.t): r.f for r in windows.forward_fill(df, ["k"], ["t"], "v", "f", hot=10).collect()}
    assert plain == spread and len(plain) == 400
    ranks = {r.t: r.n for r in windows.global_rank(df, [F.desc("t")], "n").collect()}
    assert ranks == {t: 400 - t for t in range(400)}
    assert windows.global_rank(df.limit(0), ["t"], "n").count() == 0


def test_bracket_and_nearest(spark, rows):
    scale = spark.createDataFrame([("p", 0.0, 10.0, 1), ("p", 10.0, None, 2)], "k string, low double, high double, b int")
    data = spark.createDataFrame([("p", 10.0), ("p", 11.0), ("q", 5.0), ("p", 0.0), ("p", None)], "k string, v double")
    assert rows(joins.bracket_join(data, scale, "v", "low", "high", ["k"]).select("v", "b")) == [(10.0, 1), (11.0, 2)]
    got = data.select(joins.nearest(F.col("v"), [0.0, 10.0, 12.0], 4.5)).collect()
    assert [r[0] for r in got] == [10.0, 10.0, None, 0.0, None]


def test_exact_percentiles(spark):
    import random

    import numpy as np

    rng = random.Random(3)
    values = {"a": [rng.lognormvariate(3, 2) * rng.choice([1, 1, -1]) for _ in range(501)], "b": [5.0] * 40 + [7.0] * 41, None: [0.0, -1.0], "c": [1e300, 2.5e-300], "one": [4.2]}
    data = [(k, v) for k, vs in values.items() for v in vs] + [("a", None), ("a", float("nan")), ("a", float("inf")), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: (r.n, r.p1, r.p50, r.p90) for r in windows.exact_percentiles(df, ["k"], "v", {"p1": 0.01, "p50": 0.5, "p90": 0.9}).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        assert got[k][0] == len(vs)
        assert np.allclose(got[k][1:], np.percentile(vs, [1, 50, 90]), rtol=1e-12)
    assert windows.exact_percentiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_override_and_windows(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    over = spark.createDataFrame([(1, "A"), (2, None)], "k int, v string")
    assert rows(joins.override_join(base, over, ["k"], "v")) == [(1, "A"), (2, "b"), (None, "c")]
    data = spark.createDataFrame([("x", 1, 5), ("x", 2, None), ("x", 3, 5), ("x", 4, 7), (None, 1, 1)], "k string, t int, v int")
    assert rows(windows.ordered_mode(data, ["k"], "v", "m")) == [("x", 5, 2), (None, 1, 1)]
    assert rows(windows.count_distinct_over(data, ["k"], "v", "n").select("k", "t", "n")) == [("x", 1, 2), ("x", 2, 2), ("x", 3, 2), ("x", 4, 2), (None, 1, 1)]
    assert rows(windows.forward_fill(data, ["k"], ["t"], "v", "f").select("t", "f").where("k = 'x'")) == [(1, 5), (2, 5), (3, 5), (4, 7)]
    assert rows(windows.trimmed_by_median(data, ["k"], "v", 0.9, 1.1)) == [("x", 1, 5), ("x", 3, 5), (None, 1, 1)]
    jumps = spark.createDataFrame([("a", 1, 0.5, 9), ("a", 2, 0.5, 3), ("a", 4, 0.5, 5)], "k string, n int, j double, s int")
    got = rows(windows.chained_index(jumps, ["k"], "n", "j", "s").select("n", F.round("indice", 6), "completo", "respaldo"))
    assert got == [(1, 0.5, True, 9), (2, 0.25, True, 3), (4, 0.125, False, 3)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (2, "z", -1.0)], "k int, c string, v double")
    parent = spark.createDataFrame([(1,)], "id int")
    counts = quality.violations({
        "u": quality.not_unique(df, ["k"]), "n": quality.nulls(df, "v"), "a": quality.not_accepted(df, "c", ["a", "b"]), "r": quality.out_of_range(df, "v", 0, 4), "o": quality.orphans(df, "k", parent, "id"),
    })
    assert dict(counts.collect()) == {"u": 1, "n": 1, "a": 1, "r": 2, "o": 1}
    scale = spark.createDataFrame([("p", 0.0, 10.0, 0.0, 1.0), ("p", 10.0, 20.0, 0.1, 2.0), ("p", 20.0, None, 9.0, 3.0)], "k string, low double, high double, fixed double, pct double")
    assert [r.low for r in quality.not_continuous(scale, ["k"], "low", "high", "fixed", "pct").collect()] == [20.0]
    assert quality.conserved(df, df.join(parent, df.k == parent.id, "left"))
    assert quality.validate(df, 5, {"v": 0.1}, {"v": (0, 9)}, ["k"]) == ["3 rows, expected 5", "v: 1 null", "v: 1 out of range", "k: not unique"]
    assert quality.validate(df, 1, {"v": 0.5}, {}, ["c"]) == []


def test_fallback_labels(spark, rows):
    df = spark.createDataFrame([(1, None), (None, 2), (None, None)], "a int, b int")
    value, label = windows.fallback([("propio", F.col("a")), ("general", F.col("b"))])
    assert rows(df.select(value, label)) == [(1, "propio"), (2, "general"), (None, None)]
