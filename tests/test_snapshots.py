from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rodaje.operators import snapshots

DAYS = [date(2026, m, 1) for m in range(1, 6)]
SCHEMA = "k string, d date, v long, extra string"


def brute(rows):
    held = {}
    for k, d, v, _ in rows:
        if k is not None and d is not None:
            held.setdefault(d, {}).setdefault(k, []).append(v)
    days = sorted(held)
    least = lambda vs: None if None in vs else min(vs)
    out = set()
    for a, b in zip(days, days[1:]):
        for k in set(held[a]) | set(held[b]):
            if k not in held[a]:
                out.add((k, b, "alta"))
            elif k not in held[b]:
                out.add((k, b, "baja"))
            elif least(held[a][k]) != least(held[b][k]):
                out.add((k, b, "cambio"))
    return out


def found(spark, data):
    return {tuple(r) for r in snapshots.changes(spark.createDataFrame(data, SCHEMA), "k", "d", ["v"]).collect()}


cell = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([*DAYS, None]), st.sampled_from([1, 2, None]), st.just("x"))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cell, max_size=25))
def test_against_pairwise_comparison(spark, data):
    assert found(spark, data) == brute(data)


def test_gap_is_removal_and_addition(spark):
    data = [("a", DAYS[0], 1, ""), ("z", DAYS[1], 1, ""), ("a", DAYS[2], 1, "")]
    assert found(spark, data) == {("a", DAYS[1], "baja"), ("z", DAYS[1], "alta"), ("z", DAYS[2], "baja"), ("a", DAYS[2], "alta")}


def test_latest_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 5), ("a", 2, 6), ("b", 1, 9)], "k string, d int, v int")
    assert rows(snapshots.latest(df, ["k"], "d")) == [("a", 2, 5), ("a", 2, 6), ("b", 1, 9)]
