import itertools
import math
import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from rodaje.operators import units


def cost_of(level, cost, path):
    moves = sum(units.JUMP * abs(level[i, b] - level[i - 1, a]) + units.SWITCH * (a != b) for i, (a, b) in enumerate(zip(path, path[1:]), 1))
    return moves + sum(cost[i, s] for i, s in enumerate(path))


def test_viterbi_is_the_cheapest_path():
    rng = np.random.default_rng(0)
    level, cost = rng.normal(size=(26, 3)) * 2, rng.random((26, 3))
    cost[3] = [np.inf, 0, np.inf]
    starts = np.array([0, 5, 6, 13, 19])
    state = units.viterbi(level, cost, starts)
    for a, b in zip(starts, [*starts[1:], 26]):
        best = min(cost_of(level[a:b], cost[a:b], p) for p in itertools.product(range(3), repeat=b - a))
        assert math.isclose(best, cost_of(level[a:b], cost[a:b], state[a:b]))


def records(spark, crowded):
    rng = random.Random(2)
    rows = []
    for s, n in (("a", 300), ("b", 7), ("c", 40)):
        for i in range(n):
            unit, f = rng.choice([("miles", 1e3), ("pesos", 1.0), ("millones", 1e6)])
            day = datetime(2024, 1, 1) + timedelta(days=0 if crowded and i % 2 else i)
            rows.append((len(rows), s, day, round(2e7 * math.exp(rng.gauss(0, 0.3)) / f, 3), unit if rng.random() < 0.3 else None, None, unit))
    df = spark.createDataFrame(rows, "id long, s string, at timestamp, amount double, said string, rate double, truth string")
    return df, {r[0]: r[6] for r in rows}


def decode(df, parts=None):
    out = units.decode_units(df, ["s"], "at", "id", "amount", "said", "rate", "miles", ["pesos", "millones"], parts=parts)
    assert set(out.columns) == {*df.columns, "unit"}
    return {r.id: r.unit for r in out.collect()}


def test_parts_give_the_path_of_the_whole(spark):
    for crowded in (False, True):
        df, truth = records(spark, crowded)
        assert decode(df) == decode(df, 1) == decode(df, 2) == decode(df, 9) == truth


def test_parts_of_overlapping_levels_on_one_date(spark):
    """Levels so close that the order within the date decides, many equal amounts, and ids of any spread."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        f = rng.choice([1e3, 1.0])
        rows.append((i * i * 37 % 100_003, "ab"[i % 40 == 0], datetime(2024, 1, 1), round(2e4 * math.exp(rng.choice([0, 0, 1, 2, 3, 4])) / f, 3), rng.choice([None, None, None, "miles", "pesos"]), None))
    df = spark.createDataFrame(rows, "id long, s string, at timestamp, amount double, said string, rate double")
    whole = decode(df, 1)
    assert {"miles", "pesos"} <= set(whole.values())
    assert whole == decode(df, 3) == decode(df, 10) == decode(df, 60)


def test_null_parts_of_a_series_are_values(spark):
    rows = [(i, s, t, datetime(2024, 1, 1 + i), 20.0 if s else 20000.0, None, None) for i, (s, t) in enumerate([("a", None), (None, "a")] * 6)]
    df = spark.createDataFrame(rows, "id long, s string, t string, at timestamp, amount double, said string, rate double")
    keys = df.select(F.xxhash64(*[x for c in ("s", "t") for x in (F.col(c).isNull(), F.col(c))])).distinct().count()
    assert keys == 2
    out = units.decode_units(df, ["s", "t"], "at", "id", "amount", "said", "rate", "miles", ["pesos"])
    assert out.count() == 12


def test_no_amount_and_empty(spark):
    schema = "id long, s string, at date, amount double, said string, rate double"
    df = spark.createDataFrame([(1, "a", None, None, "usd", None), (2, "a", None, 0.0, None, None), (3, None, None, 20000.0, None, None)], schema)
    assert decode(df, 3) == decode(df) == {1: "usd", 2: "miles", 3: "miles"}
    assert decode(spark.createDataFrame([], schema)) == {}


def test_units_and_amounts_in_texts(spark):
    texts = {
        "US$ 384": ("usd", 384), "999 dólares + IVA": ("usd", 999), "$ 761.000 (no se cotiza en dólares)": ("pesos", 761000),
        "$ 161.000 - kit de filtros + 4 l de aceite, 1 mil km de control sin cargo": ("pesos", 161000), "206k": ("miles", 206),
        "0,456 millones": ("millones", 0.456), "$ 0,286 M": ("millones", 0.286), "34.600.000 centavos": ("centavos", 34600000),
        "son 742 mil pesos": ("miles", 742), "ARS 307.000,00": ("pesos", 307000), "$940.000.-": ("pesos", 940000), "miles u$s": ("kusd", None),
        "MM": ("millones", None), "lista 488000 / total 536800": (None, 488000), "": (None, None),
    }
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r[0]: (r[1], None if r[2] is None else float(r[2])) for r in df.select("t", units.unit_named(F.col("t")), units.amount_in(F.col("t"))).collect()}
    assert got.pop(None) == (None, None)
    assert got == {k: (u, None if a is None else float(a)) for k, (u, a) in texts.items()}


def test_rate_of_the_last_date(spark, rows):
    rates = spark.sql("select * from values (date'2024-01-02', 10.0D), (date'2024-01-05', 20.0D), (date'2024-01-05', 19.0D), (date'2024-01-06', null) as t(fecha, valor)")
    days = spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-01-04'), (3, date'2024-01-05'), (4, date'2025-01-01'), (5, null) as t(id, d)")
    assert rows(units.rate_of_day(days, rates, "d").select("id", "rate")) == [(1, None), (2, 10.0), (3, 20.0), (4, 20.0), (5, None)]
    assert rows(units.rate_of_day(days, rates.limit(0), "d").select("id", "rate")) == [(i, None) for i in range(1, 6)]


def test_pesos_round_half_up(spark):
    df = spark.sql("select cast(3 as decimal(20,6)) as a, 896.5D as r")
    get = lambda unit: df.select(units.in_pesos(F.col("a"), F.lit(unit), F.col("r"))).first()[0]
    assert [get(u) for u in ("usd", "kusd", "miles", "centavos", "millones")] == [2690, 2689500, 3000, 0, 3000000]
