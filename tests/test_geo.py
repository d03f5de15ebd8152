import math
import random
from datetime import datetime

from rodaje.operators import geo


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.EARTH_M * math.asin(min(1, math.sqrt(h)))


def brute(points, radius):
    return {
        (min(i, j), max(i, j))
        for i, *p in points
        for j, *q in points
        if i < j and metres(p, q) <= radius
    }


def found(spark, points, radius, **more):
    df = spark.createDataFrame(points, "id long, lat double, lon double")
    return {(r.id_a, r.id_b) for r in geo.near_points(df, radius, **more).collect()}


def test_against_all_pairs_with_poles_and_date_line(spark):
    rng = random.Random(1)
    places = [(-34.6, -58.4), (89.9, 10.0), (-89.95, -170.0), (10.0, 179.99), (10.0, -179.99), (0.0, 0.0)]
    points = [
        (i, max(-90.0, min(90.0, rng.choice(places)[0] + rng.gauss(0, 0.05))), (rng.choice(places)[1] + rng.gauss(0, 0.3) + 180) % 360 - 180)
        for i in range(300)
    ]
    for radius in (300.0, 5_000.0, 40_000.0):
        assert found(spark, points, radius) == brute(points, radius)


def test_hot_cell_is_split_and_whole(spark):
    points = [(i, -30.0, -60.0) for i in range(60)] + [(99, -30.0005, -60.0)]
    assert found(spark, points, 150.0, hot=7) == brute(points, 150.0)


def test_nulls_repeats_and_empty(spark):
    points = [(1, -30.0, -60.0), (1, -30.0, -60.0), (2, None, -60.0), (3, float("nan"), -60.0), (None, -30.0, -60.0), (4, 95.0, -60.0), (5, -30.0, -60.0)]
    assert found(spark, points, 150.0) == {(1, 5)}
    assert found(spark, [], 150.0) == set()


def test_points_in_regions(spark, rows):
    corner = lambda *p: [{"lat": float(a), "lon": float(b)} for a, b in p]
    regions = spark.createDataFrame(
        [("caja", corner((0, 0), (0, 2), (2, 2), (2, 0))), ("ele", corner((0, 0), (0, 3), (1, 3), (1, 1), (3, 1), (3, 0))), ("linea", corner((0, 0), (1, 1))), (None, corner((0, 0), (0, 2), (2, 2)))],
        "region string, ring array<struct<lat: double, lon: double>>",
    )
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.5, 0.5), (4, 5.0, 5.0), (5, None, 1.0)], "id long, lat double, lon double")
    for hot in (20_000, 1):
        assert rows(geo.points_in_regions(points, regions, 0.7, hot=hot)) == [(1, "caja"), (1, "ele"), (2, "caja"), (3, "ele")]


def test_current_station_is_the_last_reported(spark, rows):
    t = datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [(1, -30.0, -60.0, t), (1, -31.0, -60.0, datetime(2026, 2, 1)), (2, -10.0, -60.0, t), (3, None, None, t), (4, -30.0, -60.0, None), (5, -30.0, -60.0, t), (5, None, None, t)],
        "nro_inscripcion long, latitud double, longitud double, ultima_informacion timestamp",
    )
    assert rows(geo.current_stations(df)) == [(1, -31.0, -60.0), (4, -30.0, -60.0), (5, -30.0, -60.0)]
