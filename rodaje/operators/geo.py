"""Points near other points, and the regions that contain them, on a sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rodaje.operators.skew import salted_join
from rodaje.session import cut

EARTH_M = 6_371_000.0


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    """Haversine distance in metres of points in degrees."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), F.lit(2)
    )
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _columns_of(band: Column, height: float) -> Column:
    """How many cells of at least `height` degrees of arc go round the sphere in a band of latitude."""
    edge = F.greatest(F.abs(band * F.lit(height)), F.abs((band + 1) * F.lit(height)))
    around = F.greatest(F.cos(F.radians(F.least(edge, F.lit(90.0)))), F.lit(0.0)) * F.lit(360.0 / height)
    return F.greatest(F.floor(around), F.lit(1)).cast("long")


def near_points(
    points: DataFrame, radius_m: float, id_col: str = "id", lat: str = "lat", lon: str = "lon", hot: int = 2000, earth_m: float = EARTH_M
) -> DataFrame:
    """id_a < id_b, metres: every pair of points at most radius_m apart.

    The sphere is cut into bands of latitude as high as the radius and each band into cells at least as wide, so a
    point's neighbours lie in the cells its circle reaches in its own band and the two beside it; only the upper one
    is searched, as the lower pairs are found from the other point. Distances are then computed exactly. Cells with
    more than `hot` points are split. Points without id or coordinates, NaN, or outside +-90 / +-180 degrees, match nothing;
    of repeated rows of an id, each place counts and a pair is reported once with its least distance.
    """
    slack = 1 + 1e-9
    height = math.degrees(radius_m / earth_m) * slack
    # Written once: both sides of the join and the count of each cell read it.
    p = cut(
        points.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        .where("id is not null and lat between -90 and 90 and lon between -180 and 180").distinct()
        .withColumn("band", F.floor(F.col("lat") / F.lit(height)).cast("long"))
    )
    width = lambda band: F.lit(360.0) / _columns_of(band, height)
    home = p.select(
        F.col("id").alias("id_b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), "band", F.col("band").alias("band_b"),
        F.pmod(F.floor((F.col("lon") + 180) / width(F.col("band"))).cast("long"), _columns_of(F.col("band"), height)).alias("cell"),
    )
    # How far a circle reaches in longitude: all the way round once it touches a pole.
    polar = F.abs("lat") + height >= 90
    reach = F.when(polar, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.sin(F.lit(math.radians(height))) / F.cos(F.radians("lat")), F.lit(1.0)))) * F.lit(slack)
    )
    sought = p.select("id", "lat", "lon", F.col("band").alias("band_a"), reach.alias("reach"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    n = _columns_of(F.col("band"), height)
    low = F.floor((F.col("lon") - F.col("reach") + 180) / width(F.col("band"))).cast("long")
    high = F.floor((F.col("lon") + F.col("reach") + 180) / width(F.col("band"))).cast("long")
    cells = F.array_distinct(F.transform(F.sequence(low, F.least(high, low + n - 1)), lambda c: F.pmod(c, n)))
    sought = sought.select(
        F.col("id").alias("id_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), "band_a", "band", F.explode(cells).alias("cell")
    )
    met = salted_join(home, sought, ["band", "cell"], hot=hot)
    once = (F.col("band_a") != F.col("band_b")) | (F.col("id_a") < F.col("id_b"))
    metres = great_circle_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"), earth_m)
    return (
        met.where(once & (F.col("id_a") != F.col("id_b"))).withColumn("metres", metres).where(F.col("metres") <= radius_m)
        .groupBy(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).agg(F.min("metres").alias("metres"))
    )


def _inside(lat: Column, lon: Column, ring: Column) -> Column:
    """Even-odd rule over a ring of (lat, lon) corners; the last corner joins the first."""
    n = F.size(ring)
    edges = F.zip_with(ring, F.concat(F.slice(ring, 2, n - 1), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        at = a["lon"] + F.try_divide(lat - a["lat"], b["lat"] - a["lat"]) * (b["lon"] - a["lon"])
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < at)

    return F.size(F.filter(edges, crossed)) % 2 == 1


def points_in_regions(
    points: DataFrame, regions: DataFrame, cell_deg: float = 0.25, id_col: str = "id", lat: str = "lat", lon: str = "lon",
    region_col: str = "region", ring_col: str = "ring", hot: int = 20_000,
) -> DataFrame:
    """id, region: every region whose ring contains the point, by the even-odd rule in degrees.

    ring is an array of struct<lat, lon>. Points and the bounding boxes of regions meet on a grid of cell_deg degrees;
    cells with more than `hot` points are split. A corner or side belongs to a region as the rule has it. Null ids,
    coordinates and rings and rings of fewer than three corners match nothing. Regions over the 180th meridian have to
    be given as two.
    """
    grid = lambda c: F.floor(c / F.lit(cell_deg)).cast("long")
    p = points.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).where(
        "id is not null and lat between -90 and 90 and lon between -180 and 180"
    )
    p = p.withColumns({"cx": grid(F.col("lat")), "cy": grid(F.col("lon"))})
    side = lambda f, axis: grid(f(F.transform("ring", lambda q: q[axis].cast("double"))))
    r = regions.select(F.col(region_col).alias("region"), F.col(ring_col).alias("ring")).where(
        F.col("region").isNotNull() & (F.size("ring") >= 3)
    )
    r = r.withColumn("cx", F.explode(F.sequence(side(F.array_min, "lat"), side(F.array_max, "lat"))))
    r = r.withColumn("cy", F.explode(F.sequence(side(F.array_min, "lon"), side(F.array_max, "lon"))))
    met = salted_join(p, r, ["cx", "cy"], hot=hot, spread=["id", "lat", "lon"])
    return met.where(_inside(F.col("lat"), F.col("lon"), F.col("ring"))).select("id", "region").distinct()


def current_stations(stations: DataFrame) -> DataFrame:
    """One row per nro_inscripcion: the one last reported, if its place is in the country's box.

    Rows without a report date count as the oldest; of several at the same instant, one with coordinates and then the
    greatest place is taken.
    """
    latest = stations.where("nro_inscripcion is not null").groupBy("nro_inscripcion").agg(
        F.max(F.struct(F.coalesce(F.col("ultima_informacion").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("t"), "latitud", "longitud")).alias("r")
    )
    return latest.select("nro_inscripcion", F.col("r.latitud").alias("latitud"), F.col("r.longitud").alias("longitud")).where(
        "latitud between -56 and -21 and longitud between -74 and -53"
    )
