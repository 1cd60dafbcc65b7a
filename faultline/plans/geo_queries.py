"""Geometry and checks of location data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import geo
from faultline.operators import mapping, quality
from faultline.plans.inputs import PLACES_SQL, places, table
from faultline.plans.registry import query

R = geo.EARTH_RADIUS_KM
VERTICES = 64


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two points per customer, a bearing and a distance."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k,
        ((k * 37 % 1700) / 10.0 - 85.0).alias("lat1"),
        ((k * 91 % 3600) / 10.0 - 180.0).alias("lon1"),
        ((k * 53 % 1700) / 10.0 - 85.0).alias("lat2"),
        ((k * 17 % 3600) / 10.0 - 180.0).alias("lon2"),
        (k * 7 % 360).cast("double").alias("bearing"),
        (1.0 + k % 50).cast("double").alias("km"),
    )


_POINTS_SQL = """
points AS (
  SELECT c_custkey, (c_custkey * 37 % 1700) / CAST(10 AS DOUBLE) - 85 AS lat1,
         (c_custkey * 91 % 3600) / CAST(10 AS DOUBLE) - 180 AS lon1,
         (c_custkey * 53 % 1700) / CAST(10 AS DOUBLE) - 85 AS lat2,
         (c_custkey * 17 % 3600) / CAST(10 AS DOUBLE) - 180 AS lon2,
         CAST(c_custkey * 7 % 360 AS DOUBLE) AS bearing,
         CAST(1 + c_custkey % 50 AS DOUBLE) AS km
  FROM customer)
"""


def _sql_distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""2 * {R} * asin(least(1, sqrt(
      pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))
      * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


def _sql_target(lat: str, lon: str, bearing: str, km: str) -> tuple[str, str]:
    sine = f"""(sin(radians({lat})) * cos({km} / {R})
      + cos(radians({lat})) * sin({km} / {R}) * cos(radians({bearing})))"""
    turn = f"""atan2(sin(radians({bearing})) * sin({km} / {R}) * cos(radians({lat})),
      cos({km} / {R}) - sin(radians({lat})) * {sine})"""
    return f"degrees(asin({sine}))", f"degrees(radians({lon}) + {turn})"


@query(
    f"""WITH {_POINTS_SQL}
    SELECT c_custkey, round({_sql_distance("lat1", "lon1", "lat2", "lon2")}, 6) AS km
    FROM points"""
)
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = geo.haversine_km("lat1", "lon1", "lat2", "lon2")
    return _points(spark, sf_dir).select("c_custkey", F.round(km, 6).alias("km"))


_TARGET = _sql_target("lat1", "lon1", "bearing", "km")


@query(
    f"""WITH {_POINTS_SQL}
    SELECT c_custkey, round({_TARGET[0]}, 6) + 0.0 AS lat, round({_TARGET[1]}, 6) + 0.0 AS lon
    FROM points"""
)
def destination_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = geo.destination_point("lat1", "lon1", "bearing", "km")
    reached = _points(spark, sf_dir).select("c_custkey", to.alias("to"))
    return reached.select(
        "c_custkey", F.round("to.lat", 6).alias("lat"), F.round("to.lon", 6).alias("lon")
    )


_VERTEX = _sql_target("lat1", "lon1", f"((i % {VERTICES}) * 360.0 / {VERTICES})", "km")


@query(
    f"""WITH {_POINTS_SQL}
    SELECT c_custkey, CAST(i AS INTEGER) AS vertex, round({_VERTEX[1]}, 6) + 0.0 AS lon,
           round({_VERTEX[0]}, 6) + 0.0 AS lat
    FROM points, (SELECT unnest(range(0, {VERTICES + 1})) AS i)"""
)
def service_area_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir).select("c_custkey", "lat1", "lon1", "km")
    vertices = geo.with_ring_vertices(points, "lat1", "lon1", "km", VERTICES)
    return vertices.select(
        "c_custkey",
        "vertex",
        F.round("vertex_lon", 6).alias("lon"),
        F.round("vertex_lat", 6).alias("lat"),
    )


_CORNER = _sql_target(
    "latitude", "longitude", f"((i % {VERTICES}) * 360.0 / {VERTICES})", "service_radius_km"
)


@query(
    f"""WITH {PLACES_SQL},
    corners AS (
      SELECT feeder_canonical, i, {_CORNER[1]} AS lon, {_CORNER[0]} AS lat
      FROM places, (SELECT unnest(range(0, {VERTICES + 1})) AS i)
      WHERE latitude IS NOT NULL)
    SELECT p.feeder_canonical, p.confidence,
           'POLYGON ((' || string_agg(printf('%.6f %.6f', lon, lat), ', ' ORDER BY i) || '))'
             AS wkt
    FROM places p LEFT JOIN corners USING (feeder_canonical)
    GROUP BY p.feeder_canonical, p.confidence"""
)
def service_area_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = geo.service_area_wkt("latitude", "longitude", "service_radius_km", n_vertices=VERTICES)
    return places(spark, sf_dir).select("feeder_canonical", "confidence", area.alias("wkt"))


@query(
    f"""WITH {PLACES_SQL}
    SELECT feeder_canonical, confidence <> 'unlocated' AS is_located,
           'POINT (' || regexp_replace(CAST(longitude AS VARCHAR), '\\.0$', '') || ' '
             || regexp_replace(CAST(latitude AS VARCHAR), '\\.0$', '') || ')' AS location_wkt
    FROM places"""
)
def point_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select(
        "feeder_canonical",
        geo.is_located().alias("is_located"),
        geo.point_wkt("longitude", "latitude").alias("location_wkt"),
    )


@query(
    f"""WITH {PLACES_SQL},
    sites AS (SELECT latitude, longitude, service_radius_km, min(place_id) AS site,
                     count(*) AS members
              FROM places WHERE latitude IS NOT NULL GROUP BY 1, 2, 3)
    SELECT a.site AS site_a, b.site AS site_b, a.members AS members_a, b.members AS members_b,
           round({_sql_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")}, 6)
             AS distance_km
    FROM sites a JOIN sites b ON a.site < b.site
      AND {_sql_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")}
          < a.service_radius_km + b.service_radius_km"""
)
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = mapping.overlapping_sites(places(spark, sf_dir), "place_id")
    return pairs.withColumn("distance_km", F.round("distance_km", 6))


@query(
    f"""WITH {PLACES_SQL},
    sites AS (SELECT latitude, longitude, service_radius_km, min(place_id) AS site,
                     count(*) AS members
              FROM places WHERE latitude IS NOT NULL GROUP BY 1, 2, 3)
    SELECT a.site, a.members, count(b.site) AS n_sites,
           CAST(coalesce(sum(b.members), 0) AS BIGINT) AS n_members
    FROM sites a LEFT JOIN sites b ON a.site <> b.site
      AND {_sql_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")}
          < a.service_radius_km + b.service_radius_km
    GROUP BY a.site, a.members"""
)
def overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.overlap_counts(places(spark, sf_dir), "place_id")


_BOX = {"lat": (7.1, 7.6), "lon": (-150.0, -140.0)}


@query(
    f"""WITH {PLACES_SQL}
    SELECT feeder_canonical, latitude, longitude FROM places
    WHERE latitude > 7.1 AND latitude < 7.6 AND longitude > -150.0 AND longitude < -140.0"""
)
def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = places(spark, sf_dir).filter(geo.in_box("latitude", "longitude", _BOX))
    return inside.select("feeder_canonical", "latitude", "longitude")


@query(
    f"""WITH {PLACES_SQL}
    SELECT feeder_canonical FROM places
    WHERE confidence <> 'unlocated'
      AND NOT (latitude > 7.1 AND latitude < 7.6 AND longitude > -150.0 AND longitude < -140.0)"""
)
def dq_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.box_violations(places(spark, sf_dir), _BOX).select("feeder_canonical")


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations with planted faults, found again by the checks."""
    k = F.col("place_id")
    return places(spark, sf_dir).withColumns(
        {
            "place_id": F.when((k % 11 == 0) & (k > 0), k - 1)
            .when(k % 13 == 0, k + 1_000_000_000)
            .otherwise(k),
            "confidence": F.when(k % 7 == 1, "guess")
            .when(k % 7 == 2, F.lit(None).cast("string"))
            .otherwise(F.col("confidence")),
            "anchor": F.when(k % 9 == 1, "  ")
            .when(k % 9 == 2, F.lit(None).cast("string"))
            .otherwise(F.col("anchor")),
            "service_radius_km": F.when(k % 6 == 1, 0.0).otherwise(F.col("service_radius_km")),
            "latitude": F.when(k % 10 == 9, 7.5).otherwise(F.col("latitude")),
        }
    )


_FAULTY_SQL = f"""{PLACES_SQL},
faulty AS (
  SELECT feeder_canonical, longitude,
         CASE WHEN place_id % 11 = 0 AND place_id > 0 THEN place_id - 1
              WHEN place_id % 13 = 0 THEN place_id + 1000000000 ELSE place_id END AS place_id,
         CASE WHEN place_id % 7 = 1 THEN 'guess' WHEN place_id % 7 = 2 THEN NULL
              ELSE confidence END AS confidence,
         CASE WHEN place_id % 9 = 1 THEN '  ' WHEN place_id % 9 = 2 THEN NULL
              ELSE anchor END AS anchor,
         CASE WHEN place_id % 6 = 1 THEN 0 ELSE service_radius_km END AS service_radius_km,
         CASE WHEN place_id % 10 = 9 THEN 7.5 ELSE latitude END AS latitude
  FROM places)
"""


@query(
    f"""WITH {_FAULTY_SQL},
    found AS (SELECT place_id, count(*) AS n FROM faulty GROUP BY 1),
    wanted AS (SELECT s_suppkey AS place_id, count(*) AS n FROM supplier GROUP BY 1)
    SELECT coalesce(f.place_id, w.place_id) AS place_id,
           CASE WHEN f.n IS NULL THEN 'missing' WHEN w.n IS NULL THEN 'unknown'
                ELSE 'duplicate' END AS problem,
           coalesce(f.n, 0) AS n_found, coalesce(w.n, 0) AS n_expected
    FROM found f FULL JOIN wanted w ON f.place_id = w.place_id
    WHERE f.n IS DISTINCT FROM 1 OR w.n IS DISTINCT FROM 1"""
)
def dq_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("place_id"))
    return quality.key_violations(_faulty(spark, sf_dir), expected, "place_id")


@query(
    f"""WITH {_FAULTY_SQL}
    SELECT feeder_canonical, confidence FROM faulty
    WHERE confidence IS NULL OR confidence NOT IN ('high', 'medium', 'low', 'unlocated')"""
)
def dq_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_violations(_faulty(spark, sf_dir)).select(
        "feeder_canonical", "confidence"
    )


@query(
    f"""WITH {_FAULTY_SQL}
    SELECT feeder_canonical, CASE WHEN confidence = 'unlocated' THEN 'unlocated_with_coordinates'
             ELSE 'located_incomplete' END AS problem
    FROM faulty
    WHERE (confidence <> 'unlocated' AND (latitude IS NULL OR longitude IS NULL
             OR service_radius_km IS NULL OR service_radius_km <= 0))
       OR (confidence = 'unlocated' AND (latitude IS NOT NULL OR longitude IS NOT NULL))"""
)
def dq_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.location_violations(_faulty(spark, sf_dir)).select(
        "feeder_canonical", "problem"
    )


@query(
    f"""WITH {_FAULTY_SQL}
    SELECT feeder_canonical, anchor FROM faulty WHERE anchor IS NULL OR trim(anchor) = ''"""
)
def dq_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.blank_violations(_faulty(spark, sf_dir)).select("feeder_canonical", "anchor")


_SUITE = {
    "radius": ("service_radius_km > 0", "warn"),
    "confidence": ("confidence IN ('high', 'medium', 'low', 'unlocated')", "fail"),
    "anchor": ("trim(anchor) <> ''", "warn"),
    "box": (
        "confidence = 'unlocated' OR (latitude > 7.1 AND latitude < 7.6 AND longitude > -150 AND longitude < -140)",
        "fail",
    ),
    "key": ("place_id IS NOT NULL", "fail"),
}


@query(
    f"""WITH {_FAULTY_SQL}
    {" UNION ALL ".join(
        f"SELECT '{name}' AS name, '{severity}' AS severity,"
        f" count(*) FILTER (NOT coalesce({holds}, false)) AS violations, count(*) AS rows FROM faulty"
        for name, (holds, severity) in _SUITE.items())}"""
)
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared constraints, all counted in one pass."""
    rules = [quality.Constraint(name, holds, severity == "fail") for name, (holds, severity) in _SUITE.items()]
    return quality.constraint_report(_faulty(spark, sf_dir), rules)
