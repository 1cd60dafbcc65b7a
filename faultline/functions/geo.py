"""Spherical geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.rules import EARTH_RADIUS_KM, REGION_BOX
from faultline.functions.text import as_column

UNLOCATED = "unlocated"


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(as_column, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2) - F.radians(lat1)
    dlon = F.radians(lon2 - lon1)
    half = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(half)))


def destination_point(lat, lon, bearing_deg, distance_km) -> Column:
    """struct(lat, lon) reached on a great circle; the longitude is not wrapped."""
    lat, lon, bearing_deg, distance_km = map(as_column, (lat, lon, bearing_deg, distance_km))
    phi, arc, course = F.radians(lat), distance_km / EARTH_RADIUS_KM, F.radians(bearing_deg)
    sin_to = F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(course)
    turn = F.atan2(
        F.sin(course) * F.sin(arc) * F.cos(phi),
        F.cos(arc) - F.sin(phi) * F.sin(F.asin(sin_to)),
    )
    return F.struct(
        F.degrees(F.asin(sin_to)).alias("lat"),
        F.degrees(F.radians(lon) + turn).alias("lon"),
    )


def service_area_ring(lat, lon, radius_km, n_vertices: int = 64) -> Column:
    """Closed ring of (lon, lat) around a point, due north first, clockwise."""
    lat, lon, radius_km = map(as_column, (lat, lon, radius_km))

    def vertex(i: Column) -> Column:
        at = destination_point(lat, lon, i * 360.0 / n_vertices, radius_km)
        return F.struct(at["lon"].alias("lon"), at["lat"].alias("lat"))

    # The last vertex repeats bearing 0, so the ring closes on exactly the first point.
    steps = F.array(*[F.lit(i % n_vertices) for i in range(n_vertices + 1)])
    return F.when(lat.isNotNull() & lon.isNotNull() & radius_km.isNotNull(),
                  F.transform(steps, vertex))


def with_ring_vertices(
    df: DataFrame, lat: str, lon: str, radius_km: str, n_vertices: int = 64
) -> DataFrame:
    """One row per vertex of each row's closed ring: `vertex`, `vertex_lon`, `vertex_lat`.

    The same points as :func:`service_area_ring`, in compiled code: numbers are made first,
    and each vertex is plain arithmetic on its row. Rows without a place give none.
    """
    placed = df.filter(
        F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(radius_km).isNotNull()
    )
    numbered = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_vertices))).alias("vertex"))
    bearing = F.col("vertex") % n_vertices * 360.0 / n_vertices
    return numbered.withColumn("__at", destination_point(lat, lon, bearing, radius_km)).select(
        *df.columns,
        "vertex",
        F.col("__at.lon").alias("vertex_lon"),
        F.col("__at.lat").alias("vertex_lat"),
    )


def polygon_wkt(ring) -> Column:
    points = F.transform(
        as_column(ring), lambda p: F.format_string("%.6f %.6f", p["lon"], p["lat"])
    )
    return F.concat(F.lit("POLYGON (("), F.array_join(points, ", "), F.lit("))"))


def is_located(confidence="confidence") -> Column:
    return as_column(confidence) != UNLOCATED


def service_area_wkt(lat, lon, radius_km, confidence="confidence", n_vertices: int = 64) -> Column:
    """Polygon text of a service area; null when the place is not located."""
    ring = service_area_ring(lat, lon, radius_km, n_vertices)
    return F.when(is_located(confidence), polygon_wkt(ring))


def _plain_number(c: Column) -> Column:
    """Shortest decimal text: no exponent and no trailing zeros."""
    text = c.cast("string")
    spelled_out = F.regexp_replace(F.format_string("%.20f", c), r"\.?0+$", "")
    return F.when(text.contains("E"), spelled_out).otherwise(F.regexp_replace(text, r"\.0$", ""))


def point_wkt(lon, lat) -> Column:
    """Point text; null when a coordinate is."""
    lon, lat = as_column(lon), as_column(lat)
    return F.concat(F.lit("POINT ("), _plain_number(lon), F.lit(" "), _plain_number(lat), F.lit(")"))


def in_box(lat, lon, box: dict = REGION_BOX) -> Column:
    """Strictly inside a latitude/longitude box."""
    lat, lon = as_column(lat), as_column(lon)
    return (
        (lat > box["lat"][0]) & (lat < box["lat"][1]) & (lon > box["lon"][0]) & (lon < box["lon"][1])
    )


def sphere_xyz(lat, lon) -> Column:
    """struct(x, y, z) in km. A straight line is never longer than the arc over it."""
    lat, lon = as_column(lat), as_column(lon)
    flat = F.cos(F.radians(lat)) * EARTH_RADIUS_KM
    return F.struct(
        (flat * F.cos(F.radians(lon))).alias("x"),
        (flat * F.sin(F.radians(lon))).alias("y"),
        (F.sin(F.radians(lat)) * EARTH_RADIUS_KM).alias("z"),
    )
