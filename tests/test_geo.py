import math
import re

import pytest
from pyspark.sql import functions as F

from faultline.functions import geo
from faultline.operators import mapping
from faultline.schemas import LOCATIONS
from made_places import PLACES as PLACES_OF_FEEDERS


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(*values):
    return [F.lit(v) for v in values]


def km(lat1, lon1, lat2, lon2):
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2
    h += math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize(
    "place, km_apart",
    [
        ((0.0, 0.0, 0.0, 90.0), math.pi / 2 * 6371.0088),  # a quarter of the equator
        ((90.0, 12.0, 90.0, -77.0), 0.0),  # all meridians meet at the pole
        ((-89.0, 0.0, -89.0, 180.0), math.radians(2.0) * 6371.0088),  # across the south pole
        ((10.0, 179.5, 10.0, -179.5), km(10.0, 0.0, 10.0, 1.0)),  # across the date line
        ((-33.0, -70.0, -34.0, -70.0), math.radians(1.0) * 6371.0088),  # along a meridian
    ],
)
def test_distances(spark, place, km_apart):
    assert one(spark, geo.haversine_km(*lit(*place))) == pytest.approx(km_apart, abs=1e-6)


def test_antipodes_do_not_leave_the_domain(spark):
    got = one(spark, geo.haversine_km(*lit(0.0, 0.0, 0.0, 180.0)))
    assert got == pytest.approx(math.pi * 6371.0088)


PLACES = [(0.0, 0.0, 1.0), (-45.0, 100.0, 30.0), (60.0, 179.9, 12.0), (89.0, -20.0, 5.0)]


@pytest.mark.parametrize("lat, lon, radius", PLACES)
@pytest.mark.parametrize("n", [3, 64])
def test_ring_goes_round_the_place(spark, lat, lon, radius, n):
    ring = one(spark, geo.service_area_ring(*lit(lat, lon, radius), n_vertices=n))
    assert len(ring) == n + 1 and ring[n] == ring[0]
    for p in ring:
        assert km(lat, lon, p.lat, p.lon) == pytest.approx(radius, rel=1e-6)
    # by bearing: north first, then clockwise, in equal steps
    bearings = [bearing(lat, lon, p.lat, p.lon) for p in ring[:n]]
    assert bearings == pytest.approx([i * 360 / n for i in range(n)], abs=1e-4)


def bearing(lat1, lon1, lat2, lon2):
    a, b, d = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    east = math.sin(d) * math.cos(b)
    north = math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(d)
    turn = round(math.degrees(math.atan2(east, north)) % 360, 9)
    return 0.0 if turn > 359.9999 else turn


def test_vertices_as_rows_are_the_ring(spark):
    df = spark.createDataFrame([*PLACES, (None, 1.0, 2.0)], "lat double, lon double, r double")
    rows = geo.with_ring_vertices(df, "lat", "lon", "r", 16).collect()
    got = {(r.lat, r.vertex): (r.vertex_lon, r.vertex_lat) for r in rows}
    assert len(rows) == len(got) == len(PLACES) * 17
    for lat, lon, radius in PLACES:
        ring = one(spark, geo.service_area_ring(*lit(lat, lon, radius), n_vertices=16))
        for i, p in enumerate(ring):
            assert got[lat, i] == pytest.approx((p.lon, p.lat), abs=1e-9)


def test_polygon_text(spark):
    quarter = math.pi / 2 * 6371.0088  # from the pole to the equator, in four directions
    wkt = one(spark, geo.service_area_wkt(*lit(0.0, 10.0, quarter, "high"), n_vertices=4))
    points = [tuple(map(float, p.split())) for p in wkt[len("POLYGON (("):-2].split(", ")]
    assert re.fullmatch(r"POLYGON \(\((-?\d+\.\d{6} -?\d+\.\d{6}(, )?){5}\)\)", wkt)
    assert points[0] == points[4] and points[0][1] == 90.0 and points[2][1] == -90.0
    assert points[1] == (100.0, 0.0) and points[3][0] == -80.0


def test_unlocated_has_no_polygon(spark):
    none = F.lit(None).cast("double")
    assert one(spark, geo.service_area_wkt(none, none, none, F.lit("unlocated"))) is None


@pytest.mark.parametrize(
    "lon, lat, text",
    [
        (-70.125, -33.5, "POINT (-70.125 -33.5)"),
        (3.0, -7.0, "POINT (3 -7)"),
        (0.0001, 100.0, "POINT (0.0001 100)"),
        (None, 7.0, None),
    ],
)
def test_point_text(spark, lon, lat, text):
    assert one(spark, geo.point_wkt(*[F.lit(v).cast("double") for v in (lon, lat)])) == text


def locations(spark):
    return spark.createDataFrame(PLACES_OF_FEEDERS, LOCATIONS)


def test_feeders_at_one_place_are_one_site(spark):
    got = [tuple(r) for r in mapping.overlapping_sites(locations(spark), "feeder_canonical").collect()]
    assert [r[:4] for r in got] == [("APETE", "ROM", 1, 2)]
    assert got[0][4] == pytest.approx(km(7.27, 3.5, 7.25, 3.5))
    counts = mapping.overlap_counts(locations(spark), "feeder_canonical").collect()
    assert sorted(map(tuple, counts)) == [("APETE", 1, 1, 2), ("ROM", 2, 1, 1)]


def test_a_dense_town_gives_a_row_per_site(spark):
    df = spark.range(700).selectExpr(
        "id AS k", "7.0 + id / 1e6 AS latitude", "3.0 + id / 1e6 AS longitude", "1.0D AS service_radius_km"
    )
    rows = mapping.overlap_counts(df, "k").collect()
    assert len(rows) == 700 and {r.n_sites for r in rows} == {699}


def brute_force(rows):
    sites = {}
    for key, lat, lon, radius in rows:
        sites.setdefault((lat, lon, radius), []).append(key)
    at = sorted((min(keys), len(keys), *place) for place, keys in sites.items())
    out = {}
    for i, (a, na, lat1, lon1, r1) in enumerate(at):
        for b, nb, lat2, lon2, r2 in at[i + 1:]:
            d = km(lat1, lon1, lat2, lon2)
            if d < r1 + r2:
                out[(a, b)] = (na, nb, round(d, 6))
    return out


@pytest.mark.parametrize("cell_rows", [2000, 3])
def test_overlaps_equal_brute_force(spark, monkeypatch, cell_rows):
    """Mixed radii, copies, the date line and the poles; also with dense cells split."""
    monkeypatch.setattr(mapping, "CELL_ROWS", cell_rows)
    rows = []
    for i in range(160):
        base = [(7.4, 3.9), (0.0, 179.99), (89.97, 10.0), (-33.0, -70.0)][i % 4]
        lat = min(89.99, base[0] + (i * 7 % 23) * 0.006)
        lon = base[1] + (i * 13 % 29) * 0.008
        lon = lon - 360 if lon > 180 else lon
        rows.append((i, lat, lon, [0.05, 0.4, 2.5, 6.0, 40.0][i * 3 % 5]))
    rows += [(1000 + i, 7.4, 3.9, 2.5) for i in range(50)]
    rows.append((2000, 50.0, 50.0, 9000.0))
    df = spark.createDataFrame(rows, "k int, latitude double, longitude double, service_radius_km double")
    got = {
        (r.site_a, r.site_b): (r.members_a, r.members_b, round(r.distance_km, 6))
        for r in mapping.overlapping_sites(df, "k").collect()
    }
    want = brute_force(rows)
    assert got == want
    counts = {r.site: r.n_sites for r in mapping.overlap_counts(df, "k").collect()}
    assert counts == {k: sum(k in pair for pair in want) for k in counts}


def test_counting_does_not_meet_all_sites_of_a_town(spark):
    """Four times the sites, in a town that most areas cover half of: far from 16 times the rows."""
    met = {}
    for n in (1000, 4000):
        df = spark.range(n).selectExpr(
            "id AS k", "7.0 + pmod(hash(id), 9973) * 1e-5 AS latitude",
            "3.0 + pmod(hash(id, 7), 9967) * 1e-5 AS longitude", "2.0D + id % 3 AS service_radius_km",
        )
        rows, whole, border = mapping._reached(df, "k")
        met[n] = mapping._compared(rows, border).count() + whole.count()
        if n == 1000:
            counts = mapping.overlap_counts(df, "k").agg(F.sum("n_sites")).first()[0]
            assert counts == 2 * len(brute_force([tuple(r) for r in df.collect()]))
    assert met[4000] < 9 * met[1000] and met[4000] < 4000**2 / 8


def test_map_keeps_unlocated_feeders(spark):
    metrics = spark.createDataFrame(
        [("APATA", 3, 1.0, 5.0, 9.0), ("SAMONDA", 4, 1.0, 2.0, 9.0), ("ROM", 1, 1.0, None, 9.0)],
        "feeder_canonical string, total_outages long, mttr_hours double, mtbf_hours double, "
        "total_customer_hours_interruption double",
    )
    rows = mapping.reliability_map(metrics, locations(spark)).collect()
    by = {r.feeder_canonical: r for r in rows}
    assert by["SAMONDA"].location_wkt == "POINT (3.5 7.25)" and len(rows) == 3
    assert by["APATA"].location_wkt is None and by["APATA"].location_confidence == "unlocated"
