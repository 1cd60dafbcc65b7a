"""Metrics on the map, and service areas that overlap."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.geo import haversine_km, point_wkt, sphere_xyz
from faultline.functions.rules import EARTH_RADIUS_KM
from faultline.session import stored

# Sizes of grid cells are powers of two km; the largest exceeds half the way round the earth.
MAX_LEVEL = 15
MIN_LEVEL = -4
# Sites of one grid cell that may meet in one join task; denser cells are split.
CELL_ROWS = 2_000
# The tree for counting: sizes of its cells in powers of two km, sites in a leaf.
TREE_AXES = ("x", "y", "z", "r")
TREE_LEVELS = (14, 6, 4, 2, 0, -2, -4, -6, -8, -10)
LEAF_SITES = 8
DOUBT_KM = 1e-6


def reliability_map(
    metrics: DataFrame, locations: DataFrame, entity: str = "feeder_canonical"
) -> DataFrame:
    """Metrics with their location. Entities that are not located keep their metrics.

    Both sides have one row per entity, so no key is heavy; whether the locations are
    broadcast is left to Spark, which knows their size.
    """
    numbers = {c: F.col(c).try_cast("double") for c in ("latitude", "longitude", "service_radius_km")}
    placed = locations.select(
        entity,
        F.col("confidence").alias("location_confidence"),
        "setting",
        *[number.alias(c) for c, number in numbers.items()],
    )
    return (
        metrics.join(placed, entity, "left")
        .withColumn("location_wkt", point_wkt("longitude", "latitude"))
    )


def sites(locations: DataFrame, key: str) -> DataFrame:
    """One row per distinct place and radius, with the number of members and the least key."""
    return (
        locations.filter(
            F.col("latitude").isNotNull()
            & F.col("longitude").isNotNull()
            & (F.col("service_radius_km") > 0)
        )
        .groupBy("latitude", "longitude", "service_radius_km")
        .agg(F.min(key).alias("site"), F.count(F.lit(1)).alias("members"))
    )


def _cell(xyz: Column, axis: str, size: Column) -> Column:
    return F.floor(xyz[axis] / size).cast("bigint")


def _reached_cells(xyz: Column, axis: str, reach: Column, size: Column) -> Column:
    return F.sequence(
        F.floor((xyz[axis] - reach) / size).cast("bigint"),
        F.floor((xyz[axis] + reach) / size).cast("bigint"),
    )


def _parted(waiting: DataFrame, visiting: DataFrame, cell: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of dense cells cut into parts of CELL_ROWS sites; each part goes to every part
    of the other side. The table of dense cells is joined as Spark sees fit."""
    both = waiting.select(*cell, F.lit(1).alias("w"), F.lit(0).alias("v")).union(
        visiting.select(*cell, F.lit(0), F.lit(1))
    )
    counts = both.groupBy(*cell).agg(F.sum("w").alias("w"), F.sum("v").alias("v"))
    dense = stored(
        counts.filter((F.col("w") > CELL_ROWS) | (F.col("v") > CELL_ROWS)).select(
            *cell,
            F.ceil(F.col("w") / CELL_ROWS).cast("int").alias("w_parts"),
            F.ceil(F.col("v") / CELL_ROWS).cast("int").alias("v_parts"),
        ),
        "dense-cells",
    )

    def cut(side: DataFrame, own: str, other: str) -> DataFrame:
        n_own, n_other = (F.coalesce(F.col(f"{x}_parts"), F.lit(1)) for x in (own, other))
        mine = F.pmod(F.xxhash64("site"), n_own).cast("int")
        return (
            side.join(dense, cell, "left")
            .withColumn(f"{own}_part", mine)
            .withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), n_other - 1)))
            .drop("w_parts", "v_parts")
        )

    return cut(waiting, "w", "v"), cut(visiting, "v", "w")


def _overlaps(locations: DataFrame, key: str) -> DataFrame:
    """Rows of two sites a and b whose service areas overlap, each pair once.

    Assets at one place with one radius form a single site first, so copies of a place never
    multiply. Each site has a level, the power of two above its radius. A pair is sought at
    the larger of its two levels, on a grid of cells as wide as the two radii can be together:
    the larger site visits the cells it can reach (at most 27), the smaller one waits in its own
    cell. A far-reaching site thus never widens the cells of the others.
    """
    level = F.least(
        F.lit(MAX_LEVEL),
        F.greatest(F.lit(MIN_LEVEL), F.ceil(F.log2("service_radius_km")).cast("int")),
    )
    placed = stored(
        sites(locations, key)
        .withColumn("level", level)
        .withColumn("xyz", sphere_xyz("latitude", "longitude")),
        "sites",
    )
    levels = placed.agg(F.collect_set("level").alias("levels")).scalar()  # at most 20
    size = F.pow(F.lit(2.0), F.col("at") + 1)
    axes = ("x", "y", "z")
    cell = ["at", *axes]
    larger = F.array_intersect(levels, F.sequence("level", F.lit(MAX_LEVEL)))
    own_cell = {axis: _cell(F.col("xyz"), axis, size) for axis in axes}
    waiting = placed.withColumn("at", F.explode(larger)).withColumns(own_cell)
    widest = F.lit(2.0 ** (MAX_LEVEL + 1))
    reach = F.least(widest, F.col("service_radius_km") + F.pow(F.lit(2.0), F.col("at")))
    visiting = placed.withColumn("at", F.col("level"))
    for axis in axes:
        cells = _reached_cells(F.col("xyz"), axis, reach, size)
        visiting = visiting.withColumn(axis, F.explode(cells))
    waiting, visiting = _parted(waiting, visiting, cell)

    fields = ("site", "members", "latitude", "longitude", "service_radius_km", "level")
    meet = [*cell, "w_part", "v_part"]
    a = visiting.select(*meet, *[F.col(f).alias(f"{f}_a") for f in fields])
    b = waiting.select(*meet, *[F.col(f).alias(f"{f}_b") for f in fields])
    distance = haversine_km("latitude_a", "longitude_a", "latitude_b", "longitude_b")
    # On equal levels both sites visit the other; the smaller key speaks.
    once = (F.col("level_a") > F.col("level_b")) | (F.col("site_a") < F.col("site_b"))
    return (
        a.join(b, meet)
        .filter(once)
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") < F.col("service_radius_km_a") + F.col("service_radius_km_b"))
    )


def _tree_cell(level: Column) -> list[Column]:
    """The cell of a site on a level, in space and radius."""
    size = F.pow(F.lit(2.0), level)
    return [F.floor(F.col(c) / size).cast("bigint").alias(f"c{c}") for c in TREE_AXES]


def _tree(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of all levels with their totals, and the sites with the leaf each is in.

    Space and radius are halved together, so that a small cell holds sites whose areas reach
    about equally far. A cell is a leaf if it holds few sites, or is on the lowest level; its
    box is that of its sites, which lie on a sphere and fill little of the cell.
    """
    levels = F.array(*[F.lit(i) for i in TREE_LEVELS])
    each = placed.withColumn("level", F.explode(levels))
    each = each.select("*", *_tree_cell(F.col("level")))
    cell = ["level", *[f"c{c}" for c in TREE_AXES]]
    ends = [f(c).alias(f"{name}_{c}") for c in TREE_AXES for f, name in ((F.min, "low"), (F.max, "high"))]
    totals = each.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("n"), F.sum("members").alias("total"), *ends
    )
    small = (F.col("n") <= LEAF_SITES) | (F.col("level") == TREE_LEVELS[-1])
    cells = stored(totals.withColumn("leaf", small), "tree-cells")
    # on the way down, the first small cell is the leaf
    leaves = each.join(cells.filter("leaf").select(*cell), cell).groupBy("site").agg(
        F.max("level").alias("level")
    )
    fields = ("members", "latitude", "longitude", "service_radius_km")
    return cells, each.select("site", *fields, *cell).join(leaves, ["site", "level"])


def _chord(arc: Column) -> Column:
    """The straight line below an arc of this many km."""
    whole = F.least(arc, F.lit(math.pi * EARTH_RADIUS_KM))
    return F.sin(whole / (2 * EARTH_RADIUS_KM)) * (2 * EARTH_RADIUS_KM)


def _seen_cells(front: DataFrame, cells: DataFrame, on: list[str]) -> DataFrame:
    """The cells below those in `front` that a site's area may touch, and whether it reaches
    all sites in them for certain. Doubt, by a millimetre, is left to the comparison of rows."""
    near, far = F.lit(0.0), F.lit(0.0)
    for c in ("x", "y", "z"):
        own, low, high = F.col(f"own_{c}"), F.col(f"low_{c}"), F.col(f"high_{c}")
        near = near + F.pow(F.greatest(low - own, own - high, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(F.abs(own - low), F.abs(own - high)), 2)
    least, most = (_chord(F.col("own_r") + F.col(f"{end}_r")) for end in ("low", "high"))
    return (
        front.join(cells, on)
        .filter(F.sqrt(near) <= most + DOUBT_KM)
        .withColumn("within", F.sqrt(far) < least - DOUBT_KM)
    )


def _reached(locations: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sites; site, n, total of cells that are reached as a whole; site and leaf to compare)."""
    placed = stored(
        sites(locations, key)
        .withColumn("xyz", sphere_xyz("latitude", "longitude"))
        .select(
            "site", "members", "latitude", "longitude", "service_radius_km", "xyz.*",
            F.col("service_radius_km").alias("r"),
        ),
        "sites",
    )
    cells, rows = _tree(placed)
    names = [f"c{c}" for c in TREE_AXES]
    own = ["site", *[f"own_{c}" for c in TREE_AXES]]
    front = placed.select("site", *[F.col(c).alias(f"own_{c}") for c in TREE_AXES])
    front = front.withColumn("to", F.lit(TREE_LEVELS[0]))
    below = cells.withColumn("to", F.col("level"))
    on, whole, border = ["to"], [], []
    for level, lower in zip(TREE_LEVELS, (*TREE_LEVELS[1:], None)):
        seen = stored(_seen_cells(front, below.filter(F.col("level") == level), on), "tree-front")
        whole.append(seen.filter("within").select("site", "n", "total"))
        border.append(seen.filter("NOT within AND leaf").select(*own, "level", *names))
        front = seen.filter("NOT within AND NOT leaf").select(
            *own, *[F.col(c).alias(f"p{c}") for c in names]
        )
        if lower is None or front.isEmpty():
            break
        shift = F.lit(2.0 ** (level - lower))
        on = [f"p{c}" for c in names]
        below = cells.withColumns({f"p{c}": F.floor(F.col(c) / shift).cast("bigint") for c in names})
    return rows, reduce(DataFrame.union, whole), reduce(DataFrame.union, border)


def _compared(rows: DataFrame, border: DataFrame) -> DataFrame:
    """The sites of every leaf at the edge of an area, next to the site whose area it is."""
    cell = ["level", *[f"c{c}" for c in TREE_AXES]]
    place = ("latitude", "longitude", "service_radius_km")
    mine = rows.select(F.col("site"), *[F.col(c).alias(f"{c}_a") for c in place])
    met = border.select("site", *cell).join(rows.withColumnRenamed("site", "other"), cell)
    return met.join(mine, "site")


def overlap_counts(locations: DataFrame, key: str) -> DataFrame:
    """Every site with the number of other sites whose areas overlap its own, and of their
    members.

    No pair of sites is made where a whole cell is in reach: its stored totals are added. The
    tree of cells is walked for all sites together, a level at a time; only leaves at the edge
    of an area compare rows. In a town of n sites that overlap, a site meets in the order of
    the square root of n leaves instead of n sites.
    """
    rows, whole, border = _reached(locations, key)
    distance = haversine_km("latitude_a", "longitude_a", "latitude", "longitude")
    reach = F.col("service_radius_km_a") + F.col("service_radius_km")
    near = _compared(rows, border).filter(distance < reach)
    found = whole.union(near.select("site", F.lit(1).cast("bigint"), "members"))
    counts = found.groupBy("site").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    # every site reaches itself
    return rows.select("site", "members").join(counts, "site").select(
        "site",
        "members",
        (F.col("n") - 1).alias("n_sites"),
        (F.col("total") - F.col("members")).alias("n_members"),
    )


def overlapping_sites(locations: DataFrame, key: str) -> DataFrame:
    """The pairs themselves, with their distance: as many rows as there are overlaps."""
    a_first = F.col("site_a") < F.col("site_b")
    return _overlaps(locations, key).select(
        F.least("site_a", "site_b").alias("site_a"),
        F.greatest("site_a", "site_b").alias("site_b"),
        F.when(a_first, F.col("members_a")).otherwise(F.col("members_b")).alias("members_a"),
        F.when(a_first, F.col("members_b")).otherwise(F.col("members_a")).alias("members_b"),
        "distance_km",
    )
