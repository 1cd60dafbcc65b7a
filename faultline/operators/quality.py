"""Checks of reference data. Each returns the violations, so an empty table means it holds."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from faultline.functions import rules
from faultline.functions.geo import UNLOCATED, in_box, service_area_wkt


def key_violations(reference: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys that are not exactly once on each side.

    Keys are counted on both sides before the join, so it meets each key once.
    """
    found = reference.groupBy(key).agg(F.count(F.lit(1)).alias("n_found"))
    wanted = expected.groupBy(key).agg(F.count(F.lit(1)).alias("n_expected"))
    problem = (
        F.when(F.col("n_found").isNull(), "missing")
        .when(F.col("n_expected").isNull(), "unknown")
        .when((F.col("n_found") > 1) | (F.col("n_expected") > 1), "duplicate")
    )
    return (
        found.join(wanted, key, "full_outer")
        .select(
            key,
            problem.alias("problem"),
            F.coalesce("n_found", F.lit(0)).cast("bigint").alias("n_found"),
            F.coalesce("n_expected", F.lit(0)).cast("bigint").alias("n_expected"),
        )
        .filter(F.col("problem").isNotNull())
    )


def _not_true(holds: Column) -> Column:
    return ~F.coalesce(holds, F.lit(False))


def domain_violations(
    df: DataFrame, column: str = "confidence", allowed: tuple[str, ...] = rules.CONFIDENCE_LEVELS
) -> DataFrame:
    return df.filter(_not_true(F.col(column).isin(*allowed)))


def blank_violations(df: DataFrame, column: str = "anchor") -> DataFrame:
    return df.filter(_not_true(F.trim(column) != ""))


def box_violations(df: DataFrame, box: dict = rules.REGION_BOX) -> DataFrame:
    """Located rows outside the region."""
    located = F.col("confidence") != UNLOCATED
    return df.filter(located & _not_true(in_box("latitude", "longitude", box)))


def location_violations(df: DataFrame) -> DataFrame:
    """Located rows need coordinates and a positive radius; unlocated ones may have no
    coordinates, and no polygon may come out of them."""
    complete = (
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & (F.col("service_radius_km") > 0)
    )
    polygon = service_area_wkt("latitude", "longitude", "service_radius_km", n_vertices=4)
    empty = F.col("latitude").isNull() & F.col("longitude").isNull() & polygon.isNull()
    unlocated = F.col("confidence") == UNLOCATED
    problem = F.when(~unlocated & _not_true(complete), "located_incomplete").when(
        unlocated & _not_true(empty), "unlocated_with_coordinates"
    )
    return df.withColumn("problem", problem).filter(F.col("problem").isNotNull())


# ---- declared constraints, counted in one pass


@dataclass(frozen=True)
class Constraint:
    """What must hold for every row, as SQL; null does not hold. `fails`: a violation stops a
    write."""

    name: str
    holds: str
    fails: bool = True


class ViolatedError(RuntimeError):
    """A table was not accepted."""


def _violations(constraints: list[Constraint]) -> list[Column]:
    return [F.count_if(_not_true(F.expr(c.holds))).alias(f"violated_{i}") for i, c in enumerate(constraints)]


def constraint_report(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One row per constraint: name, severity, violations, rows. The table is read once, however
    many constraints there are, and one row per task is shuffled."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *_violations(constraints))
    entries = [
        F.struct(
            F.lit(c.name).alias("name"),
            F.lit("fail" if c.fails else "warn").alias("severity"),
            F.col(f"violated_{i}").alias("violations"),
            F.col("rows"),
        )
        for i, c in enumerate(constraints)
    ]
    return counts.select(F.inline(F.array(*entries)))


def observed(df: DataFrame, constraints: list[Constraint]) -> tuple[DataFrame, Observation]:
    """The rows, counted against the constraints by whichever job reads them next."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *_violations(constraints)), seen


def judged(seen: Observation, constraints: list[Constraint]) -> dict[str, int]:
    """Violations of the constraints that only warn; raises if another one is violated."""
    counts = {c.name: seen.get[f"violated_{i}"] for i, c in enumerate(constraints)}
    broken = {c.name: counts[c.name] for c in constraints if c.fails and counts[c.name]}
    if broken:
        raise ViolatedError(", ".join(f"{name}: {n} rows" for name, n in broken.items()))
    return {name: n for name, n in counts.items() if n}


# ---- equality of whole tables


def _row_hash(columns: list[str], seed: int) -> Column:
    # a null is named as such: by itself it would leave the hash as it is
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")


def cover(whole: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """One row: n_whole, n_parts, and whether the parts hold together exactly the rows of the
    whole, each as often.

    Rows are told by two hashes, whose sums do not depend on their order: one pass over either
    side, no join and no sort. Values that change places change both sums.
    """
    columns = whole.columns
    sides = [(whole, True), *((p, False) for p in parts)]
    marked = [
        df.select(F.lit(side).alias("whole"), *[_row_hash(columns, k).alias(f"h{k}") for k in (0, 1)])
        for df, side in sides
    ]
    per_side = [
        f.alias(f"{name}_{side}")
        for side, of in (("whole", F.col("whole")), ("parts", ~F.col("whole")))
        for name, f in (("n", F.count_if(of)), *((h, F.sum(F.when(of, F.col(h)))) for h in ("h0", "h1")))
    ]
    sums = reduce(DataFrame.union, marked).agg(*per_side)
    same = [F.col(f"{c}_whole").eqNullSafe(F.col(f"{c}_parts")) for c in ("n", "h0", "h1")]
    return sums.select("n_whole", "n_parts", (same[0] & same[1] & same[2]).alias("covered"))
