"""Declared constraints as a data-quality job (S10) and post-load counts.

Checks: NOT NULL on every declared column, PRIMARY KEY / UNIQUE as surplus
rows per key, and the foreign key readings.unit_id → units as orphan rows.
The readings' key is counted in bitmaps, orphans per unit (map-side partial
aggregation), so a key holding a third of the rows costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.joins import join_small

UNITS_NOT_NULL = ["unit_id", "unit_code", "model", "region", "site", "install_date"]
READINGS_NOT_NULL = ["reading_id", "unit_id", "timestamp"]


class ConstraintViolation(RuntimeError):
    """Raised by ``assert_constraints`` when any check finds violations."""


def _unit_checks(units: DataFrame) -> DataFrame:
    """All unit-table checks in one aggregate: NOT NULLs, and PK / UNIQUE as
    surplus rows = count(key) − count(distinct key) (NULL keys excluded)."""
    counts = units.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in UNITS_NOT_NULL],
        (F.count("unit_id") - F.count_distinct("unit_id")).alias("_pk"),
        (F.count("unit_code") - F.count_distinct("unit_code")).alias("_code"))
    checks = [(f"units.{c} not null", c) for c in UNITS_NOT_NULL]
    checks += [("units.unit_id primary key", "_pk"), ("units.unit_code unique", "_code")]
    pairs = F.array(*[F.struct(F.lit(label).alias("check"),
                               F.col(col).cast("long").alias("violations")) for label, col in checks])
    return counts.select(F.inline(pairs))


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """(rows, ids): the rows with an integer ``key`` and its distinct values, exactly.

    Ids fall into buckets of 32,768; a bucket's ids are a bitmap with a bit per
    id, built in each task before anything moves and joined by "or".  What is
    shuffled is a bitmap per task and bucket (4 KB, compressed), not a row per
    id: ids that are close together, as numbered readings are, cost a bit each.
    """
    ids = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"))
    buckets = ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("id"))).alias("ids"))
    return buckets.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "ids")])


def _surplus(df: DataFrame, key: str, label: str) -> DataFrame:
    return distinct_ids(df, key).select(F.lit(label).alias("check"), (F.col("rows") - F.col("ids")).alias("violations"))


def _per_unit_checks(readings: DataFrame, units: DataFrame) -> DataFrame:
    """NOT NULLs of the fact and the foreign key as sums over one per-unit
    partial aggregate (one scan of the fact) beside the known unit ids."""
    per_unit = readings.groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("reading_id").isNull()).alias("reading_id"),
        F.count_if(F.col("timestamp").isNull()).alias("timestamp"))
    ids = units.select("unit_id").distinct().withColumn("known", F.lit(True))
    beside = join_small(per_unit, ids, "unit_id", "left")
    null_unit = F.col("unit_id").isNull()
    orphan = ~null_unit & F.col("known").isNull()
    totals = beside.agg(
        F.sum("reading_id").alias("readings.reading_id not null"),
        F.sum(F.when(null_unit, F.col("n")).otherwise(0)).alias("readings.unit_id not null"),
        F.sum("timestamp").alias("readings.timestamp not null"),
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("readings.unit_id references units"))
    pairs = F.array(*[F.struct(F.lit(c).alias("check"),
                               F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias("violations"))
                      for c in totals.columns])
    return totals.select(F.inline(pairs))


def check_constraints(units: DataFrame, readings: DataFrame) -> DataFrame:
    """(check STRING, violations BIGINT), one row per declared constraint.

    Two scans of the fact: the per-unit aggregate (NOT NULLs, foreign key) and
    the key count (primary key).
    """
    parts = [
        _unit_checks(units),
        _per_unit_checks(readings, units),
        _surplus(readings, "reading_id", "readings.reading_id primary key"),
    ]
    return reduce(DataFrame.unionByName, parts)


def assert_constraints(units: DataFrame, readings: DataFrame) -> dict[str, int]:
    """Run the checks (one small result, ≤ 12 rows) and raise on any violation."""
    found = {r["check"]: r["violations"] for r in check_constraints(units, readings).collect()}
    bad = {k: v for k, v in found.items() if v}
    if bad:
        raise ConstraintViolation(f"constraint violations: {bad}")
    return found
