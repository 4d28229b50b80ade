"""Joins against dimension-sized tables, with a checked broadcast.

A side is broadcast only if the files (or local rows) behind it are small:
their planned sizes, times a factor assumed for decoding, must stay within
``fleetpulse.broadcast.maxBytes``.  The check reads plan statistics only: no
job runs, nothing is remembered between queries.  It is meant for sides that
have no more rows than the tables they are made of (selections, projections
and N:1 joins of dimensions); the factor is an assumption that columns of few
distinct values can exceed, which is why the bound is far below what a task
can hold.  Beyond the bound, or where a size is unknown, the join is a shuffle
in which hot keys, measured by a pass over the key column, are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.session import BROADCAST_BYTES_KEY, conf_int

DEFAULT_BROADCAST_BYTES = 256 << 20
#: Decoded rows against compressed Parquet files.
DECODED_FACTOR = 8
UNIT_ATTRIBUTES = ("unit_code", "model", "region", "site")


def source_bytes(df: DataFrame) -> int:
    """Planned size of everything ``df`` reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the tables behind ``df`` are small enough to broadcast it."""
    bound = conf_int(df.sparkSession, BROADCAST_BYTES_KEY, DEFAULT_BROADCAST_BYTES)
    return DECODED_FACTOR * source_bytes(df) <= bound


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """``left.join(right)`` with ``right`` broadcast when it passes the size check."""
    return left.join(F.broadcast(right) if fits_broadcast(right) else right, on, how)


def restrict_to_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """Rows whose ``unit_id`` exists in ``units`` (what an inner join keeps)."""
    return join_small(df, units.select("unit_id"), "unit_id", "left_semi")


def attach_units(df: DataFrame, units: DataFrame,
                 columns=UNIT_ATTRIBUTES) -> DataFrame:
    """Inner N:1 join of a fact (or a per-unit table) to unit attributes."""
    return join_small(df, units.select("unit_id", *columns), "unit_id", "inner")


#: A key with more than this share of the rows is hot; its rows are dealt in parts of about that size.
HOT_SHARE = 1 / 256


def key_counts(fact: DataFrame, key: str) -> DataFrame:
    """(key, n): the rows of every key, counted in each task before they move."""
    return fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def join_splitting(fact: DataFrame, side: DataFrame, key: str, spread_by: str, counts: DataFrame | None = None) -> DataFrame:
    """Inner join of a fact to a side with one row per key, by a shuffle in which hot keys are split.

    ``counts`` (key, n) is the number of rows of each key, counted by a pass
    over the key column if it isn't given.  Fewer than ``1 / HOT_SHARE`` keys
    can be hot, so the table of their parts is broadcast to both sides; a hot
    key's rows are dealt to its parts by ``spread_by`` (a fact column that
    differs within a key), its row of the side is repeated for each of them.
    All other keys have one part.
    """
    counts = key_counts(fact, key) if counts is None else counts
    total = counts.select(F.sum("n")).scalar()
    share = F.col("n") / total
    hot = counts.filter(share > F.lit(HOT_SHARE)).select(
        F.col(key).alias("_hot"), F.ceil(share / F.lit(HOT_SHARE)).cast("int").alias("_parts"))

    def with_parts(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(hot), df[key] == F.col("_hot"), "left")
        return joined.withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop("_hot")

    salt = F.pmod(F.xxhash64(spread_by), F.col("_parts")).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    return (with_parts(fact).withColumn("_salt", salt).drop("_parts")
            .join(with_parts(side).withColumn("_salt", salts).drop("_parts"), [key, "_salt"]).drop("_salt"))


def attach_units_splitting(fact: DataFrame, units: DataFrame, columns=UNIT_ATTRIBUTES, spread_by: str = "reading_id") -> DataFrame:
    """``attach_units`` of a whole fact: beyond the broadcast bound hot units are split."""
    side = units.select("unit_id", *columns)
    if fits_broadcast(side):
        return fact.join(F.broadcast(side), "unit_id")
    return join_splitting(fact, side, "unit_id", spread_by)


def restrict_to_units_splitting(fact: DataFrame, units: DataFrame, spread_by: str = "reading_id") -> DataFrame:
    """``restrict_to_units`` of a whole fact: beyond the broadcast bound hot units are split."""
    side = units.select("unit_id")
    if fits_broadcast(side):
        return fact.join(F.broadcast(side), "unit_id", "left_semi")
    return join_splitting(fact, side.distinct(), "unit_id", spread_by)
