"""Exact distribution summaries per group (D6) in three passes over the fact.

Quantiles use the linear rule of SQL ``percentile`` / ``quantile_cont``: at
position p = q·(n−1) the value is v[⌊p⌋] + (v[⌈p⌉] − v[⌊p⌋])·(p − ⌊p⌋).

1. A quantile sketch per group (``percentile_approx``, ranks off by at most a
   share ``1 / ACCURACY`` of the group) brackets each quartile: the values at
   the sketch's quantiles two such shares below and above it.  Groups of up to
   ``ACCURACY`` values are their own bracket.
2. An exact pass counts the values outside of the brackets by the gap they lie
   in, and the values inside one by one, equal ones together, before anything
   is shuffled.  The counts give every kept value its exact rank.
3. The fences known, a pass counts what lies outside of them.

Brackets are cut by rank, not by value, so heavy tails and far outliers don't
fill them: about ``6 / ACCURACY`` of a group's rows are kept per quartile,
whatever the values.  A rank that its bracket doesn't hold would break the
sketch's guarantee and stops the query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions import columns as C

QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
FENCE_IQR = 1.5
#: Inverse of the sketch's relative rank error.
ACCURACY = 10_000
KEYS, CARRIED = ["metric", "group"], ["n", "min", "max"]


def stack_metrics(df: DataFrame, group_col: str, metrics: Sequence[str]) -> DataFrame:
    """Long form (group, metric, value) of the chosen metric columns, NULLs and NaN dropped."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                      for m in metrics])
    return (df.select(F.col(group_col).alias("group"), F.inline(pairs))
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def with_fences(summary: DataFrame) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return (summary.withColumn("lower_fence", F.col("q1") - F.lit(FENCE_IQR) * iqr)
            .withColumn("upper_fence", F.col("q3") + F.lit(FENCE_IQR) * iqr))


def _beside(values: DataFrame, side: DataFrame) -> DataFrame:
    """Values with their group's rows of ``side`` (NULL groups match)."""
    side = side.withColumnsRenamed({k: f"_{k}" for k in KEYS})
    on = (values["metric"] == side["_metric"]) & values["group"].eqNullSafe(side["_group"])
    # One row per label, metric and rank: labels are the few texts of a CASE or a condition column.
    return values.join(F.broadcast(side), on).drop("_metric", "_group")


def _brackets(long: DataFrame) -> DataFrame:
    """(metric, group, n, min, max, brackets): of each group and quartile the values (lo, hi) that hold its ranks."""
    slack = 2 / ACCURACY
    shares = [share for _, q in QUARTILES for share in (q - slack, q + slack)]
    sketch = F.percentile_approx("value", F.array(*[F.lit(x) for x in shares]), F.lit(ACCURACY))
    groups = long.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
                                     sketch.alias("cuts"))
    small = F.col("n") <= ACCURACY
    brackets = [F.struct(F.when(small, F.col("min")).otherwise(F.col("cuts")[2 * k]).alias("lo"),
                         F.when(small, F.col("max")).otherwise(F.col("cuts")[2 * k + 1]).alias("hi"))
                for k in range(len(QUARTILES))]
    return groups.select(*KEYS, *CARRIED, F.array(*brackets).alias("brackets"))


def _counted(long: DataFrame, brackets: DataFrame) -> DataFrame:
    """(group columns, kept, gap, rows): values inside a bracket with their rows, and the rows of each gap between brackets."""
    beside = _beside(long, brackets)
    edges = [F.col("brackets")[k] for k in range(len(QUARTILES))]
    inside = edges[0]["lo"].isNull()
    gap = F.lit(0)
    for e in edges:
        inside = inside | F.col("value").between(e["lo"], e["hi"])
        gap = gap + (F.col("value") > e["hi"]).cast("int")
    return (beside.withColumns({"kept": F.when(inside, F.col("value")), "gap": F.when(~inside, gap)})
            .groupBy(*KEYS, *CARRIED, "brackets", "kept", "gap").agg(F.count(F.lit(1)).alias("rows")))


def quartiles(long: DataFrame) -> DataFrame:
    """(metric, group, n, min, max, q1, median, q3) of every group."""
    counted = _counted(long, _brackets(long))
    # In order of value: gap k lies before the kept values above k brackets' ends.
    whole = [F.col("brackets")[k]["hi"] for k in range(len(QUARTILES))]
    ends = F.lit(0)
    for hi in whole:
        ends = ends + (F.col("kept") > hi).cast("int")
    # A gap's rows come after the brackets that end below it and before the next one begins.
    after = F.when(F.col("gap").isNotNull(), F.col("gap") * 2).otherwise(ends * 2 + 1)
    order = Window.partitionBy(*KEYS).orderBy("_after", "kept").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (counted.withColumn("_after", after)
              .withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0)))
              .filter(F.col("kept").isNotNull()))

    def at(rank: Column) -> Column:
        holds = (F.col("before") <= rank) & (rank < F.col("before") + F.col("rows"))
        return F.max(F.when(holds, F.col("kept")))

    ranks = {}
    for name, q in QUARTILES:
        pos = (F.col("n") - 1) * F.lit(q)
        ranks |= {f"{name}_lo": at(F.floor(pos).cast("long")), f"{name}_hi": at(F.ceil(pos).cast("long"))}
    found = ranked.groupBy(*KEYS, *CARRIED).agg(*[c.alias(k) for k, c in ranks.items()])
    cols = []
    for name, q in QUARTILES:
        pos = (F.col("n") - 1) * F.lit(q)
        lost = F.raise_error(F.lit("a quantile sketch's bracket doesn't hold its rank")).cast("double")
        lo, hi = (F.coalesce(F.col(f"{name}_{end}"), lost) for end in ("lo", "hi"))
        cols.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return found.select(*KEYS, *CARRIED, *cols)


def box_summary(df: DataFrame, group_col: str, metrics: Sequence[str], decimals: int = 6) -> DataFrame:
    """min, q1, median, q3, max, 1.5·IQR fences and outlier count per (group, metric)."""
    long = stack_metrics(df, group_col, metrics)
    summary = with_fences(quartiles(long))
    measures = [c for c in summary.columns if c not in KEYS]
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    out = _beside(long, summary).groupBy(*KEYS, *measures).agg(F.count_if(outside).alias("outliers"))
    rnd = [C.half_up_round(c, decimals).alias(c) for c in
           ("min", "q1", "median", "q3", "max", "lower_fence", "upper_fence")]
    return out.select(F.col("group").alias(group_col), "metric", "n", *rnd,
                      F.col("outliers").cast("long").alias("outliers")
                      ).orderBy("metric", F.asc_nulls_first(group_col))
