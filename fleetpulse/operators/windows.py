"""Moving averages over a per-unit row frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.session import BUCKET_SECONDS_KEY, conf_int

DEFAULT_BUCKET_SECONDS = 7 * 24 * 3600


def _frame(partition_cols, order, rows: int) -> Window:
    return Window.partitionBy(*partition_cols).orderBy(*order).rowsBetween(
        -(rows - 1), Window.currentRow)


def time_bucket(column: str, seconds: int) -> Column:
    """Number of the ``seconds``-wide interval a time stamp falls in (NULL first)."""
    since = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                             F.col(column).cast("timestamp_ntz"))
    return F.coalesce(F.floor(since / F.lit(seconds)).cast("long"), F.lit(-(1 << 62)))


def _sequential_mean(values: list[Column]) -> Column:
    """Mean of the values that aren't NULL, added up in the order given, as a running frame adds them."""
    total, n = F.lit(0.0), F.lit(0)
    for v in values:
        total, n = total + F.coalesce(v, F.lit(0.0)), n + v.isNotNull().cast("int")
    return F.when(n > 0, total / n)


def moving_mean(df: DataFrame, value_col: str, out: str, rows: int = 4,
                partition_col: str = "unit_id", order_cols=("timestamp", "reading_id"),
                bucket_seconds: int | None = None) -> DataFrame:
    """``avg(value) OVER (PARTITION BY p ORDER BY o ROWS rows-1 PRECEDING)``.

    Rows are dealt by (p, time bucket) on the first order column, so a unit
    with billions of rows is spread over many window tasks.  Within a bucket a
    row's frame is its ``lag`` values.  The last row of a bucket holds the
    bucket's tail in its lags; these rows, one per unit and bucket, give each
    bucket the ``rows - 1`` values before it, and only a bucket's first
    ``rows - 1`` rows look at them.  Both uses read one shuffle of one scan if
    the caller uses all columns of ``df``: the carried rows keep them all, so
    their exchange is the fact's own.
    """
    if rows < 1:
        raise ValueError("rows must be >= 1")
    width = bucket_seconds or conf_int(df.sparkSession, BUCKET_SECONDS_KEY, DEFAULT_BUCKET_SECONDS)
    value = F.col(value_col).cast("double")
    if rows == 1:
        return df.withColumn(out, value)
    # A struct: rows without a unit are one group here as in a plain window.
    others = [c for c in df.columns if c != partition_col]
    base = df.select(F.struct(F.col(partition_col).alias("k")).alias("_unit"),
                     time_bucket(order_cols[0], width).alias("_bucket"), *others)
    keys = ["_unit", "_bucket"]
    in_order = Window.partitionBy(*keys).orderBy(*order_cols)
    framed = base.withColumns({"_at": F.row_number().over(in_order)} | {
        f"_lag{k}": F.lag(value, k).over(in_order) for k in range(1, rows)})
    # The last row of each bucket and its lags: the bucket's last values, oldest first.
    own = [F.when(F.col("_at") > k, F.struct(F.col(f"_lag{k}").alias("v"))) for k in range(rows - 2, 0, -1)]
    own.append(F.struct(value.alias("v")))
    last = framed.withColumn("_next", F.lead(F.lit(1)).over(in_order)).filter(F.col("_next").isNull())
    tails = last.select(*keys, F.struct(F.array_compact(F.array(*own)).alias("tail"),
                                        F.struct(*others).alias("row")).alias("_end"))
    before = Window.partitionBy("_unit").orderBy("_bucket").rowsBetween(-(rows - 1), -1)
    carried = F.flatten(F.transform(F.collect_list("_end").over(before), lambda x: x["tail"]))
    carried = tails.select(*keys, F.reverse(carried).alias("_carried"))  # latest first
    joined = framed.join(carried, keys, "left")

    def back(k: int) -> Column:
        """The value ``k`` rows before this one, from the bucket or from those before it."""
        from_carried = F.get("_carried", F.lit(k) - F.col("_at"))["v"]
        return F.when(F.col("_at") > k, F.col(f"_lag{k}")).otherwise(from_carried)

    mean = _sequential_mean([*[back(k) for k in range(rows - 1, 0, -1)], value])
    kept = [F.col("_unit.k").alias(c) if c == partition_col else F.col(c) for c in df.columns]
    return joined.select(*kept, mean.alias(out))


def moving_mean_bounded(df: DataFrame, value_col: str, out: str, rows: int = 4,
                        partition_col: str = "unit_id",
                        order_cols=("timestamp", "reading_id")) -> DataFrame:
    """The plain window form, for inputs already cut to a bounded size (top-k)."""
    return df.withColumn(out, F.avg(value_col).over(_frame([partition_col], order_cols, rows)))
