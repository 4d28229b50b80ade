"""Scalar column expressions.

All of them are built-in Catalyst expressions; none is a Python UDF.  Scalar
ones stay inside generated code; functions over arrays (``row_mean``) are
evaluated per element.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse import schema

# Rounding goes through DECIMAL(28,10): the value is first fixed at ten
# decimals, then rounded to ``k``.  Two engines whose sums differ in the last
# bit of a double then still round to the same number.  Values beyond that type
# (1e18 and more) are rounded as doubles.
_ROUND_TYPE = "decimal(28,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up_round(c, k: int) -> Column:
    """SQL ``ROUND(x, k)``: half away from zero, result DOUBLE."""
    return F.coalesce(F.round(_col(c).try_cast(_ROUND_TYPE), k).cast("double"), F.round(_col(c).cast("double"), k))


def even_round(c, k: int) -> Column:
    """Frame-style rounding: half to even, result DOUBLE."""
    return F.coalesce(F.bround(_col(c).try_cast(_ROUND_TYPE), k).cast("double"), F.bround(_col(c).cast("double"), k))


def nan_to_null(c) -> Column:
    """NaN becomes NULL so that ``avg``/``stddev_pop`` skip it (ledger V2)."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def row_mean(samples) -> Column:
    """Mean of a numeric or numeric-text array row; NaN samples make the mean NULL.

    Text elements are cast inside the sum, so a raw line split into fields is
    averaged without building an intermediate ``array<double>`` (the cast is
    a no-op for numeric arrays).
    """
    samples = _col(samples)
    total = F.aggregate(samples, F.lit(0.0).cast("double"),
                        lambda acc, x: acc + x.cast("double"))
    return nan_to_null(F.try_divide(total, F.size(samples).cast("double")))


def condition_label(c, labels: Mapping[int, str], otherwise: str | None = None) -> Column:
    """``CASE c WHEN k THEN v ... [ELSE otherwise] END`` (unmapped → NULL)."""
    c = _col(c)
    expr = None
    for key, value in labels.items():
        expr = F.when(c == F.lit(key), F.lit(value)) if expr is None else expr.when(
            c == F.lit(key), F.lit(value))
    if otherwise is not None:
        expr = expr.otherwise(F.lit(otherwise))
    return expr


def location(region, site, separator: str = schema.SEPARATOR_SQL) -> Column:
    """``region || sep || site``; NULL when either side is NULL (ledger V7)."""
    return F.concat(_col(region), F.lit(separator), _col(site))


def hour_of_day(ts) -> Column:
    return F.hour(_col(ts))


TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(text, strict: bool = True, fmt: str = TIMESTAMP_TEXT) -> Column:
    """T13 / ledger V9: text → TIMESTAMP_NTZ.

    ``strict`` raises on unparsable text (as a frame parser does); otherwise
    such values become NULL (as SQL date functions on bad text do).
    """
    text = _col(text)
    if strict:
        return F.to_timestamp_ntz(text, F.lit(fmt))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def timestamp_text(ts, fmt: str = TIMESTAMP_TEXT) -> Column:
    """F16: timestamp → ``YYYY-MM-DD HH:MM:SS`` text."""
    return F.date_format(_col(ts), fmt)


def with_suffix(c, suffix: str = "%") -> Column:
    """number as text with a suffix, e.g. 100 → '100%'."""
    return F.concat(_col(c).cast("string"), F.lit(suffix))


def zscore(x, mean, std) -> Column:
    """``(x - mean) / std``; NULL when std is 0 or NULL (ledger V1, V8)."""
    return F.try_divide(_col(x) - _col(mean), _col(std))


def ordinal_timestamp(offset, start: str = schema.START_TIMESTAMP,
                      minutes: int = schema.INTERVAL_MINUTES) -> Column:
    """``start + offset * minutes`` as TIMESTAMP_NTZ."""
    base = F.lit(start).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", _col(offset) * F.lit(minutes), base)


def unit_code(index, fmt: str = schema.UNIT_CODE_FORMAT) -> Column:
    """Zero-padded unit code of a 0-based unit index."""
    return F.format_string(fmt, _col(index) + F.lit(1))


def install_date(index, start: str = schema.START_DATE,
                 base_days: int = schema.INSTALL_BASE_DAYS,
                 step_days: int = schema.INSTALL_STEP_DAYS) -> Column:
    """``start - (base + step * index)`` days, as DATE."""
    days = (F.lit(base_days) + F.lit(step_days) * _col(index)).cast("int")
    return F.date_sub(F.lit(start).cast("date"), days)


def grouped_number(column, decimals: int = 0) -> Column:
    """a number as text, thousands separated by commas, with so many decimal places (half up)."""
    return F.format_number(half_up_round(_col(column), decimals), decimals)


def cycled(index, values: list) -> Column:
    """``values[index % len(values)]`` as a literal-array lookup."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(_col(index), F.lit(len(values))) + F.lit(1)).cast("int"))


def without_nan(df: DataFrame) -> DataFrame:
    """``df`` with NaN as NULL in its floating-point columns: a NaN reading is no reading."""
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if f.dataType.typeName() in ("double", "float") else F.col(f.name) for f in df.schema.fields])
