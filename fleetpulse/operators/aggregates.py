"""Per-unit partial aggregates: aggregate the fact first, join units after.

Every report that groups readings by a unit attribute (region, site, model)
first reduces the fact to one row per (unit_id, extra keys) — a map-side
partial aggregation, so a hot unit costs one row per task, not a hot shuffle
partition — and only then joins the unit table.  Means are rebuilt exactly as
``sum / count`` of the partial sums and non-null counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.state import Source, condense


def per_unit(readings: Source, metrics=(), keys=()) -> DataFrame:
    """(unit_id, *keys, _n, _fail, _s_<m>, _c_<m> for m in metrics), of readings or of their state."""
    return condense(readings, ["unit_id", *keys], metrics)


def mean_of(metric: str) -> Column:
    """Mean of ``metric`` rebuilt from partials (NULL when no value)."""
    return F.try_divide(F.sum(f"_s_{metric}"), F.sum(f"_c_{metric}").cast("double"))


def unit_mean(metric: str) -> Column:
    """Mean of ``metric`` on a one-row-per-unit partial table."""
    return F.try_divide(F.col(f"_s_{metric}"), F.col(f"_c_{metric}").cast("double"))
