"""Column expressions used by the operators (all built-in Spark functions)."""

from fleetpulse.functions.columns import (  # noqa: F401
    condition_label,
    even_round,
    half_up_round,
    hour_of_day,
    install_date,
    location,
    ordinal_timestamp,
    parse_timestamp,
    row_mean,
    timestamp_text,
    unit_code,
    zscore,
)
