"""Column expressions shared by the operators. All are built-in Spark expressions (codegen'd)."""

from cordon.functions.trip import (  # noqa: F401
    after_start,
    change_pct,
    duration_seconds,
    ghost_flag,
    metric,
    pct,
    period_label,
    speed_mph,
    trip_date,
    zone_category,
)
