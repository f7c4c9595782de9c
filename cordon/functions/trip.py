"""Trip-level column expressions.

These return ``Column`` objects only; they never touch data. Division is written so that Spark's
ANSI mode never sees a zero divisor (``nullif`` or a guarding ``when``), matching the IEEE results
of the audited SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cordon.config import CLEAN_LABEL, ENTERING, EXITING, INSIDE, OUTSIDE, AuditConfig

# Reporting precision. Money, distances, means and percentages are reported to cents, as the audited
# reports do; correlation-type statistics to 6 places. Stored tables keep full precision.
METRIC_DECIMALS = 2
STAT_DECIMALS = 6


def round_half_away(c: Column, decimals: int) -> Column:
    """ROUND as the audited SQL engine does it on doubles: scale by 10^d, round the binary value half
    away from zero, scale back. (Spark's ``round`` on a double rounds its shortest decimal string
    instead, which differs on values such as 1.005.)"""
    m = F.lit(10.0 ** decimals)
    return F.round(c * m, 0) / m


def metric(c: Column, decimals: int = METRIC_DECIMALS) -> Column:
    return round_half_away(c, decimals)


def stat(c: Column) -> Column:
    return round_half_away(c, STAT_DECIMALS)


def duration_seconds(pickup: Column, dropoff: Column) -> Column:
    """Seconds between pickup and dropoff, fractional (microsecond resolution)."""
    return F.timestamp_diff("MICROSECOND", pickup, dropoff) / F.lit(1_000_000.0)


def speed_mph(distance: Column, duration: Column) -> Column:
    """Miles per hour; 0 when the duration is not positive."""
    return F.when(duration > 0, distance / (duration / F.lit(3600.0))).otherwise(F.lit(0.0))


def _exceeds_speed(distance: Column, duration: Column, cfg: AuditConfig) -> Column:
    # Unguarded quotient of the audited rule: x / (d/3600) > max. With d = 0 the IEEE result is
    # +inf (x > 0) or NaN (x = 0); both order above any number, -inf (x < 0) does not.
    quotient = F.try_divide(distance, duration / F.lit(3600.0))
    rule = quotient > F.lit(cfg.max_speed_mph)
    if cfg.zero_duration_is_speeding:
        rule = rule | ((duration == 0) & (distance >= 0))
    return rule


def ghost_flag(distance: Column, duration: Column, fare: Column, total: Column, cfg: AuditConfig) -> Column:
    """First matching anomaly rule, else 'clean'. A NULL comparison never fires a rule."""
    return (
        F.when(_exceeds_speed(distance, duration, cfg), F.lit("excessive_speed"))
        .when((duration < F.lit(cfg.short_trip_seconds)) & (fare > F.lit(cfg.high_fare)), F.lit("short_trip_high_fare"))
        .when((distance <= F.lit(cfg.min_distance_miles)) & (fare > 0), F.lit("zero_distance_positive_fare"))
        .when(duration <= 0, F.lit("negative_duration"))
        .when((fare < 0) | (total < 0), F.lit("negative_fare"))
        .otherwise(F.lit(CLEAN_LABEL))
    )


def zone_category(pickup_in: Column, dropoff_in: Column) -> Column:
    """Four-way category from two 0/1 in-zone flags."""
    return (
        F.when((pickup_in == 1) & (dropoff_in == 1), F.lit(INSIDE))
        .when((pickup_in == 0) & (dropoff_in == 1), F.lit(ENTERING))
        .when((pickup_in == 1) & (dropoff_in == 0), F.lit(EXITING))
        .otherwise(F.lit(OUTSIDE))
    )


def policy_start(cfg: AuditConfig) -> Column:
    return F.lit(cfg.policy_start_literal).cast("timestamp_ntz")


def after_start(pickup: Column, cfg: AuditConfig) -> Column:
    """1 when the trip starts at or after the policy start, else 0."""
    return F.when(pickup >= policy_start(cfg), F.lit(1)).otherwise(F.lit(0))


def period_label(after: Column, cfg: AuditConfig) -> Column:
    return F.when(after == 1, F.lit(cfg.period_after_label)).otherwise(F.lit(cfg.period_before_label))


def trip_date(pickup: Column) -> Column:
    """Midnight of the pickup day, as a zone-less timestamp."""
    return F.to_date(pickup).cast("timestamp_ntz")


def pct(part: Column, whole: Column, decimals: int | None = 2) -> Column:
    """100 * part / whole in double precision; NULL when whole is 0 or NULL."""
    v = F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_half_away(v, decimals) if decimals is not None else v


def change_pct(before: Column, after: Column) -> Column:
    """(after - before) / before * 100, or 0 when the base is not positive."""
    return F.when(before > 0, (after - before) / before * F.lit(100.0)).otherwise(F.lit(0.0))


def surcharge_paid(surcharge: Column) -> Column:
    return surcharge > 0


def surcharge_missing(surcharge: Column) -> Column:
    return surcharge.isNull() | (surcharge == 0)
