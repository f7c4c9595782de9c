"""Typed, frozen configuration of the audit.

``DEFAULT_CONFIG`` carries the policy as published (real trip files, real zone names).
``FIXTURE_CONFIG`` is the same policy shifted to the driver test tables (see FIXTURES.md):
dates move back 24 years and the tolled zone is chosen among the nation names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the audited policy for results to agree.
# ---------------------------------------------------------------------------

# Unified trip schema, in this order.
UNIFIED_COLUMNS = (
    "pickup_time",
    "dropoff_time",
    "pickup_loc",
    "dropoff_loc",
    "trip_distance",
    "fare",
    "total_amount",
    "congestion_surcharge",
)

UNIFIED_TYPES = {
    "pickup_time": T.TimestampNTZType(),
    "dropoff_time": T.TimestampNTZType(),
    "pickup_loc": T.IntegerType(),
    "dropoff_loc": T.IntegerType(),
    "trip_distance": T.DoubleType(),
    "fare": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
}

# Rows missing any of these after renaming are dropped.
REQUIRED_COLUMNS = ("pickup_time", "dropoff_time", "pickup_loc", "dropoff_loc")

# Raw column name -> unified column name, per taxi type.
YELLOW_COLUMN_MAP = {
    "tpep_pickup_datetime": "pickup_time",
    "tpep_dropoff_datetime": "dropoff_time",
    "PULocationID": "pickup_loc",
    "DOLocationID": "dropoff_loc",
    "trip_distance": "trip_distance",
    "fare_amount": "fare",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
}
GREEN_COLUMN_MAP = {
    "lpep_pickup_datetime": "pickup_time",
    "lpep_dropoff_datetime": "dropoff_time",
    "PULocationID": "pickup_loc",
    "DOLocationID": "dropoff_loc",
    "trip_distance": "trip_distance",
    "fare_amount": "fare",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
}
COLUMN_MAPS = {"yellow": YELLOW_COLUMN_MAP, "green": GREEN_COLUMN_MAP}

# Name of a monthly trip file (printf form: taxi type, year, month); the month is read back from it.
TRIP_FILE_FORMAT = "%s_tripdata_%04d-%02d.parquet"

# Anomaly labels in rule order (first match wins), then the clean label.
GHOST_LABELS = (
    "excessive_speed",
    "short_trip_high_fare",
    "zero_distance_positive_fare",
    "negative_duration",
    "negative_fare",
)
CLEAN_LABEL = "clean"

# Zone categories.
INSIDE, ENTERING, EXITING, OUTSIDE = "inside_zone", "entering_zone", "exiting_zone", "outside_zone"
CROSS_BORDER = (ENTERING, EXITING)

# Keywords naming the neighbourhoods of the tolled zone (matched case-insensitively as one regex).
ZONE_KEYWORDS = (
    "Financial", "Battery", "Tribeca", "SoHo", "Chinatown",
    "Lower East Side", "East Village", "West Village", "Greenwich",
    "Chelsea", "Gramercy", "Murray Hill", "Midtown", "Clinton",
    "Garment", "Times Square", "Penn Station", "Flatiron",
)
ZONE_BOROUGH = "Manhattan"


@dataclass(frozen=True)
class AuditConfig:
    """All business constants of the audit. Immutable; use ``dataclasses.replace`` to vary."""

    policy_start: datetime = datetime(2025, 1, 5)
    max_speed_mph: float = 65.0
    short_trip_seconds: float = 60.0
    high_fare: float = 20.0
    min_distance_miles: float = 0.01
    # Rule 1 with zero duration: x/0 is +inf (x > 0) or NaN (x = 0), both "> max speed" under
    # IEEE ordering with NaN largest. True keeps that reading.
    zero_duration_is_speeding: bool = True

    zone_borough: str = ZONE_BOROUGH
    zone_keywords: tuple[str, ...] = ZONE_KEYWORDS

    # Month imputation: target month from two earlier years, weighted.
    impute_year: int = 2025
    impute_month: int = 12
    impute_older_year: int = 2023
    impute_newer_year: int = 2024
    weight_older: str = "0.3"
    weight_newer: str = "0.7"

    # Quarter comparison (months of a "before" year against the same months of an "after" year).
    compare_before_year: int = 2024
    compare_after_year: int = 2025
    compare_months: tuple[int, ...] = (1, 2, 3)

    # Expected inventory grid.
    grid_years: tuple[int, ...] = (2023, 2024, 2025)
    grid_months: tuple[int, ...] = tuple(range(1, 13))
    taxi_types: tuple[str, ...] = ("yellow", "green")

    # Loss per trip without surcharge: cross-border leakage summary vs. all-category KPI.
    leakage_loss_per_trip: float = 9.0
    kpi_loss_per_trip: float = 2.5

    rainy_threshold_mm: float = 1.0
    top_k: int = 100
    top_leakage_k: int = 3

    # Largest dimension we agree to broadcast (rows); beyond it the join falls back to a shuffle join.
    # A zone dimension has a few hundred rows.
    broadcast_max_rows: int = 100_000

    column_maps: dict = field(default_factory=lambda: dict(COLUMN_MAPS))

    @property
    def period_after_label(self) -> str:
        return f"After {self.policy_start:%b} {self.policy_start.day}"

    @property
    def period_before_label(self) -> str:
        return f"Before {self.policy_start:%b} {self.policy_start.day}"

    @property
    def policy_start_literal(self) -> str:
        return self.policy_start.strftime("%Y-%m-%d %H:%M:%S")

    def shifted(self, years: int) -> "AuditConfig":
        """The same policy moved by ``years`` (used to map it onto the driver tables)."""
        s = self.policy_start
        return replace(
            self,
            policy_start=s.replace(year=s.year + years),
            impute_year=self.impute_year + years,
            impute_older_year=self.impute_older_year + years,
            impute_newer_year=self.impute_newer_year + years,
            compare_before_year=self.compare_before_year + years,
            compare_after_year=self.compare_after_year + years,
            grid_years=tuple(y + years for y in self.grid_years),
        )


DEFAULT_CONFIG = AuditConfig()

# Fixed values of the test projection (FIXTURES.md): 24 years back, zone chosen among nations.
FIXTURE_ZONE_BOROUGH = "ASIA"
FIXTURE_ZONE_KEYWORDS = ("NATION_2", "nation_7", "NATION_12")

FIXTURE_CONFIG = replace(
    DEFAULT_CONFIG.shifted(-24),
    zone_borough=FIXTURE_ZONE_BOROUGH,
    zone_keywords=FIXTURE_ZONE_KEYWORDS,
)
