"""Parameters of the pipeline. Every constant an operator uses is passed in from here."""

from __future__ import annotations

from dataclasses import dataclass

# The pipeline's published rules.
LOCAL_ZONE = "America/New_York"
SERVICE_DAY_START_HOUR = 3
NO_LOWER_BOUND = "2000-01-01 00:00:00"

LABEL_KEY = ["service_date_norm", "route_id", "direction_id", "stop_id", "trip_id"]
STOP_EVENT_KEY = ["trip_id", "stop_id", "polled_at"]
REQUIRED_FIELDS = ["route_id", "direction_id", "stop_id", "trip_id", "service_date"]
FEATURE_COLUMNS = [
    "route_hour_historical_late_rate",
    "headway_seconds",
    "hour_of_day",
    "day_of_week",
    "current_delay_persistence_seconds",
]

TRAIN_FRACTION = 0.70
MIN_PRECISION = 0.80
MIN_DAYS_FOR_REPORT = 7
MAX_PAGES_PER_BATCH = 5
PUBLIC_GAP_MULTIPLIER = 3.0
REASON_MAX_CHARS = 200
DETAIL_MAX_CHARS = 2000
MAX_SNAPSHOTS = 2000
FRESHNESS_MAX_MINUTES = 10
NULL_RATE_MAX_PCT = 15.0
MIN_ROWS_WRITTEN = 1
MAX_NULL_DELAY_RATE_PCT = 0.0
MIN_TRAINING_LABEL_RATE_PCT = 50.0
MIN_HISTORICAL_RATE_COVERAGE_PCT = 0.0


@dataclass(frozen=True)
class LabelRules:
    """When a trip-stop counts as settled, late, or next to a polling gap."""

    cycle_seconds: float = 66.0
    gap_threshold_seconds: float = 100.0
    settle_cycles: int = 3
    late_threshold_seconds: int = 180

    @property
    def settle_margin_seconds(self) -> float:
        return self.settle_cycles * self.cycle_seconds
