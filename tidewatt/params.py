"""Tunable thresholds and dates shared by every model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Params:
    spike_threshold: float = 300.0
    negative_threshold: float = 0.0
    lookback_days: int = 3
    regime_cutover: date = date(2022, 11, 1)
    usd_per_credit: float = 2.0
    calendar_start: date = date(2016, 1, 1)
    calendar_end: date = date(2030, 12, 31)  # exclusive
    hydro_floor: date = date(2016, 1, 1)
    usage_window_days: int = 90
    as_of: date | None = None  # "today" for relative windows; None means current_date
