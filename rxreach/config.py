"""Business thresholds of the behaviour and HCO layers.

Fixed values: these must equal the reference's thresholds for the results to
match, so they are kept together here, in the order the reference uses them.

    consistent writer (4-way pattern): first week <= 2025-02-03,
        last week >= 2025-12-01, more than 35 active weeks
    drop-off writer: first week <= 2025-03-01, last week < 2025-08-01
    late adopter: first week > 2025-05-01
    volume / value segment: HIGH >= 400 TRx, MEDIUM >= 150 TRx
    3-way pattern: CONSISTENT >= 35 weeks, MODERATE 15..34 weeks
    growth funnel: active >= 4 weeks, high value >= 400 TRx
    high-value HCO cut-off: 75th percentile (continuous) of HCO TRx
    dependency risk: HIGH > 0.6, MEDIUM > 0.3
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    consistent_first_by: _dt.date = _dt.date(2025, 2, 3)
    consistent_last_from: _dt.date = _dt.date(2025, 12, 1)
    consistent_min_weeks: int = 35          # strictly greater than
    dropoff_first_by: _dt.date = _dt.date(2025, 3, 1)
    dropoff_last_before: _dt.date = _dt.date(2025, 8, 1)
    late_first_after: _dt.date = _dt.date(2025, 5, 1)
    volume_high: int = 400
    volume_medium: int = 150
    behaviour_consistent: int = 35
    behaviour_moderate_low: int = 15
    behaviour_moderate_high: int = 34
    funnel_active_weeks: int = 4
    funnel_high_trx: int = 400
    hco_percentile: float = 0.75
    dependency_high: float = 0.6
    dependency_medium: float = 0.3


DEFAULT = Thresholds()
