"""The constants of the models, gathered so that a run can change them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    # Fixed values that the published figures depend on.
    royalty_rate: Decimal = Decimal("0.20")
    consumption_month: dt.date = dt.date(2022, 10, 1)
    as_of: dt.date = dt.date(2022, 10, 1)
    at_risk_days: int = 90
    engaged_minutes: int = 60
    # How old the latest event may be at a load; without limits it is not tested.
    warn_after: dt.timedelta | None = None
    error_after: dt.timedelta | None = None
