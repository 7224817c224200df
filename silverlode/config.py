"""Run settings, frozen so that one run sees one set of values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Everything a run may vary.

    ``as_of`` replaces "today" in ages, recency and ``days_ago``: a rerun of the same day gives the
    same tables.
    """

    root: str = "warehouse"
    as_of: dt.date = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).date())
    calendar_start: dt.date = dt.date(2010, 1, 1)
    calendar_end: dt.date = dt.date(2016, 1, 1)  # exclusive
    lookback_days: int = 3
    max_rejection_rate: float = 0.01
    freshness_warn_hours: int = 24
    freshness_error_hours: int = 72

    def layer(self, name: str) -> str:
        """Folder of a layer (``bronze``, ``silver``, ``gold``, ``checks``)."""
        return f"{self.root.rstrip('/')}/{name}"
