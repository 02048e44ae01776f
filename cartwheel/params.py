"""Run parameters: processing date, lookback window, session timeout.

One source for the lookback value; models never call "now" — the run date is
always injected, so a backfill of an old date computes that date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    run_date: dt.date = field(default_factory=dt.date.today)
    lookback_days: int = 3
    session_timeout_minutes: int = 30
    # Read buffer for sessionization: the day before the window decides whether
    # the window's first event starts a session. Must cover the timeout.
    session_buffer_days: int = 1
    # Time bucket used to spread one user's events over many tasks: a minute, so that
    # a user with millions of events in an hour is spread over sixty of them.
    session_bucket_seconds: int = 60

    def __post_init__(self):
        if isinstance(self.run_date, str):
            object.__setattr__(self, "run_date", dt.date.fromisoformat(self.run_date))
        if self.lookback_days < 0:
            raise ValueError("lookback_days must be >= 0")
        if self.session_buffer_days * 1440 < self.session_timeout_minutes:
            raise ValueError("session_buffer_days must cover session_timeout_minutes")

    def lookback_start(self, extra_days: int = 0) -> dt.date:
        """First day of [run_date - lookback - extra, run_date] (both ends inclusive)."""
        return self.run_date - dt.timedelta(days=self.lookback_days + extra_days)

    def window(self, extra_days: int = 0) -> tuple[dt.date, dt.date]:
        return self.lookback_start(extra_days), self.run_date
