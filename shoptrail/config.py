"""Run options shared by every job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

GA4 = "ga4"
SNOWPLOW = "snowplow"
CONTENTSQUARE = "contentsquare"


@dataclass(frozen=True)
class Sources:
    """Which collection systems take part in a run (SRC-12)."""

    ga4: bool = True
    snowplow: bool = True
    contentsquare: bool = True

    def enabled(self) -> list[str]:
        switches = {GA4: self.ga4, SNOWPLOW: self.snowplow, CONTENTSQUARE: self.contentsquare}
        return [name for name, on in switches.items() if on]


@dataclass(frozen=True)
class Options:
    """Behaviour switches; the defaults are what a scheduled daily run wants.

    strict_params   read engagement time from the text value only and fail on
                    text that is no number, and on a repeated parameter key
    strict_url      end a host name at ``?`` and ``#`` too, not only at ``/``
    as_of           the day from which recency is counted (None: today)
    lookback_days   how many already loaded days an incremental run replaces
    session_grain   'date' keeps one session row per day, 'session' one in all
    attach_transactions  give ContentSquare sessions their purchases
    drop_copies     keep one row of an event that was delivered several times
    """

    strict_params: bool = False
    strict_url: bool = False
    as_of: dt.date | None = None
    lookback_days: int = 0
    session_grain: str = "date"
    attach_transactions: bool = False
    drop_copies: bool = True
    sources: Sources = field(default_factory=Sources)
