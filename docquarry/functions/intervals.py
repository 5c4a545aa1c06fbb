"""Calendar and fixed-width date intervals as Column arithmetic.

Instants are taken as UTC: the session time zone has to be UTC, which
``docquarry.session.configure`` sets.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds per fixed unit.
_UNIT_MICROS = {
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
}

# Calendar units and their short spellings.
_CALENDAR = {
    "minute": "minute", "1m": "minute",
    "hour": "hour", "1h": "hour",
    "day": "day", "1d": "day",
    "week": "week", "1w": "week",
    "month": "month", "1M": "month",
    "quarter": "quarter", "1q": "quarter",
    "year": "year", "1y": "year",
}
_SHORT = {"minute": "1m", "hour": "1h"}


def micros(text: str | None) -> int:
    """Width of a fixed interval or offset such as ``12h``, ``+6h`` or ``-1d``."""
    if not text:
        return 0
    found = re.fullmatch(r"([+-]?)(\d+)(ms|s|m|h|d)", text.strip())
    if not found:
        raise ValueError(f"bad interval {text!r}")
    width = int(found[2]) * _UNIT_MICROS[found[3]]
    return -width if found[1] == "-" else width


@dataclass(frozen=True)
class Interval:
    """Bucket rule for timestamps: a calendar unit, or a fixed width."""

    unit: str | None
    width: int
    offset: int
    zone: str | None

    @classmethod
    def of(cls, calendar: str | None, fixed: str | None, offset: str | None = None,
           zone: str | None = None) -> Interval:
        if (calendar is None) == (fixed is None):
            raise ValueError("give either calendar_interval or fixed_interval")
        if calendar is not None:
            if calendar not in _CALENDAR:
                raise ValueError(f"unknown calendar interval {calendar!r}")
            unit = _CALENDAR[calendar]
            if unit in _SHORT:
                # Minutes and hours have one length everywhere.
                return cls(None, micros(_SHORT[unit]), micros(offset), zone)
            return cls(unit, 0, micros(offset), zone)
        width = micros(fixed)
        if width <= 0:
            raise ValueError("a fixed interval must be positive")
        return cls(None, width, micros(offset), zone)

    def start(self, ts: Column) -> Column:
        """Start of the bucket that holds ``ts``, as a UTC instant."""
        at = ts.cast("timestamp")
        wall = F.from_utc_timestamp(at, self.zone) if self.zone else at
        if self.unit is None:
            into = F.pmod(F.unix_micros(wall) - F.lit(self.offset), F.lit(self.width))
            return F.timestamp_micros(F.unix_micros(at) - into)
        begin = self._shift(F.date_trunc(self.unit, self._shift(wall, -self.offset)), self.offset)
        return F.to_utc_timestamp(begin, self.zone) if self.zone else begin

    def label(self, key: Column, fmt: str) -> Column:
        wall = F.from_utc_timestamp(key, self.zone) if self.zone else key
        return F.date_format(wall, fmt)

    def nth(self, first: Column, n: Column) -> Column:
        """Start of the n-th bucket after the one that starts at ``first``."""
        if self.unit is None:
            return F.timestamp_micros(F.unix_micros(first) + n * F.lit(self.width))
        wall = self._shift(self._wall(first), -self.offset)
        moved = self._shift(F.timestamp_add(self.unit.upper(), n.cast("int"), wall), self.offset)
        return F.to_utc_timestamp(moved, self.zone) if self.zone else moved

    def steps(self, first: Column, last: Column) -> Column:
        """Number of buckets that start in ``first`` (inclusive) to ``last`` (exclusive)."""
        if self.unit is None:
            span = F.unix_micros(last) - F.unix_micros(first)
            return F.ceil(span / F.lit(self.width)).cast("long")
        low = self._shift(self._wall(first), -self.offset)
        high = self._shift(self._wall(last), -self.offset)
        return F.timestamp_diff(self.unit.upper(), low, high)

    def _wall(self, key: Column) -> Column:
        return F.from_utc_timestamp(key, self.zone) if self.zone else key

    @staticmethod
    def _shift(ts: Column, by: int) -> Column:
        return F.timestamp_micros(F.unix_micros(ts) + F.lit(by)) if by else ts
