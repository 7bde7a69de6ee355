"""Spans of calendar days: the unit of every load, scan and refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

ONE_DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class DaySpan:
    """The days from ``first`` to ``last``, both included; never empty."""

    first: dt.date
    last: dt.date

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ValueError(f"a span of days cannot run from {self.first} back to {self.last}")

    def __len__(self) -> int:
        return (self.last - self.first).days + 1

    def __iter__(self) -> Iterator[dt.date]:
        day = self.first
        while day <= self.last:
            yield day
            day += ONE_DAY

    def folders(self, root: str, column: str) -> str:
        """One path pattern that matches the day folders of the span that
        exist; listing it lists no other day."""
        names = ",".join(map(dt.date.isoformat, self))
        return f"{root.rstrip('/')}/{column}={{{names}}}"

    def chunks(self, size: int) -> Iterator[DaySpan]:
        """The span cut into spans of at most ``size`` days."""
        first = self.first
        while first <= self.last:
            last = min(self.last, first + (size - 1) * ONE_DAY)
            yield DaySpan(first, last)
            first = last + ONE_DAY

    def absentees(self, present: set[str]) -> list[str]:
        """ISO dates of the span that are not in ``present``."""
        return [day.isoformat() for day in self if day.isoformat() not in present]
