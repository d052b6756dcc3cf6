"""Run parameters. Every window takes ``as_of`` explicitly; nothing here reads the clock."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

import pandas as pd

# Default scope of a run.
DEFAULT_STATIONS = ("A807",)
DEFAULT_MUNICIPALITIES = ("410690",)
RESPIRATORY_PATTERN = r"^J\d{2}"
LOOKBACK_DAYS = 10
LOOKBACK_MONTHS = 24
CALENDAR_START = date(2020, 1, 1)


def trailing_days(as_of: date, days: int = LOOKBACK_DAYS) -> tuple[date, date]:
    """The ``days`` calendar days that end the day before ``as_of``."""
    return as_of - timedelta(days=days), as_of - timedelta(days=1)


def month_range(first: tuple[int, int], last: tuple[int, int]) -> list[tuple[int, int]]:
    """Every (year, month) from ``first`` to ``last``, both included."""
    if first > last:
        raise ValueError(f"first month {first} lies after last month {last}")
    months = pd.period_range(
        pd.Period(year=first[0], month=first[1], freq="M"),
        pd.Period(year=last[0], month=last[1], freq="M"),
    )
    return [(m.year, m.month) for m in months]


def trailing_full_months(
    as_of: date, months: int = LOOKBACK_MONTHS
) -> tuple[tuple[int, int], tuple[int, int]]:
    """First and last of the ``months`` calendar months that had fully elapsed at ``as_of``."""
    last = pd.Period(as_of, freq="M") - 1
    first = last - (months - 1)
    return (first.year, first.month), (last.year, last.month)


def competence_label(month: tuple[int, int]) -> str:
    """Name of a competence as used in the landing folders: ``yyyy-MM``."""
    return f"{month[0]:04d}-{month[1]:02d}"


@dataclass(frozen=True)
class ClimateRun:
    """One weather ingestion run: which stations, which inclusive date range."""

    start: date
    end: date
    stations: tuple[str, ...] = DEFAULT_STATIONS

    def __post_init__(self) -> None:
        if not self.stations:
            raise ValueError("a weather run needs at least one station code")
        if self.start > self.end:
            raise ValueError(f"start {self.start} lies after end {self.end}")
        # A station named twice must not double its rainfall.
        object.__setattr__(self, "stations", tuple(dict.fromkeys(self.stations)))

    @classmethod
    def default(cls, as_of: date, stations: tuple[str, ...] = DEFAULT_STATIONS) -> ClimateRun:
        start, end = trailing_days(as_of)
        return cls(start, end, stations)


@dataclass(frozen=True)
class AdmissionsRun:
    """One admissions run: inclusive competence range, municipalities, diagnosis pattern, states (None: all)."""

    first: tuple[int, int]
    last: tuple[int, int]
    municipalities: tuple[str, ...] = field(default=DEFAULT_MUNICIPALITIES)
    diagnosis_pattern: str = RESPIRATORY_PATTERN
    states: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ValueError(f"first month {self.first} lies after last month {self.last}")

    @classmethod
    def default(
        cls, as_of: date, municipalities: tuple[str, ...] = DEFAULT_MUNICIPALITIES
    ) -> AdmissionsRun:
        first, last = trailing_full_months(as_of)
        return cls(first, last, municipalities)

    @property
    def competences(self) -> list[str]:
        return [competence_label(m) for m in month_range(self.first, self.last)]
