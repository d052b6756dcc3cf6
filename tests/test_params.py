from datetime import date, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st

from climora.params import (
    AdmissionsRun,
    ClimateRun,
    competence_label,
    month_range,
    trailing_days,
    trailing_full_months,
)

MONTHS = st.tuples(st.integers(1980, 2060), st.integers(1, 12))
DAYS = st.dates(date(1985, 1, 1), date(2060, 12, 31))


def number(month):
    return month[0] * 12 + month[1]


@given(MONTHS, MONTHS)
def test_month_range_counts_both_ends_or_refuses(one, other):
    first, last = sorted((one, other))
    months = month_range(first, last)
    assert (months[0], months[-1]) == (first, last)
    assert [number(m) for m in months] == list(range(number(first), number(last) + 1))
    if first < last:
        for refused in (month_range, AdmissionsRun):
            with pytest.raises(ValueError):
                refused(last, first)


def test_a_range_over_two_turns_of_the_year():
    labels = [competence_label(m) for m in month_range((2031, 12), (2033, 1))]
    assert labels[:2] == ["2031-12", "2032-01"] and labels[-2:] == ["2032-12", "2033-01"] and len(labels) == 14


@given(DAYS, st.integers(1, 40))
def test_full_months_end_before_the_month_of_the_run(as_of, months):
    first, last = trailing_full_months(as_of, months)
    assert number(last) == number((as_of.year, as_of.month)) - 1
    assert number(last) - number(first) + 1 == months
    assert 1 <= first[1] <= 12 and 1 <= last[1] <= 12


@pytest.mark.parametrize(
    "as_of, first, last",
    [
        (date(2031, 5, 31), "2029-05", "2031-04"),
        (date(2032, 1, 1), "2030-01", "2031-12"),
        (date(2028, 2, 29), "2026-02", "2028-01"),
    ],
)
def test_default_run_covers_two_years(as_of, first, last):
    run = AdmissionsRun.default(as_of)
    assert (run.competences[0], run.competences[-1], len(run.competences)) == (first, last, 24)


@given(DAYS, st.integers(1, 60))
def test_trailing_days_end_the_day_before(as_of, days):
    start, end = trailing_days(as_of, days)
    assert end + timedelta(days=1) == as_of and (end - start).days == days - 1


def test_default_weather_run():
    run = ClimateRun.default(date(2028, 3, 4))
    assert (run.start, run.end, run.stations) == (date(2028, 2, 23), date(2028, 3, 3), ("A807",))


def test_a_run_needs_a_station_and_counts_each_once():
    day = date(2030, 7, 7)
    with pytest.raises(ValueError):
        ClimateRun(day, day, ())
    with pytest.raises(ValueError):
        ClimateRun(day, day - timedelta(days=1), ("X",))
    assert ClimateRun(day, day, ("Q", "P", "Q", "P")).stations == ("Q", "P")
