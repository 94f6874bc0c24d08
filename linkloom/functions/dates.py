"""Calendar quarters, on the driver and as Columns."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Quarter:
    label: str
    start: date
    end: date


def quarter(year: int, number: int) -> Quarter:
    start = date(year, 3 * number - 2, 1)
    after = date(year + number // 4, 3 * number % 12 + 1, 1)
    return Quarter(f"{year}Q{number}", start, after - timedelta(days=1))


def quarter_from_label(label: str) -> Quarter:
    found = re.fullmatch(r"(\d{4})Q([1-4])", label.strip().upper())
    if not found:
        raise ValueError(f"not a quarter: {label!r}")
    return quarter(int(found[1]), int(found[2]))


def previous_quarter(day: date) -> Quarter:
    number = (day.month - 1) // 3
    return quarter(day.year, number) if number else quarter(day.year - 1, 4)


def latest_due_quarter(day: date) -> Quarter:
    """The last quarter whose data is due: on the 30th of January, April, July and October."""
    due = [(date(day.year, 1, 30), quarter(day.year - 1, 4)), *((date(day.year, m, 30), quarter(day.year, n)) for m, n in ((4, 1), (7, 2), (10, 3)))]
    reached = [q for at, q in due if at <= day]
    return reached[-1] if reached else quarter(day.year - 1, 3)


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))
