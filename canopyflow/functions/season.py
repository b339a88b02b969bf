"""Seasons, years to compare, windows, and codes of loss years; checked."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes count years from here; the last year that the table covers. (Fixed values.)
BASE_YEAR, LAST_YEAR = 2000, 2025


@dataclass(frozen=True)
class Season:
    """Months of one year, both included."""

    start: int
    end: int

    def __post_init__(self):
        if not 1 <= self.start <= self.end <= 12:
            raise ValueError(f"a season runs from a month to a later one of the same year: {self}")

    def dates(self, year: Column) -> tuple[Column, Column]:
        """First day, and the day after the last."""
        return F.make_date(year, F.lit(self.start), F.lit(1)), F.add_months(F.make_date(year, F.lit(self.end), F.lit(1)), 1)

    def complete_year(self, day: Column) -> Column:
        """The latest year whose season is over by that day's month."""
        return F.when(F.month(day) > self.end, F.year(day)).otherwise(F.year(day) - 1)

    def compared_years(self, day: Column, gap: int = 1) -> tuple[Column, Column]:
        if gap < 1:
            raise ValueError(f"years to compare lie a year apart at least, not {gap}")
        recent = self.complete_year(day)
        return recent - gap, recent

    def compared_today(self, today: date, gap: int = 1) -> tuple[int, int]:
        if gap < 1:
            raise ValueError(f"years to compare lie a year apart at least, not {gap}")
        recent = today.year if today.month > self.end else today.year - 1
        return recent - gap, recent


def baseline(start: Column, days: int) -> tuple[Column, Column]:
    """The days before a start; the start itself is outside."""
    if days < 1:
        raise ValueError(f"a baseline has a day at least, not {days}")
    return F.date_sub(start, days), start


def code_of_year(year: int | Column):
    """A number is checked at once, a column when it is read."""
    if isinstance(year, Column):
        return F.when(year.isNull() | year.between(BASE_YEAR + 1, LAST_YEAR), year - BASE_YEAR).otherwise(F.raise_error(F.concat(F.lit("no code for year "), year.cast("string"))).cast("int"))
    if not BASE_YEAR < year <= LAST_YEAR:
        raise ValueError(f"no code for year {year}: {BASE_YEAR + 1} to {LAST_YEAR}")
    return year - BASE_YEAR


def year_of_code(code: int | Column):
    """The inverse; 0, no loss, is no year."""
    if isinstance(code, Column):
        return F.when(code.isNull() | code.between(1, LAST_YEAR - BASE_YEAR), code + BASE_YEAR).otherwise(F.raise_error(F.concat(F.lit("no year of code "), code.cast("string"))).cast("int"))
    if not 1 <= code <= LAST_YEAR - BASE_YEAR:
        raise ValueError(f"no year of code {code}")
    return code + BASE_YEAR
