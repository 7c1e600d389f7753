"""Quarters, due periods, tolerant dates and cohort years as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DUE_DAYS = 49


def reporting_period(day: Column) -> Column:
    """FYyyyy for a year's end, yyyyH1 for the end of June, else FYyyyyH1 or H2 by the half that is running."""
    m, year = F.month(day), F.year(day).cast("string")
    ends = F.last_day(day) == F.to_date(day)
    running = F.concat(F.lit("FY"), year, F.when(m <= 6, "H1").otherwise("H2"))
    return F.when(ends & (m == 12), F.concat(F.lit("FY"), year)).when(ends & (m == 6), F.concat(year, F.lit("H1"))).otherwise(running)


def quarter_key(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def previous_quarter(key: Column) -> Column:
    year, q = F.substring(key, 1, 4).cast("int"), F.substring(key, 6, 1).cast("int")
    return F.when(q > 1, F.concat(year, F.lit("Q"), q - 1)).otherwise(F.concat(year - 1, F.lit("Q4")))


def quarter_end(day: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)


def due_quarter(today: Column, days: int = DUE_DAYS) -> Column:
    """The latest quarter whose end lies at least ``days`` before today."""
    return quarter_key(F.date_sub(F.trunc(F.date_sub(today, days - 1), "quarter"), 1))


def tolerant_date(text: Column) -> Column:
    """A date from yyyy-mm-dd, d Month yyyy, Month d, yyyy, or a/b/yyyy where only one reading is a date."""
    t = F.trim(text)
    a, b, y = (F.try_to_number(F.nullif(F.regexp_extract(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", k), F.lit("")), F.lit("9999")).cast("int") for k in (1, 2, 3))
    slash = F.when(a > 12, _date(y, b, a)).when(b > 12, _date(y, a, b)).when(a == b, _date(y, a, b))
    return F.coalesce(
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{1,2} [A-Za-z]+ \d{4}$"), F.try_to_date(F.initcap(t), "d MMMM yyyy")),
        F.when(t.rlike(r"^[A-Za-z]+ \d{1,2}, \d{4}$"), F.try_to_date(F.initcap(t), "MMMM d, yyyy")),
        slash,
    )


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def relative_day(text: Column, today: Column) -> Column:
    """'Posted 3 days ago', 'today', 'yesterday' to a day; an open count such as 30+ to null."""
    n = F.regexp_extract(F.lower(text), r"(\d+) days? ago", 1)
    return F.when(F.lower(text).contains("today"), today).when(F.lower(text).contains("yesterday"), F.date_sub(today, 1)).when((n != "") & ~text.contains("+"), F.date_sub(today, F.nullif(n, F.lit("")).cast("int")))


def cohort_year(title: Column) -> Column:
    """The year a title is for: the later of 2024/25 or 2024-2025, FYyy, else the greatest year named."""
    cycle = F.regexp_extract(title, r"(20\d{2})\s?[/-]\s?(?:20)?(\d{2})\b", 2)
    fiscal = F.regexp_extract(title, r"(?i)\bFY\s?(?:20)?(\d{2})\b", 1)
    years = F.regexp_extract_all(title, F.lit(r"\b(20\d{2})\b"), 1)
    two = lambda c: F.when(c != "", F.nullif(c, F.lit("")).cast("int") + 2000)
    return F.coalesce(two(cycle), two(fiscal), F.array_max(F.transform(years, lambda y: y.cast("int"))))


def next_friday(day: Column) -> Column:
    """The Friday on or after a day."""
    return F.next_day(F.date_sub(day, 1), "FR")


