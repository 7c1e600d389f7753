"""Deadlines that a text states near a cue, and whether it says that there's none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.dates import tolerant_date

#: Characters between a cue and its date, and months ahead that are believed.
REACH, MONTHS = 90, 24
CUES = r"deadline|closing date|closes|closing|apply by|applications? due"
ROLLING = r"rolling basis|rolling applications|until filled|no deadline"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{1,2} [A-Za-z]{3,9} \d{4}|[A-Za-z]{3,9} \d{1,2}, \d{4}|\d{1,2}/\d{1,2}/\d{4}"


def stated_dates(text: Column, reach: int = REACH) -> Column:
    """The dates that stand within ``reach`` characters after a cue, in order; other writings give null."""
    found = F.regexp_extract_all(text, F.lit(rf"(?is)\b(?:{CUES})\b.{{0,{reach}}}?({_DATE})"), 1)
    return F.transform(found, tolerant_date)


def deadline(text: Column, today: Column, reach: int = REACH, months: int = MONTHS) -> Column:
    """The first stated date from today to ``months`` ahead; null if there is none."""
    near = F.filter(stated_dates(text, reach), lambda d: (d >= today) & (d <= F.add_months(today, months)))
    return F.get(near, F.lit(0))


def is_rolling(text: Column, today: Column) -> Column:
    """Whether a text without a deadline says that it has none."""
    return F.coalesce(deadline(text, today).isNull() & text.rlike(f"(?i){ROLLING}"), F.lit(False))
