"""Dates: parsing, age in days, display."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears_mart.functions.text import strip
from arrears_mart.schemas import AGE_LABELS_DAYS, CLOCK

# A day-first date in parentheses, with any of three separators.
_DATE_IN_PARENTHESES = r"\(\s*(\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4})\s*\)"
# Two-digit years above this one belong to the last century.
_LAST_YEAR_OF_THIS_CENTURY = 68


def parse_clock(text: Column) -> Column:
    """ISO dates and date-times and `d/M/yyyy[ H:mm[:ss]]` as wall-clock time; anything else is null.

    Each value is read on its own, so the result does not depend on the other rows.
    """
    iso = F.regexp_replace(strip(text), r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")
    return F.when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), iso).try_cast(CLOCK)


def parse_date(text: Column) -> Column:
    return parse_clock(text).cast("date")


def date_in_parentheses(text: Column) -> Column:
    """The first day-first date in parentheses inside a comment; null without one or if it is no date."""
    found = F.regexp_extract(text, _DATE_IN_PARENTHESES, 1)
    part = F.split(found, r"[/\-.]")
    day, month, year = (F.try_element_at(part, F.lit(i)) for i in (1, 2, 3))
    century = F.when(year.try_cast("int") > _LAST_YEAR_OF_THIS_CENTURY, "19").otherwise("20")
    full_year = F.when(F.length(year) == 4, year).when(F.length(year) == 2, F.concat(century, year))
    return F.concat_ws("-", full_year, month, day).try_cast("date")


def call_clock(comment: Column, contact: Column) -> Column:
    """When the call took place: the date in the comment, else the time of the contact."""
    return F.coalesce(date_in_parentheses(comment).cast(CLOCK), contact.cast(CLOCK))


def run_clock(moment: dt.datetime) -> Column:
    """The run time as a constant column."""
    return F.lit(moment.isoformat(sep=" ")).cast(CLOCK)


def days_overdue(invoice_date: Column, run_date: dt.date) -> Column:
    return F.datediff(F.lit(run_date), invoice_date)


def age_by_days(days: Column) -> Column:
    """Label of a number of days overdue; a null number has no label."""
    label = F.when(days.isNull(), F.lit(None))
    for months, name in enumerate(AGE_LABELS_DAYS[:-1], start=1):
        label = label.when(days <= 30 * months, name)
    return label.otherwise(AGE_LABELS_DAYS[-1])


def display_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")
