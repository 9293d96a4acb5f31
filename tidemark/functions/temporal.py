"""Column expressions for times that are known as dates or as instants.

A temporal is stored as three columns: its precision ('date', 'datetime',
'inferred' or 'unknown'), the date as written, and the UTC instant.
"""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLETED_DATE = "completed_date"
CALENDAR_DATE_INCLUSIVE = "calendar_date_inclusive"
SAME_DAY_WARNING = "date_only_same_day_intraday_safety_not_established"

_DATE = r"^\d{4}-\d{2}-\d{2}$"
_DATETIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"


class Temporal(NamedTuple):
    """Precision, written date and instant of a stored time."""

    precision: Column
    written_date: Column
    instant: Column


def parse_temporal(raw: Column) -> Temporal:
    """A string as a date or as a datetime with offset; anything else, naive datetimes included, has a null precision."""
    day = F.when(raw.rlike(_DATE), F.expr("1"))
    moment = F.when(raw.rlike(_DATETIME), F.try_to_timestamp(raw))
    written = F.when(raw.rlike(_DATE) | raw.rlike(_DATETIME), F.substring(raw, 1, 10).try_cast("date"))
    precision = F.when(day.isNotNull() & written.isNotNull(), "date").when(moment.isNotNull() & written.isNotNull(), "datetime")
    return Temporal(precision, F.when(precision.isNotNull(), written), F.when(precision == "datetime", moment))


def cutoff(value: str) -> Temporal:
    """The cutoff of a query as literals."""
    return parse_temporal(F.lit(value))


def latest_written_date(value: str) -> datetime.date:
    """No time that is visible at the cutoff was written with a later date, whatever its offset: offsets stay below a day."""
    if len(value) == 10:
        return datetime.date.fromisoformat(value)
    return datetime.datetime.fromisoformat(value).astimezone(datetime.timezone.utc).date() + datetime.timedelta(1)


def pit_visible(available: Temporal, at: Temporal, policy: str = COMPLETED_DATE) -> Column:
    """Whether a time is at or before the cutoff.

    Inferred and unknown times never are. Dates compare as dates; a date against
    an instant counts when its day is over (completed_date) or has begun
    (calendar_date_inclusive); an instant against a date counts by the date as
    written, not by its UTC date; instants compare as instants.
    """
    date_in_day = available.written_date <= at.written_date if policy == CALENDAR_DATE_INCLUSIVE else available.written_date < at.written_date
    by_date = F.when(at.precision == "date", available.written_date <= at.written_date).otherwise(date_in_day)
    by_instant = F.when(at.precision == "date", available.written_date <= at.written_date).otherwise(available.instant <= at.instant)
    return F.coalesce(F.when(available.precision == "date", by_date).when(available.precision == "datetime", by_instant), F.lit(False))


def pit_warning(available: Temporal, at: Temporal, policy: str = COMPLETED_DATE) -> Column:
    """The warning that an inclusion carries, or null."""
    same_day = (available.precision == "date") & (at.precision == "datetime") & (available.written_date == at.written_date)
    return F.when(same_day & F.lit(policy == CALENDAR_DATE_INCLUSIVE), F.lit(SAME_DAY_WARNING))


def effective_on(valid_from: Column, valid_through: Column, day: Column) -> Column:
    """Inside a closed interval whose end may be open (null)."""
    return (valid_from <= day) & (valid_through.isNull() | (valid_through >= day))


def bucket_start(day: Column, frequency: str) -> Column:
    return F.trunc(day, {"monthly": "month", "quarterly": "quarter", "annual": "year"}[frequency])


def bucket_end(day: Column, frequency: str) -> Column:
    return F.date_sub(F.add_months(bucket_start(day, frequency), {"monthly": 1, "quarterly": 3, "annual": 12}[frequency]), 1)


def month_bounds(month: Column) -> tuple[Column, Column]:
    """First and last day of a month written as YYYY-MM; null where it isn't one."""
    first = F.when(month.rlike(r"^\d{4}-\d{2}$"), F.concat(month, F.lit("-01")).try_cast("date"))
    return first, F.last_day(first)
