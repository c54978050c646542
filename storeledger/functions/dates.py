"""Order dates: which layout a text has, and the calendar day it names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.contract import MAX_ORDER_DATE, MIN_ORDER_DATE

# Year-month-day with '-' or '/', optionally a time of day and a zone.
_DAY = r"[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}"
_TIME = r"[T ](?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,9})?)?"
_ZONE = r"Z|[+-][0-9]{2}:?[0-9]{2}"
_ORDER_DATE = rf"^{_DAY}(?:{_TIME}(?:{_ZONE})?)?$"
_WITH_ZONE = rf"^(.*?)({_ZONE})?$"
_DAY_PART = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
# Month first, as written in the United States.
_MONTH_FIRST = rf"^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})(?:{_TIME}(?:{_ZONE})?)?$"
_PLAIN_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def order_day(text: Column) -> Column:
    """The calendar day, time of day dropped; null if it cannot be read."""
    dashed = F.replace(F.regexp_extract(text, _DAY_PART, 0), F.lit("/"), F.lit("-"))
    day = F.when(text.rlike(_PLAIN_DAY), text.try_cast("date")).when(
        text.rlike(_ORDER_DATE), dashed.try_cast("date")
    ).when(
        text.rlike(_MONTH_FIRST),
        F.regexp_replace(text, _MONTH_FIRST, "$3-$1-$2").try_cast("date"),
    )
    in_range = day.between(F.lit(MIN_ORDER_DATE).cast("date"), F.lit(MAX_ORDER_DATE).cast("date"))
    return F.when(in_range, day)


def iso_day(text: Column) -> Column:
    """The calendar day as YYYY-MM-DD text."""
    return order_day(text).cast("string")


def order_day_layout(text: Column) -> Column:
    """A name for the layout: digits masked, zone kept. One file must use one layout."""
    timed = text.rlike("[T ]")
    body = F.when(timed, F.regexp_extract(text, _WITH_ZONE, 1)).otherwise(text)
    zone = F.when(timed, F.regexp_extract(text, _WITH_ZONE, 2)).otherwise("")
    masked = F.concat(F.regexp_replace(body, "[0-9]+", "9"), zone)
    return (
        F.when(text.rlike(_PLAIN_DAY), F.lit("9-9-9"))
        .when(text.rlike(_MONTH_FIRST), F.concat(F.lit("month first "), masked))
        .otherwise(masked)
    )
