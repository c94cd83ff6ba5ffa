"""Time parsing and calendar arithmetic, all in UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from ledgerline.functions.keys import DAY_PART, SLOT_PART, path_part

# Text forms of a cancellation time, the documented one first.
CANCEL_FORMAT = "yyyy MMM dd HH:mm"
TIME_FORMATS = [
    CANCEL_FORMAT,
    "yyyy MMM dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "dd MMM yyyy HH:mm:ss",
    "dd MMM yyyy HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
]
OPEN_END = "2100-01-01 00:00:00"


def event_time(epoch: Column, path: Column) -> Column:
    """Epoch seconds, or the day and slot of the file when the epoch is 0 or absent."""
    slot = F.concat(path_part(path, DAY_PART), F.lit(" "), path_part(path, SLOT_PART))
    return F.when(F.coalesce(epoch, F.lit(0)) != 0, F.timestamp_seconds(epoch)).otherwise(
        F.try_to_timestamp(slot, F.lit("yyyy-MM-dd HH-mm"))
    )


def rate_time(text: Column) -> Column:
    """A text holding epoch seconds or a plain date and time."""
    return F.coalesce(F.timestamp_seconds(text.try_cast("bigint")), F.try_to_timestamp(text))


def lenient_time(text: Column) -> Column:
    """First format that parses, else 10-digit epoch seconds, else NULL.

    A failed parse is costly, so text without a digit is not tried at all.
    """
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS]
    epoch = F.when(text.rlike(r"^\d{10}$"), F.timestamp_seconds(text.try_cast("bigint")))
    return F.when(text.rlike(r"\d"), F.coalesce(*tries, epoch))


def lenient_date(text: Column) -> Column:
    """A full date, else NULL: a year alone, or a date with something after it, is none."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text))


def hours_crossed(start: Column, end: Column) -> Column:
    """Number of hour boundaries between two times (10:59 to 11:01 is 1)."""
    seconds = F.unix_timestamp(F.date_trunc("hour", end)) - F.unix_timestamp(F.date_trunc("hour", start))
    return (seconds / 3600).cast("bigint")


def published_time(text: Column) -> Column:
    """ISO time with an offset or Z; anything else is NULL."""
    zoned = text.rlike(r"^\d{4}-\d{2}-\d{2}T.*(Z|[+-]\d{2}:\d{2}(:\d{2})?)$")
    return F.when(zoned, to_millis(F.try_to_timestamp(text)))


def utc(moment: datetime) -> datetime:
    """A time without a zone means UTC, whatever the zone of the driver's machine."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def to_millis(moment: Column) -> Column:
    return F.timestamp_millis(F.unix_millis(moment))
