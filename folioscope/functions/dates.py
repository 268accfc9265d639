"""Timestamps of the two archives, read as UTC; unreadable values become null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

HTTP_DATE_FORMAT = "d MMM yyyy HH:mm:ss zzz"


def http_date(text: Column) -> Column:
    """``Mon, 2 Apr 2007 19:18:42 GMT``; the weekday is dropped, not checked against the date."""
    without_weekday = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", "")
    return F.try_to_timestamp(without_weekday, F.lit(HTTP_DATE_FORMAT))


def iso_date(text: Column) -> Column:
    """ISO 8601 with optional fractional seconds and offset."""
    return text.try_cast("timestamp")


def published_or_created(published: Column, created: Column) -> Column:
    return F.coalesce(published, created)
