"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")


def archive_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("dd.MM.yyyy HH:mm"))


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def german_day(text: Column) -> Column:
    """`Montag, 3. März 2026` as a date; null where there is no such day."""
    name = F.regexp_extract(text, r"\d+\.\s*(\p{L}+)\s+\d{4}", 1)
    number = F.array_position(F.array(*map(F.lit, MONTHS)), name)
    day, year = F.regexp_extract(text, r"(\d+)\.", 1), F.regexp_extract(text, r"(\d{4})", 1)
    return F.when(number > 0, F.to_date(F.try_to_timestamp(F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd"))))


def retry_seconds(failures: Column) -> Column:
    """300 s, doubled with each further failure up to the ninth, a day at most."""
    return F.least(F.lit(86400.0), F.lit(300.0) * F.pow(F.lit(2.0), F.least(failures - 1, F.lit(8)))).cast("long")


def local_is_clear(local: Column, zone: str) -> Column:
    """Whether a wall-clock time exists once in a zone: not skipped and not doubled by a clock change."""
    utc = F.to_utc_timestamp(local, zone)
    hour = F.expr("interval 1 hour")
    twice = (F.from_utc_timestamp(utc - hour, zone) == local) | (F.from_utc_timestamp(utc + hour, zone) == local)
    return (F.from_utc_timestamp(utc, zone) == local) & ~twice


def publication_month(stated: Column, published: Column) -> Column:
    """The month of publication (yyyy-MM): the stated one if it is a month, else that of a time as it is written, without zones; null if neither is."""
    month, day = r"^\d{4}-(0[1-9]|1[0-2])$", r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])(T|\s|$)"
    return F.when(stated.rlike(month), stated).when(published.rlike(day), F.substring(published, 1, 7))
