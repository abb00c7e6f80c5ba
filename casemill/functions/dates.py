"""Lenient date and time readers; all give timestamps without zone, null when unreadable."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NTZ = "timestamp_ntz"


def dutch_date(c: Column) -> Column:
    """ISO date or date-time, else day-month-year."""
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), c).try_cast(NTZ)
    likely = F.when(c.rlike(r"(?s)\p{Nd}.*-.*\p{Nd}.*-.*\p{Nd}"), c)  # text that can't be read costs an exception
    return F.coalesce(iso, F.try_to_timestamp(likely, F.lit("d-M-yyyy")).cast(NTZ))


def clock_seconds(c: Column) -> Column:
    """Seconds since midnight of ``H[:M[:S]]``; null when out of range or not numeric."""
    part = lambda i: F.coalesce(
        F.try_element_at(F.split(c, ":"), F.lit(i)), F.lit("0")).try_cast("int")
    hour, minute, second = part(1), part(2), part(3)
    inside = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    return F.when(inside, hour * 3600 + minute * 60 + second)


def dutch_datetime(day: Column, clock: Column) -> Column:
    """Day plus time of day; a bad time leaves the day as it is."""
    date = dutch_date(day)
    midnight = F.date_trunc("day", date).cast(NTZ)
    seconds = clock_seconds(F.coalesce(clock, F.lit("00:00:00")))
    timed = midnight + F.make_dt_interval(secs=seconds)
    return F.when(seconds.isNull(), date).otherwise(timed)


def call_datetime(day: Column, clock: Column) -> Column:
    """Date and time columns of a call; the date alone when the time is unreadable."""
    both = F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-MM-dd HH:mm:ss"))
    alone = F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))
    return F.when(day.isNotNull() & clock.isNotNull(), F.coalesce(both, alone)).cast(NTZ)


def from_millis(c: Column) -> Column:
    return F.timestamp_millis(c.cast("bigint")).cast(NTZ)


def from_seconds(c: Column) -> Column:
    """Epoch seconds; zero means unknown."""
    return F.timestamp_seconds(F.nullif(c, F.lit(0))).cast(NTZ)


def duration_seconds(c: Column) -> Column:
    """``HH:MM:SS`` or a plain number of seconds, else null."""
    text = c.cast("string")
    piece = lambda i: F.split_part(text, F.lit(":"), F.lit(i)).try_cast("int")
    clock = text.rlike(r"^\d+:\d{1,2}:\d{1,2}$")
    return F.when(clock, piece(1) * 3600 + piece(2) * 60 + piece(3)).otherwise(
        F.floor(text.try_cast("double")).cast("int"))


def hour_between(c: Column, low: int, high: int) -> Column:
    return F.hour(c).between(low, high)


def age_years(born: Column, as_of: Column) -> Column:
    """Whole years, up to the day; born on 29 February, one gets older on 1 March of common years."""
    return F.timestamp_diff("YEAR", born.cast("timestamp_ntz"), as_of.cast("timestamp_ntz")).cast("int")
