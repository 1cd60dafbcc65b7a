"""Text and number clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions import rules

# (?U) makes \s, \d, \w and \b follow Unicode; the separators \x1c-\x1f count as space too.
SPACE = r"[\s\x1c-\x1f]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_pattern(pattern: str) -> str:
    return "(?U)" + pattern


def strip(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), unicode_pattern(f"^{SPACE}+|{SPACE}+$"), "")


def null_tokens(c: Column | str) -> Column:
    """Null for texts that stand for a missing value."""
    c = as_column(c)
    return F.when(~c.isin(*rules.NA_TOKENS), c)


def to_double(c: Column | str) -> Column:
    """Number in a text; null when there is none, and for NaN, which would poison sums."""
    number = as_column(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_int(c: Column | str) -> Column:
    """Whole number in a text; '12.0' is 12."""
    return to_double(c).try_cast("int")


def to_date(c: Column | str) -> Column:
    """Lenient date: year, year-month, or a date followed by a blank or T and anything."""
    return as_column(c).try_cast("date")


def to_event_time(date: Column | str, time: Column | str) -> Column:
    """Time of an event from a date and a clock text; null unless both are usable."""
    date, time = as_column(date), as_column(time)
    joined = F.concat_ws(" ", date.cast("string"), time)
    return F.when(date.isNotNull() & time.isNotNull(), joined.try_cast("timestamp_ntz"))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of the wall-clock time, whatever the session time zone."""
    ts = as_column(ts)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def month_from_name(name: Column | str) -> Column:
    """Month named in a file name, upper-cased."""
    month = F.upper(F.regexp_extract(as_column(name), "(?iU)" + rules.MONTH_PATTERN, 1))
    return F.when(month != "", month).otherwise(rules.UNKNOWN_MONTH)


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(as_column(path), "/"), -1)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 1)
