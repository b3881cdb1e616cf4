"""Dates as feeds write them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tried in order, after a weekday name and a Z are taken off; without an offset a time is UTC.
PATTERNS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm Z", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
CARD_PATTERNS = ("d MMMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMM yyyy", "yyyy-MM-dd")


def parse_date(value: Column) -> Column:
    """An instant, or null where no pattern fits."""
    plain = F.regexp_replace(F.trim(value), r"^[A-Za-z]{3,9},\s*", "")
    iso = F.regexp_replace(F.regexp_replace(plain, "(?<=[0-9])Z$", "+00:00"), r"(?<=T[0-9:.]{5,15}[+-][0-9]{2})([0-9]{2})$", ":$1")
    return F.coalesce(*[F.try_to_timestamp(iso, F.lit(p)) for p in PATTERNS])


def card_date(value: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(F.trim(value), F.lit(p)) for p in CARD_PATTERNS]).cast("date")


def age_hours(now: Column, published: Column) -> Column:
    """Hours between two instants, to one place, halves away from zero."""
    return F.round((F.unix_micros(now) - F.unix_micros(published)) / F.lit(3.6e9), 1)


def london_date(instant: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, "Europe/London"))
