"""URL, title and date normalisation, and null-safe access to nested values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.tokens import col, strip

_DAY_MICROS = 86_400_000_000


def normalize_url(c: Column | str) -> Column:
    """Lower-case scheme, no query, no fragment; null when nothing is left."""
    bare = F.regexp_replace(col(c), r"(?s)[?#].*$", "")
    scheme = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*:", 0)
    return F.nullif(F.concat(F.lower(scheme), F.substr(bare, F.length(scheme) + 1)), F.lit(""))


def normalize_title(c: Column | str) -> Column:
    return F.lower(strip(F.coalesce(col(c), F.lit(""))))


def parse_date(c: Column | str) -> Column:
    """Timestamp of the date part of an ISO string; null when it is no date."""
    return F.try_to_timestamp(F.split_part(col(c), F.lit("T"), F.lit(1)), F.lit("yyyy-MM-dd"))


def format_date(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def epoch_to_ts(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c))


def as_timestamp(value: dt.datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def age_days(c: Column | str, as_of: dt.datetime | str | Column) -> Column:
    """Whole days between the value and ``as_of``, rounded down (negative for the future)."""
    micros = F.unix_micros(as_timestamp(as_of)) - F.unix_micros(col(c).cast("timestamp"))
    return ((micros - F.pmod(micros, F.lit(_DAY_MICROS))) / _DAY_MICROS).cast("bigint")


def get_path(c: Column | str, path: str, default=None) -> Column:
    """``a.b.c`` inside a struct column; null anywhere on the way gives the default."""
    value = col(c)
    for name in path.split("."):
        value = value[name]
    return value if default is None else F.coalesce(value, F.lit(default))


def first_filled(columns: list[str], candidates: tuple[str, ...]) -> Column:
    """First non-empty value over the candidate columns that exist; null when there is none."""
    present = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in candidates if c in columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")
