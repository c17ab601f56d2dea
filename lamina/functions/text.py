"""String columns counted in code points, with Unicode white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space (``trim`` knows U+0020 only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """Null, empty or only white space."""
    return c.isNull() | ~c.rlike(r"(?U)\S")


def content_hash(c: Column) -> Column:
    """``sha256:`` and the hex digest of the UTF-8 text."""
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def piece(text: Column, start: Column, end: Column) -> Column:
    """Half-open, 0-based slice."""
    return F.substring(text, start + F.lit(1), end - start)


def content_timestamp(c: Column) -> Column:
    """A timestamp derived from the text: the first 8 hex digits of its hash as epoch seconds."""
    return F.timestamp_seconds(F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("bigint"))


def iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def locate_from(needle: Column, hay: Column, start: Column | int = 0) -> Column:
    """0-based first occurrence at or after ``start``; null where there is none or the needle is empty."""
    at = F.call_function("locate", needle, hay, (F.lit(start) if isinstance(start, int) else start) + F.lit(1))
    return F.when((F.length(needle) > 0) & (at > 0), at - F.lit(1))


def try_suffix_number(c: Column) -> Column:
    """The number behind the last underscore, null where there is none."""
    return F.substring_index(c, "_", -1).try_cast("int")
