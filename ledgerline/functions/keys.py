"""Natural keys from file paths, surrogate keys and content ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Path parts of the file layout.
DAY_PART = r"day=([^/]+)"
SLOT_PART = r"slot=([^/]+)"


def path_part(path: Column, pattern: str) -> Column:
    """First group of the pattern, '' when the path has no such part."""
    return F.coalesce(F.regexp_extract(path, pattern, 1), F.lit(""))


def transaction_key(path: Column, transaction_id: Column) -> Column:
    """Day and slot of the file without dashes, '#', id."""
    where = F.concat(path_part(path, DAY_PART), path_part(path, SLOT_PART))
    return F.concat(F.replace(where, F.lit("-"), F.lit("")), F.lit("#"), transaction_id.cast("string"))


def cancellation_key(path: Column, cancellation_id: Column) -> Column:
    """Day of the file without dashes, '#', id."""
    day = F.replace(path_part(path, DAY_PART), F.lit("-"), F.lit(""))
    return F.concat(day, F.lit("#"), cancellation_id.cast("string"))


def surrogate_key(*parts: Column) -> Column:
    """64-bit key; stable for equal parts, its value is not meaningful."""
    return F.xxhash64(*parts)


def content_id(*parts: Column) -> Column:
    """MD5 over the parts joined with '|', NULL counting as empty text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", *texts).cast("binary"))
