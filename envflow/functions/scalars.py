"""Scalar column helpers (all built-in expressions, no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANDING_KEY_FORMAT = "yyyy-MM-dd'T'HH-mm-ss"
ISO_MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str) -> Column:
    """ISO string -> timestamp_ntz; unparsable -> null (never fails the job).

    ``try_to_timestamp`` parses in the session zone and the cast back to NTZ
    uses the same zone, so the wall-clock value is kept whatever the zone.
    """
    return F.try_to_timestamp(_c(c)).cast("timestamp_ntz")


def to_utc(ts_ntz: Column | str, tz: Column | str) -> Column:
    """Local wall-clock time in zone ``tz`` -> UTC wall-clock time (NTZ)."""
    return F.to_utc_timestamp(_c(ts_ntz).cast("timestamp"), _c(tz)).cast("timestamp_ntz")


def sanitize_name(c: Column | str) -> Column:
    """Space, slash and backslash become underscore (folder-safe names)."""
    return F.translate(_c(c), " /\\", "___")


def landing_key(ts: Column | str) -> Column:
    """File-safe timestamp key ``YYYY-MM-DDTHH-MM-SS``."""
    return F.date_format(_c(ts), LANDING_KEY_FORMAT)


def integral_bigint(c: Column | str) -> Column:
    """A double that holds a whole number -> bigint; anything else -> null."""
    v = _c(c)
    ok = v.isNotNull() & ~F.isnan(v) & (v == F.floor(v)) & (F.abs(v) < F.lit(9.0e18))
    return F.when(ok, v.cast("bigint"))


def non_integral(c: Column | str) -> Column:
    """True when a present value is not a whole number (reject reason)."""
    v = _c(c)
    return v.isNotNull() & (F.isnan(v) | (v != F.floor(v)))


def metric_key(prefix: str, name: Column | str) -> Column:
    """Run-log metric key: prefix + lower-cased name without dots."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.lower(_c(name)), r"\.", ""))
