"""Event times as microseconds since the epoch, UTC.

Integer microseconds make window, pairing and sweep arithmetic exact and independent of the
session time zone; text is only produced at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{0,9})?$"


def event_us(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.fraction]`` read as UTC; null when it does not parse."""
    zoned = F.concat(F.rtrim(text, F.lit(".")), F.lit("Z"))
    return F.when(text.rlike(TIMESTAMP_PATTERN), F.unix_micros(zoned.try_cast("timestamp")))


def dt_bucket_us(text: Column) -> Column:
    """A compact ``yyyyMMddHHmm`` bucket."""
    return F.unix_micros(F.try_to_timestamp(text, F.lit("yyyyMMddHHmm")))


def seconds_text(us: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.timestamp_micros(us), pattern)


def _fraction_text(us: Column) -> Column:
    return F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0")


def micros_text(us: Column, separator: str = " ") -> Column:
    """Seconds text with six fraction digits, which are left out when all are zero."""
    base = seconds_text(us, f"yyyy-MM-dd'{separator}'HH:mm:ss")
    return F.when(F.pmod(us, F.lit(1_000_000)) == 0, base).otherwise(
        F.concat(base, F.lit("."), _fraction_text(us)))


def iso_local(us: Column) -> Column:
    """Shortest ISO form: no seconds when zero, otherwise 0, 3 or 6 fraction digits."""
    minute = seconds_text(us, "yyyy-MM-dd'T'HH:mm")
    second = seconds_text(us, "yyyy-MM-dd'T'HH:mm:ss")
    return (
        F.when(F.pmod(us, F.lit(60_000_000)) == 0, minute)
        .when(F.pmod(us, F.lit(1_000_000)) == 0, second)
        .when(F.pmod(us, F.lit(1_000)) == 0,
              F.concat(second, F.lit("."), F.substring(_fraction_text(us), 1, 3)))
        .otherwise(F.concat(second, F.lit("."), _fraction_text(us)))
    )


def minutes_between(start_us: Column, end_us: Column) -> Column:
    """Whole milliseconds between two instants, in minutes."""
    return F.floor((end_us - start_us) / 1000) / F.lit(60000.0)
