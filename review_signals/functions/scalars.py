"""Column expressions shared by batch and streaming code. All of them are built-in, JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_SECOND = 1_000_000


def date_from_epoch_days(days: Column) -> Column:
    """Days since 1970-01-01 to a date, without going through a time zone."""
    return F.date_from_unix_date(days.try_cast("int"))


def helpful_ratio(helpful: Column, total: Column) -> Column:
    """Share of helpful votes; null where nobody voted."""
    return F.try_divide(helpful, total)


def ratio_bin(helpful: Column, total: Column, bins: int) -> Column:
    """Histogram bin of helpful/total over [0, 1], in integer arithmetic so that bin edges are exact.

    The last bin is closed: a ratio of 1 (or above, in dirty data) falls into it.
    """
    position = F.floor(F.try_divide(helpful.cast("bigint") * bins, total)).cast("int")
    return F.when(position >= bins, bins - 1).otherwise(position)


def share(part: Column, whole: Column) -> Column:
    """part / whole, and 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def as_int(flag: Column) -> Column:
    return flag.cast("int")


def key_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Stable bucket of a key: depends on the key and the seed only, never on the partition layout."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def epoch_micros(column: Column, data_type: T.DataType) -> Column:
    """Microseconds since the epoch, for timestamps with and without a zone.

    A zone-less timestamp is taken apart instead of cast, so the session zone has no influence.
    """
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    seconds = (
        F.unix_date(column.cast("date")).cast("bigint") * 86_400
        + F.hour(column) * 3_600
        + F.minute(column) * 60
    )
    micros = (F.extract(F.lit("SECOND"), column) * MICROS_PER_SECOND).cast("bigint")
    return seconds * MICROS_PER_SECOND + micros


def sample_stddev(n: Column, total: Column, total_squares: Column) -> Column:
    """Sample standard deviation from exact integer sums; null below two values.

    n * sum(x^2) - sum(x)^2 is formed in decimals, so it neither overflows nor depends on merge order.
    """
    whole = "decimal(19,0)"
    spread = n.cast(whole) * total_squares.cast(whole) - total.cast(whole) * total.cast(whole)
    size = n.cast("double")
    return F.when(n > 1, F.sqrt(spread.cast("double") / (size * (size - 1))))


def flagged(score: Column, threshold: float) -> Column:
    """1.0 where the score reaches the threshold, 0.0 below, null for an unknown score."""
    return (score >= threshold).cast("double")
