"""Time arithmetic on TIMESTAMP_NTZ columns, independent of the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def day_start(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return floor_window(ts, 3600)


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def floor_window(ts: Column, seconds: int) -> Column:
    """Start of the tumbling window holding `ts`, aligned to midnight."""
    check_window(seconds)
    into_day = F.floor(second_of_day(ts) / seconds) * seconds
    return day_start(ts) + seconds_interval(into_day)


def check_window(seconds: int) -> None:
    """Windows restart at midnight, so their size must divide the day."""
    if seconds <= 0 or 86400 % seconds:
        raise ValueError(f"window size {seconds} s does not divide a day")


def seconds_interval(seconds: Column | int) -> Column:
    secs = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def whole_second(ts: Column) -> Column:
    """`ts` without its fraction of a second."""
    fraction = F.date_part(F.lit("SECOND"), ts) - F.second(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction.cast("decimal(18,6)"))


def day_of_week(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_PATTERN)


def event_hour(text: Column) -> Column:
    """Hour of an ISO text, 0 when it cannot be read."""
    return F.coalesce(F.hour(F.try_to_timestamp(text)), F.lit(0))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from `start` to `end`."""
    return (end - start).cast("interval second").cast("bigint")


def epoch_millis(ts: Column) -> Column:
    seconds = (ts - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second")
    return (seconds.cast("decimal(18,6)") * 1000).cast("bigint")


def as_instant(ts: Column) -> Column:
    """The UTC wall time `ts` as a TIMESTAMP, which watermarks need."""
    return F.timestamp_millis(epoch_millis(ts))


def as_wall_time(instant: Column) -> Column:
    """The UTC wall time of a TIMESTAMP."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + seconds_interval(F.unix_seconds(instant))
