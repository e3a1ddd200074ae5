"""Instants, local clocks and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import LOCAL_ZONE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _wall_clock(ts: Column) -> Column:
    """The wall clock that an instant has in UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def utc_datetime(ts: Column | str) -> Column:
    """The zone-less UTC wall clock of an instant."""
    return _wall_clock(_col(ts))


def local_datetime(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """The zone-less wall clock of an instant in ``zone``; no step looks at the session's zone.

    ``from_utc_timestamp`` moves the instant by the zone's offset and resolves a literal zone
    once per task, while ``convert_timezone`` parses both zone names for every row.
    """
    return _wall_clock(F.from_utc_timestamp(_col(ts), zone))


def local_date(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_datetime(ts, zone))


def hour_bucket(ntz: Column | str) -> Column:
    """Truncate a wall clock to the hour without leaving TIMESTAMP_NTZ.

    ``date_trunc`` returns an instant of the session zone, so it is avoided.
    """
    c = _col(ntz)
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), zero, zero)


def with_event_date_parts(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Lake partition columns: the UTC date of the event."""
    utc = utc_datetime(ts)
    return df.withColumns({
        "year": F.year(utc), "month": F.month(utc), "day": F.dayofmonth(utc),
    })


def wall_seconds(ntz: Column | str) -> Column:
    """Whole seconds of a wall clock since 1970, counted on the clock itself."""
    c = _col(ntz)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60 + F.second(c)


def utc_hour(ts: Column | str) -> Column:
    """The instant at which the UTC hour of an instant began."""
    return F.timestamp_seconds(F.floor(F.unix_micros(_col(ts)) / F.lit(3_600_000_000)) * 3600)


def best_effort_timestamp(text: Column | str, precision: int = 3) -> Column:
    """Parse ISO-8601, space-separated or epoch (s / ms) text; NULL when unreadable.

    Text without an offset is UTC.
    """
    s = F.trim(_col(text))
    with_zone = (
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(s, F.lit("T00:00:00Z")))
        .when(s.rlike(r"\d{2}:\d{2}:\d{2}(\.\d+)?$"), F.concat(s, F.lit("Z")))
        .otherwise(s)
    )
    parsed = (
        F.when(s.rlike(r"^\d{9,10}$"), F.timestamp_seconds(s.try_cast("bigint")))
        .when(s.rlike(r"^\d{12,13}$"), F.timestamp_millis(s.try_cast("bigint")))
        .otherwise(F.try_to_timestamp(with_zone))
    )
    step = {0: 1_000_000, 3: 1_000, 6: 1}[precision]
    whole = F.floor(F.unix_micros(parsed) / F.lit(step)) * step
    return F.timestamp_micros(whole)


def strict_timestamp(text: Column | str, precision: int = 3) -> Column:
    """Fail the query on text that is not a time; NULL stays NULL."""
    s, parsed = _col(text), best_effort_timestamp(text, precision)
    message = F.concat(F.lit("not a time: "), s)
    return F.when(s.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(message).cast("timestamp"))
