"""Wall clock and instant arithmetic as column expressions.

An instant is a ``timestamp``. A wall clock is carried as the ``timestamp`` that shows it in UTC, so
moving between the two is one zone shift and no result depends on the session time zone. The zone
is a literal, which lets generated code resolve it once instead of once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourpanel.spec import TIME_ZONE

OK, AMBIGUOUS, NONEXISTENT = "ok", "ambiguous", "nonexistent"
DAY_SECONDS, HOUR_SECONDS = 86_400, 3_600


def wall_clock(date: Column, hour: Column) -> Column:
    """Date and hour label (0 to 23) as a wall clock; null for any other hour."""
    seconds = F.unix_date(date).cast("bigint") * DAY_SECONDS + hour.cast("bigint") * HOUR_SECONDS
    return F.when(hour.between(0, 23), F.timestamp_seconds(seconds))


def wall_from_ntz(ntz: Column) -> Column:
    """A zoneless timestamp as a wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, ntz))


def wall_date(wall: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(wall) / DAY_SECONDS).cast("int"))


def wall_hour(wall: Column) -> Column:
    return (F.pmod(F.unix_seconds(wall), F.lit(DAY_SECONDS)) / HOUR_SECONDS).cast("int")


def _later(moment: Column, minutes: int) -> Column:
    return moment + F.make_dt_interval(mins=F.lit(minutes))


def is_nonexistent(wall: Column, tz: str = TIME_ZONE) -> Column:
    """True inside a spring-forward jump: the wall clock does not survive a round trip."""
    return F.from_utc_timestamp(F.to_utc_timestamp(wall, tz), tz) != wall


def is_ambiguous(wall: Column, tz: str = TIME_ZONE, shift_minutes: int = 60) -> Column:
    """True inside a fall-back hour: two instants one shift apart show the same wall clock."""
    instant = F.to_utc_timestamp(wall, tz)
    after = F.from_utc_timestamp(_later(instant, shift_minutes), tz)
    before = F.from_utc_timestamp(_later(instant, -shift_minutes), tz)
    return (after == wall) | (before == wall)


def dst_kind(wall: Column, tz: str = TIME_ZONE) -> Column:
    return (
        F.when(wall.isNull(), F.lit(None))
        .when(is_nonexistent(wall, tz), F.lit(NONEXISTENT))
        .when(is_ambiguous(wall, tz), F.lit(AMBIGUOUS))
        .otherwise(F.lit(OK))
    )


def localize(wall: Column, tz: str = TIME_ZONE) -> Column:
    """Instant of a wall clock; null where the wall clock means no instant or two."""
    return F.when(
        ~is_nonexistent(wall, tz) & ~is_ambiguous(wall, tz), F.to_utc_timestamp(wall, tz)
    )


def parse_instant(text: Column, tz: str = TIME_ZONE) -> Column:
    """Instant of an ISO string: with an offset taken as is, without one localised."""
    has_offset = text.rlike(r"T.*(Z|[+-]\d{2}:?\d{2})$")
    # The cast wants seconds before an offset; hourly sources often leave them out.
    full = F.regexp_replace(text, r"T(\d{2}:\d{2})(Z|[+-])", "T$1:00$2")
    return F.when(has_offset, full.try_cast("timestamp")).otherwise(
        localize(wall_from_ntz(text.try_cast("timestamp_ntz")), tz)
    )


def local_wall(instant: Column, tz: str = TIME_ZONE) -> Column:
    """Wall clock shown in ``tz`` at an instant."""
    return F.from_utc_timestamp(instant, tz)


def utc_wall(instant: Column) -> Column:
    """An instant as its UTC reading without a zone."""
    return F.convert_timezone(None, F.lit("UTC"), instant)


def local_date(instant: Column, tz: str = TIME_ZONE) -> Column:
    return wall_date(local_wall(instant, tz))


def local_hour(instant: Column, tz: str = TIME_ZONE) -> Column:
    return wall_hour(local_wall(instant, tz))


def day_of_week(date: Column) -> Column:
    """Monday = 0."""
    return F.weekday(date)


def expected_hours(date: Column, tz: str = TIME_ZONE) -> Column:
    """Array of the wall hours a day has: 0 to 23 without the skipped one; a repeated one once.

    Hours are tested one by one only on a day that is not 24 hours long.
    """
    midnight = wall_clock(date, F.lit(0))
    length = F.unix_seconds(F.to_utc_timestamp(_later(midnight, 24 * 60), tz)) - F.unix_seconds(
        F.to_utc_timestamp(midnight, tz)
    )
    hours = F.sequence(F.lit(0), F.lit(23))
    return F.when(length == DAY_SECONDS, hours).otherwise(
        F.filter(hours, lambda hour: ~is_nonexistent(wall_clock(date, hour), tz))
    )


def is_expected_hour(date: Column, hour: Column, tz: str = TIME_ZONE) -> Column:
    return hour.between(0, 23) & ~is_nonexistent(wall_clock(date, hour), tz)


def expected_grid(days: DataFrame, date: str, hour: str, tz: str = TIME_ZONE) -> DataFrame:
    """One row per day and expected wall hour."""
    return days.select("*", F.explode(expected_hours(F.col(date), tz)).alias(hour))
