"""Table constraints. A check returns offending rows or tallies; nothing returned means it holds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.functions.wallclock import utc_wall
from hourpanel.spec import FRESH_ERROR_HOURS, FRESH_WARN_HOURS

# Columns that must hold a value, by table.
NOT_NULL = {
    "stg_pedestrian_counts": ["location_id", "sensing_date", "hourday", "pedestriancount"],
    "stg_sensor_locations": ["location_id"],
    "stg_weather_hourly": ["sensing_date", "hourday"],
    "stg_public_holidays": ["holiday_date", "holiday_name"],
    "stg_school_terms": ["start_date", "end_date"],
    "stg_major_events": ["event_id", "start_date", "end_date"],
    "stg_clue_block_centroids": ["block_id", "clue_small_area", "latitude", "longitude"],
    "int_location_hour": [
        "location_id", "sensing_date", "hourday", "pedestriancount", "is_public_holiday",
        "is_school_term", "is_event_day",
    ],
    "int_sensor_block_map": ["location_id", "block_id", "clue_small_area"],
    "mart_precinct_hour": [
        "precinct", "sensing_date", "hourday", "pedestriancount", "sensor_count",
        "is_public_holiday", "is_school_term", "is_event_day",
    ],
}
# Columns that must not repeat, by table.
UNIQUE = {
    "stg_sensor_locations": "location_id",
    "stg_public_holidays": "holiday_date",
    "stg_major_events": "event_id",
    "int_sensor_block_map": "location_id",
}
# Column sets that identify a row, by table.
GRAINS = {
    "stg_pedestrian_counts": ["location_id", "sensing_date", "hourday"],
    "stg_weather_hourly": ["sensing_date", "hourday"],
    "mart_precinct_hour": ["precinct", "sensing_date", "hourday"],
}


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Nulls per column of one table, from one aggregation over all of them."""
    tallies = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    rows = tallies.unpivot([], [F.col(name) for name in columns], "column_name", "null_rows")
    return rows.select(F.lit(table).alias("table_name"), "column_name", "null_rows")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return repeated_keys(df.filter(F.col(column).isNotNull()), [column])


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, null keys included."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def missing_parents(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child keys without a parent row. Keys are deduplicated before the anti join."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return keys.join(parent.select(column), column, "left_anti")


def hours_out_of_range(df: DataFrame) -> DataFrame:
    hour = F.col("hourday")
    return df.filter((hour < 0) | (hour > 23)).select("location_id", "sensing_date", "hourday")


def row_counts_differ(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with both counts when they differ, none when they agree."""
    count = F.count(F.lit(1))
    expected = after.agg(count).scalar()
    return before.agg(count.alias("staged_rows")).withColumn(
        "joined_rows", expected
    ).filter("staged_rows != joined_rows")


def totals(location_hours: DataFrame, block_map: DataFrame, mart: DataFrame) -> DataFrame:
    """Value total of the mapped locations next to that of the mart."""
    mapped = location_hours.join(block_map.select("location_id"), "location_id")
    return mapped.agg(F.sum("pedestriancount").alias("location_total")).withColumn(
        "precinct_total", mart.agg(F.sum("pedestriancount")).scalar()
    )


def totals_differ(
    location_hours: DataFrame, block_map: DataFrame, mart: DataFrame
) -> DataFrame:
    return totals(location_hours, block_map, mart).filter("location_total != precinct_total")


def freshness(
    df: DataFrame, now: datetime, column: str = "observed_at",
    warn_hours: int = FRESH_WARN_HOURS, error_hours: int = FRESH_ERROR_HOURS,
) -> DataFrame:
    """Age of the newest reading against two limits; ``now`` is a UTC wall clock."""
    newest = df.agg(F.max(column).alias("newest")).select(utc_wall(F.col("newest")).alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest"), F.lit(now).cast("timestamp_ntz")) / 3600.0
    status = (
        F.when(F.col("newest").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return newest.select("newest", age.alias("age_hours"), status.alias("status"))
