"""The location-hour table and the area-hour mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.spec import WEATHER_MEASURES

SENSOR_COLUMNS = (
    "sensor_description", "location_sensor_name", "direction_1_label", "direction_2_label",
    "latitude", "longitude", "location_type", "sensor_status", "installation_date",
)


def sensor_dimension(sensors: DataFrame) -> DataFrame:
    """Sensor columns under the names they carry in the location-hour table."""
    return sensors.select(
        "location_id",
        "sensor_description",
        F.col("sensor_name").alias("location_sensor_name"),
        "direction_1_label",
        "direction_2_label",
        "latitude",
        "longitude",
        "location_type",
        F.col("status").alias("sensor_status"),
        "installation_date",
    )


def join_sensors(counts: DataFrame, sensors: DataFrame) -> DataFrame:
    return counts.join(sensor_dimension(sensors), "location_id", "left")


def join_weather(counts: DataFrame, weather: DataFrame) -> DataFrame:
    measures = weather.select("sensing_date", "hourday", *WEATHER_MEASURES)
    return counts.join(measures, ["sensing_date", "hourday"], "left")


def calendar_flags(df: DataFrame) -> DataFrame:
    """Flags and zero counts for days without calendar rows."""
    return df.withColumns(
        {
            "is_public_holiday": F.col("holiday_name").isNotNull(),
            "is_school_term": F.coalesce("school_term_count", F.lit(0)) > 0,
            "event_count": F.coalesce("event_count", F.lit(0).cast("bigint")),
            "is_event_day": F.col("event_names").isNotNull(),
        }
    )


def location_hour(
    counts: DataFrame, sensors: DataFrame, weather: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Staged counts with sensor, weather and calendar columns; one output row per count row.

    ``calendar`` is ``calendar_by_day``. The three dimensions are landed or materialised tables, so
    the planner knows their size and broadcasts each one that is small; the facts are then not
    shuffled at all.
    """
    bare = counts.select(
        "location_id", "sensing_date", "hourday", "observed_at", "pedestriancount",
        "direction_1_count", "direction_2_count", F.col("sensor_name").alias("count_sensor_name"),
    )
    joined = join_weather(join_sensors(bare, sensors), weather).join(
        calendar, "sensing_date", "left"
    )
    return calendar_flags(joined).select(
        "location_id", "sensing_date", "hourday", "observed_at", "pedestriancount",
        "direction_1_count", "direction_2_count", "count_sensor_name", *SENSOR_COLUMNS,
        *WEATHER_MEASURES, "holiday_name", "is_public_holiday", "school_term", "is_school_term",
        "event_count", "event_names", "is_event_day",
    )


def precinct_hour(location_hours: DataFrame, block_map: DataFrame) -> DataFrame:
    """Area-hour mart from the location-hour table; locations without an area drop out."""
    areas = block_map.select("location_id", F.col("clue_small_area").alias("precinct"))
    largest = (*WEATHER_MEASURES, "holiday_name", "school_term", "event_count", "event_names")
    anywhere = ("is_public_holiday", "is_school_term", "is_event_day")
    return (
        location_hours.join(areas, "location_id")
        .groupBy("precinct", "sensing_date", "hourday")
        .agg(
            F.min("observed_at").alias("observed_at"),
            F.sum("pedestriancount").alias("pedestriancount"),
            F.count_distinct("location_id").alias("sensor_count"),
            *(F.max(name).alias(name) for name in largest),
            *(F.bool_or(name).alias(name) for name in anywhere),
        )
        .select(*MART_COLUMNS)
    )


MART_COLUMNS = (
    "precinct", "sensing_date", "hourday", "observed_at", "pedestriancount", "sensor_count",
    *WEATHER_MEASURES, "holiday_name", "is_public_holiday", "school_term", "is_school_term",
    "event_count", "event_names", "is_event_day",
)


def area_dimension(block_map: DataFrame, sensors: DataFrame) -> DataFrame:
    """Area of every mapped location, with the number of sensor rows the location has."""
    repeats = sensors.groupBy("location_id").agg(F.count(F.lit(1)).alias("copies"))
    return block_map.select("location_id", F.col("clue_small_area").alias("precinct")).join(
        repeats, "location_id", "left"
    )


def precinct_hour_early(
    counts: DataFrame, areas: DataFrame, weather: DataFrame, calendar: DataFrame
) -> DataFrame:
    """The same mart, aggregating the counts before the hour and day columns are attached.

    Weather depends only on (date, hour) and the calendar only on the date, so they join the
    aggregate, which is smaller than the facts by the number of sensors per area. Repeated sensor
    or weather keys multiply count rows in the wide join; the sum is scaled by the same factors.
    ``areas`` is a materialised ``area_dimension``.
    """
    per_location = counts.groupBy("location_id", "sensing_date", "hourday").agg(
        F.min("observed_at").alias("observed_at"),
        F.sum("pedestriancount").alias("pedestriancount"),
    )
    summed = (
        per_location.join(areas, "location_id")
        .groupBy("precinct", "sensing_date", "hourday")
        .agg(
            F.min("observed_at").alias("observed_at"),
            F.sum(
                F.col("pedestriancount") * F.coalesce("copies", F.lit(1))
            ).alias("pedestriancount"),
            F.count(F.lit(1)).alias("sensor_count"),
        )
    )
    by_hour = weather.groupBy("sensing_date", "hourday").agg(
        *(F.max(name).alias(name) for name in WEATHER_MEASURES),
        F.count(F.lit(1)).alias("_rows"),
    )
    joined = summed.join(by_hour, ["sensing_date", "hourday"], "left").join(
        calendar, "sensing_date", "left"
    )
    scaled = joined.withColumn(
        "pedestriancount", F.col("pedestriancount") * F.coalesce("_rows", F.lit(1))
    )
    return calendar_flags(scaled).select(*MART_COLUMNS)
