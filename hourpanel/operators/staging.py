"""Staging projections: rename, cast, and pull nested fields of the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourpanel.functions.scalars import tolerant_date
from hourpanel.functions.wallclock import local_date, local_hour
from hourpanel.spec import AUDIT_COLUMN, CENSUS_YEAR, TIME_ZONE


def stage_counts(raw: DataFrame) -> DataFrame:
    """Hourly counts; the two direction columns are counts here."""
    return raw.select(
        "id",
        "location_id",
        F.col("sensing_date").cast("date").alias("sensing_date"),
        "hourday",
        F.col("direction_1").alias("direction_1_count"),
        F.col("direction_2").alias("direction_2_count"),
        "pedestriancount",
        "sensor_name",
        F.col("location.lon").alias("longitude"),
        F.col("location.lat").alias("latitude"),
        "observed_at",
        AUDIT_COLUMN,
    )


def stage_sensors(raw: DataFrame) -> DataFrame:
    """Sensor snapshot; the two direction columns are compass labels here."""
    return raw.select(
        "location_id",
        "sensor_description",
        "sensor_name",
        tolerant_date(F.col("installation_date")).alias("installation_date"),
        "note",
        "location_type",
        "status",
        F.col("direction_1").alias("direction_1_label"),
        F.col("direction_2").alias("direction_2_label"),
        "latitude",
        "longitude",
        AUDIT_COLUMN,
    )


def stage_weather(raw: DataFrame, tz: str = TIME_ZONE) -> DataFrame:
    """Hourly weather keyed by local date and hour."""
    return raw.select(
        F.col("time").alias("observed_at"),
        local_date(F.col("time"), tz).alias("sensing_date"),
        local_hour(F.col("time"), tz).alias("hourday"),
        "temperature_2m",
        "precipitation",
        "rain",
        "wind_speed_10m",
        "cloud_cover",
        AUDIT_COLUMN,
    )


def stage_holidays(raw: DataFrame, tz: str = TIME_ZONE) -> DataFrame:
    """Holidays by local date; a landed midnight instant is read on the local wall clock."""
    is_instant = dict(raw.dtypes)["date"] == "timestamp"
    day = local_date(F.col("date"), tz) if is_instant else F.col("date").cast("date")
    return raw.select(day.alias("holiday_date"), F.col("name").alias("holiday_name"), AUDIT_COLUMN)


def stage_terms(raw: DataFrame) -> DataFrame:
    return raw.select(
        "year",
        "term",
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        "jurisdiction",
        "source_note",
        AUDIT_COLUMN,
    )


def stage_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "event_name",
        "venue",
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        "notes",
        "year",
        AUDIT_COLUMN,
    )


def block_centroids(addresses: DataFrame, census_year: str = CENSUS_YEAR) -> DataFrame:
    """Mean coordinates and address count per (block, area) of one census year."""
    return (
        addresses.filter(
            (F.col("census_year").cast("string") == census_year)
            & F.col("latitude").isNotNull()
            & F.col("longitude").isNotNull()
        )
        .groupBy("block_id", "clue_small_area")
        .agg(
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
            F.count(F.lit(1)).alias("address_count"),
        )
    )
