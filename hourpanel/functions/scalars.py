"""Tolerant casts and numeric guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with a zero denominator giving null."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def flag(value: Column) -> Column:
    """Boolean as 0 or 1, null counting as false."""
    return F.coalesce(value.cast("boolean"), F.lit(False)).cast("int")


def abs_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual.cast("double") - predicted.cast("double"))


def tolerant_date(value: Column) -> Column:
    return value.try_cast("date")


def half_even(value: Column, digits: int = 6) -> Column:
    return F.bround(value, digits)


def pick_coordinates(df: DataFrame) -> tuple[Column, Column]:
    """(lon, lat) from a ``location`` struct when complete, else from longitude and latitude."""
    null = F.lit(None).cast("double")
    names = set(df.columns)
    lon, lat = null, null
    if {"longitude", "latitude"} <= names:
        both = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
        lon = F.when(both, F.col("longitude").cast("double"))
        lat = F.when(both, F.col("latitude").cast("double"))
    if "location" in names:
        x, y = F.col("location.lon").cast("double"), F.col("location.lat").cast("double")
        both = x.isNotNull() & y.isNotNull()
        lon = F.when(both, x).otherwise(lon)
        lat = F.when(both, y).otherwise(lat)
    return lon, lat
