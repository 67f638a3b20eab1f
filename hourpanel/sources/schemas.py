"""Declared schemas of the landed sources. Keys, types and column sets are fixed by the data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

from hourpanel.spec import AUDIT_COLUMN


class MissingColumns(ValueError):
    """A landed frame lacks columns its source declares."""


@dataclass(frozen=True)
class Source:
    """One landed source: its columns, how it is partitioned, and the dates it can cover."""

    name: str
    schema: T.StructType
    date_column: str | None = None
    key_column: str | None = None
    first_day: date | None = None
    last_day: date | None = None
    derived: T.StructType = T.StructType([])

    @property
    def landed(self) -> T.StructType:
        """Schema of the written tree: source columns, derived columns and the audit stamp."""
        return T.StructType(
            [*self.schema, *self.derived, T.StructField(AUDIT_COLUMN, T.TimestampType())]
        )


LON_LAT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "floats": T.ArrayType(T.FloatType()),
    "lon_lat": LON_LAT,
}


def columns(listing: str) -> T.StructType:
    """Schema from ``name type`` pairs; unlike a DDL string it needs no running session."""
    pairs = (item.split() for item in listing.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# The industry columns of the two per-block census tables.
INDUSTRIES = """
accommodation_and_food_services
administrative_and_support_services
agriculture_forestry_and_fishing
arts_and_recreation_services
construction
education_and_training
electricity_gas_water_and_waste_services
financial_and_insurance_services
health_care_and_social_assistance
information_media_and_telecommunications
manufacturing
mining
other_services
professional_scientific_and_technical_services
public_administration_and_safety
rental_hiring_and_real_estate_services
retail_trade
transport_postal_and_warehousing
wholesale_trade
""".split()


def _per_block(total: str) -> T.StructType:
    measures = ", ".join(f"{name} double" for name in [*INDUSTRIES, total])
    return columns(f"census_year string, block_id string, clue_small_area string, {measures}")


COUNTS = Source(
    "pedestrian_hourly_counts",
    columns(
        "id bigint, location_id bigint, sensing_date date, hourday int, direction_1 bigint, "
        "direction_2 bigint, pedestriancount bigint, sensor_name string, "
        "location lon_lat"
    ),
    date_column="sensing_date",
    first_day=date(2024, 9, 6),
    derived=columns("observed_at timestamp"),
)
SENSORS = Source(
    "pedestrian_sensor_locations",
    columns(
        "location_id bigint, sensor_description string, sensor_name string, "
        "installation_date string, note string, location_type string, status string, "
        "direction_1 string, direction_2 string, latitude double, longitude double, "
        "location lon_lat"
    ),
    first_day=date(2009, 1, 20),
    last_day=date(2025, 10, 18),
)
WEATHER = Source(
    "open_meteo_archive",
    columns(
        "time timestamp, temperature_2m double, precipitation double, rain double, "
        "wind_speed_10m double, cloud_cover bigint"
    ),
    date_column="time",
    first_day=date(1940, 1, 1),
)
HOLIDAYS = Source(
    "vic_public_holidays",
    columns("date date, name string"),
    date_column="date",
    first_day=date(2019, 1, 1),
)
TERMS = Source(
    "vic_school_terms",
    columns(
        "year int, term int, start_date date, end_date date, jurisdiction string, "
        "source_note string"
    ),
    key_column="year",
)
EVENTS = Source(
    "major_events",
    columns(
        "event_id string, event_name string, venue string, start_date date, end_date date, "
        "notes string"
    ),
    key_column="year",
    derived=columns("year int"),
)
ADDRESSES = Source(
    "clue_establishments_address_industry",
    columns(
        "census_year string, block_id string, property_id string, base_property_id string, "
        "clue_small_area string, trading_name string, business_address string, "
        "industry_anzsic4_code string, industry_anzsic4_description string, longitude double, "
        "latitude double, point lon_lat"
    ),
    key_column="census_year",
    first_day=date(2002, 1, 1),
    last_day=date(2024, 1, 1),
)
BLOCK_ESTABLISHMENTS = Source(
    "clue_establishments_per_block_anzsic",
    _per_block("total_establishments_in_block"),
    key_column="census_year",
    first_day=date(2002, 1, 1),
    last_day=date(2024, 1, 1),
)
BLOCK_JOBS = Source(
    "clue_jobs_per_block_anzsic",
    _per_block("total_jobs_in_block"),
    key_column="census_year",
    first_day=date(2002, 1, 1),
    last_day=date(2024, 1, 1),
)
SOURCES = {
    source.name: source
    for source in (
        COUNTS, SENSORS, WEATHER, HOLIDAYS, TERMS, EVENTS,
        ADDRESSES, BLOCK_ESTABLISHMENTS, BLOCK_JOBS,
    )
}
