"""Names and constants shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data model.
TIME_ZONE = "Australia/Melbourne"
SEASON_HOURS = 24
AUDIT_COLUMN = "ingested_at_utc"
WATCHED_LOCATIONS = (67, 68, 69)
CENSUS_YEAR = "2024"
FRESH_WARN_HOURS = 36
FRESH_ERROR_HOURS = 72
SAMPLE_ROWS = 5
NUMERIC_FEATURES = (
    "hourday",
    "day_of_week",
    "temperature_2m",
    "precipitation",
    "rain",
    "wind_speed_10m",
    "cloud_cover",
    "sensor_count",
    "lag_24h",
    "is_public_holiday",
    "is_school_term",
    "is_event_day",
)
FLAG_COLUMNS = ("is_public_holiday", "is_school_term", "is_event_day")
WEATHER_MEASURES = ("temperature_2m", "precipitation", "rain", "wind_speed_10m", "cloud_cover")


@dataclass(frozen=True)
class PanelSpec:
    """Which columns of a frame hold the series key, the wall clock, the instant and the value."""

    series: str = "location_id"
    date: str = "sensing_date"
    hour: str = "hourday"
    ts: str = "observed_at"
    value: str = "pedestriancount"
    tz: str = TIME_ZONE

    @property
    def grain(self) -> list[str]:
        return [self.series, self.date, self.hour]


LOCATION_PANEL = PanelSpec()
AREA_PANEL = PanelSpec(series="precinct")
