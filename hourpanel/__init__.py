"""Hourly sensor-panel analytics on Spark: ingest, quality, panel joins, forecasting, export."""

from hourpanel.spec import AREA_PANEL, LOCATION_PANEL, PanelSpec

__all__ = ["AREA_PANEL", "LOCATION_PANEL", "PanelSpec"]
