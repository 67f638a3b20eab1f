"""Small landed frames used by several tests."""

from datetime import date

from hourpanel.sources import schemas

POINT = (144.9619401, -37.81252157)


def counts(spark, rows, lon_lat=POINT):
    """Rows of (location, date, hour, count[, lon, lat])."""
    data = []
    for i, row in enumerate(rows):
        location, day, hour, value = row[:4]
        lon, lat = row[4:6] if len(row) > 4 else lon_lat
        data.append(
            (i, location, date.fromisoformat(day) if day else None, hour, 1, 1, value, "s",
             {"lon": lon, "lat": lat})
        )
    return spark.createDataFrame(data, schemas.COUNTS.schema)


def sensors(spark, rows):
    """Rows of (location, lat, lon)."""
    data = [
        (loc, f"site {loc}", f"N{loc}", "2020-06-03", None, "Outdoor", "A", "North", "South", lat,
         lon, {"lon": lon, "lat": lat})
        for loc, lat, lon in rows
    ]
    return spark.createDataFrame(data, schemas.SENSORS.schema)


def plan_of(df):
    """Text of the physical plan."""
    return df._jdf.queryExecution().executedPlan().toString()
