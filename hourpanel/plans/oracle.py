"""DuckDB statements that give the expected result of each registered query.

They are written from the definitions, independently of the Spark plans: plain joins on ``BETWEEN``,
cross joins for the nearest block and the gap grids, windows over whole series.
"""

from __future__ import annotations

from hourpanel.spec import FLAG_COLUMNS, NUMERIC_FEATURES, WEATHER_MEASURES

TZ = "Australia/Melbourne"


def kind(wall: str) -> str:
    at = f"timezone('{TZ}', {wall})"
    return (
        f"CASE WHEN timezone('{TZ}', {at}) <> {wall} THEN 'nonexistent' "
        f"WHEN timezone('{TZ}', {at} + INTERVAL 1 HOUR) = {wall} "
        f"OR timezone('{TZ}', {at} - INTERVAL 1 HOUR) = {wall} THEN 'ambiguous' ELSE 'ok' END"
    )


def instant(wall: str) -> str:
    """UTC wall clock of a local wall clock, null unless it means one instant."""
    return (
        f"CASE WHEN {kind(wall)} = 'ok' THEN timezone('UTC', timezone('{TZ}', {wall})) END"
    )


def wall(date: str, hour: str) -> str:
    return f"({date} + {hour} * INTERVAL 1 HOUR)"


def counts_cte(name: str, shift: int = 0) -> str:
    return f"""
{name} AS (
  SELECT *, 'S' || location_id AS sensor_name,
         144.9::DOUBLE + location_id / 1000.0::DOUBLE AS lon,
         -37.8::DOUBLE - pedestriancount / 1000.0::DOUBLE AS lat,
         {instant(wall("sensing_date", "hourday"))} AS observed_at
  FROM (SELECT user_id AS location_id, (CAST(ts AS DATE) + {shift})::DATE AS sensing_date,
               CAST(extract(hour FROM ts) AS INTEGER) AS hourday, min(event_id) AS id,
               count(*) FILTER (event_type IN ('click', 'view')) AS direction_1,
               count(*) FILTER (event_type NOT IN ('click', 'view')) AS direction_2,
               count(*) AS pedestriancount
        FROM events GROUP BY ALL))"""


def limited_cte() -> str:
    first = ", ".join(
        f"CASE WHEN {n} IS NULL THEN (SELECT min(sensing_date) FROM features WHERE {n} IS NOT NULL) END"
        for n in NUMERIC_FEATURES if n not in FLAG_COLUMNS
    )
    return f"\nlimited AS (SELECT *, least({first}) AS limit_day FROM features)"


def mart_cte() -> str:
    """Area-hour rows: flags hold if any location's does, the hour's and day's columns are the same for all locations."""
    shared = [*WEATHER_MEASURES, "holiday_name", "school_term", "event_count", "event_names"]
    columns = {
        "precinct": "clue_small_area", "sensing_date": "sensing_date", "hourday": "hourday", "observed_at": "min(observed_at)",
        "pedestriancount": "sum(pedestriancount)::BIGINT", "sensor_count": "count(DISTINCT location_id)",
        **{name: f"max({name})" for name in shared}, **{name: f"bool_or({name})" for name in FLAG_COLUMNS},
    }
    chosen = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"\nmart AS (SELECT {chosen} FROM block_map JOIN location_hour USING (location_id) GROUP BY ALL)"


CTES = {
    "counts": counts_cte("counts"),
    "counts_apr": counts_cte("counts_apr", 90),
    "counts_oct": counts_cte("counts_oct", 270),
    "shifted": """
shifted AS (SELECT * FROM counts_apr UNION ALL SELECT * FROM counts_oct)""",
    "days": """
days AS (SELECT DISTINCT sensing_date FROM counts)""",
    "sensors": """
sensors AS (
  SELECT vec_id AS location_id, 'site ' || label AS sensor_description,
         'V' || vec_id AS sensor_name,
         TRY_CAST('2020-' || lpad(CAST(label * 2 AS VARCHAR), 2, '0') || '-01' AS DATE)
           AS installation_date,
         CAST(NULL AS VARCHAR) AS note, 'Outdoor' AS location_type, 'A' AS status,
         'North' AS direction_1_label, 'South' AS direction_2_label,
         CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude
  FROM embeddings)""",
    "weather_wall": """
weather_wall AS (
  SELECT date_trunc('hour', ts) AS wall, avg(value) AS temperature_2m, min(value) AS precipitation,
         max(value) AS rain, max(value) - min(value) AS wind_speed_10m, count(*) AS cloud_cover
  FROM events WHERE event_type = 'error' GROUP BY ALL)""",
    "weather": """
weather AS (
  SELECT CAST(wall AS DATE) AS sensing_date, CAST(extract(hour FROM wall) AS INTEGER) AS hourday, *
  FROM weather_wall)""",
    "shifted_orders": """
shifted_orders AS (
  SELECT *, (CAST(o_orderdate AS DATE) + 9131)::DATE AS day FROM orders)""",
    "holidays": """
holidays AS (
  SELECT day AS holiday_date, o_orderpriority AS holiday_name
  FROM shifted_orders WHERE o_totalprice > 490000)""",
    "terms": """
terms AS (
  SELECT CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS term,
         o_orderstatus AS jurisdiction, min(day) AS start_date,
         max((day + CASE WHEN o_orderstatus = 'P' THEN 20 ELSE 0 END)::DATE) AS end_date,
         'derived' AS source_note
  FROM shifted_orders GROUP BY ALL)""",
    "major": """
major AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
         o_orderpriority || ' ' || o_orderstatus AS event_name, 'order book' AS venue,
         day AS start_date,
         (day + CAST(length(o_orderpriority) - 5 AS INTEGER))::DATE AS end_date,
         CAST(NULL AS VARCHAR) AS notes, CAST(year(day) AS INTEGER) AS year
  FROM shifted_orders WHERE o_totalprice > 450000)""",
    "blocks": """
blocks AS (
  SELECT CAST(CAST(floor(lat * 20) AS BIGINT) AS VARCHAR) || ':' ||
           CAST(CAST(floor(lon * 20) AS BIGINT) AS VARCHAR) AS block_id,
         CAST(CAST(floor(lat * 5) AS BIGINT) AS VARCHAR) || ':' ||
           CAST(CAST(floor(lon * 5) AS BIGINT) AS VARCHAR) AS clue_small_area,
         avg(lat) AS latitude, avg(lon) AS longitude, count(*) AS address_count
  FROM (SELECT CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon
        FROM embeddings)
  GROUP BY ALL)""",
    "block_map": """
block_map AS (
  SELECT location_id, block_id, clue_small_area, block_latitude, block_longitude, distance_sq
  FROM (SELECT *, row_number() OVER (PARTITION BY location_id
                   ORDER BY distance_sq, block_id, clue_small_area) AS match_rank
        FROM (SELECT s.location_id, b.block_id, b.clue_small_area,
                     b.latitude AS block_latitude, b.longitude AS block_longitude,
                     (s.latitude - b.latitude) * (s.latitude - b.latitude)
                     + (s.longitude - b.longitude) * (s.longitude - b.longitude) AS distance_sq
              FROM sensors AS s CROSS JOIN blocks AS b
              WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL))
  WHERE match_rank = 1)""",
    "holiday_days": """
holiday_days AS (
  SELECT holiday_date AS sensing_date, string_agg(holiday_name, ', ' ORDER BY holiday_name)
           AS holiday_name
  FROM holidays GROUP BY holiday_date)""",
    "term_days": """
term_days AS (
  SELECT sensing_date, count(DISTINCT term) AS school_term_count,
         CASE WHEN count(DISTINCT term) = 1 THEN min(term) END AS school_term
  FROM days JOIN terms ON sensing_date BETWEEN start_date AND end_date GROUP BY sensing_date)""",
    "event_days": """
event_days AS (
  SELECT sensing_date, count(DISTINCT event_id) AS event_count,
         string_agg(DISTINCT event_name, ', ' ORDER BY event_name) AS event_names
  FROM days JOIN major ON sensing_date BETWEEN start_date AND end_date GROUP BY sensing_date)""",
    "location_hour": """
location_hour AS (
  SELECT c.location_id, c.sensing_date, c.hourday, c.observed_at, c.pedestriancount,
         c.direction_1 AS direction_1_count, c.direction_2 AS direction_2_count,
         c.sensor_name AS count_sensor_name, s.sensor_description,
         s.sensor_name AS location_sensor_name, s.direction_1_label, s.direction_2_label,
         s.latitude, s.longitude, s.location_type, s.status AS sensor_status,
         s.installation_date, w.temperature_2m, w.precipitation, w.rain, w.wind_speed_10m,
         w.cloud_cover, h.holiday_name, h.holiday_name IS NOT NULL AS is_public_holiday,
         t.school_term, coalesce(t.school_term_count, 0) > 0 AS is_school_term,
         coalesce(e.event_count, 0) AS event_count, e.event_names,
         e.event_names IS NOT NULL AS is_event_day
  FROM counts AS c
  LEFT JOIN sensors AS s ON c.location_id = s.location_id
  LEFT JOIN weather AS w ON c.sensing_date = w.sensing_date AND c.hourday = w.hourday
  LEFT JOIN holiday_days AS h ON c.sensing_date = h.sensing_date
  LEFT JOIN term_days AS t ON c.sensing_date = t.sensing_date
  LEFT JOIN event_days AS e ON c.sensing_date = e.sensing_date)""",
    "mart": mart_cte(),
    "features": """
features AS (
  SELECT a.*, CAST(isodow(a.sensing_date) - 1 AS INTEGER) AS day_of_week,
         CAST(b.pedestriancount AS DOUBLE) AS lag_24h
  FROM mart AS a LEFT JOIN mart AS b
    ON a.precinct = b.precinct AND a.observed_at = b.observed_at + INTERVAL 24 HOURS)""",
    # The last fold date that a row can take part in: the first day of a feature that the row does not have.
    "limited": limited_cte(),
    "fold_rows": """
fold_rows AS (
  SELECT d.test_date, f.sensing_date = d.test_date AS tested,
         f.limit_day IS NULL OR f.limit_day >= d.test_date AS complete, f.precinct, f.lag_24h, f.pedestriancount
  FROM limited AS f JOIN (SELECT DISTINCT sensing_date AS test_date FROM features
                          WHERE sensing_date > (SELECT min(sensing_date) FROM features)) AS d
    ON f.sensing_date <= d.test_date)""",
    "ordered": """
ordered AS (
  SELECT *, CAST(pedestriancount AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY precinct ORDER BY sensing_date, hourday) AS position
  FROM features)""",
    "diffs": """
diffs AS (
  SELECT a.*, abs(a.y - b.y) AS seasonal_diff
  FROM ordered AS a LEFT JOIN ordered AS b
    ON a.precinct = b.precinct AND a.position = b.position + 24)""",
    # One row per (series, date) and all its earlier rows: the direct definition of a fold.
    "folds": """
folds AS (
  SELECT f.precinct, f.sensing_date, count(p.position) AS train_rows,
         CASE WHEN count(p.position) > 24
                THEN avg(p.seasonal_diff) FILTER (p.position > 24)
              WHEN count(p.position) >= 2
                THEN abs(arg_max(p.y, p.position) - arg_min(p.y, p.position)) END AS raw_scale
  FROM (SELECT DISTINCT precinct, sensing_date FROM features) AS f
  LEFT JOIN diffs AS p ON p.precinct = f.precinct AND p.sensing_date < f.sensing_date
  GROUP BY f.precinct, f.sensing_date)""",
    "scaled": """
scaled AS (
  SELECT precinct, sensing_date, train_rows, CASE WHEN raw_scale > 0 THEN raw_scale END AS scale
  FROM folds)""",
    "last_scale": """
last_scale AS (
  SELECT precinct, count(*) AS train_rows,
         CASE WHEN count(*) > 24 THEN avg(seasonal_diff) FILTER (position > 24)
              WHEN count(*) >= 2 THEN abs(arg_max(y, position) - arg_min(y, position)) END AS scale
  FROM diffs WHERE sensing_date < (SELECT max(sensing_date) FROM features)
  GROUP BY precinct)""",
    "split_scale": """
split_scale AS (
  SELECT precinct, count(*) AS train_rows,
         CASE WHEN count(*) > 24 THEN avg(seasonal_diff) FILTER (position > 24)
              WHEN count(*) >= 2 THEN abs(arg_max(y, position) - arg_min(y, position)) END AS scale
  FROM diffs WHERE sensing_date < DATE '2024-01-21' GROUP BY precinct)""",
    "pooled_parts": """
pooled_parts AS (
  SELECT f.precinct, sum(abs(f.pedestriancount - f.lag_24h)) AS numerator,
         any_value(s.scale) * count(*) AS denominator
  FROM features AS f JOIN last_scale AS s ON f.precinct = s.precinct AND s.scale > 0
  WHERE f.lag_24h IS NOT NULL AND f.sensing_date > (SELECT min(sensing_date) FROM features)
  GROUP BY f.precinct)""",
    "split_parts": """
split_parts AS (
  SELECT f.precinct, sum(abs(f.pedestriancount - f.lag_24h)) AS numerator,
         any_value(s.scale) * count(*) AS denominator
  FROM features AS f JOIN split_scale AS s ON f.precinct = s.precinct AND s.scale > 0
  WHERE f.lag_24h IS NOT NULL AND f.sensing_date >= DATE '2024-01-21'
  GROUP BY f.precinct)""",
    "hour_grid": """
hour_grid AS (SELECT CAST(range AS INTEGER) AS hourday FROM range(24))""",
    "span": """
span AS (
  SELECT CAST(unnest(generate_series(min(sensing_date), max(sensing_date), INTERVAL 1 DAY)) AS DATE)
           AS sensing_date
  FROM counts)""",
    "locations": """
locations AS (
  SELECT location_id, min(sensing_date) AS low, max(sensing_date) AS high
  FROM counts GROUP BY location_id)""",
    "global_gaps": f"""
global_gaps AS (
  SELECT l.location_id, d.sensing_date, h.hourday
  FROM locations AS l CROSS JOIN span AS d CROSS JOIN hour_grid AS h
  WHERE {kind(wall("d.sensing_date", "h.hourday"))} <> 'nonexistent'
    AND NOT EXISTS (SELECT 1 FROM counts AS c WHERE c.location_id = l.location_id
                    AND c.sensing_date = d.sensing_date AND c.hourday = h.hourday))""",
    "own_gaps": f"""
own_gaps AS (
  SELECT l.location_id, d.sensing_date, h.hourday
  FROM locations AS l JOIN span AS d ON d.sensing_date BETWEEN l.low AND l.high
  CROSS JOIN hour_grid AS h
  WHERE {kind(wall("d.sensing_date", "h.hourday"))} <> 'nonexistent'
    AND NOT EXISTS (SELECT 1 FROM counts AS c WHERE c.location_id = l.location_id
                    AND c.sensing_date = d.sensing_date AND c.hourday = h.hourday))""",
    "year_hours": f"""
year_hours AS (
  SELECT year, count(*) AS expected_hours
  FROM (SELECT DISTINCT CAST(year(sensing_date) AS INTEGER) AS year FROM counts) AS y
  CROSS JOIN LATERAL (SELECT CAST(unnest(generate_series(make_date(y.year, 1, 1),
      make_date(y.year, 12, 31), INTERVAL 1 DAY)) AS DATE) AS day) AS d
  CROSS JOIN hour_grid AS h
  WHERE {kind(wall("d.day", "h.hourday"))} <> 'nonexistent'
  GROUP BY year)""",
    "churn": """
churn AS (
  SELECT c.year, c.location_id, c.present_hours, y.expected_hours,
         c.present_hours = y.expected_hours AS full_year
  FROM (SELECT CAST(year(sensing_date) AS INTEGER) AS year, location_id,
               count(DISTINCT (sensing_date, hourday)) AS present_hours
        FROM counts GROUP BY ALL) AS c JOIN year_hours AS y ON c.year = y.year)""",
    "coordinates": """
coordinates AS (
  SELECT DISTINCT location_id, round_even(lon, 6) AS lon, round_even(lat, 6) AS lat
  FROM (SELECT location_id, lon, lat FROM counts
        UNION ALL SELECT location_id, longitude, latitude FROM sensors))""",
    "moved": """
moved AS (
  SELECT location_id, count(*) AS n_coordinates FROM coordinates
  GROUP BY location_id HAVING count(*) > 1)""",
    "hourly_rows": """
hourly_rows AS (
  SELECT user_id AS location_id, CAST(ts AS DATE) AS sensing_date,
         CAST(extract(hour FROM ts) AS INTEGER) AS hourday FROM events)""",
    "repeated": """
repeated AS (
  SELECT location_id, sensing_date, hourday, count(*) AS n FROM hourly_rows
  GROUP BY ALL HAVING count(*) > 1)""",
    "means": """
means AS (
  SELECT precinct, avg(pedestriancount) AS series_mean FROM mart GROUP BY precinct)""",
}

NEEDS = {
    "shifted": ["counts_apr", "counts_oct"],
    "days": ["counts"],
    "weather": ["weather_wall"],
    "holidays": ["shifted_orders"],
    "terms": ["shifted_orders"],
    "major": ["shifted_orders"],
    "block_map": ["sensors", "blocks"],
    "holiday_days": ["holidays"],
    "term_days": ["days", "terms"],
    "event_days": ["days", "major"],
    "location_hour": ["counts", "sensors", "weather", "holiday_days", "term_days", "event_days"],
    "mart": ["location_hour", "block_map"],
    "features": ["mart"],
    "limited": ["features"],
    "fold_rows": ["limited"],
    "ordered": ["features"],
    "diffs": ["ordered"],
    "folds": ["features", "diffs"],
    "scaled": ["folds"],
    "last_scale": ["features", "diffs"],
    "split_scale": ["diffs"],
    "pooled_parts": ["features", "last_scale"],
    "split_parts": ["features", "split_scale"],
    "span": ["counts"],
    "locations": ["counts"],
    "global_gaps": ["counts", "locations", "span", "hour_grid"],
    "own_gaps": ["counts", "locations", "span", "hour_grid"],
    "year_hours": ["counts", "hour_grid"],
    "churn": ["counts", "year_hours"],
    "coordinates": ["counts", "sensors"],
    "moved": ["coordinates"],
    "repeated": ["hourly_rows"],
    "means": ["mart"],
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` under the named common tables and whatever they build on."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for parent in NEEDS.get(name, ()):
            add(parent)
        if name not in chosen:
            chosen.append(name)

    for name in names:
        add(name)
    return "WITH" + ",".join(CTES[name] for name in chosen) + "\n" + body.strip()


STAMP = "TIMESTAMP '2024-02-01 00:00:00' AS ingested_at_utc"
WEATHER_ROUNDED = ", ".join(
    f"round({{p}}{name}, 6) AS {name}"
    for name in ("temperature_2m", "precipitation", "rain", "wind_speed_10m")
)


def weather_columns(prefix: str = "") -> str:
    return WEATHER_ROUNDED.format(p=prefix) + f", {prefix}cloud_cover AS cloud_cover"


MART_REPLACE = (
    "round(temperature_2m, 6) AS temperature_2m, round(precipitation, 6) AS precipitation, "
    "round(rain, 6) AS rain, round(wind_speed_10m, 6) AS wind_speed_10m"
)

ORACLE: dict[str, str] = {
    "scan_union_by_name": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "date_window_scan": """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem
WHERE l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1997-09-01'""",
    "existing_max_date": with_ctes("""
SELECT max(sensing_date) AS max_date, 'counts' AS source FROM counts
UNION ALL SELECT max(installation_date), 'sensors' FROM sensors""", "counts", "sensors"),
    "incremental_window": """
SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS n FROM lineitem
WHERE CAST(l_shipdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
  AND CAST(l_shipdate AS DATE) <= DATE '2001-12-31' GROUP BY ALL""",
    "interval_overlap": with_ctes("""
SELECT event_id, start_date, end_date FROM major
WHERE end_date >= DATE '2024-01-10' AND start_date <= DATE '2024-01-20'""", "major"),
    "census_year_select": """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS census_year FROM orders
WHERE year(o_orderdate) IN (1998, 1999)""",
    "calendar_csv": """
SELECT CAST(o_orderkey AS VARCHAR) AS event_id, 'order, ' || o_orderstatus AS event_name,
       o_orderpriority AS venue, CAST(o_orderdate AS DATE) AS start_date,
       CAST(o_orderdate AS DATE) AS end_date
FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "flatten_columnar_json": with_ctes(f"""
SELECT strftime(wall, '%Y-%m-%dT%H:%M') AS time, {weather_columns()} FROM weather_wall""",
        "weather_wall"),
    "json_counts": with_ctes("""
SELECT id, location_id, sensing_date, hourday, direction_1, direction_2, pedestriancount, sensor_name,
       round(lon, 6) AS lon, round(lat, 6) AS lat FROM counts""", "counts"),
    "json_sensors": with_ctes("""
SELECT location_id, sensor_description, sensor_name, '2020-' || lpad(CAST(label * 2 AS VARCHAR), 2, '0') || '-01'
         AS installation_date, note, location_type, status, direction_1_label AS direction_1,
       direction_2_label AS direction_2, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM sensors JOIN embeddings ON vec_id = location_id""", "sensors"),
    "json_addresses": """
SELECT '2024' AS census_year,
       CAST(CAST(floor(lat * 20) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(floor(lon * 20) AS BIGINT) AS VARCHAR) AS block_id,
       CAST(CAST(floor(lat * 5) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(floor(lon * 5) AS BIGINT) AS VARCHAR)
         AS clue_small_area, round(lat, 6) AS latitude, round(lon, 6) AS longitude
FROM (SELECT CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon FROM embeddings)""",
    "json_documents": """
SELECT doc_id, lang, n_chars, md5('{"\\' || text || '}"') AS text_md5 FROM documents""",
    "day_range_replace": with_ctes("""
SELECT sensing_date, count(*) AS n_rows,
       CAST(sum(CASE WHEN sensing_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'
                     THEN pedestriancount * 10 ELSE pedestriancount END) AS BIGINT)
         AS pedestriancount
FROM counts WHERE sensing_date <> DATE '2024-01-12' GROUP BY sensing_date""", "counts"),
    "key_replace": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows,
       round(sum(CASE WHEN year(o_orderdate) = 1996 THEN 1.0::DOUBLE ELSE o_totalprice END), 2)
         AS total
FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY 1""",
    "localize_wall_clock": with_ctes("""
SELECT location_id, sensing_date, hourday, observed_at FROM shifted""", "shifted"),
    "dst_kind": with_ctes(f"""
SELECT sensing_date, hourday, {kind(wall("sensing_date", "hourday"))} AS kind, count(*) AS n_rows
FROM shifted GROUP BY sensing_date, hourday""", "shifted"),
    "expected_hours": with_ctes(f"""
SELECT sensing_date, hourday FROM (SELECT DISTINCT sensing_date FROM shifted) CROSS JOIN hour_grid
WHERE {kind(wall("sensing_date", "hourday"))} <> 'nonexistent'""", "shifted", "hour_grid"),
    "day_of_week": """
SELECT CAST(ts AS DATE) AS sensing_date, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       count(*) AS pedestriancount FROM events GROUP BY ALL""",
    "stg_counts": with_ctes(f"""
SELECT id, location_id, sensing_date, hourday, direction_1 AS direction_1_count,
       direction_2 AS direction_2_count, pedestriancount, sensor_name,
       round(lon, 6) AS longitude, round(lat, 6) AS latitude, observed_at, {STAMP}
FROM counts""", "counts"),
    "stg_sensors": with_ctes(f"""
SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude), {STAMP}
FROM sensors""", "sensors"),
    "stg_weather": with_ctes(f"""
SELECT {instant("wall")} AS observed_at, sensing_date, hourday, {weather_columns()}, {STAMP}
FROM weather""", "weather"),
    "stg_holidays": with_ctes(f"SELECT *, {STAMP} FROM holidays", "holidays"),
    "stg_terms": with_ctes(f"SELECT *, {STAMP} FROM terms", "terms"),
    "stg_events": with_ctes(f"SELECT *, {STAMP} FROM major", "major"),
    "complete_rows": with_ctes("""
SELECT precinct, sensing_date, hourday, lag_24h, round(temperature_2m, 6) AS temperature_2m
FROM features WHERE lag_24h IS NOT NULL AND temperature_2m IS NOT NULL""", "features"),
    "join_left_sensor": with_ctes("""
SELECT c.location_id, c.sensing_date, c.hourday, c.pedestriancount, s.sensor_description,
       s.sensor_name AS location_sensor_name, s.direction_1_label, s.direction_2_label,
       round(s.latitude, 6) AS latitude, round(s.longitude, 6) AS longitude, s.location_type,
       s.status AS sensor_status, s.installation_date
FROM counts AS c LEFT JOIN sensors AS s ON c.location_id = s.location_id""", "counts", "sensors"),
    "join_left_composite": with_ctes(f"""
SELECT c.location_id, c.sensing_date, c.hourday, {weather_columns("w.")}
FROM counts AS c LEFT JOIN weather AS w
  ON c.sensing_date = w.sensing_date AND c.hourday = w.hourday""", "counts", "weather"),
    "range_join_terms": with_ctes("""
SELECT sensing_date, year, term, jurisdiction
FROM days JOIN terms ON sensing_date BETWEEN start_date AND end_date""", "days", "terms"),
    "range_join_events": with_ctes("""
SELECT sensing_date, event_id, event_name
FROM days JOIN major ON sensing_date BETWEEN start_date AND end_date""", "days", "major"),
    "location_hour": with_ctes(f"""
SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, {MART_REPLACE})
FROM location_hour""", "location_hour"),
    "lag_24h": with_ctes("""
SELECT a.location_id, a.sensing_date, a.hourday, a.observed_at, a.pedestriancount,
       CAST(b.pedestriancount AS DOUBLE) AS lag_24h
FROM counts AS a LEFT JOIN counts AS b
  ON a.location_id = b.location_id AND a.observed_at = b.observed_at + INTERVAL 24 HOURS""",
        "counts"),
    "join_predictions": with_ctes("""
SELECT precinct, sensing_date, hourday, pedestriancount, lag_24h AS baseline_pred, lag_24h
FROM features""", "features"),
    "calendar_difference": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders
WHERE o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) NOT IN
  (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 400000)""",
    "string_agg_ordered": """
SELECT CAST(o_orderdate AS DATE) AS day,
       string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY 1""",
    "holidays_by_day": with_ctes("SELECT * FROM holiday_days", "holiday_days"),
    "terms_by_day": with_ctes("SELECT * FROM term_days", "term_days"),
    "events_by_day": with_ctes("SELECT * FROM event_days", "event_days"),
    "block_centroids": with_ctes("""
SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude)
FROM blocks""", "blocks"),
    "feature_summary": with_ctes("""
SELECT count(*) AS rows, count(DISTINCT precinct) AS precincts, min(sensing_date) AS min_date,
       max(sensing_date) AS max_date FROM features""", "features"),
    "train_summary": with_ctes("""
SELECT count(*) AS rows, count(lag_24h) AS rows_with_baseline,
       CASE WHEN count(*) FILTER (limit_day IS NULL) >= 10 THEN count(*) FILTER (limit_day IS NULL) ELSE 0 END
         AS rows_with_lgbm, CAST(24 AS INTEGER) AS seasonality_hours
FROM limited""", "limited"),
    "gbt_train_predict": with_ctes("""
SELECT precinct, sensing_date, hourday, lag_24h AS baseline_pred, known AS lgbm_known, known AS lgbm_finite
FROM (SELECT *, limit_day IS NULL AND count(*) FILTER (limit_day IS NULL) OVER () >= 10 AS known FROM limited)""", "limited"),
    "rolling_origin_learner": with_ctes("""
SELECT r.test_date, count(*) FILTER (NOT tested) AS train_rows, count(*) FILTER (tested) AS test_rows,
       CASE WHEN count(*) FILTER (NOT tested AND complete) >= 10 THEN count(*) FILTER (tested AND complete) ELSE 0 END
         AS predicted_rows,
       round((SELECT sum(e) / sum(d) FROM (
          SELECT sum(abs(f.pedestriancount - f.lag_24h)) AS e, any_value(s.scale) * count(*) AS d
          FROM features AS f JOIN scaled AS s ON f.precinct = s.precinct AND f.sensing_date = s.sensing_date
          WHERE f.sensing_date = r.test_date AND f.lag_24h IS NOT NULL AND s.scale IS NOT NULL
          GROUP BY f.precinct)), 6) AS mase_baseline,
       count(*) FILTER (NOT tested AND complete) >= 10
         AND count(*) FILTER (tested AND complete AND s.scale IS NOT NULL) > 0 AS learner_scored
FROM fold_rows AS r LEFT JOIN scaled AS s ON r.tested AND s.precinct = r.precinct AND s.sensing_date = r.test_date
GROUP BY r.test_date""", "fold_rows", "scaled"),
    "export_with_learner": with_ctes("""
SELECT f.precinct, f.sensing_date, f.hourday, f.pedestriancount, f.lag_24h AS baseline_pred,
       f.pedestriancount - f.lag_24h AS baseline_error, known AS lgbm_pred_known, known AS lgbm_error_known,
       TRUE AS mase_lgbm_known,
       EXISTS (SELECT 1 FROM fold_rows AS r JOIN last_scale AS l ON r.precinct = l.precinct AND l.scale > 0
               WHERE r.precinct = f.precinct AND r.tested AND r.complete
                 AND (SELECT count(*) FROM fold_rows AS t WHERE t.test_date = r.test_date AND NOT t.tested AND t.complete) >= 10)
         AS mase_lgbm_precinct_known
FROM (SELECT *, limit_day IS NULL AND count(*) FILTER (limit_day IS NULL) OVER () >= 10 AS known FROM limited) AS f""",
        "limited", "fold_rows", "last_scale"),
    "usable_features": with_ctes("\nUNION ALL ".join(
        f"SELECT '{name}' AS feature, count({name}) AS filled FROM features"
        for name in (
            "hourday", "day_of_week", "temperature_2m", "precipitation", "rain",
            "wind_speed_10m", "cloud_cover", "sensor_count", "lag_24h", "is_public_holiday",
            "is_school_term", "is_event_day",
        )), "features"),
    "profile_counts": with_ctes("""
SELECT count(*) AS n_rows, count(DISTINCT location_id) AS distinct_series,
       count(*) FILTER (pedestriancount = 0) AS zero_rows,
       count(*) FILTER (pedestriancount IS NULL) AS null_rows,
       (SELECT count(*) FROM (SELECT 1 FROM counts GROUP BY location_id, sensing_date, hourday
                              HAVING count(*) > 1)) AS duplicate_groups
FROM counts""", "counts"),
    "profile_columns": "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind_}' AS column_type, count({name}) AS filled_rows, "
        f"count(*) - count({name}) AS null_rows, CAST(min({name}) AS VARCHAR) AS low, "
        f"CAST(max({name}) AS VARCHAR) AS high FROM orders"
        for name, kind_ in (
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
        )),
    "top_groups": """
SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL
ORDER BY n DESC, l_suppkey, l_returnflag LIMIT 20""",
    "watched_rows": with_ctes("""
SELECT location_id, count(*) AS n FROM counts WHERE location_id IN (67, 68, 69)
GROUP BY location_id""", "counts"),
    "column_extremes": """
SELECT min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate,
       min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice,
       min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey FROM lineitem""",
    "series_rank": with_ctes("""
SELECT precinct, round(series_mean, 6) AS mean_value,
       CAST(dense_rank() OVER (ORDER BY series_mean DESC) AS BIGINT) AS precinct_rank
FROM means""", "means"),
    "location_rank": with_ctes("""
SELECT location_id, round(m, 6) AS mean_value,
       CAST(dense_rank() OVER (ORDER BY m DESC) AS BIGINT) AS precinct_rank
FROM (SELECT location_id, avg(pedestriancount) AS m FROM counts GROUP BY location_id)""",
        "counts"),
    "hourly_index": with_ctes("""
SELECT a.precinct, a.hourday, round(a.m / nullif(b.series_mean, 0), 6) AS precinct_hourly_index,
       b.precinct_rank
FROM (SELECT precinct, hourday, avg(pedestriancount) AS m FROM mart GROUP BY ALL) AS a
JOIN (SELECT *, CAST(dense_rank() OVER (ORDER BY series_mean DESC) AS BIGINT) AS precinct_rank
      FROM means) AS b ON a.precinct = b.precinct""", "means"),
    "seasonal_diff": with_ctes("""
SELECT precinct, sensing_date, hourday, position, seasonal_diff FROM diffs""", "diffs"),
    "fold_scale": with_ctes("""
SELECT precinct, sensing_date, train_rows, round(scale, 6) AS scale FROM scaled""", "scaled"),
    "rolling_origins": """
SELECT DISTINCT CAST(ts AS DATE) AS sensing_date FROM events
WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM events)""",
    "check_churn": with_ctes("SELECT * FROM churn", "churn"),
    "check_zero_outage": with_ctes("""
SELECT count(*) FILTER (pedestriancount = 0) AS genuine_zeros,
       count(*) FILTER (pedestriancount IS NULL) AS null_counts,
       (SELECT count(*) FROM global_gaps) AS gaps FROM counts""", "global_gaps"),
    "check_gaps_global": with_ctes("SELECT * FROM global_gaps", "global_gaps"),
    "check_gaps_own_range": with_ctes("SELECT * FROM own_gaps", "own_gaps"),
    "check_duplicates": with_ctes("""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS affected_rows, count(*) AS duplicate_groups,
       count(*) FILTER (location_id IN (67, 68, 69)) AS watched_groups FROM repeated""",
        "repeated"),
    "check_continuity": with_ctes(f"""
SELECT (SELECT count(*) FROM (
          SELECT location_id, CAST(unnest(generate_series(min(sensing_date), max(sensing_date),
                 INTERVAL 1 DAY)) AS DATE) AS day FROM shifted GROUP BY location_id) AS g
        CROSS JOIN hour_grid AS h
        WHERE {kind(wall("g.day", "h.hourday"))} <> 'nonexistent'
          AND NOT EXISTS (SELECT 1 FROM shifted AS c WHERE c.location_id = g.location_id
                          AND c.sensing_date = g.day AND c.hourday = h.hourday)) AS gaps,
       (SELECT count(*) FROM shifted WHERE observed_at IS NULL) AS observed_at_nat""",
        "shifted", "hour_grid"),
    "check_relocation": with_ctes("SELECT * FROM moved", "moved"),
    "check_all": with_ctes("""
SELECT 'sensor_churn' AS name, TRUE AS passed, count(*) FILTER (NOT full_year) AS count_affected
FROM churn
UNION ALL SELECT 'zero_versus_outage', TRUE, (SELECT count(*) FROM global_gaps)
UNION ALL SELECT 'duplicate_records', TRUE, CAST(0 AS BIGINT)
UNION ALL SELECT 'timestamp_continuity', (SELECT count(*) FROM own_gaps) = 0,
                 (SELECT count(*) FROM own_gaps)
UNION ALL SELECT 'sensor_relocation', (SELECT count(*) FROM moved) = 0,
                 (SELECT count(*) FROM moved)""", "churn", "global_gaps", "own_gaps", "moved"),
    "check_unique": with_ctes("""
SELECT holiday_date, count(*) AS n_rows FROM holidays GROUP BY holiday_date
HAVING count(*) > 1""", "holidays"),
    "check_relationships": """
SELECT o_custkey AS custkey, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY o_custkey""",
    "check_hour_range": with_ctes("""
SELECT location_id, sensing_date, hourday + 3 AS hourday FROM counts WHERE hourday + 3 > 23""",
        "counts"),
    "row_count_preserved": with_ctes("""
SELECT a.n AS staged_rows, b.n AS joined_rows
FROM (SELECT count(*) AS n FROM counts) AS a, (SELECT count(*) AS n FROM location_hour) AS b
WHERE a.n <> b.n""", "location_hour"),
    "check_grain_unique": """
SELECT user_id, CAST(ts AS DATE) AS day, CAST(extract(hour FROM ts) AS INTEGER) AS hour,
       count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) > 1""",
    "check_totals_preserved": with_ctes("""
SELECT (SELECT CAST(sum(pedestriancount) AS BIGINT) FROM location_hour AS l
        JOIN block_map AS m ON l.location_id = m.location_id) AS location_total,
       (SELECT CAST(sum(pedestriancount) AS BIGINT) FROM mart) AS precinct_total""", "mart"),
    "check_freshness": with_ctes("""
SELECT newest, round(age, 6) AS age_hours,
       CASE WHEN newest IS NULL OR age > 72 THEN 'error' WHEN age > 36 THEN 'warn' ELSE 'pass' END
         AS status
FROM (SELECT newest, date_diff('second', newest, TIMESTAMP '2024-02-01 12:00:00') / 3600.0::DOUBLE
               AS age
      FROM (SELECT max(observed_at) AS newest FROM counts))""", "counts"),
    "feature_matrix": with_ctes(f"""
SELECT * REPLACE ({MART_REPLACE}) FROM features""", "features"),
    "baseline_error": with_ctes("""
SELECT precinct, count(lag_24h) AS pairs, round(avg(abs(pedestriancount - lag_24h)), 6)
         AS mean_abs_error
FROM features GROUP BY precinct""", "features"),
    "mase_scale": with_ctes("""
SELECT * FROM (
  SELECT precinct, count(*) AS train_rows,
         round(CASE WHEN count(*) > 24 THEN avg(seasonal_diff) FILTER (position > 24)
                    WHEN count(*) >= 2 THEN abs(arg_max(y, position) - arg_min(y, position)) END, 6)
           AS scale
  FROM diffs GROUP BY precinct) WHERE scale > 0""", "diffs"),
    "panel_mase": with_ctes("""
SELECT round(sum(numerator) / sum(denominator), 6) AS mase FROM split_parts""", "split_parts"),
    "mase_by_series": with_ctes("""
SELECT precinct, round(numerator / denominator, 6) AS mase FROM split_parts""", "split_parts"),
    "rolling_origin_baseline": with_ctes("""
SELECT r.sensing_date AS test_date,
       (SELECT count(*) FROM features AS f WHERE f.sensing_date < r.sensing_date) AS train_rows,
       (SELECT count(*) FROM features AS f WHERE f.sensing_date = r.sensing_date) AS test_rows,
       round((SELECT sum(e) / sum(d) FROM (
          SELECT sum(abs(f.pedestriancount - f.lag_24h)) AS e, any_value(s.scale) * count(*) AS d
          FROM features AS f JOIN scaled AS s
            ON f.precinct = s.precinct AND f.sensing_date = s.sensing_date
          WHERE f.sensing_date = r.sensing_date AND f.lag_24h IS NOT NULL
            AND s.scale IS NOT NULL
          GROUP BY f.precinct)), 6) AS mase_baseline
FROM (SELECT DISTINCT sensing_date FROM features) AS r
WHERE r.sensing_date > (SELECT min(sensing_date) FROM features)""", "features", "scaled"),
    "pooled_mase": with_ctes("""
SELECT round(sum(numerator) / sum(denominator), 6) AS mase_baseline FROM pooled_parts""",
        "pooled_parts"),
    "pooled_mase_by_series": with_ctes("""
SELECT precinct, round(numerator / denominator, 6) AS mase_baseline FROM pooled_parts""",
        "pooled_parts"),
    "export_wide": with_ctes("""
SELECT f.* EXCLUDE (day_of_week) REPLACE (
         round(temperature_2m, 6) AS temperature_2m, round(precipitation, 6) AS precipitation,
         round(rain, 6) AS rain, round(wind_speed_10m, 6) AS wind_speed_10m),
       lag_24h AS baseline_pred, CAST(NULL AS DOUBLE) AS lgbm_pred,
       (SELECT round(sum(numerator) / sum(denominator), 6) FROM pooled_parts) AS mase_baseline,
       CAST(NULL AS DOUBLE) AS mase_lgbm,
       round(p.numerator / p.denominator, 6) AS mase_baseline_precinct,
       CAST(NULL AS DOUBLE) AS mase_lgbm_precinct,
       pedestriancount - lag_24h AS baseline_error, CAST(NULL AS DOUBLE) AS lgbm_error,
       round(h.m / nullif(b.series_mean, 0), 6) AS precinct_hourly_index, b.precinct_rank
FROM features AS f
LEFT JOIN pooled_parts AS p ON f.precinct = p.precinct
JOIN (SELECT precinct, hourday, avg(pedestriancount) AS m FROM mart GROUP BY ALL) AS h
  ON f.precinct = h.precinct AND f.hourday = h.hourday
JOIN (SELECT *, CAST(dense_rank() OVER (ORDER BY series_mean DESC) AS BIGINT) AS precinct_rank
      FROM means) AS b ON f.precinct = b.precinct""", "pooled_parts", "means"),
}
for _name in ("nearest_block", "nearest_block_window"):
    ORACLE[_name] = with_ctes("""
SELECT * REPLACE (round(block_latitude, 6) AS block_latitude,
                  round(block_longitude, 6) AS block_longitude,
                  round(distance_sq, 6) AS distance_sq) FROM block_map""", "block_map")
for _name in ("precinct_hour", "precinct_hour_wide_join"):
    ORACLE[_name] = with_ctes(f"SELECT * REPLACE ({MART_REPLACE}) FROM mart", "mart")

_TABLE_SQL = {
    "stg_pedestrian_counts": "counts",
    "stg_sensor_locations": "sensors",
    "stg_weather_hourly": "weather",
    "stg_public_holidays": "holidays",
    "stg_school_terms": "terms",
    "stg_major_events": "major",
    "stg_clue_block_centroids": "blocks",
    "int_location_hour": "location_hour",
    "int_sensor_block_map": "block_map",
    "mart_precinct_hour": "mart",
}


def _not_null() -> str:
    from hourpanel.operators.constraints import NOT_NULL

    parts = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"count(*) FILTER ({column} IS NULL) AS null_rows FROM {_TABLE_SQL[table]}"
        for table, columns in NOT_NULL.items()
        for column in columns
    ]
    return with_ctes("\nUNION ALL ".join(parts), *_TABLE_SQL.values())


ORACLE["check_not_null"] = _not_null()
ORACLE["value_types"] = """
SELECT CASE WHEN word IN ('true', 'false') THEN 'bool'
            WHEN regexp_full_match(word, '[+-]?[0-9]{1,18}') THEN 'int'
            WHEN regexp_full_match(word, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
              THEN 'float'
            ELSE 'str' END AS value_type, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1"""
