"""Checking SQL: the same results stated for DuckDB over the raw tables."""

from __future__ import annotations

import re

from roadspan.functions.scalars import EARTH_RADIUS_KM, WAREHOUSE_RADIUS_KM
from roadspan.plans.fixtures import AS_OF_SQL, RAW, VIEWS

ORDERED = "ORDER BY trace_date NULLS FIRST, engine_status NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST"


def r6(expr: str, name: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) AS {name}"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str, radius: float) -> str:
    half = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return (
        f"(CAST({2 * radius!r} AS DOUBLE) * atan2(sqrt({half}), "
        f"sqrt(greatest(CAST(0 AS DOUBLE), 1 - {half}))))"
    )


def date_attributes(date: str, quarter_as_text: bool) -> str:
    quarter = f"CAST(quarter({date}) AS INT)"
    if quarter_as_text:
        quarter = f"concat(CAST(year({date}) AS VARCHAR), '-Q', CAST(quarter({date}) AS VARCHAR))"
    return f"""CAST({date} AS DATE) AS full_date, CAST(year({date}) AS INT) AS year,
  CAST(month({date}) AS INT) AS month, CAST(day({date}) AS INT) AS day,
  strftime({date}, '%Y-%m') AS month_year, monthname({date}) AS month_name,
  {quarter} AS quarter,
  CASE WHEN dayofweek({date}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  CASE WHEN month({date}) IN (12, 1, 2) THEN 'Winter' WHEN month({date}) IN (3, 4, 5) THEN 'Spring'
       WHEN month({date}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season"""


def label(date: str) -> str:
    return f"concat(rpad(strftime({date}, '%A'), 9, ' '), CAST({date} AS VARCHAR))"


def previous_rows(source: str) -> str:
    w = f"(PARTITION BY thing_id {ORDERED}, speed NULLS FIRST)"
    return f"""
SELECT DISTINCT thing_id, date_id, trace_date, engine_status, latitude, longitude, speed,
  lag(latitude) OVER {w} AS prev_latitude, lag(longitude) OVER {w} AS prev_longitude,
  lag(trace_date) OVER {w} AS prev_trace_date
FROM {source} t JOIN date_dim d ON t.trace_date_day = d.full_date"""


def vehicle_day(steps: str) -> str:
    gap = "date_diff('second', prev_trace_date, trace_date)"
    return f"""
SELECT thing_id, date_id,
  SUM(CASE WHEN engine_status = 0 THEN {gap} ELSE 0 END) / CAST(3600 AS DOUBLE) AS idle_time,
  SUM(CASE WHEN engine_status = 1 THEN {gap} ELSE 0 END) / CAST(3600 AS DOUBLE) AS active_time,
  SUM({haversine('prev_latitude', 'prev_longitude', 'latitude', 'longitude', WAREHOUSE_RADIUS_KM)})
    AS traveled_distance,
  AVG(CAST(speed AS DOUBLE)) AS avg_speed, CAST(MAX(speed) AS DOUBLE) AS max_speed
FROM {steps} WHERE prev_latitude IS NOT NULL AND prev_longitude IS NOT NULL
GROUP BY thing_id, date_id"""


CTES: dict[str, str] = {
    name: text.format(**{v: v for v in [*RAW, *VIEWS]}) for name, text in VIEWS.items()
}
CTES |= {
    "history": f"SELECT * FROM trace_week WHERE trace_date_day < {AS_OF_SQL}",
    "trace_today": f"SELECT * FROM trace_src WHERE trace_date_day = {AS_OF_SQL}",
    "alerts_today": f"SELECT * FROM alert_src WHERE alert_day = {AS_OF_SQL}",
    "date_dim": f"""
SELECT CAST(row_number() OVER (ORDER BY d) AS INT) AS date_id, {date_attributes('d', True)}
FROM (SELECT DISTINCT date_insertion_day AS d FROM trace_week)""",
    "thing_dim": """
SELECT t.thing_id, thing_type_designation, thing_designation, thing_matricule AS thing_plate,
  thing_serial_number AS thing_serial, CAST(entreprise_id AS BIGINT) AS company_id,
  CAST(NULL AS VARCHAR) AS company_name, CAST(t.thing_group_id AS BIGINT) AS group_id,
  t.thing_type_id AS type_id, thing_marque_id AS thing_mark, thing_group_designation AS group_name
FROM thing t JOIN thing_type y ON t.thing_type_id = y.thing_type_id
JOIN thing_group g ON t.thing_group_id = g.thing_group_id""",
    "steps": previous_rows("trace_week"),
    "vehicle_daily": vehicle_day("steps"),
    "vehicle_fuel": """
SELECT *, CASE WHEN traveled_distance > 100 THEN 9 + draw * 3 ELSE 3 + draw * 4 END AS fuel FROM (
  SELECT *, CAST((thing_id * 31 + date_id * 17) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS draw
  FROM vehicle_daily)""",
    "vehicle_fuel_history": """
SELECT *, CASE WHEN traveled_distance > 100 THEN 9 + draw * 3 ELSE 3 + draw * 4 END AS fuel FROM (
  SELECT *, CAST((thing_id * 31 + date_id * 17) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS draw
  FROM vehicle_daily_history)""",
    "vehicle_daily_clean": vehicle_day("steps_clean"),
    "vehicle_daily_after": vehicle_day("steps_after"),
    "alert_counted": """
SELECT t.thing_id, a.alert_degre_id, e.event_id, p.point_id, a.alert_day
FROM alert a JOIN alert_thing t ON a.alert_id = t.alert_id
JOIN alert_event e ON a.alert_id = e.alert_id JOIN alert_point p ON a.alert_id = p.alert_id
JOIN point q ON p.point_id = q.point_id JOIN alert_degre g ON a.alert_degre_id = g.alert_degre_id""",
    "alert_fact_dated": """
SELECT point_id AS location_id, date_id, alert_degre_id AS type_id, thing_id AS user_id, event_id,
  COUNT(*) AS alert_count, thing_id
FROM alert_counted c JOIN date_dim d ON c.alert_day = d.full_date
GROUP BY thing_id, alert_degre_id, event_id, point_id, date_id""",
    "steps_clean": previous_rows("(SELECT * FROM trace_week WHERE speed <= 300)"),
    "steps_after": previous_rows(
        "(SELECT * FROM trace_week WHERE trace_date_day > DATE '2024-01-15')"
    ),
    "steps_history": previous_rows("history"),
    "vehicle_daily_history": vehicle_day("steps_history"),
}

# --- live state ---------------------------------------------------------------------------


def states(source: str, keys: str) -> str:
    w = f"(PARTITION BY {keys} ORDER BY trace_date, trace_id)"
    gap = f"date_diff('second', lag(trace_date) OVER {w}, trace_date)"
    step = haversine(
        f"lag(latitude) OVER {w}", f"lag(longitude) OVER {w}", "latitude", "longitude", EARTH_RADIUS_KM
    )
    w_run = w[:-1] + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
SELECT *, list_reduce(list(CAST(speed AS DOUBLE)) OVER {w_run}, lambda a, x: (a + x) / 2) AS avg_speed,
  max(speed) OVER {w_run} AS max_speed,
  CAST(sum(idle) OVER {w_run} AS BIGINT) AS idle_time,
  CAST(sum(active) OVER {w_run} AS BIGINT) AS active_time,
  first_value(fuel_liters) OVER {w} + CAST(0.019 AS DOUBLE) * (row_number() OVER {w} - 1) AS fuel,
  sum(step) OVER {w_run} AS traveled_distance
FROM (SELECT *, CASE WHEN engine_status = 0 THEN coalesce({gap}, 0) ELSE 0 END AS idle,
  CASE WHEN engine_status = 1 THEN coalesce({gap}, 0) ELSE 0 END AS active,
  coalesce({step}, 0) AS step FROM {source})"""


def newest(source: str, keys: str, order: str = "trace_date DESC, trace_id DESC") -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS newest_rank
FROM {source}) WHERE newest_rank = 1"""


CTES |= {
    "states": states("trace_src", "thing_id"),
    "day_states": states("trace_today", "thing_id, trace_date_day"),
    "live_state": newest("states", "thing_id"),
    "live_day_state": newest("day_states", "thing_id, trace_date_day"),
    "live_rows": """
SELECT thing_id, trace_date_day AS full_date, idle_time / CAST(3600 AS DOUBLE) AS idle_time,
  active_time / CAST(3600 AS DOUBLE) AS active_time, traveled_distance, avg_speed,
  CAST(max_speed AS DOUBLE) AS max_speed, fuel FROM live_day_state""",
    "rolling_stats": """
SELECT thing_id, trace_date, trace_id, """
    + ", ".join(
        f"{f}({c}) OVER w AS {n}_{suffix}"
        for n, c in (("oil", "oil_value"), ("fuel", "fuel_liters"))
        for f, suffix in (
            ("avg", "rolling_mean"),
            ("stddev_samp", "rolling_stddev"),
            ("sum", "cumsum"),
            ("min", "min"),
            ("max", "max"),
        )
    )
    + """, trace_date_day
FROM trace_src
WINDOW w AS (PARTITION BY thing_id ORDER BY trace_date, trace_id ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)""",
    "stored_stats": newest(
        f"(SELECT * FROM rolling_stats WHERE trace_date_day < {AS_OF_SQL})", "thing_id"
    ),
    "latest_stats": newest("rolling_stats", "thing_id"),
    "latest_speed": newest("trace_src", "thing_id"),
    "stored_speed": newest(f"(SELECT * FROM trace_src WHERE trace_date_day < {AS_OF_SQL})", "thing_id"),
    "placed_alerts": """
SELECT a.*, coalesce(g.town, 'default') AS town, coalesce(g.state, 'default') AS state,
  coalesce(g.country, 'default') AS country
FROM alert_src a LEFT JOIN gazetteer g ON a.latitude >= g.south AND a.latitude < g.north
  AND a.longitude >= g.west AND a.longitude < g.east
QUALIFY row_number() OVER (PARTITION BY a.alert_id
  ORDER BY (g.north - g.south) * (g.east - g.west), g.south, g.north, g.west, g.east, g.town) = 1""",
    "counted_alerts": """
SELECT *, alert_degre_id AS type_id, thing_id AS user_id, row_number() OVER (
  PARTITION BY alert_degre_id, event_id, thing_id ORDER BY alert_time, alert_id) AS alert_number
FROM placed_alerts""",
    "live_alerts": newest(
        f"(SELECT *, alert_degre_id AS type_id, thing_id AS user_id, row_number() OVER (PARTITION BY "
        f"alert_degre_id, event_id, thing_id ORDER BY alert_time, alert_id) AS alert_number "
        f"FROM placed_alerts WHERE alert_day = {AS_OF_SQL})",
        "type_id, event_id, user_id",
        "alert_time DESC, alert_id DESC",
    ),
}

# --- journeys -------------------------------------------------------------------------------

JW = f"(PARTITION BY thing_id {ORDERED}, journey NULLS FIRST, speed NULLS FIRST)"


def greedy(points: str, keep: str) -> str:
    """Fold over a list of points; ``keep`` uses {d} for the distance to the last kept one."""
    distance = haversine("acc[-1].lat", "acc[-1].lon", "q[1].lat", "q[1].lon", EARTH_RADIUS_KM)
    return (
        f"list_reduce(list_transform({points}[2:], lambda q: [q]), lambda acc, q: "
        f"CASE WHEN {keep.format(d=distance)} THEN acc || q ELSE acc END, {points}[1:1])"
    )


def place_name(lat: str, lon: str) -> str:
    box = f"g.south <= {lat} AND {lat} < g.north AND g.west <= {lon} AND {lon} < g.east"
    return (
        f"coalesce((SELECT first(concat(g.town, ', ', g.state, ', ', g.country) "
        f"ORDER BY (g.north - g.south) * (g.east - g.west), g.south, g.north, g.west, g.east, g.town) "
        f"FROM gazetteer g WHERE {box}), 'default, default, default')"
    )


CTES |= {
    "jsource": """
SELECT DISTINCT thing_id, date_id, trace_date, engine_status, latitude, longitude, journey, speed
FROM trace_week t JOIN date_dim d ON t.trace_date_day = d.full_date""",
    "jrows": f"""
SELECT *, coalesce(prev_engine_status = 0 AND engine_status = 1, false) AS rise,
  coalesce(prev_engine_status = 1 AND engine_status = 0, false) AS fall
FROM (SELECT *, lag(engine_status) OVER {JW} AS prev_engine_status, row_number() OVER {JW} AS pos
      FROM jsource)""",
    "jedges": """
SELECT *, lead(fall) OVER w AS closed, lead(trace_date) OVER w AS end_time,
  lead(journey) OVER w AS end_journey, lead(pos) OVER w AS end_pos, lead(date_id) OVER w AS end_date_id,
  lead(latitude) OVER w AS end_latitude, lead(longitude) OVER w AS end_longitude
FROM jrows WHERE rise OR fall WINDOW w AS (PARTITION BY thing_id ORDER BY pos)""",
    "jstarts": """
SELECT *, row_number() OVER (ORDER BY thing_id, pos) AS journey_id,
  row_number() OVER (PARTITION BY thing_id ORDER BY pos) AS segment
FROM jedges WHERE rise""",
    "jclosed": "SELECT * FROM jstarts WHERE closed AND journey IS NOT NULL",
    "jpoints": """
SELECT j.journey_id, r.pos - j.pos AS seq, r.latitude, r.longitude
FROM jclosed j JOIN jrows r ON j.thing_id = r.thing_id AND r.pos BETWEEN j.pos AND j.end_pos""",
    "jpaths": """
SELECT journey_id, CAST(seq // 512 AS BIGINT) AS part, CAST(count(*) AS INT) AS n_points,
  string_agg(printf('%.6f,%.6f', latitude, longitude), ';' ORDER BY seq) AS path
FROM jpoints GROUP BY ALL""",
    "jspeeds": """
SELECT j.journey_id, avg(CAST(t.speed AS DOUBLE)) AS avg_speed, CAST(max(t.speed) AS DOUBLE) AS max_speed
FROM jclosed j JOIN trace_week t ON j.thing_id = t.thing_id
  AND t.trace_date >= j.trace_date AND t.trace_date <= j.end_time GROUP BY j.journey_id""",
    "jdim": f"""
SELECT j.journey_id, {place_name("j.latitude", "j.longitude")} AS start_point,
  {place_name("j.end_latitude", "j.end_longitude")} AS end_point,
  j.trace_date AS start_time, j.end_time, p.part, p.path,
  sum(p.n_points) OVER (PARTITION BY j.journey_id) AS n_points
FROM jclosed j JOIN jpaths p ON j.journey_id = p.journey_id""",
    "jfact": """
SELECT j.journey_id, j.thing_id, j.end_journey - j.journey AS traveled_distance,
  CAST(0 AS DOUBLE) AS idle_time,
  date_diff('second', j.trace_date, j.end_time) / CAST(60 AS DOUBLE) AS active_time,
  s.avg_speed, s.max_speed, j.end_date_id AS date_id
FROM jclosed j JOIN jspeeds s ON j.journey_id = s.journey_id""",
    "thing_points": """
SELECT thing_id, list({'seq': seq, 'lat': latitude, 'lon': longitude} ORDER BY seq) AS p
FROM (SELECT *, row_number() OVER (PARTITION BY thing_id ORDER BY trace_date, trace_id) - 1 AS seq
      FROM trace_week) GROUP BY thing_id""",
    "thing_dense": f"SELECT thing_id, {greedy('p', '{d} >= 0.01')} AS p FROM thing_points",
    "thing_clean": f"SELECT thing_id, {greedy('p', '{d} <= 1.0')} AS p FROM thing_dense",
    "journey_texts": """
SELECT journey_id, list({'seq': seq, 'lat': CAST(printf('%.6f', latitude) AS DOUBLE),
  'lon': CAST(printf('%.6f', longitude) AS DOUBLE)} ORDER BY seq) AS p FROM jpoints GROUP BY journey_id""",
    "journey_dense": f"SELECT journey_id, {greedy('p', '{d} >= 0.01')} AS p FROM journey_texts",
    "journey_cleaned": f"SELECT journey_id, {greedy('p', '{d} <= 1.0')} AS p FROM journey_dense",
}

# --- features -------------------------------------------------------------------------------

DETAILS = "replace(details, '''', '\"')"


def json_number(name: str) -> str:
    return (
        f"TRY_CAST(json_extract_string(CASE WHEN json_valid({DETAILS}) THEN {DETAILS} END, "
        f"'$.{name}') AS DOUBLE) AS {name}"
    )


def draw(salt: int) -> str:
    key = "CAST(thing_id AS BIGINT) * 7919 + CAST(epoch(date_insertion) AS BIGINT) * 104729"
    return f"(CAST(({key} + {salt * 15485863}) % 1000003 AS DOUBLE) / CAST(1000003 AS DOUBLE))"


def banded(salt: int, ranges: list[tuple[float, float]], digits: int) -> str:
    def value(low: float, high: float) -> str:
        return f"ROUND(CAST({low} AS DOUBLE) + {draw(salt)} * CAST({high - low!r} AS DOUBLE), {digits})"

    cases = " ".join(
        f"WHEN row_num <= total_rows * CAST({share} AS DOUBLE) THEN {value(*r)}"
        for share, r in zip((0.6, 0.8, 0.9), ranges, strict=False)
    )
    return f"CASE {cases} ELSE {value(*ranges[-1])} END"


CTES |= {
    "extracted": f"""
SELECT * EXCLUDE (details), {json_number('oil_value')}, {json_number('fuel_liters')} FROM rul_src""",
    "one_maximum": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY total_km
  ORDER BY thing_id, date_insertion, trace_id) AS rn, max(total_km) OVER () AS top FROM extracted)
WHERE total_km < top OR (total_km = top AND rn = 1)""",
}
for _name, _source in (("imputed", "extracted"), ("imputed_once", "one_maximum")):
    CTES[_name] = f"""
SELECT thing_id, date_insertion, trace_id, speed, total_km, engine_status, power_supply_voltage,
  coalesce(oil_value, {banded(1, [(4.0, 6.0), (3.0, 6.0), (2.0, 5.0), (1.5, 3.0)], 1)}) AS oil_value,
  {banded(2, [(0.014, 0.017), (0.014, 0.018), (0.015, 0.018), (0.017, 0.022)], 3)} AS fuel_change,
  coalesce(fuel_liters, ROUND({draw(3)} * 60, 1)) AS fuel_liters
FROM (SELECT *, row_number() OVER (PARTITION BY thing_id ORDER BY date_insertion, trace_id) AS row_num,
  count(*) OVER (PARTITION BY thing_id) AS total_rows FROM {_source})"""
CTES["training"] = f"""
SELECT *, CASE WHEN {draw(4)} < 0.7 THEN 'old' ELSE 'new' END AS car_age,
  power_supply_voltage - lag(power_supply_voltage) OVER (PARTITION BY thing_id
    ORDER BY date_insertion, trace_id) AS battery_current_change,
  avg(power_supply_voltage) OVER (PARTITION BY thing_id, date_insertion) AS daily_avg_voltage
FROM imputed_once"""


def with_ctes(sql: str) -> str:
    """Prefix the query with the common table expressions it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", text)):
            if word in CTES and word not in needed and re.search(
                rf"(?i)\b(from|join)\s*\(?\s*{word}\b|,\s*{word}\s+[a-z]\b", text
            ):
                visit(CTES[word])
                needed.append(word)

    visit(sql)
    if not needed:
        return sql
    views = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    own = sql.lstrip()
    if own.upper().startswith("WITH "):
        return views + ",\n" + own[5:]
    return views + "\n" + sql
