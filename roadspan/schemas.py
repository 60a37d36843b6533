"""Declared schemas: warehouse tables, live tables and stream messages.

The column lists are fixed values, in the order in which the tables a user already has declare
them. Where a table here holds more (further keys, fuel, coordinates, the blend of a state), these
columns come last; serial keys that a database fills by itself are left out, and measures whose
declared names are misspelt are spelt right. Live numbers that were declared as whole ones are
doubles and live times timestamps, so that nothing is cut off. Long paths have several rows in
``journey_dim``, so its key is (journey_id, part).
"""

from __future__ import annotations

from pyspark.sql import types as T


WAREHOUSE = {
    "date_dim": (
        "date_id INT, full_date DATE, year INT, month INT, day INT, month_year STRING, "
        "month_name STRING, quarter STRING, day_type STRING, season STRING"
    ),
    "location_dim": "location_id INT, municipality STRING, province STRING",
    "thing_dim": (
        "thing_id INT, thing_type_designation STRING, thing_designation STRING, thing_plate STRING, "
        "thing_serial STRING, company_id BIGINT, company_name STRING, group_id BIGINT, type_id INT, "
        "thing_mark STRING, group_name STRING"
    ),
    "vehicle_performance": (
        "idle_time DOUBLE, active_time DOUBLE, traveled_distance DOUBLE, avg_speed DOUBLE, "
        "max_speed DOUBLE, date_id INT, thing_id INT, fuel DOUBLE"
    ),
    "journey_dim": (
        "journey_id BIGINT, start_point STRING, end_point STRING, start_time TIMESTAMP, "
        "end_time TIMESTAMP, path STRING, part BIGINT"
    ),
    "journey": (
        "journey_id BIGINT, thing_id INT, traveled_distance DOUBLE, idle_time DOUBLE, "
        "active_time DOUBLE, avg_speed DOUBLE, max_speed DOUBLE, date_id INT"
    ),
    "alert_deg_dim": "alert_degree_id INT, alert_degree STRING",
    "event_dim": "event_id INT, event_designation STRING",
    "user_dim": "user_id INT, user_name STRING, company_id BIGINT, company_name STRING",
    "alert_fact": (
        "location_id INT, date_id INT, type_id INT, user_id INT, event_id INT, "
        "alert_count BIGINT, thing_id INT"
    ),
}

LIVE = {
    "trace": (
        "trace_id STRING, thing_id STRING, trace_date TIMESTAMP, long DOUBLE, lat DOUBLE, speed INT, "
        "engine_status STRING, oil_value DOUBLE, fuel_liters DOUBLE, fuel_percent DOUBLE, "
        "km_after_last_maintance DOUBLE, battery DOUBLE"
    ),
    "vehicle_performance": (
        "idle_time DOUBLE, active_time DOUBLE, traveled_distance DOUBLE, avg_speed DOUBLE, "
        "max_speed DOUBLE, full_date DATE, year INT, month INT, day INT, month_year STRING, "
        "month_name STRING, quarter INT, day_type STRING, season STRING, thing_id INT, type_id INT, "
        "group_id INT, latitude DOUBLE, longitude DOUBLE, trace_date TIMESTAMP, maintenance INT, "
        "rul FLOAT, fuel DOUBLE, thing_name STRING, km_after_last_maintenance DOUBLE"
    ),
    "alert": (
        "alert_id INT, type_id INT, event_id INT, user_id INT, province STRING, municipality STRING, "
        "alert_number BIGINT, full_date DATE, year INT, month INT, day INT, month_year STRING, "
        "month_name STRING, quarter INT, day_type STRING, season STRING"
    ),
}

# One shared message schema for positions; fuel_percent is a double.
POSITION_MESSAGE = (
    "trace_id STRING, thing_id INT, thing_name STRING, trace_date STRING, longitude DOUBLE, "
    "latitude DOUBLE, speed INT, engine_status INT, oil_value DOUBLE, fuel_liters DOUBLE, "
    "fuel_percent DOUBLE, battery DOUBLE"
)
ALERT_MESSAGE = (
    "type_id INT, user_id INT, event_date STRING, longitude DOUBLE, latitude DOUBLE, event_id INT"
)


def warehouse_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(WAREHOUSE[table])


def live_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(LIVE[table])
