"""Telemetry-shaped views over the provided tables.

The same SQL text runs in Spark (through DataFrame parameters) and in the checking
engine (as common table expressions), so both sides start from the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspan.operators.scaling import materialise

AS_OF = dt.date(2024, 1, 30)
AS_OF_SQL = "DATE '2024-01-30'"

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
KD = "CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)"

VIEWS: dict[str, str] = {
    "trace_src": f"""
SELECT CAST(event_id AS STRING) AS trace_id,
       CAST(user_id AS INT) AS thing_id,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS trace_date,
       CAST(ts AS DATE) AS trace_date_day,
       CAST(ts AS DATE) AS date_insertion_day,
       CAST(floor(value) AS INT) AS speed,
       CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS engine_status,
       CAST(36.5 AS DOUBLE) + CAST(user_id % 10 AS DOUBLE) * CAST(0.01 AS DOUBLE)
         + {KD} * CAST(0.0002 AS DOUBLE) AS latitude,
       CAST(3.0 AS DOUBLE) + CAST(user_id % 7 AS DOUBLE) * CAST(0.01 AS DOUBLE)
         + {KD} * CAST(0.0001 AS DOUBLE) AS longitude,
       CASE WHEN {K} = 7 THEN NULL
            ELSE CAST(event_id AS DOUBLE) / CAST(10 AS DOUBLE) END AS journey,
       CASE WHEN {K} % 10 = 0 THEN NULL
            ELSE {KD} / CAST(20 AS DOUBLE) END AS oil_value,
       CAST(57 AS DOUBLE) - CAST(event_id % 570 AS DOUBLE) / CAST(10 AS DOUBLE) AS fuel_liters,
       CAST(91 AS DOUBLE) - CAST(event_id % 910 AS DOUBLE) / CAST(10 AS DOUBLE) AS fuel_percent,
       CAST(12 AS DOUBLE) + CAST(event_id % 20 AS DOUBLE) / CAST(10 AS DOUBLE) AS battery,
       event_id, event_type, props
FROM {{events}}""",
    "trace_week": """
SELECT * FROM {trace_src}
UNION ALL
SELECT * FROM {trace_src} WHERE event_id % 50 = 0""",
    "thing": """
SELECT CAST(c_custkey AS INT) AS thing_id, c_name AS thing_designation,
       concat('P', CAST(c_custkey AS STRING)) AS thing_matricule,
       concat('SN', CAST(c_custkey AS STRING)) AS thing_serial_number,
       CAST(c_nationkey % 5 AS INT) AS entreprise_id,
       CAST(c_nationkey AS INT) AS thing_group_id,
       CAST(c_custkey % 5 AS INT) AS thing_type_id,
       c_mktsegment AS thing_marque_id
FROM {customer}""",
    "thing_type": """
SELECT CAST(r_regionkey AS INT) AS thing_type_id, r_name AS thing_type_designation FROM {region}""",
    "thing_group": """
SELECT CAST(n_nationkey AS INT) AS thing_group_id, n_name AS thing_group_designation
FROM {nation}""",
    "alert_src": f"""
SELECT CAST(event_id AS INT) AS alert_id, CAST(user_id AS INT) AS thing_id,
       1 + {K} % 3 AS alert_degre_id,
       1 + {K} % 4 AS event_id,
       {K} AS point_id,
       CAST(ts AS DATE) AS alert_day,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS alert_time,
       CAST(36.5 AS DOUBLE) + CAST(user_id % 10 AS DOUBLE) * CAST(0.01 AS DOUBLE)
         + {KD} * CAST(0.0002 AS DOUBLE) AS latitude,
       CAST(3.0 AS DOUBLE) + CAST(user_id % 7 AS DOUBLE) * CAST(0.01 AS DOUBLE)
         + {KD} * CAST(0.0001 AS DOUBLE) AS longitude
FROM {{events}} WHERE event_type = 'error'""",
    "alert": "SELECT alert_id, alert_degre_id, alert_day FROM {alert_src}",
    "alert_thing": "SELECT alert_id, thing_id FROM {alert_src}",
    "alert_event": "SELECT alert_id, event_id FROM {alert_src}",
    "alert_point": "SELECT alert_id, point_id FROM {alert_src}",
    "point": """
SELECT DISTINCT point_id, point_id % 25 AS wilaya_id, point_id % 5 AS commune_id
FROM {alert_src}""",
    "alert_degre": """
SELECT DISTINCT alert_degre_id,
       CASE alert_degre_id WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END
         AS alert_degre_name
FROM {alert_src}""",
    "event": """
SELECT DISTINCT event_id,
       CASE event_id WHEN 1 THEN 'speeding' WHEN 2 THEN 'geofence' WHEN 3 THEN 'fuel'
            ELSE 'engine' END AS event_designation
FROM {alert_src}""",
    "wilaya": """
SELECT CAST(n_nationkey AS INT) AS wilaya_id, n_name AS wilaya_designation FROM {nation}""",
    "commune": """
SELECT CAST(r_regionkey AS INT) AS commune_id, r_name AS commune_designation FROM {region}""",
    "users": "SELECT CAST(c_custkey AS INT) AS id, c_name AS name FROM {customer}",
    # A box per nation, four columns of small ones and one of widths that double; across them a
    # wide band per region, which overlap each other.
    "gazetteer": """
SELECT south, south + CAST(0.012 AS DOUBLE) + CAST(r AS DOUBLE) * CAST(0.002 AS DOUBLE) AS north,
       west, west + CASE WHEN n < 20 THEN CAST(1 + n % 4 AS DOUBLE) * CAST(0.003 AS DOUBLE)
                         ELSE power(CAST(2 AS DOUBLE), CAST(r AS DOUBLE)) * CAST(0.02 AS DOUBLE) END AS east,
       concat('T', CAST(n AS STRING)) AS town, state, 'land' AS country
FROM (SELECT n_nationkey AS n, n_nationkey % 5 AS r, n_name AS state,
             CAST(36.5 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) * CAST(0.022 AS DOUBLE) AS south,
             CAST(3.0 AS DOUBLE) + CAST(n_nationkey - n_nationkey % 5 AS DOUBLE) * CAST(0.0028 AS DOUBLE) AS west
      FROM {nation}) AS nations
UNION ALL
SELECT south, south + CAST(0.04 AS DOUBLE) + CAST(r AS DOUBLE) * CAST(0.01 AS DOUBLE) AS north,
       CAST(2.5 AS DOUBLE) AS west, CAST(3.3 AS DOUBLE) AS east,
       concat('B', CAST(r AS STRING)) AS town, state, 'band' AS country
FROM (SELECT r_regionkey AS r, r_name AS state,
             CAST(36.51 AS DOUBLE) + CAST(r_regionkey AS DOUBLE) * CAST(0.015 AS DOUBLE) AS south
      FROM {region}) AS regions""",
    "maintenance": """
SELECT CAST(c_custkey AS INT) AS id, CAST(c_custkey AS INT) AS thing_id,
       concat('car', CAST(c_custkey AS STRING)) AS name,
       CASE CAST(c_nationkey AS INT) % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'Soon'
            WHEN 2 THEN 'Urgent' END AS maintenance,
       CAST('2024-01-15 00:00:00' AS TIMESTAMP) AS maintenance_date
FROM {customer}""",
    "rul_src": """
SELECT thing_id, trace_date AS date_insertion, speed, journey AS total_km,
       CASE WHEN event_type = 'error' THEN 'Abnormal' WHEN event_type = 'view' THEN NULL
            ELSE 'Normal' END AS engine_status,
       battery AS power_supply_voltage,
       concat('{{''oil_value'': ', coalesce(CAST(oil_value AS STRING), 'None'),
              ', ''fuel_liters'': ', CAST(fuel_liters AS STRING), '}}') AS details,
       trace_id
FROM {trace_src}""",
}

RAW = {
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
}


class Inputs:
    """The views as DataFrames for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or not (name in RAW or name in VIEWS):
            raise AttributeError(name)
        if name not in self._frames:
            if name in RAW:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = VIEWS[name]
                used = {v: getattr(self, v) for v in [*RAW, *VIEWS] if "{" + v + "}" in text}
                frame = self.spark.sql(text, **used)
            self._frames[name] = frame
        return self._frames[name]

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame that several parts of a query use, written to the checkpoint folder."""
        if name not in self._frames:
            self._frames[name] = materialise(build())
        return self._frames[name]

    @cached_property
    def history(self) -> DataFrame:
        """Trace rows before the as-of day."""
        return self.trace_week.filter(F.col("trace_date_day") < F.lit(AS_OF))

    @cached_property
    def today(self) -> DataFrame:
        """Position events of the as-of day, as the stream delivers them."""
        return self.trace_src.filter(F.col("trace_date_day") == F.lit(AS_OF))

    @cached_property
    def today_alerts(self) -> DataFrame:
        return self.alert_src.filter(F.col("alert_day") == F.lit(AS_OF))
