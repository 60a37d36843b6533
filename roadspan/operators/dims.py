"""Dimension builders of the warehouse."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.functions.scalars import with_date_attributes
from roadspan.operators.loading import conform_to_schema, incremental_filter, surrogate_key
from roadspan.schemas import warehouse_schema

# Names of the source and of the warehouse.
THING_NAMES = {
    "thing_matricule": "thing_plate",
    "thing_serial_number": "thing_serial",
    "entreprise_id": "company_id",
    "thing_group_id": "group_id",
    "thing_type_id": "type_id",
    "thing_marque_id": "thing_mark",
    "thing_group_designation": "group_name",
}
DEGREE_NAMES = {"alert_degre_id": "alert_degree_id", "alert_degre_name": "alert_degree"}
USER_NAMES = {"id": "user_id", "name": "user_name"}

DATE_COLUMNS = [
    "date_id", "full_date", "year", "month", "day",
    "month_year", "month_name", "quarter", "day_type", "season",
]


def thing_dim(
    thing: DataFrame, thing_type: DataFrame, thing_group: DataFrame, after_id: int | None = None
) -> DataFrame:
    """Vehicles with their type and group names, under the warehouse's names; only ids above
    ``after_id`` when given. A company's name is NULL where the source has none."""
    if after_id is not None:
        thing = incremental_filter(thing, "thing_id", after_id)
    named = thing.join(thing_type, "thing_type_id").join(thing_group, "thing_group_id")
    return conform_to_schema(named, warehouse_schema("thing_dim"), THING_NAMES)


def date_dim(
    trace: DataFrame, day: str, after_day: Any = None, current_max_id: int = 0
) -> DataFrame:
    """One row per distinct day after ``after_day``, with dense ids in day order."""
    days = trace.select(F.col(day).alias("full_date"))
    if after_day is not None:
        days = incremental_filter(days, "full_date", after_day)
    days = days.filter(F.col("full_date").isNotNull()).distinct()
    # Distinct days are bounded by the calendar, so one window numbers them.
    numbered = surrogate_key(days, "date_id", ["full_date"], current_max_id, bounded=True)
    return (
        with_date_attributes(numbered, F.col("full_date"), quarter_as_text=True)
        .withColumn("date_id", F.col("date_id").cast("int"))
        .select(*DATE_COLUMNS)
    )


def alert_degree_dim(codes: DataFrame) -> DataFrame:
    return conform_to_schema(codes, warehouse_schema("alert_deg_dim"), DEGREE_NAMES)


def event_dim(codes: DataFrame) -> DataFrame:
    return codes.select("event_id", "event_designation")


def user_dim(users: DataFrame) -> DataFrame:
    """Users; the company columns are NULL where the source has none."""
    return conform_to_schema(users, warehouse_schema("user_dim"), USER_NAMES)


def location_dim(
    alert_point: DataFrame, point: DataFrame, province: DataFrame, municipality: DataFrame
) -> DataFrame:
    """Places that alerts refer to, keyed by the point itself, each once.

    The alert points are reduced to distinct ids first: a point with very many
    alerts is one row before anything is shuffled for the joins.
    """
    return (
        alert_point.select("point_id")
        .distinct()
        .join(point, "point_id")
        .join(province, "wilaya_id")
        .join(municipality, "commune_id")
        .select(
            F.col("point_id").alias("location_id"),
            F.col("wilaya_designation").alias("province"),
            F.col("commune_designation").alias("municipality"),
        )
        .distinct()
    )
