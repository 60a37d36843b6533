"""Scalar expressions shared by the warehouse, the journeys and the live state.

Everything here is a built-in column expression, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.045
WAREHOUSE_RADIUS_KM = KM_PER_DEGREE * 180.0 / math.pi


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance; NULL when any coordinate is NULL, 0 for equal points."""
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    half = F.pow(F.sin(dlat / 2.0), F.lit(2.0)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2.0), F.lit(2.0))
    )
    # Not least(1, half): that would turn a NULL into the distance to the antipode.
    bounded = F.when(half > 1.0, F.lit(1.0)).otherwise(half)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(bounded))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def season(date: Column) -> Column:
    month = F.month(date)
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def day_type(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(1, 7), "Weekend").otherwise("Weekday")


def day_label(date: Column) -> Column:
    """Day name padded to nine characters, then the ISO date."""
    return F.concat(F.rpad(F.date_format(date, "EEEE"), 9, " "), date.cast("string"))


def with_date_attributes(df: DataFrame, date: Column, quarter_as_text: bool) -> DataFrame:
    """Add the calendar attributes of ``date``.

    The warehouse dimension holds the quarter as ``2024-Q1``, the live tables hold
    the bare number; ``quarter_as_text`` chooses.
    """
    quarter = F.quarter(date)
    if quarter_as_text:
        quarter = F.concat(F.year(date).cast("string"), F.lit("-Q"), quarter.cast("string"))
    return df.withColumns(
        {
            "full_date": date,
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "month_year": F.date_format(date, "yyyy-MM"),
            "month_name": F.date_format(date, "MMMM"),
            "quarter": quarter,
            "day_type": day_type(date),
            "season": season(date),
        }
    )


def json_field(details: Column, key: str) -> Column:
    """One key of single-quoted JSON text; NULL for anything that does not parse."""
    return F.get_json_object(F.translate(details, "'", '"'), f"$.{key}")


def key_draw(number: Column, when: Column, salt: int) -> Column:
    """Repeatable number in [0, 1) by arithmetic on a row's key: a number and a time."""
    mixed = (
        number.cast("long") * 7919 + F.unix_seconds(when) * 104729 + F.lit(salt * 15485863).cast("long")
    )
    return F.pmod(mixed, F.lit(1_000_003)) / F.lit(1_000_003.0)
