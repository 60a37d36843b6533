"""The denormalised order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_wide_table(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    supplier: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """One row per order line with all attributes of its order, customer, part and
    supplier, and the nation and region of the customer.

    The customer side (customer, nation, region) and the order are joined first, so
    the order line is shuffled once for it, on the order key. No hints: Spark
    broadcasts the small sides by their size and shuffles the large ones.
    """
    customers = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )
    bought = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    wide = (
        lineitem.join(bought, lineitem["l_orderkey"] == bought["o_orderkey"])
        .join(part, lineitem["l_partkey"] == part["p_partkey"])
        .join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"])
    )
    # Keys that repeat a key of the order line or of the customer.
    repeated = ["o_orderkey", "c_custkey", "p_partkey", "s_suppkey", "n_nationkey", "r_regionkey"]
    return wide.drop(*repeated)


def with_iso_dates(wide: DataFrame) -> DataFrame:
    """Date columns as DATE, whatever the source held."""
    dates = [c for c in wide.columns if c.endswith("date")]
    return wide.withColumns({c: F.to_date(F.col(c)) for c in dates})
