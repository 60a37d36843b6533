"""Feature engineering for the maintenance and speed models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspan.functions.scalars import json_field, key_draw
from roadspan.operators.timeline import AUTO, Cuts, Timeline, cuts_for, hot_cuts, join_null_safe

ORDER = ["date_insertion", "trace_id"]

# Upper end of each progress band and the draw ranges within it.
BANDS = [0.6, 0.8, 0.9]
OIL_RANGES = [(4.0, 6.0), (3.0, 6.0), (2.0, 5.0), (1.5, 3.0)]
FUEL_CHANGE_RANGES = [(0.014, 0.017), (0.014, 0.018), (0.015, 0.018), (0.017, 0.022)]
FUEL_LITERS_RANGE = (0.0, 60.0)
OLD_CAR_SHARE = 0.7
SPEEDING_ABOVE = 70

TRAINING_COLUMNS = [
    "thing_id", "date_insertion", "speed", "total_km", "engine_status", "power_supply_voltage",
    "oil_value", "fuel_change", "fuel_liters", "battery_current_change", "daily_avg_voltage",
]


def _timeline(df: DataFrame, cuts: Cuts) -> Timeline:
    return Timeline(df, ["thing_id"], ORDER, cuts_for(df, ["thing_id"], ORDER[0], cuts))


def json_field_extract(df: DataFrame, fields: tuple[str, ...] = ("oil_value", "fuel_liters")) -> DataFrame:
    """Numbers out of single-quoted JSON text; NULL when the text does not parse."""
    return df.withColumns({f: json_field(F.col("details"), f).try_cast("double") for f in fields})


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"day_of_week": F.dayofweek("date_insertion"), "hour_of_day": F.hour("date_insertion")}
    )


def group_mean_joinback(df: DataFrame, cuts: Cuts = AUTO) -> DataFrame:
    """Mean voltage per vehicle and time, back on every row.

    Without a large vehicle one window does it, on a partitioning that the other
    per-vehicle steps share. With one, many rows may have the same time, so the mean
    is aggregated (combining before the shuffle) and joined back.
    """
    keys = ["thing_id", "date_insertion"]
    mean = F.avg("power_supply_voltage")
    if cuts_for(df, ["thing_id"], ORDER[0], cuts) is None:
        return df.withColumn("daily_avg_voltage", mean.over(Window.partitionBy(*keys)))
    return join_null_safe(df, df.groupBy(*keys).agg(mean.alias("daily_avg_voltage")), keys)


def engine_alert_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("engine_alert", F.when(F.col("engine_status") == "Abnormal", 1).otherwise(0))


def row_progress(df: DataFrame, cuts: Cuts = AUTO) -> DataFrame:
    """Row number and number of rows per vehicle, and the band thresholds."""
    counted = (
        _timeline(df, cuts)
        .running({"row_num": ("count", F.lit(1))})
        .totals({"total_rows": ("count", F.lit(1))})
        .df
    )
    names = ["first_threshold", "second_threshold", "third_threshold"]
    return counted.withColumns(
        {name: F.col("total_rows") * F.lit(share) for name, share in zip(names, BANDS, strict=True)}
    )


def drop_repeated_max(df: DataFrame, column: str = "total_km") -> DataFrame:
    """Of the rows that hold the largest value keep one; rows without a value go.

    The largest value is read first and becomes a literal, so both branches filter
    at the scan; the kept row is a top-1, never a gathered group.
    """
    largest = df.agg(F.max(column)).first()[0]
    if largest is None:
        return df.limit(0)
    one = df.filter(F.col(column) == F.lit(largest)).orderBy("thing_id", *ORDER).limit(1)
    return df.filter(F.col(column) < F.lit(largest)).unionByName(one)


def _banded(draw: Column, ranges: list[tuple[float, float]], digits: int) -> Column:
    """A draw scaled to the range of the row's progress band."""

    def value(low_high: tuple[float, float]) -> Column:
        low, high = low_high
        return F.round(F.lit(low) + draw * (high - low), digits)

    chosen = [
        (F.col("row_num") <= F.col("total_rows") * F.lit(share), value(r))
        for share, r in zip(BANDS, ranges, strict=False)
    ]
    return reduce(lambda rest, case: F.when(*case).otherwise(rest), reversed(chosen), value(ranges[-1]))


def banded_impute(df: DataFrame, cuts: Cuts = AUTO) -> DataFrame:
    """Fill missing oil levels and fuel litres and give every row a fuel change.

    The draws come from the row's key, so a rerun gives the same values.
    """
    low, high = FUEL_LITERS_RANGE

    def draw(salt: int) -> Column:
        return key_draw(F.col("thing_id"), F.col("date_insertion"), salt)

    return row_progress(df, cuts).withColumns(
        {
            "oil_value": F.coalesce("oil_value", _banded(draw(1), OIL_RANGES, 1)),
            "fuel_change": _banded(draw(2), FUEL_CHANGE_RANGES, 3),
            "fuel_liters": F.coalesce(
                "fuel_liters", F.round(F.lit(low) + draw(3) * (high - low), 1)
            ),
        }
    ).drop("first_threshold", "second_threshold", "third_threshold")


def lag_difference(df: DataFrame, cuts: Cuts = AUTO) -> DataFrame:
    """Change of the voltage since the vehicle's previous reading."""

    def change(w):
        now = F.col("power_supply_voltage")
        return {"battery_current_change": now - F.lag("power_supply_voltage").over(w)}

    return _timeline(df, cuts).frame(1, 0, change).df


def training_projection(df: DataFrame) -> DataFrame:
    """The eleven training columns and an age class, old for 70 % of the rows."""
    draw = key_draw(F.col("thing_id"), F.col("date_insertion"), 4)
    return df.select(
        *TRAINING_COLUMNS, F.when(draw < OLD_CAR_SHARE, "old").otherwise("new").alias("car_age")
    )


def training_set(df: DataFrame) -> DataFrame:
    """All steps from the raw export to the training projection.

    Rows are counted for large vehicles once, on the raw export.
    """
    cuts = hot_cuts(df, ["thing_id"], ORDER[0])
    once = drop_repeated_max(engine_alert_flag(calendar_features(json_field_extract(df))))
    filled = banded_impute(group_mean_joinback(once, cuts), cuts)
    return training_projection(lag_difference(filled, cuts))


def next_value_pairs(df: DataFrame) -> DataFrame:
    """Each reading with the vehicle's next one; the last reading has none and goes."""

    def following(w):
        return {"next_speed": F.lead("speed").over(w), "_has_next": F.lead(F.lit(True)).over(w)}

    return _timeline(df, AUTO).frame(0, 1, following).df.filter("_has_next").drop("_has_next")


def split_80_20(df: DataFrame) -> DataFrame:
    """Mark each row train or test by arithmetic on its key, stable over layouts."""
    place = F.pmod(F.col("thing_id") * 31 + F.unix_seconds("date_insertion"), F.lit(10))
    return df.withColumn("split", F.when(place < 8, "train").otherwise("test"))


def linear_fit(pairs: DataFrame, at: float = 50.0) -> DataFrame:
    """Least squares of next speed on speed over the train rows: coefficients, R² on
    both splits, and the prediction at one speed. One aggregate over one scan."""
    x, y = F.col("speed").cast("double"), F.col("next_speed").cast("double")
    train, test = F.col("split") == "train", F.col("split") == "test"

    def on(side: Column, value: Column) -> Column:
        return F.when(side, value)

    sums = pairs.agg(
        F.count(on(train, y)).alias("n_train"),
        F.count(on(test, y)).alias("n_test"),
        F.regr_slope(on(train, y), on(train, x)).alias("slope"),
        F.regr_intercept(on(train, y), on(train, x)).alias("intercept"),
        F.regr_r2(on(train, y), on(train, x)).alias("train_r2"),
        # Centred sums of the test rows; squared residuals follow from them.
        F.avg(on(test, x)).alias("_mx"),
        F.avg(on(test, y)).alias("_my"),
        F.regr_sxx(on(test, y), on(test, x)).alias("_sxx"),
        F.regr_syy(on(test, y), on(test, x)).alias("_syy"),
        F.regr_sxy(on(test, y), on(test, x)).alias("_sxy"),
    )
    b = F.col("slope")
    off = F.col("_my") - F.col("intercept") - b * F.col("_mx")
    sse = F.col("_syy") - 2 * b * F.col("_sxy") + b * b * F.col("_sxx") + F.col("n_test") * off * off
    return sums.select(
        "n_train",
        "n_test",
        "slope",
        "intercept",
        "train_r2",
        (1 - sse / F.col("_syy")).alias("test_r2"),
        (F.col("intercept") + b * F.lit(at)).alias("prediction"),
    )


def sliding_sequences(df: DataFrame, steps: int = 5) -> DataFrame:
    """Every run of ``steps`` consecutive speeds of a vehicle with the next as target."""

    def run(w):
        earlier = {f"s{steps + 1 - k}": F.lag("speed", k).over(w) for k in range(steps, 0, -1)}
        return earlier | {"_run": F.count(F.lit(1)).over(w.rowsBetween(-steps, 0))}

    rows = _timeline(df.select("thing_id", *ORDER, "speed"), AUTO).frame(steps, 0, run).df
    return (
        rows.filter(F.col("_run") == steps + 1)
        .drop("_run")
        .withColumnRenamed("speed", "target")
    )


def speeding_label(df: DataFrame, above: float = SPEEDING_ABOVE) -> DataFrame:
    return df.withColumn("speeding", F.when(F.col("speed") > above, 1).otherwise(0))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and the four cells of the confusion matrix."""
    y, p = F.col(label), F.col(prediction)

    def cell(actual: int, predicted: int) -> Column:
        return F.count(F.when((y == actual) & (p == predicted), 1))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole == 0, 0.0).otherwise(part / F.nullif(whole, F.lit(0)))

    counted = df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counted.withColumns(
        {
            "accuracy": share(tn + tp, tn + fp + fn + tp),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
        }
    )
