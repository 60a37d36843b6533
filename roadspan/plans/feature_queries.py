"""Queries over features, models and the order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.operators import features, models, orders
from roadspan.operators.scaling import materialise
from roadspan.plans.fixtures import Inputs
from roadspan.plans.oracle import r6
from roadspan.plans.registry import query, rounded

def extracted(i: Inputs) -> DataFrame:
    return features.json_field_extract(i.rul_src)


def pairs(i: Inputs) -> DataFrame:
    return features.next_value_pairs(i.rul_src.select("thing_id", "date_insertion", "trace_id", "speed"))


@query(
    "json_field_extract",
    "SELECT trace_id, oil_value, fuel_liters FROM extracted",
)
def _json(i: Inputs) -> DataFrame:
    return extracted(i).select("trace_id", "oil_value", "fuel_liters")


@query(
    "calendar_features",
    """SELECT trace_id, CAST(dayofweek(date_insertion) + 1 AS INT) AS day_of_week,
    CAST(hour(date_insertion) AS INT) AS hour_of_day FROM rul_src""",
)
def _calendar(i: Inputs) -> DataFrame:
    return features.calendar_features(i.rul_src).select("trace_id", "day_of_week", "hour_of_day")


@query(
    "group_mean_joinback",
    f"""SELECT trace_id, thing_id, date_insertion, {r6('''avg(power_supply_voltage) OVER (
    PARTITION BY thing_id, date_insertion)''', 'daily_avg_voltage')} FROM rul_src""",
)
def _mean(i: Inputs) -> DataFrame:
    return rounded(
        features.group_mean_joinback(i.rul_src).select(
            "trace_id", "thing_id", "date_insertion", "daily_avg_voltage"
        ),
        "daily_avg_voltage",
    )


@query(
    "engine_alert_flag",
    "SELECT trace_id, CASE WHEN engine_status = 'Abnormal' THEN 1 ELSE 0 END AS engine_alert FROM rul_src",
)
def _flag(i: Inputs) -> DataFrame:
    return features.engine_alert_flag(i.rul_src).select("trace_id", "engine_alert")


PROGRESS = ["first_threshold", "second_threshold", "third_threshold"]


@query(
    "row_progress",
    f"""SELECT trace_id, thing_id, row_number() OVER (PARTITION BY thing_id ORDER BY date_insertion,
    trace_id) AS row_num, count(*) OVER (PARTITION BY thing_id) AS total_rows,
    {', '.join(r6(f'{share} * count(*) OVER (PARTITION BY thing_id)', name)
               for share, name in zip(features.BANDS, PROGRESS))} FROM rul_src""",
)
def _progress(i: Inputs) -> DataFrame:
    shown = features.row_progress(i.rul_src).select(
        "trace_id", "thing_id", F.col("row_num").cast("long"), "total_rows", *PROGRESS
    )
    return rounded(shown, *PROGRESS)


@query(
    "drop_repeated_max",
    """SELECT trace_id, thing_id, speed FROM (SELECT *, row_number() OVER (PARTITION BY speed
    ORDER BY thing_id, date_insertion, trace_id) AS rn, max(speed) OVER () AS top FROM rul_src)
    WHERE speed < top OR rn = 1""",
)
def _max(i: Inputs) -> DataFrame:
    return features.drop_repeated_max(i.rul_src, "speed").select("trace_id", "thing_id", "speed")


FILLED = ["oil_value", "fuel_change", "fuel_liters"]
FILLED_SQL = ", ".join(r6(c, c) for c in FILLED)


@query("banded_impute", f"SELECT trace_id, thing_id, {FILLED_SQL} FROM imputed")
def _impute(i: Inputs) -> DataFrame:
    filled = features.banded_impute(extracted(i)).select("trace_id", "thing_id", *FILLED)
    return rounded(filled, *FILLED)


@query(
    "lag_difference",
    f"""SELECT trace_id, thing_id, {r6('''power_supply_voltage - lag(power_supply_voltage) OVER (
    PARTITION BY thing_id ORDER BY date_insertion, trace_id)''', 'battery_current_change')} FROM rul_src""",
)
def _lag(i: Inputs) -> DataFrame:
    shown = features.lag_difference(i.rul_src).select("trace_id", "thing_id", "battery_current_change")
    return rounded(shown, "battery_current_change")


DERIVED = [*FILLED, "battery_current_change", "daily_avg_voltage"]


@query(
    "training_projection",
    f"""SELECT thing_id, date_insertion, speed, total_km, engine_status, power_supply_voltage, car_age,
    {", ".join(r6(c, c) for c in DERIVED)} FROM training""",
)
def _training(i: Inputs) -> DataFrame:
    return rounded(features.training_set(i.rul_src), *DERIVED)


PAIRS_SQL = """(SELECT thing_id, date_insertion, trace_id, speed, next_speed FROM (
SELECT *, lead(speed) OVER w AS next_speed, lead(trace_id) OVER w AS next_id FROM rul_src
WINDOW w AS (PARTITION BY thing_id ORDER BY date_insertion, trace_id)) WHERE next_id IS NOT NULL)"""
SPLIT_SQL = """CASE WHEN (thing_id * 31 + CAST(epoch(date_insertion) AS BIGINT)) % 10 < 8
THEN 'train' ELSE 'test' END AS split"""


@query("next_value_pairs", f"SELECT * FROM {PAIRS_SQL}")
def _pairs(i: Inputs) -> DataFrame:
    return pairs(i)


@query("split_80_20", f"SELECT trace_id, {SPLIT_SQL} FROM rul_src")
def _split(i: Inputs) -> DataFrame:
    return features.split_80_20(i.rul_src).select("trace_id", "split")


FIT = ["slope", "intercept", "train_r2", "test_r2", "prediction"]


@query(
    "linear_fit",
    f"""WITH p AS (SELECT *, {SPLIT_SQL} FROM {PAIRS_SQL}),
    fit AS (SELECT COUNT(*) AS n_train, regr_slope(next_speed, speed) AS slope,
      regr_intercept(next_speed, speed) AS intercept, regr_r2(next_speed, speed) AS train_r2
      FROM p WHERE split = 'train'),
    mean AS (SELECT COUNT(*) AS n_test, AVG(next_speed) AS m FROM p WHERE split = 'test')
    SELECT n_train, n_test, {r6('slope', 'slope')}, {r6('intercept', 'intercept')},
    {r6('train_r2', 'train_r2')},
    {r6('''1 - (SELECT SUM(pow(next_speed - intercept - slope * speed, 2)) FROM p WHERE split = 'test')
      / (SELECT SUM(pow(next_speed - m, 2)) FROM p WHERE split = 'test')''', 'test_r2')},
    {r6('intercept + slope * 50', 'prediction')} FROM fit, mean""",
)
def _fit(i: Inputs) -> DataFrame:
    return rounded(features.linear_fit(features.split_80_20(pairs(i))), *FIT)


@query(
    "sliding_sequences",
    """SELECT thing_id, date_insertion, trace_id, s1, s2, s3, s4, s5, target FROM (
    SELECT thing_id, date_insertion, trace_id, lag(speed, 5) OVER w AS s1, lag(speed, 4) OVER w AS s2,
      lag(speed, 3) OVER w AS s3, lag(speed, 2) OVER w AS s4, lag(speed, 1) OVER w AS s5,
      speed AS target, row_number() OVER w AS rn FROM rul_src
    WINDOW w AS (PARTITION BY thing_id ORDER BY date_insertion, trace_id)) WHERE rn >= 6""",
)
def _sequences(i: Inputs) -> DataFrame:
    return features.sliding_sequences(i.rul_src)


def _least_squares(lags: list[str], columns: str) -> str:
    """Least squares of ``target`` on the lags over the train rows of q, as one chain of tables.

    Each lag loses what the earlier ones and a constant explain of it; on what is left, the
    slopes of the target are those of single regressions.
    """
    steps = "o0 AS (SELECT * FROM q)"
    for n, lag in enumerate(lags, 1):
        before = [f"e{k}" for k in range(1, n)]
        slopes = ", ".join([f"regr_slope({lag}, {e}) AS b{e}" for e in before] + [f"AVG({lag}) AS m"])
        less = "".join(f" - b{e} * {e}" for e in before)
        steps += f""", c{n} AS (SELECT {slopes} FROM o{n - 1} WHERE split = 'train'),
    o{n} AS (SELECT o{n - 1}.*, {lag} - m{less} AS e{n} FROM o{n - 1}, c{n})"""
    n = len(lags)
    slopes = ", ".join(f"coalesce(regr_slope(target, e{k}), 0) AS t{k}" for k in range(1, n + 1))
    value = " + ".join(["m", *[f"t{k} * e{k}" for k in range(1, n + 1)]])
    return f"""{steps}, y AS (SELECT AVG(target) AS m, {slopes} FROM o{n} WHERE split = 'train'),
    forecast AS (SELECT {columns}, {value} AS prediction FROM o{n}, y WHERE split = 'test')"""


SEQUENCES_SQL = f"""q AS (SELECT *, {SPLIT_SQL} FROM (
    SELECT thing_id, date_insertion, trace_id, lag(speed, 5) OVER w AS s1, lag(speed, 4) OVER w AS s2,
      lag(speed, 3) OVER w AS s3, lag(speed, 2) OVER w AS s4, lag(speed, 1) OVER w AS s5,
      speed AS target, row_number() OVER w AS rn FROM rul_src
    WINDOW w AS (PARTITION BY thing_id ORDER BY date_insertion, trace_id)) WHERE rn >= 6
    AND s1 + s2 + s3 + s4 + s5 + target IS NOT NULL),
    {_least_squares(["s1", "s2", "s3", "s4", "s5"], "thing_id, date_insertion, trace_id, target")}"""


@query(
    "ar5_forecast",
    f"""WITH {SEQUENCES_SQL} SELECT thing_id, date_insertion, trace_id, target,
    ROUND(prediction, 4) AS prediction FROM forecast""",
)
def _forecast(i: Inputs) -> DataFrame:
    predicted, _ = models.ar5_forecast(features.sliding_sequences(i.rul_src))
    return predicted.select(
        "thing_id", "date_insertion", "trace_id", "target", F.round("prediction", 4).alias("prediction")
    )


@query(
    "ar5_forecast_error",
    f"""WITH {SEQUENCES_SQL} SELECT COUNT(*) AS n_test, ROUND(AVG(pow(target - prediction, 2)), 4) AS mse
    FROM forecast""",
)
def _forecast_error(i: Inputs) -> DataFrame:
    _, error = models.ar5_forecast(features.sliding_sequences(i.rul_src))
    return error.select("n_test", F.round("mse", 4).alias("mse"))


@query(
    "speeding_label",
    "SELECT trace_id, speed, CASE WHEN speed > 70 THEN 1 ELSE 0 END AS speeding FROM rul_src",
)
def _label(i: Inputs) -> DataFrame:
    return features.speeding_label(i.rul_src).select("trace_id", "speed", "speeding")


# The label is a function of the speed alone and speeds are whole, so a fit that is good for
# anything gives every test row its label.
@query(
    "speeding_classifier",
    f"""SELECT thing_id, date_insertion, trace_id, speed, CASE WHEN speed > 70 THEN 1 ELSE 0 END AS label,
    CASE WHEN speed > 70 THEN 1 ELSE 0 END AS prediction, true AS sure
    FROM (SELECT *, {SPLIT_SQL} FROM rul_src) WHERE split = 'test' AND speed IS NOT NULL""",
)
def _classifier(i: Inputs) -> DataFrame:
    scored = models.speeding_classifier(i.rul_src)
    sure = (F.col("probability") > 0.5) == (F.col("prediction") == 1)
    return scored.select("thing_id", *features.ORDER, "speed", "label", "prediction", sure.alias("sure"))


@query(
    "speeding_classifier_metrics",
    f"""SELECT COUNT(*) FILTER (speed <= 70) AS tn, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn,
    COUNT(*) FILTER (speed > 70) AS tp, CAST(1 AS DOUBLE) AS accuracy, CAST(1 AS DOUBLE) AS "precision",
    CAST(1 AS DOUBLE) AS recall FROM (SELECT *, {SPLIT_SQL} FROM rul_src) WHERE split = 'test'
    AND speed IS NOT NULL""",
)
def _classifier_metrics(i: Inputs) -> DataFrame:
    return features.classification_metrics(models.speeding_classifier(i.rul_src))


@query(
    "classification_metrics",
    f"""SELECT tn, fp, fn, tp, {r6('(tn + tp) / (tn + fp + fn + tp)', 'accuracy')},
    {r6('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END', '"precision"')},
    {r6('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END', 'recall')} FROM (
    SELECT COUNT(*) FILTER (next_speed <= 70 AND speed <= 70) AS tn,
      COUNT(*) FILTER (next_speed <= 70 AND speed > 70) AS fp,
      COUNT(*) FILTER (next_speed > 70 AND speed <= 70) AS fn,
      COUNT(*) FILTER (next_speed > 70 AND speed > 70) AS tp FROM {PAIRS_SQL})""",
)
def _metrics(i: Inputs) -> DataFrame:
    """A reading's label predicted by the label of the reading before."""
    labelled = pairs(i).select(
        F.when(F.col("next_speed") > 70, 1).otherwise(0).alias("label"),
        F.when(F.col("speed") > 70, 1).otherwise(0).alias("prediction"),
    )
    return rounded(features.classification_metrics(labelled), "accuracy", "precision", "recall")


# A forest's score is a mean of labels, so it lies between the least and the largest; and a fit
# that has learned anything errs less than the mean of all labels does, whose squared error is
# the variance. Both bounds come from SQL alone.
@query(
    "rul_train_score",
    """SELECT thing_id, trace_date, trace_id, CAST(n - k AS DOUBLE) AS label, true AS within_labels,
    true AS beats_mean FROM (SELECT thing_id, trace_date, trace_id, COUNT(*) OVER (PARTITION BY thing_id) AS n,
    row_number() OVER (PARTITION BY thing_id ORDER BY trace_date, trace_id) AS k FROM trace_src)""",
)
def _rul(i: Inputs) -> DataFrame:
    rows = materialise(models.rul_features(i.trace_src))
    scored = materialise(models.rul_score(models.rul_train(rows), rows).select("thing_id", "trace_date", "trace_id", "label", "rul"))
    bounds = scored.agg(
        F.min("label").alias("least"),
        F.max("label").alias("most"),
        (F.avg(F.pow(F.col("label") - F.col("rul"), F.lit(2.0))) < F.var_pop("label")).alias("beats_mean"),
    )
    # One row of three numbers.
    return scored.join(F.broadcast(bounds)).select(
        "thing_id", "trace_date", "trace_id", "label", F.col("rul").between(F.col("least"), F.col("most")).alias("within_labels"), "beats_mean"
    )


@query(
    "order_wide_table",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate, o_custkey, o_orderstatus,
    o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, c_name, c_nationkey,
    c_acctbal, c_mktsegment, p_name, p_brand, p_type, p_size, p_retailprice, s_name, s_nationkey,
    s_acctbal, n_name, n_regionkey, r_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _wide(i: Inputs) -> DataFrame:
    wide = orders.order_wide_table(
        i.lineitem, i.orders, i.customer, i.part, i.supplier, i.nation, i.region
    )
    return orders.with_iso_dates(wide)
