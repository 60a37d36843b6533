"""Models on the features, all with Spark's own distributed learners."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.operators import features, live
from roadspan.operators.scaling import materialise
from roadspan.operators.timeline import hot_cuts

RUL_FEATURES = [
    "car_usage", "thing_id", "oil_value", "fuel_change",
    "oil_rolling_mean", "fuel_rolling_mean", "oil_rolling_stddev", "fuel_rolling_stddev",
    "oil_cumsum", "fuel_cumsum", "oil_min", "fuel_min", "oil_max", "fuel_max",
]


def rul_features(trace: DataFrame) -> DataFrame:
    """The 14 features of every reading and the number of readings the vehicle has left.

    A missing level counts as 0, as does the deviation of a first reading.
    """
    cuts = hot_cuts(trace, ["thing_id"], "trace_date")
    rolled = live.rolling_sensor_stats(trace, keep=("oil_value",), cuts=cuts)
    stats = live.constant_features(rolled)
    ordered = stats.withColumn("date_insertion", F.col("trace_date"))
    counted = features.row_progress(ordered, cuts)
    filled = counted.fillna(0.0, subset=[c for c in RUL_FEATURES if c != "thing_id"])
    return filled.select(
        *dict.fromkeys(["thing_id", *live.EVENT_ORDER, *RUL_FEATURES]),
        (F.col("total_rows") - F.col("row_num")).cast("double").alias("label"),
    )


def rul_train(rows: DataFrame, trees: int = 20, depth: int = 5, seed: int = 7) -> PipelineModel:
    """Scale the features and fit a random forest to the readings left.

    The learner passes over its rows several times; give a stored frame.
    """
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=RUL_FEATURES, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, predictionCol="rul"),
        ]
    ).fit(rows)


def rul_score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Score rows with a fitted pipeline; the model is loaded once by the caller."""
    return model.transform(rows).withColumn("rul", F.col("rul").cast("float")).drop("raw", "features")


def ar5_forecast(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Linear forecast from five lags: predictions of the test rows, and their error."""
    lags = [c for c in sequences.columns if c.startswith("s") and c[1:].isdigit()]
    parts = materialise(features.split_80_20(sequences.dropna(subset=[*lags, "target"])))
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=lags, outputCol="features"),
            LinearRegression(labelCol="target", predictionCol="prediction"),
        ]
    ).fit(parts.filter("split = 'train'"))
    predicted = model.transform(parts.filter("split = 'test'")).drop("features")
    squared = F.pow(F.col("target") - F.col("prediction"), F.lit(2.0))
    return predicted, predicted.agg(F.count("*").alias("n_test"), F.avg(squared).alias("mse"))


def speeding_classifier(rows: DataFrame) -> DataFrame:
    """Logistic regression of the speeding label on the speed, scored on the test rows."""
    labelled = features.split_80_20(features.speeding_label(rows.filter("speed IS NOT NULL")))
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=["speed"], outputCol="features"),
            LogisticRegression(labelCol="speeding", maxIter=50),
        ]
    ).fit(labelled.filter("split = 'train'"))
    scored = model.transform(labelled.filter("split = 'test'"))
    return scored.select(
        "thing_id",
        *features.ORDER,
        "speed",
        F.col("speeding").alias("label"),
        F.col("prediction").cast("int"),
        F.get(vector_to_array("probability"), 1).alias("probability"),
    )
