"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The presence of an n-gram (hashed) counts once per text, whatever its length. Each feature is
multiplied by the logarithm of the ratio of its smoothed shares among toxic and other texts,
then a logistic regression is fitted in which both labels weigh the same in all, as toxic texts
are few; both become one weight per feature for scoring. The n-grams kept are those whose ratio
is surest: with many more, a long text sums up so much noise that a rare insult does not tell.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.llm.common import crc_remainder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDERS = (3, 4, 5)
BITS = 20
# Documented bounds of the fit: labelled rows sampled by a hash of their id, features kept.
LABELLED_ROWS = 20_000
FEATURES = 2_048
SMOOTHING = 1.0
PENALTY = 0.002


def ngrams(text: str | None) -> np.ndarray:
    """Hashes of all character n-grams of the text, lower-cased with single spaces around words."""
    code = np.frombuffer(
        f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32
    )
    found = []
    for order in ORDERS:
        if len(code) >= order:
            n = len(code) - order + 1
            h = np.full(n, order, dtype=np.uint32)
            for k in range(order):
                h = (h ^ code[k : k + n]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            found.append(h >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


class Presence:
    """The distinct features of a text, ascending."""

    def __init__(self):
        self.flags = np.zeros(1 << BITS, dtype=bool)

    def __call__(self, text: str | None) -> np.ndarray:
        all_of = ngrams(text)
        self.flags[all_of] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    presence, counts = Presence(), np.zeros((2, 1 << BITS), dtype=np.int64)
    for rows in batches:
        for text, label in zip(rows["text"], rows["label"]):
            counts[int(label)][presence(text)] += 1
    seen = np.flatnonzero(counts.sum(axis=0))
    yield pd.DataFrame({"feature": seen, "other": counts[0][seen], "toxic": counts[1][seen]})


class Model:
    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, text, label): about LABELLED_ROWS labelled documents that learning may see.

    Rows are drawn by a hash of the id. A document labelled more than once counts as toxic if
    one label says so; a text without label or a label without document is left out.
    """
    known = (
        labels.filter(F.col(label_col).isNotNull() & (crc_remainder(id_col, 5) != 0))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    share = min(1.0, LABELLED_ROWS / max(known.count(), 1))
    drawn = stored(
        known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20))), "drawn-labels"
    )
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    # The drawn labels are bounded by LABELLED_ROWS, so they go to the documents.
    return texts.join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).select("_id", "text", "label")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Without rows of both labels the model gives every text the share of toxic labels."""
    rows = stored(labelled_rows(docs, labels, id_col, text_col, label_col).repartition(16), "labelled")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        share = 1 - 1e-6 if 1 in sizes else 1e-6
        return Model(np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share))))

    # One row per hashed feature reaches the driver, as columns: their number is fixed.
    counts = (
        rows.mapInPandas(_counted, "feature int, other long, toxic long")
        .groupBy("feature")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        .toArrow()
        .to_pandas()
    )
    p = (counts["toxic"] + SMOOTHING) / (sizes[1] + 2 * SMOOTHING)
    q = (counts["other"] + SMOOTHING) / (sizes[0] + 2 * SMOOTHING)
    ratio = np.log(p / q)
    sure = ratio.abs() * np.sqrt(counts["toxic"] + counts["other"])
    kept = counts.assign(ratio=ratio, sure=sure).nlargest(FEATURES, "sure").sort_values("feature")
    feature, ratio = kept["feature"].to_numpy(), kept["ratio"].to_numpy()
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[feature] = np.arange(len(feature))

    presence = Presence()

    @F.udf(VectorUDT())
    def scaled(text):
        at = place[presence(text)]
        at = at[at >= 0]
        return SparseVector(len(feature), at.tolist(), ratio[at].tolist())

    total = sizes[0] + sizes[1]
    weight = F.when(F.col("label") == 1, total / (2 * sizes[1])).otherwise(total / (2 * sizes[0]))
    data = stored(
        rows.select("label", weight.alias("weight"), scaled("text").alias("features")), "toxicity-features"
    )
    fitted = LogisticRegression(
        labelCol="label", weightCol="weight", maxIter=60, regParam=PENALTY, standardization=False, tol=1e-5
    ).fit(data)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[feature] = fitted.coefficients.toArray() * ratio
    return Model(weights, float(fitted.intercept))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row; null and empty texts get the score of no feature at all."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        presence = Presence()
        for rows in batches:
            sums = np.array([model.weights[presence(t)].sum(dtype=np.float64) for t in rows["text"]])
            yield pd.DataFrame(
                {"id": rows["id"], "score": 1 / (1 + np.exp(-np.clip(sums + model.intercept, -500, 500)))}
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(of, "id long, score double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with the columns of the input."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        presence = Presence()
        sums = np.array([model.weights[presence(t)].sum(dtype=np.float64) for t in texts])
        return pd.Series(1 / (1 + np.exp(-np.clip(sums + model.intercept, -500, 500))))

    return docs.filter(score(F.col(text_col)) < threshold)
