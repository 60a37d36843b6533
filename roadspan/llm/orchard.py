"""Centroid clustering of vectors, nearest centroids found by Orchard search.

Every centroid has a list of all others, nearest first. The search for a vector walks the list
of its best centroid so far; a closer one met on the way is jumped to, and its list is walked
instead. A centroid beyond twice the vector's distance, seen from the best one, cannot be as
near by the triangle inequality, and no later one of the list can; so the walk stops strictly
beyond, and ties are still seen. Centroids are marked when measured, so none is measured twice.

Vectors are whole numbers, so that distances, sums and ties are exact. They never move: each
task sums up its own vectors per cluster, and only these sums are shuffled.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Components are kept within this, so that four times a squared distance of up to 1,024
# components still fits 64 bits.
LIMIT = 1 << 24
SCHEMA = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_vectors(vectors: DataFrame, size: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): floor(scale * x) of each component; only vectors of ``size`` finite components."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        scaled = F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
        return F.floor(scaled).cast("int")

    return vectors.filter((F.size(vector_col) == size) & finite).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, whole).alias("v")
    )


class Orchard:
    """The centroids, and per centroid the numbers and squared distances of the others, nearest first."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
        apart[np.arange(k), np.arange(k)] = -1  # itself comes first and is left out
        self.order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.measured = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector, the smaller number in a tie, and the squared distance.

        All vectors take one step of their own walk at a time.
        """
        n, k = len(vectors), len(self.centroids)
        best = np.zeros(n, dtype=np.int64)
        near = ((vectors - self.centroids[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, 0] = True
        place = np.zeros(n, dtype=np.int64)
        live = np.arange(n) if k > 1 else np.zeros(0, dtype=np.int64)
        self.measured += n
        while len(live):
            live = live[place[live] < k - 1]
            live = live[self.apart[best[live], place[live]] <= 4 * near[live]]
            other = self.order[best[live], place[live]]
            place[live] += 1
            unseen = ~seen[live, other]
            rows, other = live[unseen], other[unseen]
            seen[rows, other] = True
            far = ((vectors[rows] - self.centroids[other]) ** 2).sum(axis=1)
            self.measured += len(rows)
            closer = (far < near[rows]) | ((far == near[rows]) & (other < best[rows]))
            rows = rows[closer]
            best[rows], near[rows], place[rows] = other[closer], far[closer], 0
        return best, near


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _sums(rows: DataFrame, centroids: np.ndarray) -> list:
    """Per non-empty cluster and component the sum, and the count: centroids x components rows."""
    k, size = centroids.shape

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        sums, counts = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            vectors = _vectors(batch, size)
            cluster, _ = orchard.nearest(vectors)
            np.add.at(sums, cluster, vectors)
            counts += np.bincount(cluster, minlength=k)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(full, pa.int32()), "n": pa.array(counts[full], pa.int64()),
             "sums": pa.array(sums[full].tolist(), pa.list_(pa.int64()))}
        )

    parts = rows.select("v").mapInArrow(of, "cluster int, n long, sums array<long>")
    return (
        parts.select("cluster", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("cluster", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(19,0)")).alias("s"))
        .collect()
    )


def _assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    size = centroids.shape[1]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        for batch in batches:
            cluster, distance = orchard.nearest(_vectors(batch, size))
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance)}
            )

    return rows.mapInArrow(of, "id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: str = "2:",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    Kept are vectors of exactly ``size`` components, none null, NaN or infinite, as whole
    numbers floor(scale * x) held within +-2^24. The first centroids are the ``k`` kept vectors
    with the smallest sha256 of ``seed`` and the id (a null id comes last, equal ids go by
    their vectors); fewer vectors give fewer centroids, none an empty result. Each round moves
    a centroid to the floor of the mean of its vectors; one without vectors stays. Equal
    vectors, repeated rows and null ids give a row each. An inertia beyond 64 bits is null.

    ``k`` times ``k`` neighbours and ``k`` times ``size`` sums are held in memory, nothing of
    the size of the input.
    """
    if size > 1024:
        raise ValueError("distances of more than 1,024 components may not fit 64 bits")
    spark = vectors.sparkSession
    rows = stored(whole_vectors(vectors, size, scale, id_col, vector_col), "whole-vectors")
    named = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.select("v", named.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], SCHEMA)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(rows, centroids):
            moved[r.cluster, r.at] = int(r.s) // r.n
        centroids = moved
    found = stored(_assigned(rows, centroids), "clusters")
    inertia = {
        r.cluster: int(r.s)
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()
    }
    held = lambda n: n if n < 1 << 63 else None
    about = [
        (c, held(s), held(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, s in inertia.items()
    ]
    each = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select(*SCHEMA.replace(",", "").split(" ")[::2])
