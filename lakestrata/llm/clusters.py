"""k-means in whole numbers; a vector finds its centroid by a tournament of bisecting planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import ready, saved


class Planes:
    """For each pair a < b of centroids the plane halfway between them: ``x . normal > threshold`` where b is nearer.

    ``|x-a|^2 > |x-b|^2`` is ``x . 2(b-a) > |b|^2 - |a|^2``, all in whole numbers.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of each row's nearest centroid, the smaller of equals: k - 1 sign tests a row.

        Centroids come in order of their numbers, so whoever is ahead has the smaller number and zero leaves it there.
        """
        ahead = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            for a in np.unique(ahead):
                rows = np.flatnonzero(ahead == a)
                ahead[rows[x[rows] @ self.normals[a, b] > self.thresholds[a, b]]] = b
        return ahead

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        away = x - self.centroids[cluster]
        return (away * away).sum(axis=1)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _sums(centroids: np.ndarray):
    planes = Planes(centroids)
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            cluster = planes.nearest(x)
            counts += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                sums[c] += x[cluster == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    return run


def _assigned(centroids: np.ndarray):
    planes = Planes(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), centroids.shape[1])
            cluster = planes.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(planes.distances(x, cluster))], ["vec_id", "cluster", "distance"]
            )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid becomes the floor of the exact mean of its vectors; one without vectors stays.

    Every task adds up its own rows, so a round sends ``k`` rows a task and gives ``k * width`` numbers.
    """
    parts = vectors.select("x").mapInArrow(_sums(centroids), "cluster long, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at")
    rows = each.agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    out = centroids.copy()
    for r in rows:
        if r.n:
            out[r.cluster, r.at] = int(r.total) // r.n
    return out


def k_means(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = 64,
    scale: int = 1024,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Components become whole numbers ``floor(scale * x)``. The centroids start as the ``k`` vectors with the smallest
    SHA-256 of ``seed:vec_id``; ``rounds`` times all vectors are assigned and the centroids moved, then all are assigned
    once more. Distances are squared and exact. The vectors are written once as whole numbers; each round reads them
    and returns sums, so nothing is shuffled but ``k`` rows a task, and a lost task is run again from the stored rows.

    A vector is left out when it is NULL, has not exactly ``width`` components, or holds a NULL, NaN or infinite one.
    Repeated rows count as often as they occur, also as starting centroids; of rows with one id the smaller vector starts first. A
    row with NULL id is assigned and counted but starts no centroid, unless there are not enough others; then the smallest vectors
    do. Fewer than ``k`` vectors make fewer clusters. Components that make
    distances beyond 63 bits raise an error. Other columns are not read. An empty table gives an empty result.
    """
    spark = df.sparkSession
    ready(spark)
    odd = F.exists(vector_col, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    vectors = saved(
        df.where(F.col(vector_col).isNotNull() & (F.size(vector_col) == width)).where(~odd).select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.transform(vector_col, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("int")).alias("x"),
        ),
        "vectors",
    )
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last()
    first = vectors.orderBy(order, "x").limit(k).collect()
    if not first:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    most = vectors.agg(F.max(F.greatest(F.array_max(F.transform("x", lambda c: F.abs(c.cast("long")))), F.lit(0)))).first()[0]
    if width * (2 * most) ** 2 >= 2**63:
        raise ValueError(f"components up to {most} make distances beyond 63 bits")
    centroids = np.array([r.x for r in first], np.int64).reshape(len(first), width)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    assigned = saved(vectors.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), "assigned")
    sums = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    own = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(centroids))])
    texts = F.array(*[F.lit(",".join(map(str, c))) for c in centroids.tolist()])
    return assigned.select(
        "vec_id", "cluster", "distance", F.get(own, "cluster").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"), F.sha2(F.get(texts, "cluster").cast("binary"), 256).alias("centroid_sha256"),
    )
