"""Centroid clustering with integer vectors, filtered in a rotated space.

Vectors are scaled and floored to integers. Principal axes of all vectors are fitted
once; each vector is stored with its leading rotated coordinates and the norm of what
they leave out. For a vector and a centroid the squared distance of the rotated
coordinates plus the squared difference of the residual norms never exceeds the true
squared distance. The centroid with the least bound is measured in integers first, and
then those alone whose bound does not exceed that distance. Rotated numbers only decide
what is measured, with a margin for their rounding; distances, sums and means are exact.

A round is one pass without a shuffle of vectors: a task hands on one row of sums a
centroid. What reaches the driver, and tasks from there, are the centroids.

Defined cases: vectors that are null, of another length, or with a null or non-finite
component are left out. Scaled components are held within +-2^62; batches with any
beyond 2^27 are measured with integers of any length, and distances and inertias that
no long can hold are given as the largest long. Rows with equal or null ids are rows
of their own; among equal hashes of ids the smaller vector comes first. Fewer vectors
than centroids give that many centroids. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored

Centroids = list[list[int]]

LEADING = 16  # rotated coordinates that are stored
# Share of the squared norms by which a bound may be wrong: stored coordinates have 24 bits.
MARGIN = 4e-6
SMALL = 1 << 27  # below it, a squared distance of up to 1024 components fits a long
LONGEST = (1 << 63) - 1


def kept(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): the usable vectors as integers."""
    def finite(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))

    vec = F.col(f"`{vec_col}`")
    good = F.coalesce((F.size(vec) == dims) & F.forall(vec, finite), F.lit(False))
    bound = F.lit(1 << 62)
    whole = F.transform(vec, lambda x: F.greatest(-bound, F.least(bound, F.floor(x.cast("double") * scale))))
    return vectors.where(good).select(F.col(f"`{id_col}`").alias("id"), whole.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> Centroids:
    """The k vectors whose seeded ids have the smallest hashes: k rows, taken from a partial top-k of every task."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(row.v) for row in rows.orderBy(key, "v").limit(k).select("v").collect()]


class Rotation:
    """Leading principal axes about a middle."""

    def __init__(self, axes: np.ndarray, middle: np.ndarray):
        self.axes, self.middle = axes, middle

    @classmethod
    def fitted(cls, rows: DataFrame, dims: int, leading: int) -> Rotation:
        count, *means = rows.agg(F.count(F.lit(1)), *[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(dims)]).first()
        axes = np.eye(dims, min(leading, dims))
        if count > 1:  # one vector has no principal axes
            data = rows.select(array_to_vector(F.col("v").cast("array<double>")).alias("x"))
            found = PCA(k=min(leading, dims), inputCol="x", outputCol="y").fit(data).pc.toArray()
            axes = found if np.isfinite(found).all() else axes
        # Exactly orthogonal, whatever the fit returned for directions without spread.
        return cls(np.linalg.qr(axes)[0], np.array([float(m) for m in means]))

    def apply(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rotated coordinates, residual norms, squared norms) of vectors."""
        moved = np.asarray(vectors, dtype=float) - self.middle
        turned = moved @ self.axes
        norms = (moved**2).sum(axis=1)
        return turned, np.sqrt(np.maximum(norms - (turned**2).sum(axis=1), 0)), norms


def rotated(rows: DataFrame, rotation: Rotation) -> DataFrame:
    """(id, v, turned, residual, norm), stored: every round reads it."""
    def turn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                turned, residual, norm = rotation.apply(np.stack(frame.v.to_numpy()))
                yield frame.assign(turned=list(turned.astype(np.float32)), residual=residual, norm=norm)

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, v array<bigint>, turned array<float>, residual double, norm double"
    return stored(rows.mapInPandas(turn, schema), "rotated")


class Assigner:
    """Nearest centroids of batches of rotated rows."""

    def __init__(self, centroids: Centroids, rotation: Rotation):
        self.centroids = centroids
        self.turned, self.residual, self.norm = rotation.apply(np.array(centroids, dtype=float))
        self.small = max((abs(x) for c in centroids for x in c), default=0) < SMALL

    def measure(self, frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, cluster, squared distance); the smaller number among equals."""
        vectors = np.stack(frame.v.to_numpy())
        exact = np.int64 if self.small and np.abs(vectors).max(initial=0) < SMALL else object
        vectors, centroids = vectors.astype(exact), np.array(self.centroids, dtype=exact)
        turned = np.stack(frame.turned.to_numpy()).astype(float)
        bound = (frame.residual.to_numpy()[:, None] - self.residual) ** 2 - MARGIN * (frame.norm.to_numpy()[:, None] + self.norm)
        bound += np.maximum((turned**2).sum(axis=1)[:, None] + (self.turned**2).sum(axis=1) - 2 * turned @ self.turned.T, 0)
        cluster = bound.argmin(axis=1)
        distance = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
        survivors = bound <= distance[:, None].astype(float)
        survivors[np.arange(len(cluster)), cluster] = False
        # One centroid at a time, so that only survivors are measured and little is held.
        for number in np.flatnonzero(survivors.any(axis=0)):
            at = np.flatnonzero(survivors[:, number])
            other = ((vectors[at] - centroids[number]) ** 2).sum(axis=1)
            nearer = (other < distance[at]) | ((other == distance[at]) & (number < cluster[at]))
            cluster[at[nearer]], distance[at[nearer]] = number, other[nearer]
        return vectors, cluster, distance


def moved_centroids(rows: DataFrame, assigner: Assigner) -> Centroids:
    """Every non-empty centroid as the exact floored mean of its vectors."""
    dims = len(assigner.centroids[0])

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, totals = {}, {}
        for frame in frames:
            if not len(frame):
                continue
            vectors, cluster, _ = assigner.measure(frame)
            for number in np.unique(cluster):
                mine = vectors[cluster == number]
                counts[number] = counts.get(number, 0) + len(mine)
                # Whole numbers of any length from here on.
                totals[number] = totals.get(number, 0) + mine.sum(axis=0).astype(object)
        if counts:
            yield pd.DataFrame(
                {"cluster": list(counts), "n": list(counts.values()), "s": [[Decimal(int(x)) for x in totals[c]] for c in counts]}
            )

    partial = rows.mapInPandas(sums, "cluster int, n bigint, s array<decimal(38,0)>")
    merged = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(dims)])
    centroids = [list(c) for c in assigner.centroids]
    for row in merged.collect():  # one row a centroid
        centroids[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dims)]
    return centroids


def assigned(rows: DataFrame, assigner: Assigner) -> DataFrame:
    """(id, cluster, distance)."""
    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                _, cluster, distance = assigner.measure(frame)
                yield pd.DataFrame({"id": frame.id, "cluster": cluster, "distance": np.minimum(distance, LONGEST).astype(np.int64)})

    return rows.mapInPandas(label, f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def fit(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> tuple[DataFrame, Centroids]:
    """((id, cluster, distance), stored; final centroids)."""
    rows = stored(kept(vectors, dims, scale, id_col, vec_col), "integers")
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    rotation = Rotation.fitted(rows, dims, LEADING)
    ready = rotated(rows, rotation)
    for _ in range(rounds):
        centroids = moved_centroids(ready, Assigner(centroids, rotation))
    return stored(assigned(ready, Assigner(centroids, rotation)), "assigned"), centroids


def with_inertia(clusters: DataFrame, centroids: Centroids, id_col: str = "vec_id") -> DataFrame:
    """Every vector with the inertia of its cluster and of all, and the digest of its centroid."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    as_long = lambda name: F.least(F.col(name), F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint").alias(name)
    every = Window.partitionBy(F.lit(1))  # one row a centroid
    by_cluster = clusters.groupBy("cluster").agg(total.alias("cluster_inertia")).withColumn("inertia", F.sum("cluster_inertia").over(every))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)]
    facts = clusters.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string").join(by_cluster, "cluster")
    return clusters.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", as_long("cluster_inertia"), as_long("inertia"), "centroid_sha256"
    )
