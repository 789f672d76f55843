"""An inverted file of vectors: cells around centroids, stored as partitions; a question reads few of them.

Centroids are fitted on a bounded sample; every vector is assigned to its nearest one. A search probes the nearest cells
and ranks what is in them by the exact similarity. An exact search reads the nearest cells first and then those that, by
their radius, could still hold something better: it gives what a scan of all vectors gives.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.functions import text as X

#: Most vectors that centroids are fitted on, most cells, and rounds of fitting.
SAMPLE, MOST_CELLS, ROUNDS = 20_000, 1024, 12
#: What floats may be off in the comparison of a bound with a similarity.
SLACK = 1e-6


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def fit(sample: np.ndarray, cells: int, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit centroids, as many as ``cells`` or as there are different vectors, if that is fewer."""
    rng, points = np.random.default_rng(seed), np.unique(_unit(sample.astype(np.float64)), axis=0)
    centroids = points[rng.permutation(len(points))[: min(cells, len(points))]]
    for _ in range(ROUNDS):
        nearest = (points @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        empty = ~np.isin(np.arange(len(centroids)), nearest)
        centroids = np.where(empty[:, None], centroids, _unit(sums))
    return centroids


class VectorIndex:
    """Vectors (id, emb, and what else they bring) under ``path``: ``cells/cell=...`` and ``centroids``.

    Null vectors, and those of another length than most, are not in it. Vectors are kept at unit length, zero ones as
    they are. Equal vectors lie in one cell, whose files Spark splits as any others.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE, seed: int = 5) -> VectorIndex:
        """Index all rows of ``vectors``. By default there are as many cells as the root of the number of vectors."""
        rows = vectors.where("emb is not null").withColumn("emb", X.l2_normalize(F.col("emb").cast("array<double>")))
        n = rows.count()
        h = F.pmod(F.xxhash64("emb", F.lit(seed)), F.lit(1_000_000))
        some = rows.where(h < max(1, min(1_000_000, 2_000_000 * sample // max(1, n)))).select("emb").limit(sample).collect()
        some = [r["emb"] for r in some if None not in r["emb"]]
        size = max({len(v) for v in some} or {0}, key=lambda k: sum(len(v) == k for v in some))
        centroids = fit(np.array([v for v in some if len(v) == size]).reshape(-1, size), cells or max(1, min(MOST_CELLS, math.isqrt(n))))
        shared = self.spark.sparkContext.broadcast(centroids)

        @F.pandas_udf("struct<cell int, similarity double>")
        def nearest(emb):
            import pandas as pd

            found = np.stack(emb.to_numpy()) @ shared.value.T
            return pd.DataFrame({"cell": found.argmax(1).astype("int32"), "similarity": found.max(1)})

        usable = rows.where((F.size("emb") == size) & ~F.exists("emb", lambda x: x.isNull()))
        placed = usable.withColumn("_n", nearest("emb")).select(*rows.columns, F.col("_n.similarity").alias("to_centroid"), F.col("_n.cell").alias("cell"))
        placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/cells")
        # a cell's radius: the least similarity of its vectors to the centroid
        radius = self._cells().groupBy("cell").agg(F.min("to_centroid").alias("least"), F.count(F.lit(1)).alias("n"))
        known = self.spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centroids)], "cell int, centroid array<double>")
        known.join(radius, "cell").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centroids")
        return self

    def _cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    def _nearest(self, vector: list[float]) -> list[tuple]:
        """(similarity to the centroid, highest similarity that a vector of the cell can have, cell, rows), the nearest first."""
        out, v = [], _unit(np.array([vector], np.float64))[0]
        for r in self.spark.read.parquet(f"{self.path}/centroids").collect():  # at most MOST_CELLS rows
            near = float(np.dot(v, r["centroid"]))
            angle = math.acos(max(-1.0, min(1.0, near))) - math.acos(max(-1.0, min(1.0, r["least"])))
            out.append((near, math.cos(max(0.0, angle)) + SLACK, r["cell"], r["n"]))
        return sorted(out, reverse=True)

    def _ranked(self, cells: list[int], vector: list[float], n: int) -> DataFrame:
        unit = _unit(np.array([vector], np.float64))[0].tolist()
        rows = self._cells().where(F.col("cell").isin(cells)).drop("to_centroid")
        scored = rows.withColumn("similarity", X.dot(F.col("emb"), F.array(*map(F.lit, unit))))
        return scored.orderBy(F.desc("similarity"), "id").limit(n)

    def search(self, vector: list[float], n: int = 300, probes: int = 16, exact: bool = False) -> DataFrame:
        """The ``n`` most similar rows, with their ``similarity``, equal ones by id.

        At least ``probes`` cells, and as many as hold ``n`` rows, are read. With ``exact``, those too in which something
        better than the n-th of these can be; a zero vector is always compared with all.
        """
        order, cells, held = self._nearest(vector), [], 0
        for _, _, cell, rows in order:
            if len(cells) >= probes and held >= n:
                break
            cells.append(cell)
            held += rows
        if exact and len(cells) < len(order):
            if any(vector):
                last = self._ranked(cells, vector, n).agg(F.min("similarity")).first()[0]
                cells = [cell for _, most, cell, _ in order if most >= last or cell in set(cells)]
            else:
                cells = [cell for _, _, cell, _ in order]
        return self._ranked(cells, vector, n)

    def cells_read(self, found: DataFrame) -> int:
        return found.select("cell").distinct().count()
