"""Centroid clustering of integer vectors with a table of distances to fixed pivots (LAESA).

Every vector's distances to a few pivots are measured once and stored beside it. In each round the
pivots' distances to the centroids are measured, a few hundred numbers; by the triangle inequality no
centroid is nearer to a vector than the difference of their distances to any pivot. A vector takes its
centroids by rising bound and measures them in whole numbers until the next bound is beyond the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.session import cut_lineage

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 8
#: Pivots are spread over this many vectors, those of smallest hash.
PIVOT_SAMPLE = 256
#: Components reach no further, so that squared distances fit 64 bits.
LARGEST = 1 << 27
#: Vectors that a task measures at a time.
_AT_ONCE = 4096


def quantised(vector: Column, scale: int = SCALE, dimensions: int = DIMENSIONS) -> Column:
    """floor(scale * x) of each component; null unless all of exactly so many components are finite numbers."""
    wide = lambda x: scale * x.cast("double")
    finite = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    small = F.forall(vector, lambda x: F.abs(wide(x)) < LARGEST)
    refused = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<int>")
    whole = F.transform(vector, lambda x: F.floor(wide(x)).cast("int"))
    return F.when((F.size(vector) == dimensions) & finite, F.when(small, whole).otherwise(refused))


def spread(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` of some vectors: the first, then always the one farthest from those taken."""
    taken, apart = [], None
    for _ in range(min(count, len(vectors))):
        at = 0 if apart is None else int(apart.argmax())
        taken.append(at)
        new = _squares(vectors, vectors[at])
        apart = new if apart is None else np.minimum(apart, new)
    return vectors[taken]


def _squares(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    differ = vectors - others
    return np.einsum("...i,...i->...", differ, differ)


def nearest(
    vectors: np.ndarray, away: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of each vector, the smaller of equals, its squared distance, and how
    many distances were measured. `away` holds the vectors' distances to the pivots."""
    far = np.sqrt(_squares(centroids[:, None, :], pivots[None, :, :]).astype(np.float64))
    bound = np.zeros((len(vectors), len(centroids)))
    for p in range(len(pivots)):
        # a margin above what rounding may add
        gap = np.abs(away[:, p, None] - far[None, :, p]) - 1e-9 * (away[:, p, None] + far[None, :, p])
        np.maximum(bound, gap, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best, number = np.full(len(vectors), np.iinfo(np.int64).max), np.full(len(vectors), len(centroids))
    measured, rows = 0, np.arange(len(vectors))
    for step in range(len(centroids)):
        rows = rows[bound[rows, order[rows, step]] <= np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-9) + 1e-6]
        if not len(rows):
            break
        measured += len(rows)
        taken = order[rows, step]
        distance = _squares(vectors[rows], centroids[taken])
        better = (distance < best[rows]) | ((distance == best[rows]) & (taken < number[rows]))
        best[rows[better]], number[rows[better]] = distance[better], taken[better]
    return number, best, measured


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, _AT_ONCE):
            yield batch.slice(low, _AT_ONCE)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(kind)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """`vectors` has id and q; adds away, the distances to the pivots. Written once, read in every round."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            q = _matrix(part.column("q"), np.int64)
            away = np.stack([np.sqrt(_squares(q, p).astype(np.float64)) for p in pivots], axis=1)
            listed = pa.ListArray.from_arrays(np.arange(0, away.size + 1, len(pivots), dtype=np.int32), away.ravel())
            yield pa.RecordBatch.from_arrays([*part.columns, listed], names=[*part.schema.names, "away"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("away", T.ArrayType(T.DoubleType()))])
    return cut_lineage(vectors.mapInArrow(measure, schema))


def _cluster_sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of the vectors nearest to each centroid that has any.

    A task adds its own vectors up first; what reaches the driver is one number a centroid and component.
    """
    size = centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), size), np.int64)
        for part in _batches(batches):
            q = _matrix(part.column("q"), np.int64)
            number, _, _ = nearest(q, _matrix(part.column("away"), np.float64), centroids, pivots)
            count += np.bincount(number, minlength=len(centroids))
            np.add.at(sums, number, q)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(count[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = table.select("q", "away").mapInArrow(add, "cluster long, n long, sums array<bigint>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    totals = each.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in totals.orderBy("cluster", "place").collect():
        found.setdefault(r.cluster, (r.n, []))[1].append(int(r.total))
    return found


def _first_vectors(vectors: DataFrame, count: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in this order; equal ids by their components."""
    code = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(code.alias("code"), "q").orderBy("code", "q").limit(count).collect()
    return np.array([r.q for r in rows], np.int64)


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid (array of its cluster's final components).

    Components x become floor(scale * x). Vectors that are null, of another length, or hold null or
    non-finite components take no part; one with a component too large for exact 64-bit distances stops
    the job with a message. Centroids start as the vectors with the smallest SHA-256 of `1:<vec_id>` (fewer
    than `clusters` vectors: all of them); each round replaces them by the floor of their vectors' mean,
    empty ones stay. Equal distances go to the smaller number. Repeated rows and ids each take part, a null
    id hashes as an empty one and stays null; other columns do not matter; no vectors give no rows.
    """
    taken = vectors.select(
        F.col(id_column).alias("id"), quantised(F.col(vector_column), scale, dimensions).alias("q")
    ).where("q is not null")
    first = _first_vectors(taken, max(clusters, PIVOT_SAMPLE))
    centroids = first[:clusters]
    out = "id {}, cluster int, distance long".format(taken.schema["id"].dataType.simpleString())
    if not len(first):
        return _finished(taken.selectExpr("id", "0 AS cluster", "0L AS distance"), centroids)
    fixed = spread(first, pivots)
    table = pivot_table(taken, fixed)
    for _ in range(rounds):
        sums = _cluster_sums(table, centroids, fixed)
        centroids = np.array(
            [[t // sums[k][0] for t in sums[k][1]] if k in sums else c.tolist() for k, c in enumerate(centroids)], np.int64
        )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            q = _matrix(part.column("q"), np.int64)
            number, distance, _ = nearest(q, _matrix(part.column("away"), np.float64), centroids, fixed)
            columns = [part.column("id"), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return _finished(cut_lineage(table.mapInArrow(assign, out)), centroids)


def _finished(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Sums over clusters, at most one row each, and centroids are joined to the assigned vectors."""
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    listed = ",".join(f"array({','.join(f'{x}L' for x in c)})" for c in centroids.tolist())
    centroid = F.get(F.expr(f"cast(array({listed}) AS array<array<bigint>>)"), F.col("cluster"))
    each = F.broadcast(sums.withColumn("centroid", centroid))  # a row a cluster
    return assigned.join(each, "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def cluster_digests(clustered: DataFrame) -> DataFrame:
    """`cluster` with centroid_sha256, of the components joined by commas, in the centroid's place."""
    joined = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return clustered.withColumn("centroid_sha256", F.sha2(joined.cast("binary"), 256)).drop("centroid")
