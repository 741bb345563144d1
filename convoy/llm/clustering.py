"""Centroid clustering: dimension-sharded Lloyd on exact integers.

A vector becomes integers floor(scale * x) and is cut into column blocks of ``width`` dimensions;
a block of every vector is a shard.  In a round, tasks over a shard's rows compute the exact
partial squared distances of their columns to the same columns of every centroid (a task needs a
slice of the centroids, never the whole of a vector); the partial distances are added by key
over the shards and the nearest centroid is taken (ties: the smaller number).  Each shard then
joins the assignment and sums its own columns by cluster, which gives its slice of the next
centroids, floor(sum / count).

Scale.  Blocks are written once and read in every round; a round shuffles the partial distances
(k longs a vector and shard) and the join of the shards with the assignment.  Keys are row
numbers, one per vector, so that copies of one vector spread like all others; sums by cluster are
combined in the map tasks, so a cluster with most of the rows moves one row per task.  The driver
holds k centroids and nothing that grows with the vectors.  Assignments and results are tables in
the shared folder, so a lost executor re-reads files.

Cases: vectors that are NULL, of another length, or with a NULL or non-finite component are left
out.  So are those with an integer beyond +-2^26, for which a squared distance may not fit a
long.  Rows that repeat an id are vectors of their own (among equal ids the smaller vector starts
first); a NULL id counts as the empty text in the hash that picks the first centroids.  Fewer
vectors than ``k`` give as many centroids; a table without vectors gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, staged

#: Largest integer component: 64 dimensions of (2 * LARGEST)^2 stay below 2^63.
LARGEST = 1 << 26


def _integers(vector: Column, scale: int) -> Column:
    """array<long> of floor(scale * x) with x as double, out of range or not finite as NULL."""
    scaled = F.transform(vector.cast("array<double>"), lambda x: x * F.lit(float(scale)))
    return F.transform(scaled, lambda x: F.when(F.abs(x) <= LARGEST, F.floor(x)))  # false for NaN


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def partial_distances(blocks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """(gid, d0 .. dk-1): of every block, the squared distances of its columns."""
    slices = {s: centroids[:, s * width : (s + 1) * width] for s in range(-(-centroids.shape[1] // width))}
    names = [f"d{j}" for j in range(len(centroids))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column(1).to_numpy()
            out = np.empty((len(shard), len(names)), np.int64)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                columns = _matrix(batch.column(2).take(pa.array(at)))
                for j, centre in enumerate(slices[s]):
                    off = columns - centre
                    out[at, j] = np.einsum("ij,ij->i", off, off)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(d) for d in out.T]], ["gid", *names])

    return blocks.select("gid", "shard", "part").mapInArrow(run, "gid long, " + ", ".join(f"{n} long" for n in names))


def assign(blocks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """(gid, cluster, distance): partial distances added by key, then the nearest centroid."""
    names = [f"d{j}" for j in range(len(centroids))]
    whole = partial_distances(blocks, centroids, width).groupBy("gid").agg(*[F.sum(n).alias(n) for n in names])
    nearest = F.array_min(F.array(*[F.struct(F.col(n).alias("distance"), F.lit(j).alias("cluster")) for j, n in enumerate(names)]))
    return whole.select("gid", nearest.alias("nearest")).select("gid", "nearest.cluster", "nearest.distance")


def update(blocks: DataFrame, assigned: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """The next centroids: every shard sums its own columns by cluster; k x dimensions come back."""
    dims = min(width, centroids.shape[1])
    sums = [F.sum(F.get("part", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    rows = blocks.join(assigned.select("gid", "cluster"), "gid").groupBy("shard", "cluster").agg(F.count("*").alias("n"), *sums)
    nxt = centroids.copy()
    for r in rows.collect():  # k rows a shard
        for i in range(dims):
            if r[f"s{i}"] is not None:
                nxt[r["cluster"], r["shard"] * width + i] = int(r[f"s{i}"]) // r["n"]
    return nxt


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
    width: int = 16,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    rows = vectors.select(col(id_col).alias("vec_id"), _integers(col(vector_col), scale).alias("v"))
    rows = rows.where((F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull()))
    rows = staged(rows.withColumn("gid", F.monotonically_increasing_id()), "kept_vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    if not first:
        return _result(rows, rows.select("gid", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [])
    centroids = np.array([r["v"] for r in sorted(first)], np.int64)
    parts = [
        F.struct(F.lit(s).alias("shard"), F.slice("v", s * width + 1, width).alias("part")) for s in range(-(-dims // width))
    ]
    blocks = staged(rows.select("gid", F.inline(F.array(*parts))), "column_blocks")
    for _ in range(rounds):
        assigned = staged(assign(blocks, centroids, width).select("gid", "cluster"), "assigned")
        nxt = update(blocks, assigned, centroids, width)
        if (nxt == centroids).all():  # a fixed point: all further rounds repeat it
            break
        centroids = nxt
    final = staged(assign(blocks, centroids, width), "assigned")
    return _result(rows, final, [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])


def _result(rows: DataFrame, final: DataFrame, hashes: list[str]) -> DataFrame:
    spark = rows.sparkSession
    inertia = {r["cluster"]: int(r["s"]) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(inertia.values())
    clusters = spark.createDataFrame(
        [(c, s, total, hashes[c]) for c, s in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    named = final.join(F.broadcast(clusters), "cluster")  # k rows
    return rows.select("gid", "vec_id").join(named, "gid").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
