"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact rerank.

Index.  On a bounded sample (``SAMPLE`` vectors of smallest hash) the driver centres the unit
vectors, takes their principal axes and learns by iterative quantisation the rotation that
brings them nearest to the corners of a cube; the signs are a balanced binary code of up to 64
bits.  The code is cut into ``m`` substrings, one Hamming table each; a pair is retrieved where
some substring differs in at most ``r`` bits.  (m, r) is fitted too: among the settings that
retrieve ``RECALL`` of pairs lying *at* the threshold (sample vectors turned by exactly that
angle), the cheapest for the number of vectors wins, so substrings lengthen with the corpus.
Every vector is indexed.

Retrieval and rerank.  A vector is stored under its own substring and probes those within ``r``
bits.  Label, table and substring form a bucket; fuller buckets than ``BLOCK`` are cut into cells
(block of stored rows x block of probing rows), so a task's work is bounded and nothing is
capped.  In a cell the cosine of every pair is computed in double precision from the original
vectors; a pair counts only in the first table that retrieves it, which the codes tell, so no
list of pairs is ever written: a cell returns a count per vector and a spanning forest.

Copies: equal vectors of a label are one entry with a multiplicity.

Cases: vectors that are NULL, zero, or hold NULL or non-finite components, and NULL labels, link
with nothing.  Vectors of different length never link.  Rows that repeat count each.  NULL ids
never name a component while another id can.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, components, staged

SAMPLE = 4096
ITERATIONS = 50
#: Share of pairs at the threshold that the fitted tables must retrieve.
RECALL = 0.96
#: Rows on either side of a cell.
BLOCK = 2048


@dataclass
class Index:
    mean: np.ndarray
    axes: np.ndarray  # [d, bits]: principal axes times the learned rotation
    cuts: list[tuple[int, int]]  # (first bit, bits) of each table
    radius: int

    def codes(self, unit: np.ndarray) -> np.ndarray:
        bits = (unit - self.mean) @ self.axes > 0
        return (bits.astype(np.uint64) << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def substrings(self, codes: np.ndarray) -> np.ndarray:
        """[n, tables]"""
        return np.stack([(codes >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in self.cuts], axis=1).astype(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(sample: np.ndarray, count: int, threshold: float, seed: int = 42) -> Index:
    """``sample``: unit vectors; ``count``: vectors in the largest label."""
    rng = np.random.default_rng(seed)
    n, d = sample.shape
    mean = sample.mean(axis=0)
    centred = sample - mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, : min(64, d)]
    bits = axes.shape[1]
    low = centred @ axes
    rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(ITERATIONS):
        corners = np.where(low @ rotation > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(corners.T @ low)
        rotation = (u @ vt).T
    # pairs exactly at the threshold
    side = rng.normal(size=sample.shape)
    side -= (side * sample).sum(axis=1, keepdims=True) * sample
    turned = threshold * sample + np.sqrt(max(0.0, 1 - threshold**2)) * side / np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    best = None
    for tables in range(1, bits + 1):
        edges = np.linspace(0, bits, tables + 1).astype(int)
        cuts = [(int(a), int(b - a)) for a, b in zip(edges, edges[1:], strict=False)]
        if cuts[0][1] > 24 and bits > 24:
            continue
        index = Index(mean, axes @ rotation, cuts, 0)
        apart = np.bitwise_count(index.substrings(index.codes(sample)) ^ index.substrings(index.codes(turned)))
        for radius in (0, 1):
            index = Index(mean, axes @ rotation, cuts, radius)
            recall = float((apart.min(axis=1) <= radius).mean())
            probes = sum(1 + radius * w for _, w in cuts)
            met = sum((1 + radius * w) * count / 2.0**w for _, w in cuts)
            cost = probes * 100 + met  # a row moved costs about a hundred comparisons
            if recall >= RECALL and (best is None or cost < best[0]):
                best = (cost, index)
    return best[1] if best else Index(mean, axes @ rotation, [(i, 1) for i in range(bits)], 0)


def _forest(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Group labels of the rows and columns of a bipartite relation, or of one square relation."""
    n, m = near.shape
    rows, cols = np.arange(n), (np.arange(m) if same else np.arange(n, n + m))
    while True:
        top = np.minimum(rows, np.where(near, cols[None, :], n + m).min(axis=1, initial=n + m))
        left = top if same else np.minimum(cols, np.where(near, top[:, None], n + m).min(axis=0, initial=n + m))
        if (top == rows).all() and (left == cols).all():
            return rows, cols
        rows, cols = top, left


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


def _verify(cell: pa.Table, index: Index, threshold: float) -> pa.Table:
    gid, role = cell["gid"].to_numpy(), cell["role"].to_numpy()
    table, copies = int(cell["t"][0].as_py()), cell["copies"].to_numpy()
    vectors, codes = unit(_vectors(cell["v"])), cell["code"].to_numpy().view(np.uint64)
    stored, probing = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    same = len(stored) == len(probing) == len(gid)
    parts, counts, edges = index.substrings(codes), np.zeros(len(stored), np.int64), []
    near = np.zeros((len(stored), len(probing)), bool)
    for s in range(0, len(stored), 512):
        rows = stored[s : s + 512]
        hit = vectors[rows] @ vectors[probing].T >= threshold
        hit &= gid[rows][:, None] != gid[probing][None, :]
        for t in range(table):  # retrieved by an earlier table: counted there
            hit &= np.bitwise_count(parts[rows, t][:, None] ^ parts[probing, t][None, :]) > index.radius
        near[s : s + 512] = hit
        counts[s : s + 512] = hit @ copies[probing]
    if near.any():
        left, right = _forest(near, same)
        names = gid[stored] if same else np.concatenate((gid[stored], gid[probing]))
        edges = [(gid[stored], names[left])] + ([] if same else [(gid[probing], names[right])])
    has = counts > 0
    a = np.concatenate([gid[stored][has], *[x[0] for x in edges]])
    b = np.concatenate([gid[stored][has], *[x[1] for x in edges]])
    n = np.concatenate([counts[has], np.zeros(len(a) - int(has.sum()), np.int64)])
    keep = (n > 0) | (a != b)
    return pa.table({"a": a[keep], "b": b[keep], "n": n[keep]})


def _link(entries: DataFrame, dim: int, threshold: float, block: int, sample: int) -> DataFrame:
    """Entries (gid, label, v, copies, ...) of one length -> (a, b, n): n counts of entry a = b,
    or an edge."""
    mine = entries.where(F.size("v") == dim)
    largest = mine.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    rows = mine.select("v", F.xxhash64("gid").alias("h")).orderBy("h").limit(sample).select("v").toArrow()
    index = fit(unit(_vectors(rows["v"])), largest, threshold)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per (entry, table, probed substring); role 1 stored, 2 probing, 3 both."""
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            codes = index.codes(unit(_vectors(whole["v"])))
            parts = index.substrings(codes)
            at, t, key, role = [], [], [], []
            for i, (_, width) in enumerate(index.cuts):
                for flip in [0] + [1 << b for b in range(width)] * index.radius:
                    at.append(np.arange(len(codes)))
                    t.append(np.full(len(codes), i))
                    key.append(parts[:, i] ^ flip)
                    role.append(np.full(len(codes), 2 if flip else 3))
            at = np.concatenate(at)
            out = whole.select(["gid", "label", "copies"]).take(at)
            for name, x in (("code", codes.view(np.int64)[at]), ("t", np.concatenate(t)), ("key", np.concatenate(key)), ("role", np.concatenate(role))):
                out = out.append_column(name, pa.array(x.astype(np.int64)))
            yield from out.to_batches()

    label = mine.schema["label"].dataType.simpleString()
    slim = mine.select("gid", "label", "copies", "v")
    keys = slim.mapInArrow(keyed, f"gid long, label {label}, copies long, code long, t long, key long, role long")
    keys = staged(keys, "hamming_keys")  # without the vectors, which join once the cells are known
    counts = keys.groupBy("label", "t", "key").agg(F.count("*").alias("n"), F.max(F.col("role") % 2).alias("stored"))
    # a bucket with one row, or with probing rows only, holds no pair
    counts = counts.where("n > 1 and stored = 1").select("label", "t", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = keys.join(counts, ["label", "t", "key"]).withColumn("own", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_stored = F.transform(others, lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(1).alias("role")))
    as_probing = F.transform(others, lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(2).alias("role")))
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("role").cast("int").alias("role")))
    cells = F.when(F.col("blocks") == 1, alone).when(F.col("role") == 3, F.concat(as_stored, as_probing)).otherwise(as_probing)
    dealt = placed.withColumn("cell", F.explode(cells)).select(
        "gid", "copies", "code", "label", "t", "key", "cell.i", "cell.j", F.col("cell.role").cast("long").alias("role")
    )
    full = dealt.join(mine.select("gid", "v"), "gid")
    return full.groupBy("label", "t", "key", "i", "j").applyInArrow(
        lambda cell: _verify(cell, index, threshold), "a long, b long, n long"
    )


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    block: int = BLOCK,
    sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = vectors.select(
        col(id_col).alias("vec_id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("v")
    ).withColumn("ok", F.col("label").isNotNull() & _valid(F.col("v")))
    keys = [F.xxhash64("label", "v").alias("k1"), F.xxhash64(F.lit(1), "label", "v").alias("k2")]
    good = rows.where("ok").select("vec_id", "label", "v", *keys)
    entries = good.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("v").alias("v")
    )
    entries = staged(entries.withColumn("gid", F.monotonically_increasing_id()), "vectors")
    dims = [r[0] for r in entries.select(F.size("v")).distinct().collect()]  # the lengths in use, one as a rule
    found = None
    for dim in sorted(dims):
        part = _link(entries, dim, threshold, block, sample)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = entries.select(F.col("gid").alias("a"), F.col("gid").alias("b"), F.col("copies").alias("n")).limit(0)
    found = staged(found, "vector_links")
    linked = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "gid")
    member = components(found.where("n = 0").select("a", "b")).select(F.col("node").alias("gid"), "root")
    member = member.unionByName(member.select(F.col("root").alias("gid"), "root").distinct())
    named = member.join(entries.select("gid", "first"), "gid").groupBy("root").agg(F.min("first").alias("component"))
    info = (
        entries.select("gid", "k1", "k2", "first", "copies")
        .join(linked, "gid", "left")
        .join(member.join(named, "root").select("gid", "component"), "gid", "left")
        .select(
            "k1", "k2",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    joined = good.select("vec_id", "k1", "k2").join(info, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
