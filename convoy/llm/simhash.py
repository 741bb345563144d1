"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints: the 64-bit majority of the XXH64 hashes of a text's word shingles.  Two documents
link when their fingerprints differ in at most three bits; a component is a set of documents
connected by links.

Retrieval.  A fingerprint is cut into four 16-bit segments.  Three errors cannot reach all four
segments, and pigeonhole gives more: whatever the errors, some segment z is free of them while
its cyclic successor s(z) has at most one.  (If the three errors sit in three segments, the
fourth is z and its successor has one.  Otherwise at most one segment has two or more; of the
error-free segments, of which there are at least two, only one can have that bad one as its
successor.)  So each fingerprint gets keys (z, exact segment z, codeword of segment s(z)).  The
codeword comes from the binary Golay code [23, 12, 7], in which every word lies within three
bits of exactly one codeword: a segment is padded to 23 bits and decoded to the indices of *all*
codewords within four bits, 1 or 6 of them.  Two segments that differ in one bit share such a
codeword (the nearest one of either is within four bits of the other), so every pair to be found
shares a key: no link is missed, and unrelated fingerprints rarely meet on these 28-bit keys.

Join and verify.  Only distinct fingerprints are joined, so exact copies cost nothing.  A key
with up to ``BUCKET`` fingerprints is verified within its group, which yields a spanning forest
of the links (never all pairs).  The fingerprints of fuller keys are joined exactly in another
way, linear in their number: x and y are within three bits exactly when some word lies within one
bit of x and two of y.  Each fingerprint lists its 2081 words at distance two or less; all fingerprints that meet at a word that lies within one bit of one of them are connected through it.
``BUCKET`` only divides the two exact ways.

Cases: NULL or wordless text has fingerprint zero and links like any other; fewer words than the
shingle length give one shingle; repeated shingles count each time.  Rows repeat in the result as
in the input; a NULL id never names a component unless all ids of it are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, components, lower_words, staged

#: Most fingerprints of one key that are verified against each other in one group.
BUCKET = 1024
#: Shingles hashed at a time; bounds memory on long texts.
CHUNK = 1 << 16

# Fixed value: generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        s, e = starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist()
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(s, e, strict=True)), np.uint64, len(s))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def text_key(id_col: str, text_col: str) -> Column:
    """128 bits of hash of a row's id and text, as two numbers."""
    return F.struct(
        F.xxhash64(col(id_col), col(text_col)).alias("h1"), F.xxhash64(F.lit("2"), col(text_col), col(id_col)).alias("h2")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_key struct, fp long): the fingerprint's bits as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(2)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    slim = docs.select(
        col(id_col).alias("doc_id"),
        text_key(id_col, text_col).alias("text_key"),
        col(text_col).cast("string").cast("binary").alias("text"),
    )
    types = {c: slim.schema[c].dataType.simpleString() for c in ("doc_id", "text_key")}
    return slim.mapInArrow(run, f"doc_id {types['doc_id']}, text_key {types['text_key']}, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator: the code's syndromes."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1 == 1, r ^ (GOLAY << (bit - 11)), r)
    return r


def error_patterns() -> np.ndarray:
    """[syndrome, 6]: the error patterns of weight 4 or less behind a syndrome; unused places repeat the first."""
    from itertools import combinations

    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        words = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)], np.int64)
        for syndrome, word in zip(_remainder(words).tolist(), words.tolist(), strict=True):
            found[syndrome].append(word)
    return np.array([f + f[:1] * (6 - len(f)) for f in found], np.int64)


def segments(fps: np.ndarray) -> np.ndarray:
    """[n, 4] 16-bit segments of unsigned fingerprints."""
    return ((fps[:, None] >> np.array([0, 16, 32, 48], np.uint64)) & np.uint64(0xFFFF)).astype(np.int64)


def golay_keys(fps: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in fps, key) of every key of every fingerprint, each key once."""
    seg = segments(fps)
    near = patterns[_remainder(seg)]  # [n, 4, 6]
    words = (seg[:, :, None] ^ near) >> 11  # a codeword's index is its 12 data bits
    fresh = np.ones(words.shape, bool)
    fresh[:, :, 1:] = near[:, :, 1:] != near[:, :, :1]
    after = np.array([1, 2, 3, 0])
    key = (np.arange(4)[None, :, None] << 28) | (seg[:, :, None] << 12) | words[:, after]
    keep = fresh[:, after]
    return np.broadcast_to(np.arange(len(fps))[:, None, None], keep.shape)[keep], key[keep]


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(position, position of its group's first) over links within ``distance`` bits."""
    n = len(fps)
    if n == 2:
        return [(1, 0)] if (int(fps[0]) ^ int(fps[1])).bit_count() <= distance else []
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    root = np.arange(n)
    while True:
        low = np.where(near, root[None, :], n).min(axis=1)
        low = low[low]
        if (low == root).all():
            return [(i, int(r)) for i, r in enumerate(root.tolist()) if r != i]
        root = low


def _linked_in_groups(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups, a, b = batch.column(0), [], []
        flat = groups.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(groups.value_lengths().to_numpy(zero_copy_only=False))
        for s, e in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
            for i, r in forest(flat[s:e].view(np.uint64), distance):
                a.append(flat[s + i])
                b.append(flat[s + r])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _ball(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """(word, fp, core): the words within the larger half of ``distance`` of each fingerprint;
    core: within the smaller half."""
    from itertools import combinations

    outer, inner = distance - distance // 2, distance // 2
    masks = [sum(1 << b for b in c) for weight in range(outer + 1) for c in combinations(range(64), weight)]
    core = np.array([m.bit_count() <= inner for m in masks])
    flips = np.array(masks, np.uint64)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for s in range(0, len(fps), 64):
            part = fps[s : s + 64]
            words = (part[:, None] ^ flips[None, :]).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(np.repeat(part.view(np.int64), len(flips))), pa.array(np.tile(core, len(part)))],
                ["word", "fp", "core"],
            )


def links(distinct: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints ``distinct(fp)`` within ``distance``
    bits (at most three) of each other, directly or through others."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys guarantee pairs up to three bits apart")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = error_patterns()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, key = golay_keys(fps, patterns)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[at].view(np.int64))], ["key", "fp"])

    keys = distinct.select("fp").mapInArrow(keyed, "key long, fp long")
    keys = staged(keys, "golay_keys")
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # groups that several keys share are verified once
    groups = (
        keys.join(counts.where(F.col("n") <= bucket).select("key"), "key")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .select("fps")
        .distinct()
    )
    found = groups.mapInArrow(lambda batches: _linked_in_groups(batches, distance), "a long, b long")
    crowded = keys.join(counts.where(F.col("n") > bucket).select("key"), "key").select("fp").distinct()
    if crowded.isEmpty():
        return found.distinct()
    ball = staged(crowded, "crowded").mapInArrow(lambda batches: _ball(batches, distance), "word long, fp long, core boolean")
    # the smallest fingerprint that has the word in its core reaches all that meet there
    hubs = ball.groupBy("word").agg(F.min(F.when(F.col("core"), F.col("fp"))).alias("hub"), F.count("*").alias("n"))
    met = ball.join(hubs.where("hub is not null and n > 1").select("word", "hub"), "word")
    return found.unionByName(met.select(F.col("fp").alias("a"), F.col("hub").alias("b")).where("a <> b")).distinct()


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int, bucket: int) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id), one row per input row; root: the component's
    smallest fingerprint, which names it whatever its ids are."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = components(links(distinct, distance, bucket)).select(F.col("node").alias("fp"), "root")
    # roots are nodes of their own component
    member = member.unionByName(member.select(F.col("root").alias("fp"), "root").distinct())
    named = member.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component"))
    known = member.join(named, "root").select("fp", "root", "component")
    label = distinct.join(known, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "first").alias("component_id")
    )
    # a table of its own, so that the join below reads two plain exchanges and can split a hot fingerprint
    label = staged(label, "labels")
    return fps.join(label, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row; component_id is the smallest
    id among documents connected by links of at most ``distance`` bits."""
    out = _labelled(docs, id_col, text_col, shingle, distance, bucket)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """``docs`` with one row of each component: its smallest id (of rows that share that id, one)."""
    rows = staged(_labelled(docs, id_col, text_col, shingle, distance, bucket), "labelled")
    first = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # several rows only where an id repeats or is NULL: one text of them stays, and one row of that text
    one = first.groupBy("root").agg(F.min("text_key").alias("text_key"), F.count("*").alias("n"))
    # the row travels as a struct, so no column of it can clash with the key
    keyed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), text_key(id_col, text_col).alias("text_key"))
    kept = keyed.join(one.select("text_key").distinct().hint("shuffle_hash"), "text_key", "left_semi")
    if not one.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["text_key"])
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
