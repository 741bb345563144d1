"""Mixing sources to target weights: subset-sum budget fitting.

Documents are counted by source and exact size.  Each source gets a target (its share of the
budget by weight, capped at ``repeat`` times its size, the excess reshared).  Whole passes over a
source come first; the rest of its target is a subset-sum problem over the counts by size: every
size contributes its proportional number of documents, a greedy pass brings the remainder under a
bound, and a bounded-knapsack dynamic programme finds the sizes that fill the remainder as
exactly as they can.  The documents of a size are taken in the order of a seeded hash.

Scale: the programme runs once per source on its histogram (one row per distinct size, never the
documents).  Selection does not rank a whole (source, size) group in one task: documents are
counted by (source, size, hash bucket), a running count over the buckets finds which buckets are
taken whole, and documents are ranked inside a bucket only.

Cases: NULL text has size 0 and takes 0 words; the NULL source is a source of its own, last in
order; an empty table gives an empty result; a source without words has target 0; rows that
repeat an id are separate documents, tied in hash order by id.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import WHITE, col, staged

#: Hash buckets per (source, size) group in the selection.
BUCKETS = 256
#: Largest remainder, in words, that the dynamic programme fills.
CAPACITY = 1 << 16


def word_count(text: Column) -> Column:
    """Number of words: gaps between words plus one (no array of words is kept)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+", -1))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], budget: float, repeat: float) -> DataFrame:
    """``sizes(source, source_size)`` -> plus ``target``; one row per source.

    The reshared targets are a water level: sources whose cap per weight lies below the level
    are full, the others get level times weight.  With sources in the order of cap per weight,
    the level that the first k full sources leave is a running sum away.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    ranked = sizes.withColumn("k", (F.row_number().over(order) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") + 1).cast("int"))
    ranked = ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(repeat)))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("w"), "k", F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (F.col("total") * F.lit(float(budget)) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))) / (
        F.col("weights") - F.coalesce(F.sum("w").over(filled), F.lit(0.0))
    )
    out = ranked.withColumns(
        {"total": F.sum("source_size").over(everything), "weights": F.sum("w").over(everything)}
    ).withColumn("level", level)
    # the first source that its cap does not fill fixes the level for all later ones
    last = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)
    out = out.withColumn("last", last["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("last") * F.col("w"), F.col("cap")))
    return out.select("source", "source_size", target.alias("target"))


def fill(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many items of each size to take so that their sum comes as near ``budget`` from below
    as the programme finds (exactly, whenever a subset reaches it from the proportional start)."""
    take = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = (counts * (budget / total)).astype(np.int64)
    rest = budget - int((sizes * take).sum())
    free = counts - take
    # greedy, largest first, down to what the programme fills; it should have half its capacity left,
    # but where larger sizes alone remain, every one that fits is taken
    for spare in (CAPACITY // 2, 0):
        for i in np.argsort(-sizes, kind="stable"):
            if rest <= CAPACITY:
                break
            if sizes[i]:
                n = min(int(free[i]), (rest - spare) // int(sizes[i]))
                if not spare:
                    n = min(n, -((CAPACITY - rest) // int(sizes[i])))  # no more than bring it to the programme
                if n > 0:
                    take[i] += n
                    free[i] -= n
                    rest -= n * int(sizes[i])
    rest_cap = min(rest, CAPACITY)
    # bounded knapsack: reach[s] = the last size used on the way to sum s (-1: not reached);
    # counts are split into powers of two, so a size with n items costs log n passes
    last = np.full(rest_cap + 1, -1, np.int64)
    last[0] = 0
    parts: list[tuple[int, int]] = [(0, 0)]
    for i in np.flatnonzero((free > 0) & (sizes > 0) & (sizes <= rest_cap)):
        n, step = min(int(free[i]), rest_cap // int(sizes[i])), 1
        while n > 0:
            step = min(step, n)
            w = step * int(sizes[i])
            if w <= rest_cap:
                reached = (last[:-w] >= 0) & (last[w:] < 0)
                parts.append((int(i), step))
                last[w:][reached] = len(parts) - 1
            n -= step
            step *= 2
        if last[rest_cap] >= 0:
            break
    s = int(np.flatnonzero(last >= 0).max())
    while s > 0:
        i, step = parts[last[s]]
        take[i] += step
        s -= step * int(sizes[i])
    return take


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size", kind="stable")
    sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    target, total = float(group["target"].iloc[0]), int((sizes * counts).sum())
    passes = int(target // total) if total else 0
    extra = fill(sizes, counts, int(round(target - passes * total)))
    return pd.DataFrame({"source": group["source"], "size": sizes, "passes": passes, "extra": extra})


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    budget: float = 1.5,
    repeat: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, text_key): one row per
    document; ``copies`` times the document is taken, ``taken`` = copies * size words."""
    slim = docs.select(
        col(id_col).alias("doc_id"),
        col(source_col).cast("string").alias("source"),
        word_count(col(text_col)).alias("size"),
        *[h.alias(n) for n, h in zip(("h", "h2"), _hashes(id_col, text_col, seed), strict=True)],
    ).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    slim = staged(slim, "mix_sizes")  # the texts are read once
    fine = slim.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    hist = fine.groupBy("source", "size").agg(F.sum("n").alias("n"))
    goal = staged(
        targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, budget, repeat),
        "mix_targets",
    )
    same = lambda l, r: F.col(f"{l}.source").eqNullSafe(F.col(f"{r}.source"))
    fitted = (
        hist.alias("l")
        .join(goal.alias("r"), same("l", "r"))
        .select("l.source", "size", "n", "target")
        .groupBy("source")
        .applyInPandas(_fit, "source string, size long, passes int, extra long")
    )
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        fine.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .alias("l")
        .join(fitted.alias("r"), same("l", "r") & (F.col("l.size") == F.col("r.size")))
        .select(
            "l.source", "l.size", "bucket", "passes",
            F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("before"))).alias("quota"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "h2", "doc_id"))
    picked = (
        slim.withColumn("rank", rank)
        .alias("l")
        .join(quota.alias("r"), same("l", "r") & (F.col("l.size") == F.col("r.size")) & (F.col("l.bucket") == F.col("r.bucket")))
        .select("doc_id", "l.source", "l.size", "h", "h2", (F.col("passes") + (F.col("rank") <= F.col("quota")).cast("int")).alias("copies"))
    )
    return (
        picked.alias("l")
        .join(goal.alias("r"), same("l", "r"))
        .select(
            "doc_id", "l.source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"), F.struct("h", "h2").alias("text_key"),
        )
    )


def _hashes(id_col: str, text_col: str, seed: int) -> tuple[Column, Column]:
    """128 bits of hash of a row's id and text: the first also deals the rows to buckets."""
    i, t = col(id_col), col(text_col)
    return F.xxhash64(F.lit(seed), i, t), F.xxhash64(F.lit("2"), F.lit(seed), t, i)


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, **options) -> DataFrame:
    """The documents of the mix: every row of ``docs`` as often as it is taken."""
    taken = staged(mix(docs, id_col, text_col, seed=seed, **options).where("copies > 0"), "mix_taken")
    # rows that agree in id and text are one key; their copies are dealt out in rank order
    ids = taken.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies"))
    key = F.struct(*[h.alias(n) for n, h in zip(("h", "h2"), _hashes(id_col, text_col, seed), strict=True)])
    nth = F.row_number().over(Window.partitionBy("text_key").orderBy("text_key"))
    # the row travels as a struct, so no column of it can clash with the key
    keyed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), key.alias("text_key"))
    counted = taken.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if counted == 0:  # the usual case: no two rows agree in id and text
        joined = keyed.withColumn("nth", F.lit(1))
    else:
        joined = keyed.withColumn("nth", nth)
    ids = ids.select("text_key", "copies")
    return (
        joined.join(ids.hint("shuffle_hash"), "text_key")
        .withColumn("times", F.coalesce(F.get("copies", F.col("nth") - 1), F.lit(0)))
        .where("times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*[F.col("row")[c].alias(c) for c in docs.columns])
    )
