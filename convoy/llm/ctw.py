"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

Text.  A text is its words, A-Z lowered, joined by one space and closed by an end byte, the same
events that the base score (a smoothed word unigram) counts.  A byte is eight binary decisions;
the decision at a path inside the byte, after the last d bytes of context, is a node.

Model.  Every node holds a Krichevsky-Trofimov estimator of its bit.  A node of depth d < D
weights its own estimate against the product of its children's (one more byte of context), half
and half: P_w = (P_e + prod P_w(child)) / 2.  The posterior odds ``beta = P_e / prod P_w(child)``
say how far prediction trusts the node against its deeper contexts; predicting walks from depth 0
down the context, mixing all depths by these odds, and ends at the deepest context that occurred.

Training is counting.  Tasks count (D context bytes, byte) grams of all texts, apart for those of
the training texts, and Spark adds them up.  Nodes of depth 2..D belong to one family of grams, those
with the same two nearest context bytes; a pass over the families derives the sums that depth 1
needs, depths 0 and 1 (at most 65,280 nodes) are added on the driver, and a second pass walks
every distinct gram from depth 0 down and writes its log probability.  Grams that only unseen
texts hold have no counts, which changes no node: an estimator without counts has probability 1.

Scoring adds up the log probabilities of a text's grams.  Those of the ``HEAD_GRAMS`` most frequent
grams are broadcast (a threshold found from a histogram); all others are joined, so what the
model knows grows with the corpus and no count is left out.

Base score.  Counts of the ``HEAD`` most frequent tokens are broadcast; all others are joined with
the token counts, so the vocabulary is never held whole.

Cases: NULL or empty text is the end alone.  Without training rows every bit has probability 1/2
and every token is unknown.  Long texts are scored in blocks, with no context lost.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, lower_words, staged

DEPTH = 5
#: Bounds on what is broadcast: grams and tokens.  Beyond them rows are joined.
HEAD_GRAMS, HEAD = 1 << 21, 1 << 17
#: Bytes counted or scored at a time; also bounds the distinct grams that a task holds while counting.
BLOCK = 1 << 18
#: Grams weighed at a time; a family of grams stays whole.
CHUNK = 1 << 16
END = b"\n"
_LN2 = float(np.log(2.0))


def stream(text: bytes | None) -> bytes:
    return b" ".join(lower_words(text)) + END


def _blocks(streams: Iterator[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, owner) of texts' streams: gram = the context bytes, nearest first, then the byte;
    owner = the text's place.  A text's first contexts are end bytes."""
    lead, held, size = END * depth, [], 0

    def grams(parts):
        """parts: (owner, lead and bytes); the lead only serves as context."""
        buffer = np.frombuffer(b"".join([p for _, p in parts]), np.uint8).astype(np.uint64)
        n = len(buffer) - depth
        key = buffer[depth - 1 : depth - 1 + n].copy()
        for k in range(2, depth + 1):
            key = (key << np.uint64(8)) | buffer[depth - k : depth - k + n]
        key = (key << np.uint64(8)) | buffer[depth:]
        lengths = np.array([len(p) for _, p in parts]) - depth
        counted = np.ones(n, bool)
        for start in (np.cumsum(lengths + depth) - depth)[:-1]:  # the leads of all but the first
            counted[start : start + depth] = False
        return key[counted], np.repeat([o for o, _ in parts], lengths)

    for owner, data in enumerate(streams):
        data = lead + data
        for s in range(depth, len(data), BLOCK):  # a piece of a long text has the bytes before it as lead
            piece = data[s - depth : s + BLOCK]
            held.append((owner, piece))
            size += len(piece)
            if size >= BLOCK:
                yield grams(held)
                held, size = [], 0
    if held:
        yield grams(held)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def count_grams(texts: DataFrame, depth: int) -> DataFrame:
    """(gram long, n long, learned long) over ``texts(text binary, training boolean)``: how often
    a gram occurs in all texts and in those to learn from; each task merges its blocks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def out(keys, counts):
            columns = [keys.view(np.int64), counts[:, 0].copy(), counts[:, 1].copy()]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "n", "learned"])

        for batch in batches:
            training = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for grams, owner in _blocks((stream(x.as_py()) for x in batch.column(0)), depth):
                keys, place = np.unique(grams, return_inverse=True)
                learned = np.bincount(place[training[owner]], minlength=len(keys))
                parts.append((keys, np.stack([np.bincount(place, minlength=len(keys)), learned], axis=1)))
                if sum(len(k) for k, _ in parts) > 2 * BLOCK:
                    parts = [_merged(parts)]
                    if len(parts[0][0]) > BLOCK:
                        yield out(*parts[0])
                        parts = []
        if parts:
            yield out(*_merged(parts))

    counted = texts.mapInArrow(run, "gram long, n long, learned long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("learned").alias("learned"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series after a shift by six)."""
    y = x + 6.0
    shift = sum(np.log(x + i) for i in range(6))
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that a KT estimator gives a sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - float(np.log(np.pi))


def _bit_nodes(contexts: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[n, 8] keys (context, path inside the byte) and bits of byte symbols."""
    k = np.arange(8, dtype=np.uint64)
    path = (np.uint64(1) << k) | (symbols[:, None] >> (np.uint64(8) - k))
    return (contexts[:, None] << np.uint64(8)) | path, ((symbols[:, None] >> (np.uint64(7) - k)) & np.uint64(1)).astype(bool)


def _families(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[list[np.ndarray]]:
    """The columns of batches sorted by gram, cut where the two nearest context bytes change, in
    pieces of about ``CHUNK`` grams."""
    shift = np.uint64(8 * (depth - 1))
    held, size, last = [], 0, None
    for batch in batches:
        if not len(batch):
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        columns[0] = columns[0].view(np.uint64)
        held.append(columns)
        size += len(batch)
        near = columns[0][-1] >> shift
        if size >= CHUNK and near != last:
            merged = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(merged[0] >> shift, near))
            if cut:
                yield [c[:cut] for c in merged]
            held, size = [[c[cut:] for c in merged]], size - cut
        last = near
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _odds(own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(own - deeper, -69, 69))


def _weigh(grams: np.ndarray, learned: np.ndarray, depth: int) -> tuple[dict[int, tuple], tuple]:
    """Whole families of distinct grams -> the nodes of depths 2 to ``depth`` as seen by the eight
    bits of every gram, {depth: (node of each bit, its count, probability of a one, beta)}, and
    what depth 1 needs of them: (keys, zeros, ones, sum of log P_w over the children)."""
    symbols, contexts, levels, below = grams & np.uint64(255), grams >> np.uint64(8), {}, None
    weights = np.repeat(learned, 8).astype(float)
    for d in range(depth, 0, -1):
        keys, bits = _bit_nodes(contexts >> np.uint64(8 * (depth - d)), symbols)
        nodes, place = np.unique(keys.ravel(), return_inverse=True)
        ones = np.bincount(place, weights * bits.ravel(), len(nodes))
        zeros = np.bincount(place, weights, len(nodes)) - ones
        if below is not None:
            child, log_pw = below
            parent = ((child >> np.uint64(16)) << np.uint64(8)) | (child & np.uint64(255))
            deeper = np.bincount(np.searchsorted(nodes, parent), log_pw, len(nodes))
            if d == 1:
                return levels, (nodes, zeros, ones, deeper)
        own = np.where(zeros + ones > 0, log_kt(zeros, ones), 0.0)
        beta = np.full(len(nodes), np.inf) if below is None else _odds(own, deeper)
        levels[d] = place.reshape(-1, 8), zeros + ones, (ones + 0.5) / (zeros + ones + 1.0), beta
        below = nodes, own if below is None else np.logaddexp(own, deeper) - _LN2
    raise ValueError("depth 2 or more")


def _walk(grams: np.ndarray, learned: np.ndarray, depth: int, top: list[tuple]) -> np.ndarray:
    """log10 P(byte | context) of whole families of distinct grams; ``top``: (count, probability
    of a one, beta) of the nodes of depths 0 and 1 by their keys."""
    levels, _ = _weigh(grams, learned, depth)
    symbols, contexts = grams & np.uint64(255), grams >> np.uint64(8)
    for d in (0, 1):
        nearest = contexts >> np.uint64(8 * (depth - 1)) if d else np.zeros_like(contexts)
        keys, bits = _bit_nodes(nearest, symbols)
        levels[d] = keys.astype(np.int64), *top[d]
    mixed, left, last = np.zeros(bits.shape), np.ones(bits.shape), np.full(bits.shape, 0.5)
    for d in range(depth + 1):
        place, count, p, beta = levels[d]
        seen = count[place] > 0  # a context that did not occur has no deeper one that did
        p = np.where(bits, p[place], 1.0 - p[place])
        share = left / (1.0 + beta[place])
        last = np.where(seen, mixed + left * p, last)
        mixed = np.where(seen, mixed + (left - share) * p, mixed)
        left = np.where(seen, share, left)
    return np.log10(last).sum(axis=1)


_FREE = np.uint64(2**64 - 1)


class Table:
    """A fixed-size hash table in arrays: unsigned keys to rows of numbers, by linear probing."""

    def __init__(self, capacity: int, width: int, kind):
        self.bits = max(4, int(np.ceil(np.log2(max(1, capacity)))) + 1)
        self.room = capacity
        self.keys = np.full(1 << self.bits, _FREE)
        self.values = np.zeros((1 << self.bits, width), kind)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct new keys; those beyond the capacity are left out."""
        keys, values = keys[: self.room], values[: self.room]
        self.room -= len(keys)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] == _FREE
            self.keys[at[free]] = keys[left[free]]  # of several at one slot the last stays
            mine = self.keys[at] == keys[left]
            self.values[at[mine]] = values[left[mine]]
            at, left = (at[~mine] + 1) & (len(self.keys) - 1), left[~mine]

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, values)"""
        at = self._slots(keys)
        there = self.keys[at]
        found = there == keys
        left = np.flatnonzero(~found & (there != _FREE))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at[left]]
            found[left] = there == keys[left]
            left = left[(there != keys[left]) & (there != _FREE)]
        return found, self.values[at]


class Head:
    """The broadcast grams: gram -> log10 of its probability.  What travels are the plain arrays; a
    worker builds the table at its first use."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        self.arrays, self.table = (grams, logs), None

    def get(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, log10)"""
        if self.table is None:
            (keys, logs), self.arrays = self.arrays, None
            self.table = Table(len(keys), 1, np.float64)
            self.table.put(keys, logs[:, None])
        found, values = self.table.get(grams)
        return found, values[:, 0]


def heaviest(df: DataFrame, weight: Column, limit: int) -> DataFrame:
    """The rows of largest weight, at most ``limit`` of them; rows of about the same weight (an
    eighth of a power of two) are in or out together.  Only a histogram reaches the driver."""
    binned = df.withColumn("__bin", F.floor(F.log2(weight) * 8))
    total, least = 0, None
    for r in binned.groupBy("__bin").count().orderBy(F.desc("__bin")).collect():  # under 600 bins
        total += r["count"]
        if total > limit:
            break
        least = r["__bin"]
    return binned.where(F.lit(False) if least is None else F.col("__bin") >= least).drop("__bin")


def gram_scores(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram long, n long, log10 double): every distinct gram of ``texts(text binary, training
    boolean)``, its count in all of them and its probability given the training texts."""
    if not 2 <= depth <= 6:
        raise ValueError("depth 2 to 6")
    grams = staged(count_grams(texts, depth), "grams")
    families = grams.repartition(F.shiftright("gram", 8 * (depth - 1))).sortWithinPartitions("gram")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _, learned in _families(batches, depth):
            _, (nodes, *values) = _weigh(keys, learned, depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.view(np.int64)), *map(pa.array, values)], ["node", "zeros", "ones", "deeper"]
            )

    # depth 1 is summed over the second context byte: at most 256 x 255 nodes; depth 0 follows
    low = families.where("learned > 0").mapInArrow(sums, "node long, zeros double, ones double, deeper double")
    low = low.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "deeper")]).toArrow()
    z1, o1, d1 = np.zeros((3, 1 << 16))
    for target, name in ((z1, "zeros"), (o1, "ones"), (d1, "deeper")):
        target[low["node"].to_numpy()] = low[name].to_numpy()
    own = np.where(z1 + o1 > 0, log_kt(z1, o1), 0.0)
    z0, o0, d0 = (x.reshape(256, 256).sum(axis=0) for x in (z1, o1, np.logaddexp(own, d1) - _LN2))
    top = [
        (z0 + o0, (o0 + 0.5) / (z0 + o0 + 1), _odds(np.where(z0 + o0 > 0, log_kt(z0, o0), 0.0), d0)),
        (z1 + o1, (o1 + 0.5) / (z1 + o1 + 1), _odds(own, d1)),
    ]
    sent = texts.sparkSession.sparkContext.broadcast(top)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, learned in _families(batches, depth):
            logs = _walk(keys, learned, depth, sent.value)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n), pa.array(logs)], ["gram", "n", "log10"])

    return staged(families.mapInArrow(walk, "gram long, n long, log10 double"), "gram_scores")


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token binary, n long), the end included, over ``texts(text binary)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"]
            )

        for batch in batches:
            for x in batch.column(0):
                counts.update(lower_words(x.as_py()))
            counts[END] += len(batch)
            if len(counts) > 1 << 19:
                yield out()
                counts.clear()
        if counts:
            yield out()

    return texts.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def score(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    head_grams: int = HEAD_GRAMS,
    head: int = HEAD,
) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)."""
    spark = docs.sparkSession
    slim = docs.select(
        col(id_col).alias("doc_id"), training.alias("training"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")
    )
    vocabulary = staged(count_tokens(slim.where("training").select("text")), "tokens")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bottom = max(total + 0.5 * (distinct + 1), 0.5)
    top = heaviest(vocabulary, F.col("n"), head).toArrow()
    known = dict(zip(top["token"].to_pylist(), np.log10((top["n"].to_numpy() + 0.5) / bottom).tolist(), strict=True))
    model = gram_scores(slim.select("text", "training"), depth)
    often = heaviest(model, F.col("n"), head_grams).select("gram", "log10").toArrow()
    sent = spark.sparkContext.broadcast((Head(often["gram"].to_numpy().view(np.uint64), often["log10"].to_numpy()), known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, frequent = sent.value
        get = frequent.get
        for batch in batches:
            tokens, sums, rest, n = [], [], [], len(batch)
            scores, sizes = np.zeros(n), np.zeros(n, np.int64)
            rare, rare_sizes = [np.zeros(0, np.uint64)], np.zeros(n, np.int64)

            def streams(texts, tokens=tokens, sums=sums, rest=rest):
                for x in texts:
                    words = lower_words(x.as_py())
                    yield b" ".join(words) + END
                    words.append(END)
                    logs = list(map(get, words))
                    tokens.append(len(words))
                    rest.append([w for w, v in zip(words, logs, strict=True) if v is None] if None in logs else [])
                    sums.append(sum(filter(None, logs)))

            for grams, owner in _blocks(streams(batch.column(2)), depth):
                found, logs = grams_of.get(grams)
                scores += np.bincount(owner, np.where(found, logs, 0.0), n)
                sizes += np.bincount(owner, minlength=n)
                rare.append(grams[~found])  # owners ascend
                rare_sizes += np.bincount(owner[~found], minlength=n)
            offsets = np.concatenate(([0], np.cumsum(rare_sizes))).astype(np.int32)
            rare_grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rare).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(sums, pa.float64()),
                    pa.array(rest, pa.list_(pa.binary())), pa.array(scores), rare_grams, pa.array(sizes),
                ],
                ["doc_id", "training", "n_tokens", "head_sum", "rare", "head_score", "rare_grams", "size"],
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    scored = slim.mapInArrow(
        run,
        f"doc_id {kind}, training boolean, n_tokens long, head_sum double, rare array<binary>, head_score double, "
        "rare_grams array<long>, size long",
    )
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode("rare").alias("token")).join(vocabulary, "token", "left")
    tail = rare.groupBy("row").agg(
        F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(bottom))).alias("tail_sum"),
        F.sum(F.col("n").isNull().cast("long")).alias("unknown"),
    )
    # a gram outside the head is rare, so neither side of this join has a hot key
    others = scored.select("row", F.explode("rare_grams").alias("gram")).join(model.select("gram", "log10"), "gram")
    deep = others.groupBy("row").agg(F.sum("log10").alias("tail_score"))
    out = scored.drop("rare", "rare_grams").join(tail, "row", "left").join(deep, "row", "left")
    whole = F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))
    return out.select(
        "doc_id",
        "training",
        "n_tokens",
        (F.col("n_tokens") - F.coalesce("unknown", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0))).alias("base_score"),
        whole.alias("score"),
        (-whole / F.log10(F.lit(2.0)) / F.greatest("size", F.lit(1))).alias("bits_per_byte"),
    )
