"""Cross-tokenizer alignment: how the tokens of two tokenizers cover the same bytes.

Exact-text deduplication.  Rows are shuffled by their full text and copies counted; each
distinct text is tokenised by both tokenizers and aligned once.  Tokens carry their byte
lengths; byte offsets where a token of A and one of B both end cut the text into groups, and
every stretch between two neighbouring token ends (of either) is one link: the one A token and
the one B token that cover it.  A text is stored as its ids and one step per link (1: the A
token ends, 2: the B token, 3: both).  Link counts of id pairs are weighted by the number of
copies of the text, added up inside the task and then by Spark.  Measures of a text need the
corpus-wide counts of its links: a bounded number of the most frequent pairs (``TOP``) is sent
to the tasks, links of any other pair join the count table.  Measures return to the rows by a
128-bit hash of the text.

Units.  Neither tokenizer merges across a blank that follows a non-blank character (A's pattern
starts a new piece there, and no piece of B holds its blank mark after another character; both
are checked when the vocabularies load), so a text is encoded by such units and each Python
worker keeps the encoding and alignment of recent short units.  A text one of whose units does
not give back its bytes is encoded as a whole.

Skew.  Copies are combined map-side before the shuffle by text, so a text with a third of all
rows is one row per task; the measures are a written table, so the join back reads two plain
exchanges that adaptive execution splits at a hot text.

Cases: texts that are NULL or empty, or whose joined bytes of either tokenizer differ from
blank + text, have no tokens: zeros and the empty string.  Repeated rows each get the result of
their text.  Strings of special tokens are ordinary text.  A very long text is encoded in slices
of its units; one unit without a blank is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, staged

#: Pairs whose counts are sent to every task: 17 bytes each, so 18 MB.
TOP = 1 << 20
#: Units that a worker remembers, the longest of them in characters, and units taken at a time.
MEMO, MEMO_CHARS, SLICE = 1 << 18, 64, 1 << 14
#: Links held or expanded at a time, about: a bound on what a task keeps beside its batch.
LINKS = 1 << 20
#: A blank that starts a unit: after a character that is no white space.
UNIT = re.compile(r"(?<=\S)(?= )")
#: Where a blank does not start a unit (``text`` stands after the added blank).
GLUED = re.compile(r"^ |\s ")
BLANK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies: itself where printable in
    Latin-1, else the next character from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(slots=True)
class Aligned:
    """Packed ids of both tokenizers, a step per link, the groups as text, copies not yet counted."""

    a: bytes
    b: bytes
    steps: bytes
    groups: bytes
    n: int = 0


def concat(parts: list[Aligned]) -> Aligned:
    return Aligned(
        b"".join([p.a for p in parts]),
        b"".join([p.b for p in parts]),
        b"".join([p.steps for p in parts]),
        b";".join([p.groups for p in parts]),
    )


def expand(parts: list, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Of alignments laid end to end: A id * 2^32 + B id of every link, and the links of each."""
    steps = np.frombuffer(b"".join([p.steps for p in parts]), np.uint8)
    a, b = (np.frombuffer(b"".join([getattr(p, f) for p in parts]), kind).astype(np.int64) for f in ("a", "b"))
    # a link belongs to the token whose number is how many tokens ended before it
    ends_a, ends_b = steps & 1, steps >> 1
    pairs = (a[np.cumsum(ends_a, dtype=np.int64) - ends_a] << 32) | b[np.cumsum(ends_b, dtype=np.int64) - ends_b]
    return pairs, np.array([len(p.steps) for p in parts], np.int64)


def sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[start], np.add.reduceat(counts, start)


class Tokenizers:
    """Both tokenizers and the bytes of their ids; remembers units and counts their links."""

    def __init__(self, byte_level: str, pieces: str, pattern: str):
        with open(byte_level, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        ids = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if ids != list(range(256, 256 + len(ids))):  # then merging by id is merging by the list of merges
            raise ValueError("the ids of a byte-level vocabulary must follow its merges")
        ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(ids)}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", n) for n in names):
            raise ValueError("a piece holds a blank after another character")
        self.a_size = [n for _, n in sorted((i, len(t)) for t, i in ranks.items())]
        self.b_bytes = [
            bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(BLANK, " ").encode() for i, n in enumerate(names)
        ]
        self.b_size = [len(t) for t in self.b_bytes]
        self.name = [str(i) for i in range(max(len(ranks), len(names)))]
        self.code, self.kind = ("H", "u2") if len(self.name) <= 1 << 16 else ("I", "u4")
        self.memo: dict[str, Aligned] = {}
        self.large: list[Aligned] = []  # counted, but not remembered
        self.links = 0  # in large

    def encode(self, text: str) -> Aligned | None:
        """Blank + text aligned, encoded as one; None where a tokenizer does not give it back."""
        a = self.a.encode_ordinary(" " + text)  # byte level: always gives its text back
        b = self.b.encode(text) if text else [self.b.piece_to_id(BLANK)]
        if b"".join([self.b_bytes[i] for i in b]) != (" " + text).encode():
            return None
        size_a, size_b, name = self.a_size, self.b_size, self.name
        steps, groups = [], []
        i = j = first_a = first_b = 0
        apart = size_a[a[0]] - size_b[b[0]]  # end of A's token less that of B's
        while True:
            if not apart:
                steps.append(3)
                i += 1
                j += 1
                if i - first_a == 1 == j - first_b:
                    groups.append(name[a[first_a]] + "|" + name[b[first_b]])
                else:
                    groups.append(",".join([name[x] for x in a[first_a:i]]) + "|" + ",".join([name[x] for x in b[first_b:j]]))
                if i == len(a):
                    break
                first_a, first_b = i, j
                apart = size_a[a[i]] - size_b[b[j]]
            elif apart < 0:
                steps.append(1)
                i += 1
                apart += size_a[a[i]]
            else:
                steps.append(2)
                j += 1
                apart -= size_b[b[j]]
        return Aligned(array(self.code, a).tobytes(), array(self.code, b).tobytes(), bytes(steps), ";".join(groups).encode())

    def unit(self, unit: str) -> Aligned | None:
        """A unit not remembered."""
        found = self.encode(unit)
        if found is not None and len(unit) <= MEMO_CHARS:
            self.memo[unit] = found
        elif found is not None:
            self.hold(found, 0)
        return found

    def hold(self, found: Aligned, n: int) -> None:
        found.n = n
        self.large.append(found)
        self.links += len(found.steps)

    def full(self) -> bool:
        return len(self.memo) > MEMO or self.links > LINKS

    def count(self) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, counts) of all links since the last call; forgets units seen once."""
        held = [e for e in self.memo.values() if e.n] + [e for e in self.large if e.n]
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(held), SLICE):
            pairs, links = expand(held[at : at + SLICE], self.kind)
            found = sums(pairs, np.repeat(np.array([e.n for e in held[at : at + SLICE]], np.int64), links))
            keys.append(found[0])
            counts.append(found[1])
        often = {u: e for u, e in self.memo.items() if e.n > 1} if len(self.memo) > MEMO // 2 else self.memo
        self.memo = often if len(often) <= MEMO // 2 else {}
        self.reset()
        return sums(np.concatenate(keys), np.concatenate(counts))

    def reset(self) -> None:
        for e in self.memo.values():
            e.n = 0
        self.large, self.links = [], 0

    def align(self, text: str, copies: int) -> Iterator[tuple | Aligned | None]:
        """Pair counts that must be handed on meanwhile, then the text's alignment (or None)."""
        if BLANK in text:  # B gives a blank back
            yield None
            return
        plain = not GLUED.search(text) and not text.endswith(" ")
        units = text.split(" ") if plain else [u[1:] for u in UNIT.split(" " + text)]
        parts = []
        for at in range(0, len(units), SLICE):
            found = [self.memo.get(u) or self.unit(u) for u in units[at : at + SLICE]]
            if None in found:  # the whole text decides; what was counted of it is taken back
                if parts:
                    self.hold(concat(parts), -copies)
                whole = self.encode(text)
                if whole is not None:
                    self.hold(whole, copies)
                yield whole
                return
            for e in found:
                e.n += copies
            parts.append(found[0] if len(found) == 1 else concat(found))
            if self.full():
                yield self.count()
        yield parts[0] if len(parts) == 1 else concat(parts)


_LOADED: dict[tuple[str, str, str], Tokenizers] = {}


def loaded(byte_level: str, pieces: str, pattern: str) -> Tokenizers:
    """One pair of tokenizers, with its units, per Python worker."""
    if (byte_level, pieces, pattern) not in _LOADED:
        _LOADED[byte_level, pieces, pattern] = Tokenizers(byte_level, pieces, pattern)
    return _LOADED[byte_level, pieces, pattern]


ALIGNED = (
    "k1 long, k2 long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a binary, b binary, steps binary, pairs array<long>, counts array<long>"
)
_TYPES = [*[pa.int64()] * 6, pa.string(), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2]
_NAMES = [f.split(" ")[0] for f in ALIGNED.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def align_texts(texts: DataFrame, byte_level: str, pieces: str, pattern: str) -> DataFrame:
    """Distinct texts (k1, k2, text, copies) -> a row per text with tokens, and rows that hold
    nothing but pair counts of the texts of their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = loaded(byte_level, pieces, pattern)
        tokenizers.reset()
        rows, held = [], 0

        def counted(found):
            return (None,) * 10 + tuple(found) if len(found[0]) else None

        for batch in batches:
            for k in range(batch.num_rows):
                k1, k2, text, copies = (batch.column(c)[k].as_py() for c in range(4))
                for found in tokenizers.align(text, copies):
                    if isinstance(found, tuple):
                        rows.append(counted(found))
                        held += 2 * len(found[0])
                    elif found is not None:
                        sha, size = hashlib.sha256(found.groups).hexdigest(), np.dtype(tokenizers.kind).itemsize
                        numbers = (len(found.a) // size, len(found.b) // size, found.steps.count(3), len(found.steps))
                        rows.append((k1, k2, *numbers, sha, found.a, found.b, found.steps, None, None))
                        held += len(found.steps)
                if held > LINKS:
                    yield _batch([r for r in rows if r])
                    rows, held = [], 0
        rows.append(counted(tokenizers.count()))
        if any(rows):
            yield _batch([r for r in rows if r])

    return texts.select("k1", "k2", "text", "copies").mapInArrow(run, ALIGNED)


def measure(aligned: DataFrame, top: pa.Table, kind: str) -> DataFrame:
    """(k1, k2, n_best, count_sum, rest): ``top`` (pair, n, best) gives the counts of the links of
    its pairs; ``rest`` lists the text's other pairs with how many links hold each."""
    order = np.argsort(top["pair"].to_numpy())
    keys, counts, best = (top[c].to_numpy()[order] for c in ("pair", "n", "best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.cumsum([len(x.as_buffer()) for x in batch.column(4)])
            ends = [0, *(np.flatnonzero(np.diff(lengths // LINKS)) + 1).tolist(), batch.num_rows]
            for start, end in zip(ends, ends[1:], strict=False):
                parts = [Aligned(*(batch.column(c)[k].as_py() for c in (2, 3, 4)), b"") for k in range(start, end)]
                pairs, links = expand(parts, kind)
                at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                first = np.cumsum(links) - links
                n = np.where(known, counts[at], 0) if len(keys) else np.zeros(len(pairs), np.int64)
                b = known & best[at] if len(keys) else known
                rest = [None] * len(parts)
                if not known.all():
                    for t in np.unique(np.searchsorted(first, np.flatnonzero(~known), "right") - 1).tolist():
                        mine = slice(first[t], first[t] + links[t])
                        rare, k = np.unique(pairs[mine][~known[mine]], return_counts=True)
                        rest[t] = [{"pair": p, "k": c} for p, c in zip(rare.tolist(), k.tolist(), strict=True)]
                out = [batch.column(c).slice(start, end - start) for c in (0, 1)]
                out += [pa.array(np.add.reduceat(x, first)) for x in (b.astype(np.int64), n)]
                out.append(pa.array(rest, pa.list_(pa.struct([("pair", pa.int64()), ("k", pa.int64())]))))
                yield pa.RecordBatch.from_arrays(out, ["k1", "k2", "n_best", "count_sum", "rest"])

    rows = aligned.where("k1 is not null").select("k1", "k2", "a", "b", "steps")
    return rows.mapInArrow(run, "k1 long, k2 long, n_best long, count_sum long, rest array<struct<pair:long,k:long>>")


def align(
    docs: DataFrame, byte_level: str, pieces: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", top: int = TOP
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``byte_level`` and ``pieces`` are vocabulary files that every executor has at these paths."""
    kind = loaded(byte_level, pieces, pattern).kind
    text = col(text_col).cast("string")
    hashes = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")]
    rows = docs.select(col(id_col).alias("doc_id"), text.alias("text"))
    distinct = rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies")).select(*hashes, "text", "copies")
    aligned = staged(align_texts(distinct, byte_level, pieces, pattern), "aligned", "zstd")

    listed = aligned.where("pairs is not null").select(F.inline(F.arrays_zip("pairs", "counts")))
    # texts that were counted by units and then taken back leave zeros
    counts = staged(listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")).where("n > 0"), "pair_counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    highest = counts.groupBy(b_id).agg(F.max("n").alias("most"))  # as many rows as B has ids
    counts = counts.withColumn("b", b_id).join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    frequent = counts.orderBy(F.desc("n"), "pair").limit(top).toArrow()

    measures = staged(measure(aligned, frequent, kind), "link_measures")
    found = aligned.where("k1 is not null").drop("a", "b", "steps", "pairs", "counts").join(measures.drop("rest"), ["k1", "k2"])
    if frequent.num_rows == top:  # there may be pairs beyond
        rest = measures.where("rest is not null").select("k1", "k2", F.inline("rest")).join(counts, "pair")
        rest = rest.groupBy("k1", "k2").agg(
            F.sum(F.col("n") * F.col("k")).alias("rest_sum"), F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("rest_best")
        )
        found = found.join(rest, ["k1", "k2"], "left").select(
            *[c for c in found.columns if c not in ("n_best", "count_sum")],
            (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"),
        )
    found = staged(found, "measures")  # a table of its own, so that the join below can be split at a hot text
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return (
        rows.select("doc_id", *hashes)
        .join(found, ["k1", "k2"], "left")
        .select(
            "doc_id",
            *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
            F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        )
    )
