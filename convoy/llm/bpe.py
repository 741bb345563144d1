"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is split into pieces by the vocabulary's pattern; each piece is an element of a monoid of
token sequences.  A short piece is merged directly.  A long one is encoded in halves,
recursively, and two neighbours are joined by re-encoding a window around their boundary: the
last tokens of the left and the first of the right.  The window grows until the pair of tokens
at each of its ends is *compatible*, that is, encoding the two tokens' bytes together gives the
same two tokens.  A sequence in which all neighbours are compatible is the only encoding of its
bytes, so from then on nothing outside the window can change.  Decoding concatenates the tokens'
bytes up a tree over the ids.

Work: n log n merges in the length of a piece instead of the quadratic re-scan of a plain merge
loop; each Python worker keeps a bounded memo of short pieces.

Cases: NULL is the empty text (no ids); white space, lone symbols and very long pieces take the
same path; any Unicode text round-trips.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col

#: Pieces up to this many bytes are merged directly, longer ones in halves.
LEAF = 48
#: Memoised pieces per Python worker, and the longest piece that is memoised, in characters.
MEMO, MEMO_CHARS = 1 << 19, 32


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Bpe(dict):
    """A vocabulary; as a dict, the memo from a short piece to its packed ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """The defining procedure: merge the pair of lowest rank, leftmost first, until none merges."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        get, none = self.ranks.get, len(self.ranks) + 1
        at = list(range(len(data) + 1))  # the parts' boundaries
        rank = [get(data[i : i + 2], none) for i in range(len(data) - 1)]  # of each two neighbours
        while rank and (least := min(rank)) != none:
            i = rank.index(least)
            del at[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(data[at[i] : at[i + 2]], none)
            if i:
                rank[i - 1] = get(data[at[i - 1] : at[i + 1]], none)
        return [self.ranks[data[s:e]] for s, e in zip(at, at[1:], strict=False)]

    def compatible(self, a: int, b: int) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            got = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.pairs) < MEMO:
                self.pairs[a, b] = got
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of two encoded neighbours."""
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        i, j = 1, 1  # tokens of the window on either side
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            data = b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j]))
            window = self.merge(data)
            ok_left = i == len(left) or self.compatible(left[-i - 1], window[0])
            ok_right = j == len(right) or self.compatible(window[-1], right[j])
            if ok_left and ok_right:
                return left[: len(left) - i] + window + right[j:]
            i, j = i * 2 if not ok_left else i, j * 2 if not ok_right else j

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merge(data) if data else []
        # bottom up, so that the depth of the tree never meets Python's recursion limit
        level = [self.merge(data[k : k + LEAF]) for k in range(0, len(data), LEAF)]
        while len(level) > 1:
            joined = [self.join(level[k], level[k + 1]) for k in range(0, len(level) - 1, 2)]
            level = joined + level[len(level) - len(level) % 2 :]
        return level[0]

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        packed = np.asarray([whole] if whole is not None else self.tree(data), "<u4").tobytes()
        if len(piece) <= MEMO_CHARS and len(self) < MEMO:
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.split(text or "")))

    def decode(self, packed: bytes) -> bytes:
        tokens = list(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        while len(tokens) > 1:  # up a tree of 4096 children a node
            tokens = [b"".join(tokens[k : k + 4096]) for k in range(0, len(tokens), 4096)]
        return tokens[0] if tokens else b""


_LOADED: dict[tuple[str, str], Bpe] = {}


def loaded(vocabulary: str, pattern: str) -> Bpe:
    """One vocabulary, with its memo, per Python worker."""
    if (vocabulary, pattern) not in _LOADED:
        _LOADED[vocabulary, pattern] = Bpe(load_ranks(vocabulary), pattern)
    return _LOADED[vocabulary, pattern]


#: Ids per output batch, about: a bound on what a task holds beside its input batch.
BATCH_IDS = 1 << 20


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True
) -> DataFrame:
    """(doc_id, n_tokens, ids array<int> or NULL, ids_sha256, decoded_sha256) of every row.

    ``vocabulary`` is a rank file that every executor has at this path (a parameter, part of the
    installed tokenizer package); each Python worker loads it once.  The decoded bytes
    are those of the ids, decoded again after encoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary, pattern)
        for batch in batches:
            ids_of, texts = batch.column(0), batch.column(1)
            done, held, kept, counts, shas, back = 0, 0, [], [], [], []

            def flush(stop, ids_of=ids_of):
                nonlocal done, held, kept, counts, shas, back
                out = [
                    ids_of.slice(done, stop - done),
                    pa.array(counts, pa.int64()),
                    pa.array(kept, pa.list_(pa.int32())),
                    pa.array(shas, pa.string()),
                    pa.array(back, pa.string()),
                ]
                done, held, kept, counts, shas, back = stop, 0, [], [], [], []
                return pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

            for k in range(len(texts)):
                packed = bpe.encode(texts[k].as_py())
                counts.append(len(packed) // 4)
                shas.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(bpe.decode(packed)).hexdigest())
                kept.append(np.frombuffer(packed, "<i4") if keep_ids else None)
                held += len(packed) // 4
                if held >= BATCH_IDS:
                    yield flush(k + 1)
            if done < len(texts):
                yield flush(len(texts))

    slim = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): ids to text, bytes that are not UTF-8 replaced."""

    def run(batches):
        bpe = loaded(vocabulary, pattern)
        for batch in batches:
            texts = [bpe.decode(np.asarray(x.as_py() or [], "<u4").tobytes()).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    slim = encoded.select("doc_id", "ids")
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, text string")


def query(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    return encode_documents(docs, vocabulary, pattern, keep_ids=False).select(
        F.col("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256"
    )
