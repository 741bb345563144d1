"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Each text becomes a row of document statistics (lengths, shares of character classes, repetition
of words and lines, punctuation at line ends).  Standardised and projected on random frequencies,
their cosines approximate a Gaussian kernel; ridge regression on them needs only the sums Z'Z and
Z'y, which every partition adds up on its own rows and Spark adds over partitions.  A
monotone curve (pool adjacent violators, straight lines between the pools) fitted on rows the ridge has not seen turns
its output into a probability.

Bounds: at most ``SAMPLE`` labelled rows of the training folds, the smallest by a hash of their
id, are used; one fifth of them calibrates.  Sums over partitions are ``FEATURES`` squared
numbers, whatever the sample.

Cases: NULL and empty texts have statistics (all zero) and get a score.  Without labels, or with
one class only, every score is the share of label 1 (1/2 without labels).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, staged

SAMPLE = 20_000
#: Cosine features, kernel width in standard deviations over all statistics, ridge penalty.
FEATURES, WIDTH, PENALTY = 384, 6.0, 1e-3
_SYMBOLS = b"#*$%&|<>"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: Byte classes whose shares are statistics.
CLASSES = (
    _SYMBOLS, b"!", b".,;:?", bytes(range(48, 58)), bytes(range(65, 91)), b"()[]{}\"'`", b"=+-_/\\@~^", b" \t\n\r\x0b\x0c",
)
N_STATS = len(CLASSES) + 12


def statistics(text: bytes | None) -> list[float]:
    """Document statistics, each bounded or logarithmic."""
    text = text or b""
    words, n = text.split(), max(1, len(text))
    total = max(1, len(words))
    shares = [(n - len(text.translate(None, c))) / n if text else 0.0 for c in CLASSES]
    lines = [line for line in text.split(b"\n") if line.strip()]
    count_lines = max(1, len(lines))
    counts = Counter(words)
    top = counts.most_common(1)[0][1] if counts else 0
    runs = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lettered = sum(1 for w in words if w.translate(None, _LETTERS) != w)
    shouted = sum(map(bytes.isupper, words))
    chars = len(text) - shares[-1] * n
    return [
        *[math.sqrt(s) for s in shares],
        math.log1p(len(words)) / 4,
        min(chars / total, 40.0) / 8,
        len(counts) / total if words else 0.0,
        math.sqrt(top / total),
        runs / total,
        pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        lettered / total,
        shouted / total,
        math.log1p(len(lines)) / 4,
        1 - len(set(lines)) / count_lines if lines else 0.0,
        sum(1 for line in lines if line.rstrip()[-1:] in b".!?") / count_lines,
        1.0 if re.search(rb"(?i)licen[sc]ed? under|all rights reserved|copyright", text) else 0.0,
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]  # ridge output -> probability, linear in between

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.frequencies + self.phases)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.steps), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots at the mean x of each pool."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of x, sum of y, count
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        pools.append([a, b, 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _stats_of(column) -> np.ndarray:
    return np.array([statistics(x.as_py()) for x in column], float).reshape(-1, N_STATS)


def learn(rows: DataFrame, seed: int = 42) -> Model:
    """A model from a bounded sample of labelled rows (id, text, label 0 or 1)."""
    rng = np.random.default_rng(seed)
    frequencies = rng.normal(size=(N_STATS, FEATURES)) / WIDTH
    phases = rng.uniform(0, 2 * np.pi, FEATURES)

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _stats_of(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(values), pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["stats", "y", "o"]
            )

    rows = rows.select(F.col("text").cast("binary").alias("text"), F.col("label").alias("y"), F.xxhash64("id").alias("o"))
    rows = staged(rows.mapInArrow(stats, "stats array<double>, y double, o long"), "quality_sample")
    moments = rows.agg(
        F.avg("y").alias("y"),
        F.min("y").alias("low"),
        F.max("y").alias("high"),
        *[f(F.get("stats", F.lit(i))).alias(f"{n}{i}") for i in range(N_STATS) for n, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    if moments["low"] is None or moments["low"] == moments["high"]:
        flat = 0.5 if moments["y"] is None else float(moments["y"])
        zero = np.zeros(N_STATS)
        return Model(zero, zero + 1, frequencies, phases, np.zeros(FEATURES + 1), (np.array([0.0]), np.array([flat])))
    mean = np.array([moments[f"m{i}"] for i in range(N_STATS)])
    scale = np.maximum(np.array([moments[f"s{i}"] for i in range(N_STATS)]), 0.02)
    model = Model(mean, scale, frequencies, phases, np.zeros(FEATURES + 1), (np.array([0.0]), np.array([0.0])))
    held = F.pmod(F.xxhash64("o"), F.lit(5)) == 0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per feature and partition: that row of Z'Z, with Z'y as its last number."""
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(np.array(batch.column(0).to_pylist(), float).reshape(-1, N_STATS))
            total += z.T @ np.concatenate([z, batch.column(1).to_numpy()[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"]
        )

    width = FEATURES + 2
    added = (
        rows.where(~held)
        .mapInArrow(sums, "i long, sums array<double>")
        .groupBy("i")
        .agg(F.collect_list("sums").alias("parts"))  # at most 16 parts, one per partition of the sample
        .select("i", F.aggregate("parts", F.array_repeat(F.lit(0.0), width), lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("s"))
        .orderBy("i")
        .toArrow()
    )
    system = np.array(added["s"].to_pylist(), float)
    gram, target = system[:, :-1], system[:, -1]
    model.weights = np.linalg.solve(gram + PENALTY * np.eye(len(gram)), target)
    rest = rows.where(held).select("stats", "y").toArrow()
    if len(rest) == 0:
        rest = rows.select("stats", "y").toArrow()
    model.steps = isotonic(model.raw(np.array(rest["stats"].to_pylist(), float)), rest["y"].to_numpy())
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_stats_of(batch.column(1))))], ["doc_id", "score"])

    slim = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").cast("binary").alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")
