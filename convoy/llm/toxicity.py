"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding.  Case, homoglyphs (Cyrillic, Greek and full-width look-alikes), combining marks of the
ASCII letters, and digit or sign substitutions inside words (``l0ser``, ``$tupid``) are folded to
plain letters; other characters separate words.  Letters with marks that distinguish words in the
training languages stay as they are.

Lexicon.  Learned on a bounded sample (``SAMPLE`` labelled rows of the training folds, by a hash
of their ids): candidates are folded words and word beginnings of four to six letters.  A
candidate counts once per distinct context (the word before it), so that a family of near
copies counts once, not by its size.  It enters when a one-sided binomial bound, corrected for the
number of candidates, says that toxic texts use it more than their share; its weight is the
smoothed log-odds.  A word beginning replaces the words it starts when it explains more contexts
than any of them.  Exception phrases, given and learned (words that begin like an entry and are
as frequent in clean texts), are matched too, and a match inside one does not count.

Score.  The weights of the matches are summed and normalised by length (weight per hundred words,
on a logarithmic scale, beside the logarithm of the sum itself); a logistic curve fitted on the
same sample maps both to 0..1.  Matching is linear in the text; matches come out in one pass over
whole texts.

Cases: NULL or empty text has no match and gets the score of a clean text; without labelled rows,
or with one class only, the lexicon is empty and every score is 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import col, staged

SAMPLE = 10_000
#: Letters of a word beginning that can become an entry.
STEMS = (4, 5, 6)
#: Chance, over all candidates together, that one enters the lexicon without cause.
RISK = 0.01
#: Largest lexicon (the strongest entries), and largest number of learned exceptions.
ENTRIES, EXCEPTIONS = 4096, 4096

# Look-alikes of Latin letters, and what stands for a letter inside a word.
HOMOGLYPHS = dict(zip("асеорхуіјѕԁһкмтвнαεοιρντυκ", "aceopxyijsdhkmtbhaeoipvtuk", strict=True))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}


def _fold_table() -> dict[int, str]:
    """Code point -> folded text, for all but letters that fold to themselves."""
    table = {}
    for c in range(0x3000):
        ch = chr(c)
        low = HOMOGLYPHS.get(ch.lower(), ch.lower())
        table[c] = low if low.isalpha() or ch in SUBSTITUTES or ch.isdigit() else ("" if unicodedata.combining(ch) else " ")
    table.update({c: chr(c - 0xFEE0).lower() for c in range(0xFF21, 0xFF5B) if chr(c - 0xFEE0).isalpha()})  # full width
    table.update(dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x00AD), ""))  # invisible characters
    return table


#: No disguise: four digits or signs in a row.
JUNK = re.compile(r"[0-9@$!|]{4}")
_FOLD = _fold_table()
_SUBSTITUTE = str.maketrans(SUBSTITUTES)


def folded_words(text: str | None) -> list[str]:
    """The words of a text after folding.  A digit or sign becomes a letter only in a word that
    has letters, and not in a run of ``JUNK``; a trailing ! or |, and a trailing run of one sign, is
    punctuation."""
    out = []
    for w in (text or "").translate(_FOLD).split():
        if not w.isalpha():
            last = w[-1]
            if last in "!|" or last in "$@" and w[-2:] == last * 2:
                w = w.rstrip(last)
            if not any(map(str.isalpha, w)) or JUNK.search(w):
                continue
            w = w.translate(_SUBSTITUTE)
        if w:
            out.append(w)
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)  # word "loser" or beginning "vequ*"
    exceptions: set[str] = field(default_factory=set)  # folded phrases
    curve: tuple[float, float, float] = (0.0, 0.0, -20.0)  # of the density, of the sum, constant

    def __post_init__(self):
        self.automaton = None

    def build(self) -> None:
        """Patterns are delimited by blanks, as the folded text is: " loser ", " vequ"."""
        self.automaton = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            pattern = f" {entry[:-1]}" if entry.endswith("*") else f" {entry} "
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            pattern = f" {phrase} "
            if pattern not in self.automaton:
                self.automaton.add_word(pattern, (len(pattern), 0.0))
        if len(self.automaton):
            self.automaton.make_automaton()

    def evidence(self, text: str | None) -> tuple[float, float, int]:
        """(log weight per hundred words, log weight, matches) of a text; the longest match at a
        place counts."""
        if self.automaton is None:
            self.build()
        words = folded_words(text)
        if not words or not len(self.automaton):
            return 0.0, 0.0, 0
        best: dict[int, tuple[int, float]] = {}  # start -> (length, weight)
        for end, (length, weight) in self.automaton.iter(f" {' '.join(words)} "):
            start = end - length + 1
            if start not in best or length > best[start][0]:
                best[start] = (length, weight)
        total, hits, clear = 0.0, 0, 0
        for start in sorted(best):
            length, weight = best[start]
            if weight == 0.0:
                clear = max(clear, start + length - 1)  # matches before this place are inside an exception
            elif start >= clear:
                total, hits = total + weight, hits + 1
        return math.log1p(100.0 * total / len(words)), math.log1p(total), hits

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        """[n, 2] densities and sums to scores."""
        z = evidence @ np.array(self.curve[:2]) + self.curve[2]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))

    def score(self, text: str | None) -> float:
        return float(self.scores(np.array([self.evidence(text)[:2]]))[0])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, before, toxic), once per partition: words and word beginnings with their context."""
    for batch in batches:
        seen: set[tuple[str, str, int]] = set()
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            before = ""
            for w in folded_words(text.as_py()):
                if len(w) > 2:
                    seen.add((w, before, toxic))
                    for k in STEMS:
                        if len(w) >= k:
                            seen.add((w[:k] + "*", before, toxic))
                before = w
        rows = list(zip(*seen, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64())], ["term", "before", "toxic"]
        )


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-stabilised logistic regression by Newton steps; the constant comes last."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], 1e-2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def starts_with(term: Column, begins: Sequence[str]) -> Column:
    """Whether a term starts with one of many beginnings: a set lookup per length, however many."""
    by_length = {k: sorted({b for b in begins if len(b) == k}) for k in sorted(set(map(len, begins)))}
    found = F.lit(False)
    for k, some in by_length.items():
        found = found | F.substring(term, 1, k).isin(some)
    return found


def learn(rows: DataFrame, exceptions: Sequence[str] = ()) -> Lexicon:
    """A lexicon from a bounded sample of labelled rows (text, label 0 or 1)."""
    rows = rows.select("text", F.col("label").cast("long").alias("toxic"))
    spotted = rows.mapInArrow(_candidates, "term string, before string, toxic long").distinct()
    terms = spotted.groupBy("term").agg(
        F.sum("toxic").cast("double").alias("t"), F.sum(1 - F.col("toxic")).cast("double").alias("n")
    )
    terms = staged(terms, "toxic_terms")
    words = ~F.col("term").endswith("*")
    total = terms.where(words).agg(F.sum("t"), F.sum("n"), F.count("*")).first()
    if not total[0] or not total[1]:
        return Lexicon()
    base = total[0] / (total[0] + total[1])
    count = F.col("t") + F.col("n")
    share = F.col("t") / count
    bits = F.col("t") * F.log(share / base) + F.when(F.col("n") > 0, F.col("n") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    weight = F.log((F.col("t") + 0.5) / total[0]) - F.log((F.col("n") + 0.5) / total[1])
    strong = terms.where((share > 0.5 + base / 2) & (bits > math.log(total[2] / RISK))).withColumn("w", weight)
    chosen = strong.orderBy(F.desc("t"), F.desc(F.length("term")), "term").limit(ENTRIES).collect()
    chosen = {r["term"]: (r["t"], r["w"]) for r in chosen}
    # a beginning stands if it covers clearly more than its most frequent word; then it covers its words
    kept: dict[str, float] = {}
    stems = sorted((s for s in chosen if s.endswith("*")), key=lambda s: (-chosen[s][0], -len(s), s))
    by_stem: Counter = Counter()
    for term, (t, _) in chosen.items():
        if not term.endswith("*"):
            for k in STEMS:
                by_stem[term[:k] + "*"] = max(by_stem[term[:k] + "*"], t)
    for s in stems:
        covered = any(s[:-1].startswith(o[:-1]) for o in kept) or any(
            o != s and o[:-1].startswith(s[:-1]) and chosen[o][0] >= 0.95 * chosen[s][0] for o in stems
        )
        if chosen[s][0] > 1.2 * by_stem[s] and not covered:
            kept[s] = chosen[s][1]
    for term, (_, w) in chosen.items():
        if not term.endswith("*") and not any(term.startswith(o[:-1]) for o in kept if o.endswith("*")):
            kept[term] = w
    given = {" ".join(folded_words(p)) for p in exceptions} - {""}
    begins = [o[:-1] for o in kept if o.endswith("*")]
    clean: set[str] = set()
    if begins:
        usual = terms.where(words & starts_with(F.col("term"), begins) & (F.col("n") > 0) & (share <= base)).orderBy(F.desc("n"), "term").limit(EXCEPTIONS)
        clean = {r["term"] for r in usual.collect()}
    lexicon = Lexicon(kept, given | clean)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([lexicon.evidence(x.as_py())[:2] for x in batch.column(0)], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column(1)], ["d", "w", "y"])

    fitted = rows.mapInArrow(evidence, "d double, w double, y long").toArrow()
    curve = _logistic(np.stack([fitted["d"].to_numpy(), fitted["w"].to_numpy()], axis=1), fitted["y"].to_numpy().astype(float))
    return Lexicon(kept, given | clean, tuple(curve.tolist()))


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_matches) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)
        for batch in batches:
            found = np.array([own.evidence(x.as_py()) for x in batch.column(1)], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own.scores(found[:, :2])), pa.array(found[:, 2].astype(np.int64))],
                ["doc_id", "score", "n_matches"],
            )

    slim = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    lexicon.automaton = None  # the patterns travel, each task builds its own automaton
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double, n_matches long")
