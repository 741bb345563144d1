"""Secret scans: fixed patterns plus sliding-window entropy over candidate strings.

Base spans (kinds ``assign``, ``access``, ``hex``) are the leftmost non-overlapping matches of
three patterns, dropped when too short.  The method adds spans of kind ``entropy``: a candidate
is a maximal run of token characters that holds a digit and a letter; for each character class
(hex digits, digits with letters of one case or both, base-64 characters) a window slides over
its runs of the class, and its Shannon entropy is kept by incremental counts, one character in
and one out per step; a run shorter than the window is measured at its own length.  The
threshold is the low tail of the entropy that random windows of that length and alphabet have,
computed exactly.  Windows that reach it are united into spans.  Words, dates and UUIDs between
separators are no part of a key: they are cut out of a candidate before it is measured, so a
path, a name or a date beside a key does not hide it.  An allow-list suppresses spans that are
random in looks only: well-known example keys, UUIDs, dates and version numbers, paths,
placeholders with few distinct characters, and runs in alphabetical order; an entropy span that
a base span covers is not repeated.

Offsets are code points, end exclusive.  NULL is the empty text; very long texts are scanned
whole (each pattern and the window are linear).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from convoy.llm.common import col

# The base patterns, in the order that breaks ties between spans.
ASSIGN = r"""((?:(?ai:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"  # 16 characters or more
HEX = r"[0-9a-f]+"  # 32 or more
KINDS = ("assign", "access", "hex", "entropy")

#: Window length, and the least length of a run that is measured.
WINDOW, SHORTEST = 20, 16
#: Share of random windows that may stay below the threshold of their class.
TAIL = 0.02
#: Characters of each class, and the size of the smallest alphabet that random strings in it have.
CLASSES = (
    ("hex", "0-9a-fA-F", 16),
    ("lower", "0-9a-z", 32),
    ("upper", "0-9A-Z", 32),
    ("alnum", "0-9a-zA-Z", 62),
    ("base64", "0-9a-zA-Z+/=_-", 64),
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{%d,}" % SHORTEST)
#: A word: letters of one case, or capitalised parts.
WORD = r"(?:[A-Z]{3,}+|[A-Z]?[a-z]{2,}+(?:[A-Z][a-z]++)*+)"
ALLOW = tuple(
    re.compile(p)
    for p in (
        r"(?i)example|sample|placeholder|dummy|changeme|your[_-]?(?:key|token|secret)",
        r"\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\Z",
        r"\A\d{4}-\d{2}-\d{2}\Z",
        # words, numbered words and short numbers in a path or slug
        rf"\A(?:[A-Za-z]+|{WORD}\d{{1,4}}|\d{{1,4}})(?:[/_=-]+(?:[A-Za-z]+|{WORD}\d{{1,4}}|\d{{1,4}}))*[/_=-]*\Z",
    )
)
UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
#: What is cut out of a candidate where separators or its ends enclose it.
_PLAIN = re.compile(rf"(?<![0-9A-Za-z+])(?:{UUID}|\d{{4}}(?:[-/_]\d{{2}}){{1,2}}|(?=[A-Za-z]{{3}}){WORD}\d{{0,4}})(?![0-9A-Za-z+])")
SEPARATORS = "/_=-"
#: Longest example word, less the character that the span has at least.
_REACH = 13
#: A span in which this share of steps goes to the next character of the alphabet is a sequence.
SEQUENCE = 0.6

# The last two match maximal runs, so their least length can stand in the pattern.
_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN), re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
#: i * log2(i), for entropy from counts in a window
_XLOGX = [0.0] + [i * math.log2(i) for i in range(1, WINDOW + 1)]


def _partitions(n: int, most: int) -> Iterator[list[int]]:
    if n == 0:
        yield []
    for first in range(min(n, most), 0, -1):
        for others in _partitions(n - first, first):
            yield [first, *others]


def least_entropy(length: int, alphabet: int) -> float:
    """The entropy that all but ``TAIL`` of the random strings of this length and alphabet reach."""
    shares = []
    for counts in _partitions(length, length):
        if len(counts) <= alphabet:
            ways = math.factorial(length) * math.perm(alphabet, len(counts))
            for x in (*counts, *Counter(counts).values()):
                ways //= math.factorial(x)
            shares.append((math.log2(length) - sum(_XLOGX[x] for x in counts) / length, ways / alphabet**length))
    below = 0.0
    for entropy, share in sorted(shares):
        below += share
        if below > TAIL:
            break
    return entropy - 1e-6  # sums kept step by step may be off by their rounding


#: per class: its runs, and the threshold by window length
_RUNS = tuple(
    (re.compile("[%s]{%d,}" % (members, SHORTEST)), {n: least_entropy(n, size) for n in range(SHORTEST, WINDOW + 1)})
    for _, members, size in CLASSES
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end), sorted."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def high_entropy(run: str) -> list[tuple[int, int]]:
    """Spans of ``run`` covered by windows whose entropy reaches the threshold of a class."""
    hits: list[tuple[int, int]] = []
    for runs, least in _RUNS:
        for m in runs.finditer(run):
            window = min(WINDOW, m.end() - m.start())
            most = (math.log2(window) - least[window]) * window
            counts: dict[str, int] = {}
            total, s = 0.0, m.start()
            for e in range(m.start(), m.end()):
                n = counts.get(run[e], 0)
                counts[run[e]] = n + 1
                total += _XLOGX[n + 1] - _XLOGX[n]
                if e + 1 - s == window:
                    if total <= most:
                        hits.append((s, e + 1))
                    n = counts[run[s]]
                    counts[run[s]] = n - 1
                    total += _XLOGX[n - 1] - _XLOGX[n]
                    s += 1
    spans: list[tuple[int, int]] = []
    for s, e in sorted(hits):
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
        else:
            spans.append((s, e))
    return spans


def pieces(run: str) -> list[tuple[int, int]]:
    """The parts of a candidate that can hold a key, between what ``_PLAIN`` matches; the whole
    of it where that leaves nothing to measure of a candidate that is mostly not plain."""
    out, at, plain = [], 0, 0
    for s, e in [*(m.span() for m in _PLAIN.finditer(run)), (len(run), len(run))]:
        part = run[at:s]
        if at:
            part = part.lstrip(SEPARATORS)
        start = s - len(part)
        if e > s:
            part = part.rstrip(SEPARATORS)
        if len(part) >= SHORTEST:
            out.append((start, start + len(part)))
        at, plain = e, plain + e - s
    return out if out or 2 * plain >= len(run) else [(0, len(run))]


def allowed(run: str, start: int, end: int) -> bool:
    """Whether the allow-list takes a span of ``run``: example words also where they leave the
    span in the same token, the rest on the span without separators at its ends."""
    s, e = start, end
    while s > max(0, start - _REACH) and run[s - 1].isalnum():
        s -= 1
    while e < min(len(run), end + _REACH) and run[e].isalnum():
        e += 1
    value = run[start:end].strip(SEPARATORS)
    if ALLOW[0].search(run, s, e) or any(p.search(value) for p in ALLOW[1:]):
        return True
    steps = sum(ord(b) - ord(a) == 1 for a, b in zip(value, value[1:], strict=False))
    return steps >= SEQUENCE * (len(value) - 1)


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if not any(c.isdigit() for c in run) or run.isdigit():
            continue
        for at, end in pieces(run):
            for s, e in high_entropy(run[at:end]):
                part = run[at + s : at + e]
                if any(c.isdigit() for c in part) and any(c.isalpha() for c in part) and not allowed(run, at + s, at + e):
                    out.append((m.start() + at + s, 3, m.start() + at + e))
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (start, kind index, end) in order."""
    text = text or ""
    base = base_spans(text)
    # an entropy span that a base span covers is not repeated: both lists by start, merged once
    extra, starts, i, reach = [], sorted((s, e) for s, _, e in base), 0, -1
    for s, k, e in sorted(entropy_spans(text)):
        while i < len(starts) and starts[i][0] <= s:
            reach = max(reach, starts[i][1])
            i += 1
        if e > reach:
            extra.append((s, k, e))
    return base, sorted(base + extra)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) of every row."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas, spans = ([], [], [], []), [], []
            for x in batch.column(1):
                base, every = scan(x.as_py())
                for k, to in enumerate(counts):
                    to.append(sum(s[1] == k for s in every))
                shas.append(hashlib.sha256(render(base).encode()).hexdigest())
                spans.append(render(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(shas), pa.array(spans, pa.string())], names
            )

    slim = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
    )
