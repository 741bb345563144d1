"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base figures of every text (words, characters, symbols, repeated lines, repeated 5-word windows)
come from array functions on the row itself: no shuffle, no Python, no explode.  Windows are
compared by a 64-bit hash inside one text; only texts whose windows repeat at all sort them.

The cascade: each rule's cost and selectivity are measured on a bounded sample of the texts
(``SAMPLE`` rows of at most ``SAMPLE_BYTES`` each).  One aggregate gives the share that each rule
rejects; a rule's cost is the time to evaluate it on the sample's rows repeated often enough to
measure, less the time of the same job without a rule.  Rules are ordered by rejection per cost, and evaluated as the branches of one CASE, which stops at
the first rule that rejects.  The sample decides the order only; any order keeps the same texts.

Cases: NULL text has no word (base_failed); blank lines are no repeats; a text of fewer than five
words has no window; long texts cost n log n at worst.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import WHITE, col, staged

#: Rows on which costs and selectivities are estimated, and the longest text among them (the
#: sample passes through the driver; longer texts are judged like all others, only not timed).
SAMPLE, SAMPLE_BYTES = 256, 1 << 16
#: Evaluations of a rule that are timed, and how often; the least time counts.
EVALUATIONS, TIMES = 1 << 14, 2
MIN_WORDS, WINDOW = 10, 5
MAX_REPEAT_PERCENT = 20

NO_LETTERS = r"^[!-@\[-`{-~]+$"  # ASCII digits and punctuation only


def _removed(text: Column, pattern: str) -> Column:
    """How many ASCII characters of ``text`` a character class holds."""
    return F.octet_length(text) - F.octet_length(F.regexp_replace(text, pattern, ""))


#: name -> rejects(base columns t, words, n_words, ...); all in whole numbers.
RULES = {
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    "symbols": lambda: 10 * F.col("n_symbols") > F.col("n_words"),
    "repeated_lines": lambda: 2 * F.col("n_dup_lines") > F.col("n_word_lines"),
    "capitals": lambda: 100 * _removed(F.col("t"), "[A-Z]+") > 40 * F.col("word_chars"),
    "exclamations": lambda: 10 * _removed(F.col("t"), "!+") > 3 * F.col("n_words"),
    "no_letters": lambda: 10 * F.size(F.filter("words", lambda w: w.rlike(NO_LETTERS))) > 4 * F.col("n_words"),
}


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, words, n_words, word_chars, n_symbols, n_dup_lines, n_word_lines, n_repeat_words)."""
    t, at = F.col("t"), lambda i: F.get("words", i)
    first = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    trimmed = F.btrim(t, F.lit(WHITE))
    split = first.select(
        "doc_id",
        "t",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+", -1)).alias("words"),
        F.filter(F.split("t", "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "").alias("lines"),
        _removed(t, "[#*$%&|<>]+").alias("n_symbols"),
    )
    hashed = split.select(
        "doc_id",
        "t",
        "words",
        "n_symbols",
        F.size("words").alias("n"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_word_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*[at(i + k) for k in range(WINDOW)])
            ),
        ).alias("hashes"),
    )
    # windows that occur again, as (hash, place) neighbours in order
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = hashed.withColumn(
        "ordered", F.when(repeats, F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    )
    again = ordered.withColumn(
        "places",
        F.sort_array(
            F.transform(
                F.filter(
                    "ordered",
                    lambda e, i: e["h"].eqNullSafe(F.get("ordered", i - 1)["h"]) | e["h"].eqNullSafe(F.get("ordered", i + 1)["h"]),
                ),
                lambda e: e["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    out = again.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    return out.select(
        "doc_id",
        "t",
        "words",
        *[F.col(a).cast("long").alias(b) for a, b in (("n", "n_words"), ("word_chars", "word_chars"))],
        *[F.col(c).cast("long").alias(c) for c in ("n_symbols", "n_dup_lines", "n_word_lines", "n_repeat_words")],
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def order_rules(
    docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, rules: dict[str, Callable[[], Column]] | None = None
) -> list[tuple[str, float, float]]:
    """[(rule, share rejected, seconds for ``EVALUATIONS`` texts)] in the order of the cascade, from a
    bounded sample.

    The rows are the first that the driver takes, which reads no more partitions than it needs (a
    limit inside a plan would take as many rows of every partition, a sample over the table would
    read every text once more).  Their figures are staged once, so a rule's time is its own."""
    rules = rules or RULES
    text = col(text_col).cast("string")
    taken = docs.where(F.coalesce(F.octet_length(text), F.lit(0)) <= SAMPLE_BYTES).select(text.alias("text")).limit(sample).collect()
    texts = docs.sparkSession.createDataFrame(taken, "text string").coalesce(1).withColumn("id", F.lit(0))
    # the base is judged on the staged rows: a filter before would be pushed below the projections of
    # ``figures``, which repeats the sort of a text's windows for every window
    rows = staged(figures(texts, "id", "text"), "rules_sample").where(~base_failed())
    shares = rows.agg(F.count("*").alias("n"), *[F.avg(r().cast("double")).alias(name) for name, r in rules.items()]).first()
    repeats = math.ceil(EVALUATIONS / max(1, shares["n"]))
    repeated = rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats)))) if shares["n"] else rows

    def seconds(rejects: Column) -> float:
        # the count of the repetition keeps each evaluation a row of its own
        job = repeated.agg(F.sum(F.when(rejects, F.col("again")).otherwise(0)) if shares["n"] else F.count("*"))
        best = math.inf
        for _ in range(TIMES):
            began = time.perf_counter()
            job.collect()
            best = min(best, time.perf_counter() - began)
        return best

    first = seconds(F.col("n_words") < 0)  # also warms up the job, so the idle time is taken again at the end
    timed = {name: seconds(r()) for name, r in rules.items()}
    idle = min(first, seconds(F.col("n_words") < 0))
    measured = [(name, shares[name] or 0.0, max(timed[name] - idle, 1e-4)) for name in rules]
    return sorted(measured, key=lambda m: (-m[1] / m[2], m[0]))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    rejected_by) of every row; ``order`` fixes the cascade instead of measuring it."""
    names = order or [name for name, _, _ in order_rules(docs, text_col)]
    cascade = F.when(base_failed(), F.lit("base"))
    for name in names:
        cascade = cascade.when(RULES[name](), F.lit(name))
    return (
        figures(docs, id_col, text_col)
        .withColumn("rejected_by", cascade)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            base_failed().alias("base_failed"), F.col("rejected_by").isNull().alias("kept"), "rejected_by",
        )
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The row rides along as a struct, so no join brings the figures back to their rows."""
    whole = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(text_col).alias("text"))
    judged = judge(whole, "row", "text", [n for n, _, _ in order_rules(whole, "text")])
    # a plain filter would be pushed below the staged projections, which repeats their work for
    # each use; a filter on what a generator returns stays above them
    kept = judged.select(F.explode_outer(F.when(F.col("kept"), F.array("doc_id"))).alias("row")).where("row is not null")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
