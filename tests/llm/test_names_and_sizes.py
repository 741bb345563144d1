"""Columns named like the operators' own, long inputs, and large lexicons."""

import random
import time

import numpy as np

from pyspark.sql import functions as F

from convoy.llm import line_dedup, mixing, quality_classifier, quality_rules, secrets, simhash, toxicity

OWN = ("text_key", "row", "nth", "copies", "times", "copy", "__key", "__n", "__r1", "__r2", "__drops", "__all", "__kept", "fp", "root", "line", "h1")


def _named(spark):
    rng = random.Random(4)
    shared = "a line that many documents share with others"
    rows = []
    for i in range(60):
        words = " ".join(rng.choices("abcdefghij", k=rng.randrange(12, 40)))
        rows.append((i, f"{words}\n{shared}" if i % 3 else words, f"s{i % 3}"))
    rows += [(100 + i, rows[0][1], "s0") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in OWN}
    )


def _own(rows):
    return all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in OWN)


def test_columns_named_like_our_own_come_back_unchanged(spark):
    docs = _named(spark)
    plain = docs.select("doc_id", "text", "source")
    for stage in (simhash.keep_one, mixing.apply_mix, lambda d: line_dedup.dedup_lines(d).select(*d.columns)):
        got, want = stage(docs), stage(plain).collect()
        assert got.columns == docs.columns
        rows = got.collect()
        assert _own(rows) and rows
        assert sorted(tuple(r)[:3] for r in rows) == sorted(tuple(r) for r in want)


def test_a_lexicon_of_thousands_of_beginnings(spark):
    rng = random.Random(1)
    begins = sorted({"".join(rng.choices("abcdefgh", k=rng.choice(toxicity.STEMS))) for _ in range(6000)})[:4096]
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(3000)]
    frame = spark.createDataFrame([(w,) for w in words], "term string")
    got = sorted(r["term"] for r in frame.where(toxicity.starts_with(F.col("term"), begins)).collect())
    assert len(begins) == 4096 and got == sorted(w for w in words if any(w.startswith(b) for b in begins))
    assert frame.where(toxicity.starts_with(F.col("term"), [])).count() == 0


def test_disguised_words_fold():
    want = {"stupid$$$": "stupid", "$h1t": "shit", "1d10t": "idiot", "l0ser!!": "loser", "id1ot": "idiot", "cla$$y": "classy"}
    for word, folded in want.items():
        assert toxicity.folded_words(word) == [folded], word
    assert toxicity.folded_words("2024 $$$ 12:30 a12345 !!!") == []


def test_matches_equal_a_plain_matcher():
    """The automaton against trying every entry at every word."""
    rng = random.Random(9)
    vocabulary = ["bad", "badly", "badge", "ugly", "nice", "ba", "idiot", "club", "word"]
    for _ in range(400):
        weights = {rng.choice(["bad", "ugly", "idiot"]): 2.0, rng.choice(["badl*", "ugl*", "idio*"]): 3.0}
        exceptions = {" ".join(rng.choices(vocabulary, k=rng.choice((1, 2)))) for _ in range(2)} - {w for w in weights}
        lexicon = toxicity.Lexicon(weights, exceptions)
        words = rng.choices(vocabulary, k=rng.randrange(12))
        total, hits, clear = 0.0, 0, 0
        for i, word in enumerate(words):
            found = [(len(e), w) for e, w in weights.items() if word == e]
            found += [(len(e) - 2, w) for e, w in weights.items() if e.endswith("*") and word.startswith(e[:-1])]
            for phrase in exceptions:
                parts = phrase.split()
                if words[i : i + len(parts)] == parts:
                    found.append((len(phrase), 0.0))
                    if max(found)[1] == 0.0:
                        clear = max(clear, i + len(parts))
            if found and max(found)[1] > 0 and i >= clear:
                total, hits = total + max(found)[1], hits + 1
        got = lexicon.evidence(" ".join(words))
        assert got[2] == hits, (words, weights, exceptions)


def test_megabytes_of_keys_are_scanned_in_linear_time():
    rng = random.Random(3)
    lines = [f"token = {''.join(rng.choices('0123456789abcdef', k=40))}" for _ in range(40_000)]
    small, large = "\n".join(lines[:10_000]), "\n".join(lines)
    times = []
    for text in (small, large):
        began = time.process_time()
        base, every = secrets.scan(text)
        times.append(time.process_time() - began)
        assert len(base) >= text.count("token") and len(every) >= len(base)
    assert times[1] < 10 * times[0]


def test_covered_entropy_spans_are_not_repeated():
    rng = random.Random(8)
    for _ in range(200):
        text = " ".join(
            rng.choice(["token=", "id:", "AKIA", ""]) + "".join(rng.choices("0123456789abcdefXYZ", k=rng.randrange(10, 50)))
            for _ in range(6)
        )
        base, every = secrets.scan(text)
        plain = [x for x in secrets.entropy_spans(text) if not any(s <= x[0] and x[2] <= e for s, _, e in base)]
        assert every == sorted(base + plain)


def test_row_keys_have_two_independent_hashes(spark):
    """Keys of 128 bits: rows that agree in the first hash are still told apart."""
    docs = _named(spark).select("doc_id", "text", "source")
    keys = docs.select(simhash.text_key("doc_id", "text").alias("k"), "doc_id", "text").select("k.*", "doc_id", "text").collect()
    assert len({(r["h1"], r["h2"]) for r in keys}) == len({(r["doc_id"], r["text"]) for r in keys})
    assert all(r["h1"] != r["h2"] for r in keys)
    mixed = mixing.mix(docs).select("text_key.*").collect()
    assert len(mixed) == docs.count() and all(r["h"] != r["h2"] for r in mixed)


def test_first_hashes_that_collide_keep_every_document(spark, monkeypatch):
    """With a first hash that is the same for all rows, no document is lost or doubled."""
    docs = _named(spark).select("doc_id", "text", "source")
    want = [sorted(map(tuple, stage(docs).collect())) for stage in (simhash.keep_one, mixing.apply_mix)]

    def key(id_col, text_col):
        return F.struct(F.lit(1).cast("long").alias("h1"), F.xxhash64(text_col, id_col).alias("h2"))

    monkeypatch.setattr(simhash, "text_key", key)
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == want[0]
    own = mixing._hashes
    monkeypatch.setattr(mixing, "_hashes", lambda *a: (F.pmod(own(*a)[0], F.lit(2)), own(*a)[1]))
    rows = [tuple(r) for r in mixing.apply_mix(docs).collect()]
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert sorted(rows) == sorted(tuple(r) for r in docs.collect() for _ in range(taken[r["doc_id"]]))


def test_rules_are_ordered_by_rejection_per_cost(spark):
    """A slow rule goes behind a fast one of the same share, and in front where it rejects enough."""
    docs = spark.createDataFrame(
        [(i, " ".join(f"word{(i * 7 + k) % 97}" for k in range(60)) + "".join(f" more{k}" for k in range(20 * (i % 4 == 0)))) for i in range(80)],
        "doc_id long, text string",
    )
    many = F.col("n_words") > 70
    slow = lambda: many & (F.size(F.filter("words", lambda w: w.rlike("^(a|b|c|w)+(o|r|d)+[0-9]*x$"))) == 0)
    fast = lambda: many
    never = lambda: F.col("n_words") < 0
    for rules in ({"a_slow": slow, "b_fast": fast, "c_never": never}, {"a_never": never, "b_fast": fast, "c_slow": slow}):
        got = quality_rules.order_rules(docs, rules=rules)
        names = [name[2:] for name, _, _ in got]
        assert names[0] == "fast" and names[-1] == "never", got
        shares = {name[2:]: share for name, share, _ in got}
        assert shares == {"slow": 0.25, "fast": 0.25, "never": 0.0}
        seconds = {name[2:]: s for name, _, s in got}
        assert seconds["slow"] > 3 * seconds["fast"]
    rare = lambda: F.col("doc_id").isNull()  # noqa: E731  (the sample has one id)
    assert [n for n, _, _ in quality_rules.order_rules(docs, rules={"rare": rare, "slow": slow})] == ["slow", "rare"]
    assert {n for n, _, _ in quality_rules.order_rules(docs.limit(0))} == set(quality_rules.RULES)
    long = spark.createDataFrame([(1, "word " * 100_000)], "doc_id long, text string")
    assert {share for _, share, _ in quality_rules.order_rules(long)} == {0.0}


def test_quality_model_equals_plain_sums_and_pools(spark):
    """Standardising, normal equations, ridge and the pooled curve against loops over the same rows."""
    rng = random.Random(11)
    rows = []
    for i in range(120):
        good = i % 3 > 0
        words = [rng.choice(("alpha", "beta", "gamma", "delta")) + ("" if good else rng.choice("#$%&*")) for _ in range(rng.randrange(5, 40))]
        rows.append((i, " ".join(words) + ("." if good or rng.random() < 0.3 else "!!"), float(good)))
    frame = spark.createDataFrame(rows, "id long, text string, label double")
    model = quality_classifier.learn(frame.repartition(3))

    held = {r["id"] for r in frame.where(F.pmod(F.xxhash64(F.xxhash64("id")), F.lit(5)) == 0).collect()}
    assert 0 < len(held) < len(rows) // 2
    stats = {i: quality_classifier.statistics(text.encode()) for i, text, _ in rows}
    n = quality_classifier.N_STATS
    mean = [sum(s[k] for s in stats.values()) / len(rows) for k in range(n)]
    scale = [max(0.02, (sum((s[k] - mean[k]) ** 2 for s in stats.values()) / len(rows)) ** 0.5) for k in range(n)]
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)

    size = quality_classifier.FEATURES
    z = {}
    for i, s in stats.items():
        x = np.array([min(8.0, max(-8.0, (a - m) / d)) for a, m, d in zip(s, mean, scale, strict=True)])
        z[i] = np.array([(2 / size) ** 0.5 * np.cos(float(x @ model.frequencies[:, f]) + model.phases[f]) for f in range(size)] + [1.0])
    gram, target = quality_classifier.PENALTY * np.eye(size + 1), np.zeros(size + 1)
    for i, _, label in rows:
        if i not in held:
            gram += np.outer(z[i], z[i])
            target += label * z[i]
    weights = np.linalg.solve(gram, target)
    assert np.allclose(gram @ model.weights, target, atol=1e-6) and np.allclose(weights, model.weights, atol=1e-4)

    # the calibrated value of a held-out row: the greatest lower mean over all runs that hold it
    kept = sorted((float(z[i] @ model.weights), label) for i, _, label in rows if i in held)
    ys = [y for _, y in kept]
    plain = [
        max(min(sum(ys[j : k + 1]) / (k + 1 - j) for k in range(i, len(ys))) for j in range(i + 1)) for i in range(len(ys))
    ]
    knots = {}
    for (x, _), p in zip(kept, plain, strict=True):
        knots.setdefault(round(p, 9), []).append(x)
    got = dict(zip(np.round(model.steps[1], 9).tolist(), model.steps[0].tolist(), strict=True))
    assert got.keys() == knots.keys()
    assert all(abs(got[p] - sum(xs) / len(xs)) < 1e-6 for p, xs in knots.items())

    # scores: the straight line between the knots beside the raw value
    scored = {r["doc_id"]: r["score"] for r in quality_classifier.score(frame.withColumnRenamed("id", "doc_id"), model).collect()}
    at = sorted((sum(xs) / len(xs), p) for p, xs in knots.items())
    for i, _, _ in rows:
        raw = float(z[i] @ model.weights)
        below, above = [k for k in at if k[0] <= raw], [k for k in at if k[0] > raw]
        if not below or not above:
            want = (below or above)[-1 if below else 0][1]
        else:
            (x0, p0), (x1, p1) = below[-1], above[0]
            want = p0 + (p1 - p0) * (raw - x0) / (x1 - x0)
        assert abs(scored[i] - want) < 1e-5, i
