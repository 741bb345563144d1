"""Learned operators: held-out accuracy, recall, brute-force twins, odd rows, and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import SF

import corpus_pipeline
from convoy.llm import ctw, embedding_dedup, quality_classifier, queries, toxicity
from convoy.llm.common import components

SF_LARGER = "/root/testdata/sf0.01"


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def _vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 32))
    rows = []
    for i in range(600):
        v = base[i % 40] + rng.normal(size=32) * rng.choice([0.05, 0.15, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    rows += [
        (2000, None, 0), (2001, [0.0] * 32, 0), (2002, [float("nan")] * 32, 0), (2003, [None] + [1.0] * 31, 0),
        (2004, rows[0][1], None), (2005, rows[0][1][:16], 0), (2006, [], 0), (2007, [float("inf")] * 32, 0), (2008, rows[0][1], 1),
        (None, rows[0][1], 0),
    ]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, gid int")


def test_embedding_links(spark):
    rows, frame = _vectors(spark)
    ok = [r for r in rows if r[1] and len(r[1]) == 32 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) and r[2] is not None]
    x = np.array([r[1] for r in ok])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in ok])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    for block in (16, 2048):  # buckets cut into cells, and whole
        got = defaultdict(list)
        for r in embedding_dedup.near_duplicates(frame, block=block).collect():
            got[r["vec_id"]].append(r)
        assert sum(map(len, got.values())) == len(rows)
        found = [got[r[0]][0]["n_links"] for r in ok]
        assert all(f <= n for f, n in zip(found, near.sum(axis=1), strict=True))
        assert sum(found) >= 0.9 * near.sum()
        for i in (2000, 2001, 2002, 2003, 2004, 2005, 2006, 2007):
            assert got[i][0]["n_links"] == 0 and got[i][0]["component_id"] == i and got[i][0]["kept"]
        assert got[1005][0]["component_id"] == 0 and not got[1005][0]["kept"] and got[0][0]["kept"]
        assert got[None][0]["component_id"] == 0 and not got[None][0]["kept"]
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_cells_do_not_change_links(spark):
    _, frame = _vectors(spark)
    key = lambda block: sorted(str(tuple(r)) for r in embedding_dedup.near_duplicates(frame, block=block).collect())
    assert key(8) == key(2048)


def test_base_score_and_tree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b"\n"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    count = Counter(w for i, ws in texts.items() if not held[i] for w in ws)
    total, distinct = sum(count.values()), len(count)
    bottom = total + 0.5 * (distinct + 1)
    training = queries.fold_of(ctw.F.col("doc_id"), 5) != 1
    for head in (64, 1 << 17):  # most tokens joined, and most broadcast
        for r in ctw.score(docs, training, head=head).collect():
            ws = texts[r["doc_id"]]
            assert r["training"] != held[r["doc_id"]] and r["n_tokens"] == len(ws) and r["train_tokens"] == total
            assert r["n_known"] == sum(count[w] > 0 for w in ws)
            assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.5) / bottom) for w in ws), rel_tol=1e-9)
            assert r["score"] < 0


def reference_log10(training, text, depth):
    """Context-tree weighting straight from its definition, with counts in a dict."""
    counts = defaultdict(lambda: [0, 0])

    def path(data, i):
        byte, node = data[i], 1
        for k in range(7, -1, -1):
            yield node, byte >> k & 1
            node = node * 2 + (byte >> k & 1)

    pad = b"\n" * depth
    for t in training:
        data = pad + ctw.stream(t)
        for i in range(depth, len(data)):
            for node, bit in path(data, i):
                for d in range(depth + 1):
                    counts[data[i - d : i], node][bit] += 1
    children = defaultdict(set)
    for context, node in counts:
        if context:
            children[context[1:], node].add(context)

    def log_kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    memo = {}

    def parts(context, node):
        if (context, node) not in memo:
            own = log_kt(*counts[context, node])
            deeper = sum(parts(c, node)[1] for c in children[context, node]) if len(context) < depth else None
            memo[context, node] = (None if deeper is None else own - deeper, own if deeper is None else np.logaddexp(own, deeper) - math.log(2))
        return memo[context, node]

    data, total = pad + ctw.stream(text), 0.0
    for i in range(depth, len(data)):
        for node, bit in path(data, i):
            mixed, left, last = 0.0, 1.0, 0.5
            for d in range(depth + 1):
                key = (data[i - d : i], node)
                if key not in counts:
                    break
                zeros, ones = counts[key]
                p = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
                odds = parts(*key)[0]
                last = mixed + left * p
                if odds is not None:
                    share = left / (1 + math.exp(min(69, max(-69, odds))))
                    mixed, left = mixed + (left - share) * p, share
            total += math.log10(last)
    return total


def test_tree_equals_definition(spark):
    rng = np.random.default_rng(4)
    make = lambda n: " ".join("".join(rng.choice(list("abé"), rng.integers(1, 5))) for _ in range(n))
    texts = [make(40) for _ in range(6)] + ["", None, "zzz unseen"]
    frame = spark.createDataFrame([(i, t, i < 5) for i, t in enumerate(texts)], "doc_id long, text string, use boolean")
    known = [(t or "").encode() for t in texts[:5]]
    for head_grams in (1 << 21, 20, 0):  # all grams broadcast, some joined, all joined
        for r in ctw.score(frame, ctw.F.col("use"), depth=3, head_grams=head_grams).collect():
            want = reference_log10(known, (texts[r["doc_id"]] or "").encode(), 3)
            assert math.isclose(r["score"], want, rel_tol=1e-6), (r, want)


def test_families_stay_whole(monkeypatch):
    monkeypatch.setattr(ctw, "CHUNK", 5)
    grams = np.sort(np.random.default_rng(2).integers(0, 6 << 24, 400)).astype(np.int64)
    batches = [ctw.pa.RecordBatch.from_arrays([ctw.pa.array(grams[s : s + 3])], ["gram"]) for s in range(0, 400, 3)]
    pieces = [p[0] for p in ctw._families(iter(batches), 3)]
    assert np.concatenate(pieces).tolist() == grams.tolist()
    heads = [set((p >> np.uint64(16)).tolist()) for p in pieces]
    assert len(pieces) > 50 and sum(map(len, heads)) == len(set().union(*heads))


def test_scoring_odd_rows(odd, empty, monkeypatch):
    assert ctw.score(empty, ctw.F.lit(True)).count() == 0
    none = ctw.score(odd, ctw.F.lit(False)).collect()
    assert len(none) == odd.count() and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)
    whole = {(r["doc_id"], r["n_tokens"]): r["score"] for r in ctw.score(odd, ctw.F.lit(True)).collect()}
    assert whole[5, 40_001] < 0 and whole[2, 1] == whole[3, 1] == whole[4, 1] < 0
    one, _ = zip(*ctw._blocks(iter([b"abc def\n", b"\n"]), 4), strict=True)
    monkeypatch.setattr(ctw, "BLOCK", 3)
    many, _ = zip(*ctw._blocks(iter([b"abc def\n", b"\n"]), 4), strict=True)
    assert np.concatenate(one).tolist() == np.concatenate(many).tolist()


def _held_out(spark, query, column):
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    return query(spark, SF_LARGER).join(labels, "doc_id").where("held_out").select("score", "predicted", column).collect()


def _auc(rows, column):
    good, bad = [r["score"] for r in rows if r[column] == 1], [r["score"] for r in rows if r[column] == 0]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_toxicity_held_out(spark):
    rows = _held_out(spark, queries.op4_toxicity, "toxic")
    assert _auc(rows, "toxic") > 0.9
    assert all(r["predicted"] == 0 for r in rows if r["toxic"] == 0)


def test_toxicity_folding_exceptions_and_odd_rows(spark, odd, empty):
    assert toxicity.folded_words("L0SER, lоѕer! ｌｏｓｅｒ l​oser 2024 c'est!") == ["loser", "loser", "loser", "loser", "c", "est"]
    lexicon = toxicity.Lexicon({"trash": 5.0, "lose*": 4.0}, {"trash can", "losers club"}, (1.0, 0.0, -3.0))
    assert lexicon.evidence("trash")[2] == 1 and lexicon.evidence("a trash can here")[2] == 0
    assert lexicon.evidence("losers club")[2] == 0 and lexicon.evidence("the losing lost loser")[2] == 1
    assert lexicon.evidence(None) == (0.0, 0.0, 0) and lexicon.evidence("x" * 10**6)[2] == 0
    assert lexicon.score("tr4$h") > lexicon.score("tr4$h and " + "many clean words " * 300) > lexicon.score("")
    assert toxicity.score(odd, lexicon).count() == odd.count() and toxicity.score(empty, lexicon).count() == 0
    nothing = toxicity.learn(spark.createDataFrame([], "id long, text string, label double"))
    assert {r["score"] < 1e-6 for r in toxicity.score(odd, nothing).collect()} == {True}


def test_quality_held_out(spark):
    rows = _held_out(spark, queries.op8_quality_classifier, "quality")
    assert _auc(rows, "quality") > 0.98
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_quality_odd_rows(spark, odd, empty):
    flat = quality_classifier.learn(spark.createDataFrame([(1, "x", 1.0)], "id long, text string, label double"))
    assert {r["score"] for r in quality_classifier.score(odd, flat).collect()} == {1.0}
    assert quality_classifier.score(empty, flat).count() == 0
    for text in (None, b"", b" \n", b"x" * 10**6, "中文 🙂".encode()):
        assert np.isfinite(quality_classifier.statistics(text)).all() and len(quality_classifier.statistics(text)) == quality_classifier.N_STATS
    x, y = quality_classifier.isotonic(np.array([3.0, 1.0, 2.0, 4.0]), np.array([0.0, 0.0, 1.0, 1.0]))
    assert x.tolist() == [1.0, 2.5, 4.0] and y.tolist() == [0.0, 0.5, 1.0]


def test_pipeline_stages(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, SF), f"test_{name}")
        counts.append(docs.count())
        assert docs.columns == before.columns or name == "bpe"
    assert counts[0] < before.sparkSession.read.parquet(f"{SF}/documents.parquet").count() and counts[2] < counts[1] == counts[0]
    assert corpus_pipeline.run(spark, SF).count() == counts[-1]
    for frame in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.staged(stage(spark, frame, SF), "test_odd")
