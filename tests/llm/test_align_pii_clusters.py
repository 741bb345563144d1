"""Personal data, tokenizer alignment and centroid clustering against brute force and odd rows."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from conftest import SF
from tokenizers import Tokenizer

from convoy.llm import alignment, clustering, pii, queries

# ---- personal data ---------------------------------------------------------------------------

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_luhn(digits):
    doubled = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            fits = (
                kind == 0
                or kind == 1 and all(int(x) <= 255 for x in m.group().split("."))
                or kind == 2 and 13 <= len(digits) <= 19 and plain_luhn(digits)
                or kind == 3 and 9 <= len(digits) <= 15
            )
            out += [(kind, *m.span())] if fits else []
    return out


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.seeds())


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for alphabet, size in (("aé0129.@+- ()_%\n", 60), ("0127. -+", 45), ("a@.b-", 30), ("41 -", 30)):
        for _ in range(6000):
            text = "".join(rng.choices(alphabet, k=rng.randrange(size)))
            assert pii.base_spans(text)[0] == plain_spans(text), text


def test_viterbi_and_gradient_equal_enumeration():
    rng = np.random.default_rng(3)
    moves = np.where(pii.FORBIDDEN, -1e9, rng.normal(size=pii.FORBIDDEN.shape))
    scores = [rng.normal(size=(n, pii.TAGS)) for n in (1, 3, 3, 2, 4, 1)]

    def total(score, tags):
        path = [0, *tags, 0]
        return sum(score[t, g] for t, g in enumerate(tags)) + sum(moves[a, b] for a, b in zip(path, path[1:]))

    for score, tags in zip(scores, pii.viterbi(scores, moves), strict=True):
        every = list(np.ndindex(*[pii.TAGS] * len(score)))
        assert total(score, tags) == pytest.approx(max(total(score, t) for t in every))
    # the loss by enumeration, its gradient by differences
    ids, gold = rng.integers(0, 6, (2, 3, pii.WIDTH)), np.array([[1, 2, 0], [0, 3, 0]])
    mask = np.array([[True, True, True], [True, True, False]])
    weights = rng.normal(size=(6, pii.TAGS)) / 4
    loss, by_weights, by_moves = pii.gradient(ids, mask, gold, weights, moves)
    want = 0
    for k, n in enumerate((3, 2)):
        score = weights[ids[k, :n]].sum(axis=1)
        paths = [total(score, t) for t in np.ndindex(*[pii.TAGS] * n)]
        want += np.log(np.exp(paths).sum()) - total(score, gold[k, :n])
    assert loss == pytest.approx(want)
    for x, g, at in ((weights, by_weights, (2, 1)), (weights, by_weights, (0, 0)), (moves, by_moves, (1, 2)), (moves, by_moves, (0, 3))):
        x[at] += 1e-5
        more = pii.gradient(ids, mask, gold, weights, moves)[0]
        x[at] -= 1e-5
        assert (more - loss) / 1e-5 == pytest.approx(g[at], abs=1e-3)


def test_field_learns_the_labelled_table_and_adds_what_no_pattern_finds(field):
    missed = wrong = spans = 0
    for text, gold in pii.seeds():
        base, added = next(pii.find([text], field))
        spans += len(gold)
        missed += len(set(gold) - set(base + added))
        wrong += len(set(base + added) - set(gold))
    assert missed + wrong <= 2 < spans
    found = {}
    for text in ("ring 0171 987 6543 ok", "tel (040) 8765 432 or", "4111111111111111 5500000000000004 x", "phone 555-123-9876 now"):
        base, added = next(pii.find([text], field))
        assert not base
        found[text] = [text[s:e] for _, s, e in added]
    assert list(found.values()) == [["0171 987 6543"], ["(040) 8765 432"], ["4111111111111111", "5500000000000004"], ["555-123-9876"]]
    for text in ("in 2021-03-04 at 12:00:00 we saw 4711 of 0815", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff x 1234567890 y", "a b c", ""):
        assert next(pii.find([text], field)) == ([], [])


def test_sequences_cut_the_chain_only_beside_untagged_words():
    rng = random.Random(5)
    for _ in range(2000):
        text = " ".join(rng.choices(["a", "b", "7", "x@y"], weights=[6, 6, 1, 1], k=rng.randrange(30)))
        words = [m.span() for m in pii.WORD.finditer(text)]
        hot = {i for i, (s, e) in enumerate(words) if pii.TRIGGER.search(text[s:e])}
        near = {j for i in hot for j in range(i - pii.REACH, i + pii.REACH + 1) if 0 <= j < len(words)}
        runs = list(pii.sequences(text))
        got = [words.index(w) for run in runs for w in run]
        assert got == sorted(got) and near <= set(got)
        for one, two in zip(runs, runs[1:]):
            assert words.index(two[0]) - words.index(one[-1]) >= 2


def test_long_texts_in_linear_time(field):
    for unit in ("0", "a", "a@", "1.", "+1 ", "4 ", "x1 ", "(", "1-", "x" * 50 + "7"):
        began = time.time()
        list(pii.find([unit * (200_000 // len(unit))], field))
        assert time.time() - began < 30, unit


def test_pii_rows(spark, odd, empty, documents, field):
    rows = documents.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op11_pii(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        spans, g = plain_spans(r["text"] or ""), got[r["doc_id"]]
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert g["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [g[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in range(4)]
        assert set(filter(None, text.split(","))) <= set(g["spans"].split(","))
    assert pii.scan_documents(odd, field).count() == odd.count()
    assert pii.scan_documents(empty, field).count() == 0
    assert pii.labelled_table(empty) == []


# ---- tokenizer alignment ---------------------------------------------------------------------

A, B = Tokenizer.from_file(queries.BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
A.encode_special_tokens = True


def brute_alignment(texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of texts, one by one."""
    alphabet = alignment.byte_alphabet()
    a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in A.get_vocab().items() if set(t) <= alphabet.keys()}

    def b_bytes(i):
        piece = B.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
        want = (" " + text).encode()
        if b"".join(map(a_bytes.get, a)) != want or b"".join(map(b_bytes, b)) != want:
            return None
        owner = [[i for i, t in enumerate(x) for _ in get(t)] for x, get in ((a, a_bytes.get), (b, b_bytes))]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(*owner, strict=True)))]
        groups, ga, gb = [], [], []
        for at, (i, j) in enumerate(zip(*owner, strict=True)):
            last = [at + 1 == len(want) or o[at + 1] != o[at] for o in owner]
            ga += [str(a[i])] * last[0]
            gb += [str(b[j])] * last[1]
            if all(last):
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
        return len(a), len(b), len(groups), links, ";".join(groups)

    rows = [one(t) for t in texts]
    counts = Counter(x for r in rows if r for x in r[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (*r[:3], len(r[3]), sum(counts[x] == most[x[1]] for x in r[3]), sum(counts[x] for x in r[3]), hashlib.sha256(r[4].encode()).hexdigest())
        if r
        else (0, 0, 0, 0, 0, 0, "")
        for r in rows
    ]


def odd_texts():
    rng = random.Random(2)
    pool = [" ", "  ", "\n", "\t", "the", "ing", "é", "中文", "🙂", "'s", "<s>", "<|endoftext|>", "<0x41>", "12", ".", "Á", "　", "\x00"]
    texts = ["".join(rng.choices(pool, k=rng.randrange(1, 12))) for _ in range(400)]
    return texts + ["", None, " ", "a ", " a", "x\n y", "has ▁ mark", "w" * 5000, "word " * 3000, "the the the"] * 2


def test_alignment_equals_brute_force(spark, monkeypatch):
    texts = odd_texts()
    frame = spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(texts)], "doc_id long, text string, k1 string, copies int")
    want = brute_alignment(texts)
    args = (queries.BYTE_LEVEL, queries.PIECES, queries.PATTERN)
    for top in (alignment.TOP, 40, 1):  # all counts sent to the tasks, and most of them joined
        got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(frame, *args, top=top).collect()}
        assert [got[i] for i in range(len(texts))] == want, top


def test_alignment_hands_counts_on_in_pieces(monkeypatch):
    """With room for a few units only, the pair counts still add up."""
    texts = [t for t in odd_texts() if t]
    sums = []
    for memo, links, size in ((1 << 17, 1 << 20, 1 << 14), (5, 20, 3)):
        for name, value in (("MEMO", memo), ("LINKS", links), ("SLICE", size)):
            monkeypatch.setattr(alignment, name, value)
        tokenizers = alignment.Tokenizers(queries.BYTE_LEVEL, queries.PIECES, queries.PATTERN)
        total, rows = Counter(), []
        for k, text in enumerate(texts):
            for found in tokenizers.align(text, 1 + k % 3):
                if isinstance(found, tuple):
                    total.update(dict(zip(found[0].tolist(), found[1].tolist(), strict=True)))
                else:
                    rows.append(found and (found.a, found.b, found.steps, found.groups))
        total.update(dict(zip(*[x.tolist() for x in tokenizers.count()], strict=True)))
        sums.append(({k: n for k, n in total.items() if n}, rows))
    assert sums[0] == sums[1]


def test_alignment_of_the_table_and_odd_rows(spark, odd, empty, documents):
    args = (queries.BYTE_LEVEL, queries.PIECES, queries.PATTERN)
    rows = documents.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_alignment(spark, SF).collect()}
    assert [got[r["doc_id"]] for r in rows] == brute_alignment([r["text"] for r in rows])
    assert alignment.align(odd, *args).count() == odd.count()
    assert alignment.align(empty, *args).count() == 0


# ---- centroid clustering ---------------------------------------------------------------------


def brute_clusters(rows, dims, k, rounds=10, scale=1024):
    """Lloyd's rounds in whole numbers of Python."""
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        by = {}
        for _, v in kept:
            by.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(by[j]) for x in zip(*by[j], strict=True)] if j in by else c for j, c in enumerate(centres)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in last:
        inertia[j] += d
    return [
        (i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
        for i, d, j in last
    ]


@pytest.mark.parametrize(("dims", "k", "width"), [(10, 4, 4), (6, 1, 6), (5, 9, 2)])
def test_clusters_equal_whole_number_lloyd(spark, dims, k, width):
    rng = np.random.default_rng(dims)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=dims) * rng.choice([0.1, 3])]) for i in range(60)]
    rows += [(i, rows[0][1]) for i in (100, 101, 102)] + [(5, rows[1][1]), (5, rows[2][1]), (None, rows[3][1]), (None, rows[3][1])]
    rows += [(200, None), (201, []), (202, [0.0] * (dims + 1)), (203, [float("nan")] * dims), (204, [None] + [1.0] * (dims - 1))]
    rows += [(205, [float("inf")] * dims), (206, [0.0] * dims), (207, [-0.0] * dims)]
    frame = spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<float>, cluster int, gid int")
    got = clustering.cluster(frame, dims=dims, k=k, width=width).collect()
    assert Counter(map(tuple, got)) == Counter(brute_clusters(rows, dims, k))


def test_clusters_of_few_empty_and_huge_vectors(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1e30, 0.0])], "vec_id long, embedding array<double>")
    got = clustering.cluster(frame, dims=2, k=8, width=1).collect()
    assert [(r["vec_id"], r["cluster"], r["distance"], r["inertia"]) for r in sorted(got)] == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert clustering.cluster(frame.limit(0), dims=2).count() == 0
