"""Spelling variants, quality and hard negatives against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from ledgerloom.llm import hard_negatives, quality_classifier, spelling_variants
from ledgerloom.llm.common import Scratch


def plain_variants(rows):
    """The contract, word by word and pair by pair."""
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]])
    return out


def test_variants(spark):
    rnd = random.Random(6)
    base = ["straße", "Éclair", "abcdef", "hello", "aaaaa", "façades", "×÷×÷×"] + ["".join(rnd.choice("abé") for _ in range(rnd.randint(4, 7))) for _ in range(40)]
    long = "".join(rnd.choice("acgt") for _ in range(2000))
    words = [*base, long, long[:700] + "x" + long[700:], long[:64], long[:65], long[:65][:30] + "z" + long[31:65]]
    rows = []
    for i in range(150):
        some = rnd.choices(words, weights=[2 ** (9 - j % 10) for j in range(len(words))], k=60)
        some = [w if rnd.random() < 0.7 else w[: (k := rnd.randrange(len(w)))] + rnd.choice(["", "x", w[k] * 2]) + w[k + 1 :] for w in some]
        rows.append((i, " ".join(w.upper() if rnd.random() < 0.3 else w for w in some) + rnd.choice([".", "Ā", "漢", "\n"])))
    rows += [(None, "hello hello hello"), (900, None), (901, ""), (902, "12 ... !"), rows[3], rows[3], *((1000 + i, f"{long} {long[:700]}x{long[700:]} {long[:65]}") for i in range(3))]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants.group_variants(docs, Scratch(spark, "t")).collect()}
    want = plain_variants(rows)
    assert got == want and any(f and r != f for f, r, *_ in want.values()) and len(long) in map(len, want)
    assert spelling_variants.group_variants(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_chains_of_any_length_are_followed(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)] + [(f"v{i}", "w037") for i in range(50)]
    got = {r.word: r.root for r in spelling_variants.follow(spark.createDataFrame(chain, "word string, form string"), Scratch(spark, "t")).collect()}
    assert got == {a: "w037" for a, _ in chain}
    assert spelling_variants.follow(spark.createDataFrame([], "word string, form string"), Scratch(spark, "t")).count() == 0


def test_each_near_pair_shares_one_key():
    words = list({"".join(t) for t in np.random.default_rng(1).choice(list("abc"), (200, 6)).tolist()} | {"aaaaa", "aaaaaa", "abcabca"})
    owners, keys = spelling_variants.deletion_keys(words)
    held = collections.defaultdict(list)
    for o, k in zip(owners.tolist(), keys.tolist(), strict=True):
        held[k].append(o)
    shared = collections.Counter((a, b) for group in held.values() for a in group for b in group if a < b)
    cuts = [{w} | {w[:i] + w[i + 1 :] for i in range(len(w))} for w in words]
    assert sum(map(len, cuts)) == len(keys)
    for (a, b), times in shared.items():
        assert cuts[a] & cuts[b] and (times == 1 or len(words[a]) == len(words[b]))


def plain_quality(rows, labels):
    """The classifier in plain numpy, from whole matrices."""
    q = quality_classifier
    label = {}
    for i, y in labels:
        if i is not None and y in (0, 1):
            label.setdefault(i, set()).add(y)
    learn = [(t or "", min(label[i])) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 5 and len(label.get(i, ())) == 1]
    totals = np.array([q.count_text(t) for t, _ in learn]).sum(axis=0)
    x, y = q.transform([q.count_text(t) for t, _ in learn], totals) / q.STEP, np.array([k for _, k in learn])
    spread = {k: np.cov(x[y == k].T, bias=True) for k in (0, 1)}
    share = {k: (y == k).mean() for k in (0, 1)}
    pooled, scale = sum(share[k] * spread[k] for k in (0, 1)), x.std(axis=0) + 1e-3
    dense = []
    z = q.transform([q.count_text(t or "") for _, t in rows], totals) / q.STEP
    for k in (0, 1):
        c = ((1 - q.POOLED) * spread[k] + q.POOLED * pooled) / np.outer(scale, scale)
        c = (1 - q.UNIT) * c + q.UNIT * max(np.trace(c) / len(c), 1e-3) * np.eye(len(c))
        away = (z - x[y == k].mean(axis=0)) / scale
        dense.append(np.log(share[k]) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,ij->i", away, np.linalg.solve(c, away.T).T))
    return 1 / (1 + np.exp(np.clip(dense[0] - dense[1], -700, 700)))


def test_quality(spark):
    rnd = random.Random(2)
    good = lambda: " ".join(rnd.choice(["the", "cat", "sat", "On", "mats,", "there."]) for _ in range(rnd.randint(30, 90)))
    bad = lambda: rnd.choice([" | ".join(rnd.choice(["a1", "B!!", "$$"]) for _ in range(40)), "SPAM!! " * rnd.randint(20, 60), "x\n" * 40])
    rows = [(i, good() if i % 4 else bad()) for i in range(400)] + [(None, good()), (401, None), (402, ""), (403, "é" * 200000), (5, good()), (8, bad()), (8, "$ " * 9)]
    labels = [(i, int(i % 4 > 0)) for i in range(400)] + [(7, 0), (9, None), (11, 2), (None, 1), (12, 0)]
    docs = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "doc_id long, text string, quality int, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_classifier.classify(docs, marks, Scratch(spark, "t")).collect()
    key = lambda i, s: (i is None, i or 0, round(s, 6))
    assert sorted(key(r.doc_id, r.score) for r in got) == sorted(key(i, s) for (i, _), s in zip(rows, plain_quality(rows, labels), strict=True))
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.predicted, int(r.doc_id % 4 > 0)) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400 and r.doc_id not in (5, 8)]
    assert sum(a == b for a, b in held) >= 0.97 * len(held) > 40
    one = quality_classifier.classify(docs, marks.where("quality = 1"), Scratch(spark, "t")).collect()
    assert {r.score for r in one} == {1.0} and {r.score for r in quality_classifier.classify(docs, marks.limit(0), Scratch(spark, "t")).collect()} == {0.5}
    assert quality_classifier.classify(docs.limit(0), marks, Scratch(spark, "t")).count() == 0


def plain_negatives(rows):
    """Every pair by whole numbers of any size."""
    there = []
    for i, v, label in rows:
        if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v):
            moved = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            there.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], moved))
    late = lambda i: (i is None, i or 0)
    out = []
    for a, (i, v, label) in enumerate(there):
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), j, k) for b, (j, w, k) in enumerate(there) if b != a and len(w) == len(v)]
        best = sorted(((s, j) for s, j, k in scored if k == label), key=lambda t: (-t[0], late(t[1])))[:5]
        for p, j in best:
            fit = sorted(((s, m) for s, m, k in scored if k != label and 30 * p <= 100 * s <= 90 * p), key=lambda t: (-t[0], late(t[1])))[:10]
            out += [(i, j, r + 1, m, p, s) for r, (s, m) in enumerate(fit)]
    return out


@pytest.mark.parametrize(("shard_rows", "block_anchors"), [(10_000, 2_000), (60, 3)])
def test_negatives(spark, monkeypatch, shard_rows, block_anchors):
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    g = np.random.default_rng(4)
    centres = g.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.3 * g.normal(size=12)).astype(np.float32).tolist(), int(i % 3 if i % 3 else g.integers(10))) for i in range(420)]
    same = rows[100][1]
    rows += [(500 + i, same, i % 4) for i in range(60)]  # copies of an anchor's vector, in several labels
    rows += [(600, None, 1), (700, [0.5] * 12, None), (800, [float("nan")] * 12, 1), (900, [None] * 12, 1), (1000, [float("inf")] * 12, 2), (1100, [], 3), (1101, [], 3), (1102, [], 4), (1200, [0.5, -0.25], 1),
             (1201, [0.5, 0.25], 1), (1202, [0.3, 0.1], 2), (None, same, 5), (300, rows[300][1], 7), (301, rows[301][1], rows[301][2])]
    vectors = spark.createDataFrame([(i, v, x, 1, "s") for i, v, x in rows], "vec_id long, embedding array<float>, label int, row int, score string")
    got = [tuple(r) for r in hard_negatives.mine(vectors, Scratch(spark, "t"), shard_rows=shard_rows, block_anchors=block_anchors).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    order = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=order) == sorted(plain_negatives(rows), key=order) and len(got) > 100
    assert hard_negatives.mine(vectors.limit(0), Scratch(spark, "t")).count() == 0


def test_trees_search_exactly_and_leave_nodes_out(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    g = np.random.default_rng(9)
    centres = g.normal(size=(40, 8)) * 800
    x = np.floor(np.concatenate([c + g.normal(size=(100, 8)) * 20 for c in centres]))
    labels, ids = np.arange(len(x)) // 100, g.permutation(len(x)).astype(np.int64)
    tree = hard_negatives.VantageTree(x, ids, labels)
    looked = 0
    for a in range(0, len(x), 331):
        probe, s = tree.probe(x[a]), (x @ x[a]).astype(int)
        for k, low, high in ((5, 0, int(s.max())), (10, int(s.max() * 0.3), int(s.max() * 0.9)), (3, 5, 4)):
            got = list(zip(*(v.tolist() for v in tree.first(probe, k, low, high, lambda there, _, a=a: there != labels[a])), strict=True))
            assert got == [(t, i) for t, i in sorted(((t, i) for t, i, y in zip(s.tolist(), ids.tolist(), labels, strict=True) if y != labels[a] and low <= t <= high), key=lambda r: (-r[0], r[1]))[:k]]
        looked += len(probe[-1])
    assert looked < 0.5 * len(range(0, len(x), 331)) * len(x) / hard_negatives.LEAF
    big = hard_negatives.VantageTree(x * 1e9, ids, labels)  # beyond doubles' whole numbers
    q = [int(v) for v in x[0] * 1e9]
    want = sorted(((max(-(1 << 62), min(1 << 62, sum(int(v) * w for v, w in zip(r, q, strict=True)))), i) for r, i in zip((x * 1e9).tolist(), ids.tolist(), strict=True)), key=lambda r: (-r[0], r[1]))[:7]
    assert list(zip(*(v.tolist() for v in big.first(big.probe(x[0] * 1e9), 7, -(1 << 62), 1 << 62, lambda there, _: there >= 0)), strict=True)) == want
