"""Operators against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import embedding_dedup, language_id, license_scan, near_copies, packing, simhash_dedup, substring_dedup, suffix_dedup
from ledgerloom.llm.common import Scratch, connected_components


def components(n, pairs):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return [top(i) for i in range(n)]


def test_connected_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()}
    want = components(361, pairs)
    assert all(want[k] == v for k, v in got.items()) and {x for p in pairs if p[0] != p[1] for x in p} == set(got)
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def texts_for(rnd, words, sep):
    make = lambda n: sep.join(rnd.choice(words) for _ in range(n))
    base = [make(rnd.randint(0, 90)) for _ in range(25)]
    out = base + [base[3], base[3], None, "", "a" * 70, "xyz" * 20]
    for _ in range(40):
        a, b = rnd.choice(base), rnd.choice(base)
        out.append(a[: rnd.randint(0, len(a))] + sep + make(2) + sep + b[rnd.randint(0, len(b)) :])
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup(spark, hot):
    texts = texts_for(random.Random(5), ["ab", "ba", "aab", "c", "é ", "abab"], "")
    k, at = 20, collections.Counter()
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        at.update(b[i : i + k] for i in range(len(b) - k + 1))
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), Scratch(spark, "t"), window=k, gram=8, shard_bytes=1500, hot_spans=hot).collect()}
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - k + 1):
            if at[b[j : j + k]] > 1:
                gone[j : j + k] = True
        runs = len(re.findall("1+", "".join("01"[int(x)] for x in gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), gone.sum(), runs, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup_tells_what_others_share(spark, hot):
    """Windows of 20 bytes are removed; n_shared is about strings of 12 that another document has."""
    rnd = random.Random(21)
    texts = texts_for(rnd, ["ab", "ba", "aab", "c", "é ", "abab"], "")
    rows = [*enumerate(texts), (3, texts[3]), (5, texts[9])]
    k, w, where, at = 12, 20, collections.defaultdict(set), collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        at.update(b[j : j + w] for j in range(len(b) - w + 1))
        for j in range(len(b) - k + 1):
            where[b[j : j + k]].add((i, b))
    want = []
    for i, b in raw:
        gone, shared = np.zeros(len(b), bool), np.zeros(len(b), bool)
        for j in range(len(b) - w + 1):
            gone[j : j + w] |= at[b[j : j + w]] > 1
        for j in range(len(b) - k + 1):
            shared[j : j + k] |= len(where[b[j : j + k]]) > 1
        want.append((i, len(b), int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest(), int(shared.sum())))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, Scratch(spark, "t"), window=w, shared=k, gram=5, shard_bytes=1500, hot_spans=hot)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "kept_sha256", "n_shared").collect()) == sorted(want)
    whole = {(r.doc_id, r.kept_sha256): bytes(r.kept) for r in suffix_dedup.remove_repeats(df, Scratch(spark, "t"), window=w, shared=k, gram=5, with_text=True).collect()}
    assert all(hashlib.sha256(v).hexdigest() == h for (_, h), v in whole.items()) and set(whole) == {(x[0], x[3]) for x in want}


def test_suffix_order_is_sorted():
    rnd = random.Random(2)
    spans = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randint(6, 60))) for _ in range(40)]
    ends = np.cumsum([len(s) for s in spans])
    text = b"".join(spans)
    starts = ends - np.array([len(s) for s in spans])
    order = suffix_dedup.suffix_order(text, starts, ends, 6)
    wins = [text[i : i + 6] for i in order]
    assert wins == sorted(wins) and len(order) == sum(len(s) - 5 for s in spans)


@pytest.mark.parametrize("hot", [4096, 1])
def test_substring_dedup(spark, hot):
    rnd = random.Random(6)
    rows = list(enumerate(texts_for(rnd, ["ab", "ba", "c", "d"], " ")))
    rnd.shuffle(rows)
    rows += [rows[0], rows[7]]
    k, first = 8, {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - k + 1):
            first[tuple(w[i : i + k])] = min(first.get(tuple(w[i : i + k]), 1 << 60), d)
    want = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        want.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    got = [tuple(r) for r in substring_dedup.remove_earlier(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t"), window=k, gram=3, shard_words=400, hot_spans=hot).collect()]
    assert sorted(got) == sorted(want)


def test_simhash_bits_and_links(spark):
    rnd = random.Random(7)
    some = [rnd.getrandbits(64) for _ in range(700)]
    a = np.array(some, dtype=np.uint64)
    b = np.array([rnd.choice(some) ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randint(0, 6))}) for _ in range(300)], dtype=np.uint64)
    for radius in (0, 1, 3, 5, 20):
        i, j = simhash_dedup.close_pairs(a, b, radius)
        want = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(w.tolist() for w in want), strict=True))


def test_simhash_large_bucket_is_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "BUCKET", 64)
    rnd = random.Random(8)
    prints = sorted({rnd.getrandbits(14) << 20 for _ in range(400)})
    links = simhash_dedup.close_links(spark.createDataFrame([(p,) for p in prints], "fp long"), Scratch(spark, "t"), 3)
    at = {p: i for i, p in enumerate(prints)}
    got = components(len(prints), [(at[r.a], at[r.b]) for r in links.collect()])
    arr = np.array(prints, dtype=np.uint64)
    i, j = np.nonzero(np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 3)
    assert got == components(len(prints), zip(i.tolist(), j.tolist(), strict=True))


@pytest.mark.parametrize("meeting", [1000, 8])
def test_near_copies(spark, monkeypatch, meeting):
    monkeypatch.setattr(near_copies, "CHUNK", meeting)
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(12):
        base = [rnd.choice(vocab) for _ in range(200)]
        for _ in range(1 + g * 3):
            copy = list(base)
            for _ in range(rnd.randint(0, 8)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    sets = [set(near_copies.shingle_set(t).tolist()) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in near_copies.drop_near_copies(df, Scratch(spark, "t")).collect()}
    assert kept == set(components(len(rows), pairs))


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 20)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 64))
    x = np.concatenate([base, base[rng.integers(0, 8, 160)] + rng.standard_normal((160, 64)) * rng.uniform(0.1, 0.5, (160, 1))]).astype(np.float32)
    rows = [(i, x[i].tolist(), int(i % 2)) for i in range(len(x))]
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    near = (u @ u.T >= 0.93) & (np.arange(200)[:, None] % 2 == np.arange(200)[None, :] % 2)
    np.fill_diagonal(near, False)
    root = components(200, zip(*(w.tolist() for w in np.nonzero(near)), strict=True))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), Scratch(spark, "t")).collect()}
    assert near.sum() > 100 and got == {i: (int(near[i].sum()), root[i]) for i in range(200)}


def test_best_fit_is_best_fit():
    rnd = random.Random(4)
    lengths = sorted((rnd.randint(1, 100) for _ in range(500)), reverse=True)
    into, offset = packing.best_fit(lengths, 100)
    room = []
    for n, w, o in zip(lengths, into, offset, strict=True):
        fits = [r for r in room if r >= n]
        if fits:
            assert room[w] == min(fits) and o == 100 - room[w]
            room[w] -= n
        else:
            assert w == len(room) and o == 0
            room.append(100 - n)


def test_tokens_equal_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = packing.default_vocabulary()
    lib, mine = tokenizers.Tokenizer.from_file(path), packing.byte_bpe(path)
    rnd = random.Random(11)
    pool = ["a", "B", " ", "  ", "\n", "é", "ß", "'s", "12", "!?", "日本", "🙂", "\t", "'LL", "don't", "　", "<|endoftext|>", "\x1c", "ﬁ"]
    for _ in range(400):
        t = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30)))
        assert mine(t) == lib.encode(t, add_special_tokens=False).ids


def test_language_profiles(spark):
    rnd = random.Random(12)
    langs = {"x": ["ka", "to", "mi"], "y": ["schr", "ung", "ein"], "z": ["tion", "eau", "ille"]}
    rows = [(i, " ".join("".join(rnd.choice(langs[l]) for _ in range(2)) for _ in range(12)), l) for i in range(240) for l in [rnd.choice("xyz")]]
    r = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    want = {i: l for i, _, l in rows}
    assert len(r) > 30 and all(x.lang_pred == want[x.doc_id] for x in r)


def test_ngrams_of_parts_equal_the_whole(monkeypatch):
    text = "Über den Wolken, 12 muss die Freiheit wohl grenzenlos sein! " * 40
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "PART", 100)
    parts = language_id.ngram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    words = [f" {w} " for w in re.findall(r"[^\W\d_]+", text.lower())]
    grams = collections.Counter(w[i : i + n] for w in words for n in range(1, 6) for i in range(len(w) - n + 1) if w[i : i + n].strip())
    assert sorted(grams.values()) == sorted(whole[1].tolist())


def jaccard_components(rows):
    """The smallest id of each component of (id, text) rows by plain sets of five-word shingles."""
    sets = []
    for _, t in rows:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    return components(len(rows), pairs)


def test_near_copies_of_short_texts_are_all_found(spark):
    """Pairs at 4 of 5 shingles, some of whose majority fingerprints lie more than 20 bits apart."""
    rnd = random.Random(11)
    rows = []
    for _ in range(1500):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(9)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:8]))]
    kept = {r.doc_id for r in near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert kept == set(range(0, len(rows), 2))


def test_near_copies_without_a_common_least_hash(spark, monkeypatch):
    """Every fifth pair at 0.8 lacks a common least hash; long and short texts, with one least meeting told apart."""
    monkeypatch.setattr(near_copies, "LEAST", 1)
    rnd = random.Random(12)
    rows = []
    for n in [60, 104, 154, 204, 304] * 12:
        words = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        for cut in (0, (n - 4) // 5, (n - 4) // 5 + 1):
            rows.append((len(rows), " ".join(words[cut:])))
    kept = {r.doc_id for r in near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert kept == set(jaccard_components(rows))


def test_license_rules(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"
    rows = [(1, mit), (2, "x\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0."), (3, "You may obtain a copy of the License at"), (4, "nothing")]
    r = {x.doc_id: (x.licenses, x.status) for x in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert r == {1: ("MIT", "known"), 2: ("Apache-2.0,MIT", "known"), 3: ("", "partial"), 4: ("", "none")}
    assert all(re.search(license_scan._trigger(), s) for ps in license_scan.SENTENCES.values() for s in ps)
    assert all(any(x in t for x in license_scan.STEMS) for t in license_scan.TRIGGERS)
    named = {f"named-{n}" for n in license_scan.NAMES}
    assert {i for _, run in license_scan.RULES for part in run for i in part.rstrip("?").split("|")} <= set(license_scan.SENTENCES) | named
    assert set(license_scan._known().values()) == set(license_scan.SENTENCES) | named


def test_every_license_line_of_the_documents(spark):
    want = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All rights reserved.": "LicenseRef-Proprietary", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = {x.doc_id: set(x.licenses.split(",")) for x in license_scan.scan(docs).collect()}
    held = {line: [d.doc_id for d in docs.collect() if d.text and line in d.text] for line in want}
    assert all(held.values()) and all(want[line] in r[i] for line, ids in held.items() for i in ids)
    known = set().union(*map(set, held.values()))
    lines = [x for d in docs.collect() for x in (d.text or "").split("\n") if re.search(r"licen[sc]e|rights reserved", x, re.I) and d.doc_id not in known]
    assert not lines


def test_all_rights_reserved_belongs_to_the_license_that_follows(spark):
    bsd = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]
    text = "Copyright (c) X. All rights reserved. " + ". ".join(license_scan.SENTENCES[i][0] for i in bsd)
    rows = [(1, text), (2, "all\n# RIGHTS reserved"), (3, "overall rights reserved")]
    r = {x.doc_id: (x.licenses, x.status) for x in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert r == {1: ("BSD-2-Clause", "known"), 2: ("LicenseRef-Proprietary", "known"), 3: ("", "none")}


def test_licenses_by_name_and_by_sequence(spark):
    say = lambda *ids: ".\n".join(license_scan.SENTENCES[i][0].capitalize() for i in ids) + "."
    cases = {
        "This tool is available under the terms of the MIT License.": ("MIT", "known"), "// SPDX-License-Identifier: BSD-2-Clause": ("BSD-2-Clause", "known"), say("isc-grant"): ("ISC", "known"),
        say("isc-grant", "mit-grant", "mit-notice", "isc-as-is"): ("MIT,ISC", "partial"),  # what stands around a taken run doesn't meet
        say("mit-grant", "isc-grant", "mit-notice", "isc-as-is"): ("MIT,ISC", "known"), "Licensed under the Mozilla Public License, v. 2.0. More.": ("MPL-2.0", "known"),
        "Dual-licensed: licensed under the MIT license, or distributed under the Apache License, Version 2.0": ("Apache-2.0,MIT", "known"),
        say("gpl-free") + " Either version 3 of the License, or (at your option) any later version.": ("GPL-3.0-or-later", "known"),
        "It is licensed under the Frobnication Public License.": ("", "unknown"), "Licensed under the MIT License. Also covered under a very odd license.": ("MIT", "partial"),
        "The committee granted a license to the shop.": ("", "none"), "": ("", "none"), None: ("", "none"), "He said e.g. nothing. " * 3000 + "Released under the ISC License!": ("ISC", "known"),
    }
    rows = list(enumerate(cases))
    r = {x.doc_id: (x.licenses, x.status) for x in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {t: r[i] for i, t in rows} == cases


def test_sentences_are_split(spark):
    text = "One, v. 2.0 holds. Two (\"Three.\") Four\n# goes on! \n\n Five"
    (r,) = spark.createDataFrame([(text,)], "t string").select(license_scan.sentences(license_scan.F.col("t")).alias("s")).collect()
    assert r.s == ["one v 2 0 holds", "two three", "four goes on", "five"]


def test_close_rows_and_wide_fingerprints():
    rng = np.random.default_rng(5)
    for n in (1, 63, 64, 65, 700):
        a = rng.integers(0, 1 << 63, (n, 4), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (n, 4), dtype=np.uint64)
        b = a.copy()
        for k in range(n):
            for bit in rng.choice(256, rng.integers(0, 200), replace=False):
                b[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        apart = np.bitwise_count(a ^ b).sum(axis=1)
        for radius in (0, 5, 90, 255, 256):
            assert simhash_dedup.close_rows(a, b, radius).tolist() == np.flatnonzero(apart <= radius).tolist()
    i, j = simhash_dedup.close_pairs(a[:40], b, 90)
    want = np.nonzero(np.bitwise_count(a[:40, None] ^ b[None]).sum(axis=2) <= 90)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(w.tolist() for w in want), strict=True))


def plain_fingerprint(text, n=3):
    import xxhash

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash_query_rows_against_brute_force(spark):
    rnd = random.Random(13)
    words = ["Alpha", "beta", "GAMMA", "delta", "é", "Ⅷ", "x\x0by"]
    texts = [None, "", " \n", "One", "one", "two words"] + [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30))) for _ in range(120)]
    texts += [t + " tail" for t in texts[6:60]] + [texts[10], "a " * 5000]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    fp = {i: plain_fingerprint(t) for i, t in rows}
    ids = sorted(fp)
    pairs = [(i, j) for i in ids for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3]
    root = components(len(ids), pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert got == {i: (f"{fp[i]:016x}", root[i]) for i in ids} and len(set(root)) < len(ids)


def test_language_predictions_against_brute_force(spark):
    rnd = random.Random(14)
    langs = {"x": ["ka", "to", "mi"], "y": ["schr", "ung", "ein"], "z": ["tion", "eau", "ille"]}
    rows = [(i, " ".join("".join(rnd.choice(langs[l]) for _ in range(2)) for _ in range(rnd.randint(1, 12))), l) for i in range(150) for l in [rnd.choice("xyz")]]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), size=60).collect()}

    def ranked(texts):
        n = collections.Counter()
        for t in texts:
            k, c = language_id.ngram_counts(t)
            n.update(dict(zip(k.view(np.int64).tolist(), c.tolist(), strict=True)))
        return n

    import zlib

    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    profile = {}
    for l in langs:
        n = ranked(t for i, t, k in rows if k == l and not out(i))
        profile[l] = {g: r for r, (g, _) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:60])}
    for i, t, _ in rows:
        unsigned = lambda g: g % (1 << 64)
        top = [g for g, _ in sorted(ranked([t]).items(), key=lambda x: (-x[1], unsigned(x[0])))[:60]]
        away = {l: sum(abs(p[g] - r) if g in p else 60 for r, g in enumerate(top)) for l, p in profile.items()}
        best = min(sorted(away), key=away.get)
        assert (got[i].held_out, got[i].lang_pred) == (out(i), best) and got[i].score == pytest.approx(1 - away[best] / (60 * len(top)))


def test_part_boundaries(spark, monkeypatch):
    """Long texts in parts give what they give as a whole."""
    from ledgerloom.llm import anchors

    rnd = random.Random(15)
    text = " ".join("".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 9))) for _ in range(900)) + " " + "z" * 700
    whole = near_copies.shingle_set(text)
    spans = anchors.spans(np.frombuffer(text.encode(), np.uint8).astype(np.uint64) + np.uint64(1), 60, 12)
    monkeypatch.setattr(anchors, "PART", 256)
    assert (near_copies.shingle_set(text) == whole).all() and len(whole) > 800
    parts = anchors.spans(np.frombuffer(text.encode(), np.uint8).astype(np.uint64) + np.uint64(1), 60, 12)
    windows = lambda s: [(k, f) for k, _, a, b, _ in zip(*s, strict=True) for f in range(a, b)]
    assert windows(parts) == windows(spans)


#: Written by hand from the licences' own words, not from the tables of the scan.
BY_HAND = [
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0", "known"),
    ("Released under the GNU General Public License v2 or any later version.", "GPL-2.0-or-later", "known"),
    ("licensed under GPLv3 or later", "GPL-3.0-or-later", "known"), ("Licensed under the GNU GPL version 2", "GPL-2.0", "known"),
    ("// SPDX-License-Identifier: Apache-2.0 OR MIT", "Apache-2.0,MIT", "known"), ("# SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later", "known"),
    ("Licensed under the MIT license or the Apache License, Version 2.0, at your option.", "Apache-2.0,MIT", "known"),
    ("This is not licensed under the MIT License.", "", "unknown"), ("It is no longer available under the Apache License.", "", "unknown"),
    ('Apache License\nVersion 2.0, January 2004\n\n1. Definitions.\n\n"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.', "Apache-2.0", "known"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nEveryone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.\n\nPreamble\n\nThe GNU General Public License is a free, copyleft license for software and other kinds of works.", "GPL-3.0", "known"),
    ("See https://creativecommons.org/licenses/by-sa/4.0/ for it", "CC-BY-SA-4.0", "known"), ("https://creativecommons.org/publicdomain/zero/1.0/", "CC0-1.0", "known"),
    ("Licensed under the EUPL, Version 1.2", "EUPL-1.2", "known"), ("Distributed under the Artistic License 2.0.", "Artistic-2.0", "known"),
    ("Licensed under the Frobnicate Public License.", "", "unknown"), ("We permit you to go under the bridge.", "", "none"), ("Plain prose, no terms.", "", "none"), (None, "", "none"),
]


def test_licences_by_hand(spark):
    got = license_scan.scan(spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(BY_HAND)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.licenses, r.status) for r in got} == {i: (names, status) for i, (_, names, status) in enumerate(BY_HAND)}


def crowded(spark, n=900):
    """Texts that another text shares words with, once each, among so many short copies that a bitmap of copies is dense."""
    rnd = random.Random(9)
    make = lambda k: " ".join(f"{rnd.randrange(1 << 30):x}" for _ in range(k))
    shared = [make(30) for _ in range(n // 2)]
    rows = [(i, f"{make(3)} {t} {make(3)}") for i, t in enumerate(t for s in shared for t in (s, s))]
    rows += [(n + i, f"copy {i // 2}") for i in range(4000)]
    return rows, shared, spark.createDataFrame(rows, "doc_id long, text string")


def test_suffix_dedup_loses_no_text_among_many_copies(spark):
    rows, shared, df = crowded(spark)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(df, Scratch(spark, "t"), window=60, gram=16).collect()}
    assert all(got[i] >= len(shared[i // 2]) for i in range(2 * len(shared)))


def test_suffix_dedup_deals_each_span_once(spark, monkeypatch):
    """A passage that thousands of texts have goes to its shard once, not as often as the filter lets its occurrences through."""
    rows, spans = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(run):
        def wrapped(table):
            rows.add(table.num_rows)
            spans.add(len(set(zip(*(table.column(c).to_pylist() for c in suffix_dedup.SPAN), strict=True))))
            return run(table)

        return wrapped

    monkeypatch.setattr(suffix_dedup, "whole_group", counted)
    rnd = random.Random(4)
    make = lambda k: "".join(rnd.choice("abcdefgh") for _ in range(k))
    passage = make(200)
    df = spark.createDataFrame([(i, make(20) + passage + make(20)) for i in range(1500)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, Scratch(spark, "t"), window=60, gram=16).collect()
    assert len(got) == 1500 and all(r.n_removed >= len(passage) for r in got)
    assert rows.value == spans.value > 0


def test_substring_dedup_loses_no_text_among_many_copies(spark):
    rows, shared, df = crowded(spark)
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_earlier(df, Scratch(spark, "t"), window=20, gram=5).collect()}
    assert all(got[i] == (30 if i % 2 else 0) for i in range(2 * len(shared)))
