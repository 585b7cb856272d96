import collections
import random

import corpus_pipeline as P
from ledgerloom.llm import packing
from ledgerloom.llm.common import Scratch, read_table
from tests.llm.test_methods import jaccard_components
from tests.llm.test_tables import plain_copies

D = "/root/testdata/sf0.001"


def test_stages_chain(spark):
    docs = first = read_table(spark, D, "documents")
    scratch = Scratch(spark, "t")
    for name, stage in P.STAGES[:-1]:
        after = scratch.write(stage(spark, docs, D))
        assert after.columns == first.columns, name
        docs = after
    assert docs.count() > 0 and P.run(spark, D).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    for _, stage in P.STAGES:
        assert stage(spark, first.limit(0), D).count() == 0


def corpus():
    """Documents of three made-up languages: copies, near copies, texts in none of them, and what holds no text."""
    rnd = random.Random(41)
    langs = {"x": ["ka", "to", "mi", "re", "su"], "y": ["schr", "ung", "ein", "ost", "kel"], "z": ["tion", "eau", "ille", "que", "oux"]}
    rows = []
    for i in range(150):
        lang = rnd.choice("xyz")
        words = ["".join(rnd.choice(langs[lang]) for _ in range(rnd.randint(1, 3))) + f"{chr(97 + i % 26)}" for _ in range(rnd.randint(8, 60))]
        rows.append((len(rows), " ".join(words), lang, rnd.choice(["a", "b", "c", None])))
        if i % 5 == 0:
            rows.append((len(rows), rows[-1][1], lang, "b"))
        if i % 7 == 0 and len(words) > 30:
            rows.append((len(rows), " ".join(words[1:]), lang, "a"))
    rows += [(len(rows), None, None, "a"), (len(rows) + 1, "", "x", "b"), (len(rows) + 2, "123 !! ...", "x", "c"), (len(rows) + 3, "ЖЩЮ ЪЫЭ ФЦЧ " * 5, None, "a"), (len(rows) + 4, "東京 大阪 京都 " * 6, None, None)]
    rnd.shuffle(rows)
    return rows


def test_run_against_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = P.run(spark, f"file://{tmp_path}").collect()

    told = [r for r in rows if r[2] and any(c.isalpha() for c in r[1] or "")]
    last = {t: max(i for i, u, *_ in told if u == t) for _, t, *_ in told}
    unique = sorted((i, t, s) for i, t, _, s in told if last[t] == i)
    root = jaccard_components([(i, t) for i, t, _ in unique])
    near = [x for k, x in enumerate(unique) if root[k] == k]
    assert len(near) < len(unique) < len(told) < len(rows)
    sizes = collections.defaultdict(list)
    for _, t, s in near:
        sizes["n" if s is None else "s" + s].append(len(t.split()))
    copies, _ = plain_copies(dict(sizes))

    encode = packing.byte_bpe(packing.default_vocabulary())
    text = {i: t for i, t, _ in near}
    times = collections.Counter(r.doc_id for r in got if r.start == 0)
    assert set(times) <= set(text)
    by_size = collections.Counter()
    for i, t, s in near:
        by_size["n" if s is None else "s" + s, len(t.split())] += times[i]
    assert by_size == collections.Counter({(s, x): n for s, c in copies.items() for x, n in c.items()})
    windows = collections.defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(encode(text[r.doc_id])) + 1 and r.start % 2048 == 0 and r.length == min(2048, r.doc_tokens - r.start)
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
