"""Every operator over nulls, empties, ties, repeated rows, clashing columns and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import embedding_dedup, exact_dedup, language_id, license_scan, mixing, near_copies, packing, sharding, simhash_dedup, substring_dedup, suffix_dedup
from ledgerloom.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, copies long, hash string, text_sha256 string"
LONG = "wort " * 30000
ROWS = [
    (1, "the cat sat on the mat", "en", "a"), (2, None, None, None), (3, "", "en", None), (4, "die Katze und der Hund", "de", "b"), (4, "die Katze und der Hund", "de", "b"),
    (5, "the cat sat on the mat", "en", "a"), (6, LONG, "de", "a"), (None, "the dog and the cat", "en", "c"), (7, " \n\t ", "en", "a"), (8, "12345 !!", "en", "b"), (9, LONG + "ende", "de", "b"),
]

OPERATORS = {
    "language": lambda d, s: language_id.identify(d), "license": lambda d, s: license_scan.scan(d), "mix": mixing.mix, "shard": lambda d, s: sharding.assign_shards(d),
    "exact": exact_dedup.exact_groups, "suffix": suffix_dedup.remove_repeats, "substring": substring_dedup.remove_earlier, "simhash": simhash_dedup.near_components,
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, 2, "k", 3, "h", "x") for r in ROWS], DOCS)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_a_row(spark, docs, name):
    out = OPERATORS[name](docs, Scratch(spark, "t"))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.select("doc_id").collect()) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    assert OPERATORS[name](docs.limit(0), Scratch(spark, "t")).count() == 0


def test_pack_covers_every_token(spark, docs):
    out = packing.pack(docs, Scratch(spark, "t")).collect()
    assert {r.doc_id for r in out} == {r[0] for r in ROWS} and max(r.length for r in out) == 2048
    by_seq = {}
    for r in out:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_exact(spark, docs):
    r = exact_dedup.exact_groups(docs, Scratch(spark, "t")).collect()
    cat = {x.doc_id: x for x in r if x.doc_id in (1, 5)}
    assert (cat[1].keep_id, cat[1].kept, cat[5].kept, cat[5].group_size) == (5, False, True, 2)
    assert sorted(x.kept for x in r if x.doc_id == 4) == [False, True]
    assert {x.keep_id for x in r if x.doc_id in (2, 3)} == {3}
    kept = exact_dedup.drop_exact_copies(docs, Scratch(spark, "t"))
    assert kept.columns == docs.columns and sorted((x.doc_id or 0) for x in kept.collect()) == [0, 3, 4, 5, 6, 7, 8, 9]


def test_language_unknown_and_held_out(spark, docs):
    r = {x.doc_id: x for x in language_id.identify(docs).collect()}
    assert {r[i].lang_pred for i in (2, 3, 7, 8)} == {"und"} and all(0 <= x.score <= 1 for x in r.values())
    assert language_id.keep_identified(docs).columns == docs.columns
    assert not {2, 3, 7, 8} & {x.doc_id for x in language_id.keep_identified(docs).collect()}
    assert language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_shards(spark, docs):
    r = sharding.assign_shards(docs, 3).collect()
    for s in range(3):
        slots = sorted(x.slot for x in r if x.shard == s)
        assert slots == list(range(len(slots)))
    assert all(x.grown_shard in (x.shard, 3) for x in r)
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    a = sharding.assign_shards(many, 60).collect()  # past the first loop of jumps as well
    assert {x.shard for x in a} == set(range(60)) and all(x.grown_shard in (x.shard, 60) for x in a)
    b = {x.doc_id: x.shard for x in sharding.assign_shards(many, 61).collect()}
    assert all(b[x.doc_id] == x.grown_shard for x in a)


def plain_targets(sizes, most=3, weights=(1, 2, 3)):
    """Target by source key from (source key, size) pairs, by hand."""
    order = sorted((s, n) for s, n in sizes if s != "n") + [(s, n) for s, n in sizes if s == "n"]
    weight = {s: weights[i % 3] for i, (s, _) in enumerate(order)}
    left, open_, out = float(sum(n for _, n in order)), dict(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s: float(most * n) for s, n in open_.items() if left * weight[s] / total > most * n}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        out |= over
        left -= sum(over.values())
        open_ = {s: n for s, n in open_.items() if s not in out}
    return out


def solved_targets(spark, sizes):
    d = spark.createDataFrame(sizes, "source_key string, source_size long")
    return {r.source_key: r.target for r in mixing.targets(d, Scratch(spark, "t")).collect()}


def test_mix_targets(spark):
    t = solved_targets(spark, [("sb", 100), ("sa", 100), ("n", 10), ("sc", 1)])
    assert t["sc"] == 3 and t["n"] == 30 and t["sb"] == pytest.approx(2 * t["sa"]) and sum(t.values()) == pytest.approx(211)
    assert solved_targets(spark, []) == {} and solved_targets(spark, [("sa", 0)]) == {"sa": 0}
    rnd = random.Random(3)
    sizes = [(f"s{i}é"[: rnd.randint(2, 4)] + str(i), int(10 ** rnd.uniform(0, 5))) for i in range(40)] + [("n", 7)]
    assert solved_targets(spark, sizes) == pytest.approx(plain_targets(sizes))


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), None, f"s{i % 5}" if i % 5 else None) for i in range(500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mix(d, Scratch(spark, "t")).collect()
    want = {x.source: x.target for x in out}
    got = {}
    for x in out:
        got[x.source] = got.get(x.source, 0) + x.taken
        assert 0 <= x.taken <= 3 * x["size"]
    assert all(abs(got[s] - want[s]) <= 2 for s in want)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix(d, Scratch(spark, "t")).collect()), key=str)
    assert mixing.repeat_documents(d, Scratch(spark, "t")).count() == sum(x.copies for x in out)


def test_tilted_rates_solve_the_dual(spark):
    """The rates before rounding, against a plain bisection of the same condition."""
    import math

    sizes = {1: 30, 5: 20, 17: 10, 400: 2}
    h = spark.createDataFrame([("sx", s, n) for s, n in sizes.items()], "source_key string, size long, n long")
    total = sum(s * n for s, n in sizes.items())
    for share in (0.3, 1.0, 2.2, 2.9):
        sources = spark.createDataFrame([("sx", total, share * total)], "source_key string, source_size long, target double")
        r = mixing._solve(h, sources, Scratch(spark, "t")).first()
        words = lambda t: sum(n * s * min(3.0, math.exp(min(t * s / r.unit, 50))) for s, n in sizes.items())
        assert words(r.tilt) == pytest.approx(share * total, rel=1e-5)


def test_vectors(spark):
    v = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 1), (11, [1.0], 1), (12, [], 1), (3, [1.0, 0.01], 1)]
    d = spark.createDataFrame(v, "vec_id long, embedding array<float>, label int")
    r = sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in embedding_dedup.near_vectors(d, Scratch(spark, "t")).collect())
    assert r == sorted([(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (10, 4, 1, False), *((i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 11, 12))])
    assert embedding_dedup.near_vectors(d.limit(0), Scratch(spark, "t")).count() == 0


#: Names that the stages' own columns had, or have; each stage must leave them alone.
CLASHES = ["_id", "_lost", "_key_id", "_key_text", "_source", "_size", "_copies", "copies", "copy", "salt", "rank", "order", "hash", "DOC", "h", "rid", "gone_id", "source_key", "size", "content", "length", "prefix"]
STAGES = {
    "language": lambda d, s: language_id.keep_identified(d), "exact": exact_dedup.drop_exact_copies, "near": near_copies.drop_near_copies, "mix": mixing.repeat_documents,
}


def stage_docs(spark, rows, kind="long"):
    d = spark.createDataFrame(rows, f"doc_id {kind}, text string, lang string, source string")
    return d.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_of_any_name(spark, name):
    d = stage_docs(spark, [(i, f"the cat number {chr(97 + i)} sat on the mat and the dog saw it there", "en", "a") for i in range(6)] + [(6, None, None, None), (None, "", "en", None), (2, "the cat and the dog", "en", "a")])
    out = STAGES[name](d, Scratch(spark, "t"))
    assert out.columns == d.columns and out.count() > 0 and out.select(*(f"`{c}`" for c in CLASHES)).distinct().count() == 1
    empty = STAGES[name](d.limit(0), Scratch(spark, "t"))
    assert empty.columns == d.columns and empty.count() == 0


def kept(df):
    return sorted((str(r.doc_id), r.text) for r in df.select("doc_id", "text").collect())


def test_exact_copies_with_ids_of_texts_and_nulls(spark):
    """A null id is not the id "null", and no text is lost."""
    rows = [("null", "same", "en", "a"), (None, "same", "en", "a"), (None, "alone", "en", "a"), (None, "alone", "en", "b"), ("a", "x", "en", "a"), ("b", "x", "en", "a"), ("b", "x", "en", "z"), ("b", "y", "en", "a"), ("c", None, "en", "a"), ("d", "", "en", "a")]
    out = exact_dedup.drop_exact_copies(stage_docs(spark, rows, "string"), Scratch(spark, "t"))
    assert kept(out) == sorted([("null", "same"), ("None", "alone"), ("b", "x"), ("b", "y"), ("d", "")], key=str)
    groups = exact_dedup.exact_groups(stage_docs(spark, rows, "string"), Scratch(spark, "t")).collect()
    assert len(groups) == len(rows) and sum(r.kept for r in groups) == 5


def test_exact_copies_of_equal_prefixes(spark):
    """Equal lengths and equal first characters, but other texts: nothing goes."""
    head = "p" * 100
    rows = [(i, head + c, "en", "a") for i, c in enumerate("abcdef")] + [(9, head + "a", "en", "a")]
    out = exact_dedup.drop_exact_copies(stage_docs(spark, rows), Scratch(spark, "t"))
    assert kept(out) == sorted((str(i), t) for i, t, *_ in rows[1:])


def test_near_copies_with_repeated_and_missing_ids(spark):
    """Rows that share an id are judged by their own texts; a null id loses to any other."""
    words = [f"w{i}" for i in range(40)]
    near = " ".join(words[1:])
    rows = [(5, " ".join(words), "en", "a"), (7, near, "en", "a"), (7, "a text of its own that stays where it is", "en", "a"), (None, " ".join(words[:-1]), "en", "a"), (8, None, "en", "a"), (9, "", "en", "a"), (10, " \t", "en", "a")]
    out = near_copies.drop_near_copies(stage_docs(spark, rows), Scratch(spark, "t"))
    assert {(r.doc_id, r.text) for r in out.collect()} == {r[:2] for i, r in enumerate(rows) if i not in (1, 3)}


def test_equal_rows_get_the_copies_of_their_mix(spark):
    rows = [(1, "a b c", None, "x")] * 6 + [(2, "d e f g", None, "y")] * 3 + [(3, "h", None, "y"), (4, None, None, "y")]
    d = stage_docs(spark, rows)
    want = {}
    for r in mixing.mix(d.select("doc_id", "text", "source"), Scratch(spark, "t")).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {r.doc_id: r["count"] for r in mixing.repeat_documents(d, Scratch(spark, "t")).groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v} and sum(got.values()) > 4


def plain_copies(sizes, most=3):
    """Copies by (source, size), from {source: [sizes]}: bisection of the dual, rounding and making up, by hand."""
    import math

    goal = plain_targets([(s, sum(v)) for s, v in sizes.items()])
    out = {}
    for s, v in sizes.items():
        count = {x: v.count(x) for x in set(v)}
        total = sum(v)
        unit = sum(n * x * x for x, n in count.items()) / max(total, 1) or 1.0
        rate = lambda t, x: 1.0 if x == 0 else min(math.exp(min(t * x / unit, 50)), most)  # noqa: E731, B023
        low, high = -200.0, 200.0
        for _ in range(200):
            t = (low + high) / 2
            low, high = (t, high) if sum(n * x * rate(t, x) for x, n in count.items()) < goal[s] else (low, t)
        if total and goal[s] >= most * total * (1 - 1e-7):
            t = math.inf
        run, last, got = 0.0, 0, {}
        for x in sorted(count, reverse=True):
            run += count[x] * (rate(t, x) if t != math.inf else (most if x else 1.0))
            got[x] = min(max(math.floor(run + 0.5 + 1e-9) - last, 0), count[x] * most)
            last = math.floor(run + 0.5 + 1e-9)
        for _ in range(mixing.PASSES):
            lack = goal[s] - sum(x * n for x, n in got.items())
            fits = []
            for x in got:
                if x:
                    q = lack / x
                    more = min(max(int(math.copysign(math.floor(abs(q) + 0.5), q)), -got[x]), count[x] * most - got[x])
                    if more:
                        fits.append((abs(lack - more * x), x, more))
            if not fits or min(fits)[0] >= abs(lack):
                break
            _, x, more = min(fits)
            got[x] += more
        out[s] = got
    return out, goal


def test_mix_against_brute_force(spark):
    rnd = random.Random(31)
    rows = []
    for s in ["a", "b", "é", None, "z"]:
        for _ in range(rnd.choice([3, 20, 60])):
            rows.append((len(rows), "w " * rnd.choice([0, 1, 2, 5, 17, 40, 200]), None, s))
    rows += [(0, "w " * 40, None, "a"), (1, None, None, None)]
    sizes = {}
    for _, t, _, s in rows:
        sizes.setdefault("n" if s is None else "s" + s, []).append(len((t or "").split()))
    want, goal = plain_copies(sizes)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got, taken = {}, {}
    for r in mixing.mix(d, Scratch(spark, "t")).collect():
        s = "n" if r.source is None else "s" + r.source
        got.setdefault((s, r["size"]), []).append(r.copies)
        taken[s] = taken.get(s, 0) + r.taken
        assert r.source_size == sum(sizes[s]) and r.target == pytest.approx(goal[s]) and r.taken == r.copies * r["size"]
    assert {k: sum(v) for k, v in got.items()} == {(s, x): n for s, c in want.items() for x, n in c.items()}
    assert all(max(v) - min(v) <= 1 for v in got.values())
    for (s, x), v in got.items():  # no copy more or less of any size brings a source closer
        lack = goal[s] - taken[s]
        if x and (sum(v) < 3 * len(v) if lack > 0 else sum(v) > 0):
            assert abs(lack) <= x / 2 + 1e-6


def test_sources_come_within_a_few_words(spark):
    """Where no one size helps, two sizes do: a dozen long documents a source come within a quarter of the smallest."""
    rnd = random.Random(12)
    rows = [(10 * s + i, " ".join(["w"] * rnd.randint(80, 900)), f"s{s:02d}") for s in range(9) for i in range(12)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), Scratch(spark, "t"))
    got = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert len(got) == 9 and all(abs(r.taken - r.target) <= 20 and r.over <= 0 for r in got)


def test_a_row_repeated_past_a_group_spreads(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    out = packing.pack(spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words again").alias("text")).repartition(4), Scratch(spark, "t")).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.sequence_id % 8, []).append(r.length)
    assert len(out) == 400 and len(groups) == 8 and max(map(len, groups.values())) < 120
