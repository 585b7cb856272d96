"""Nearest texts: bounds, blocks and merged results against all pairs."""

import random

import numpy as np
import pytest

from ledgerloom.functions.block_similarity import TextBlock
from ledgerloom.functions.text import lcs_length
from ledgerloom.operators import routing as R
from ledgerloom.operators import similarity as S
from ledgerloom.plans import q_routing as QR


def ratio(a, b):
    return 100.0 if not a and not b else 200.0 * lcs_length(a, b) / (len(a) + len(b))


def words(rnd, n, letters, most):
    return list(dict.fromkeys("".join(rnd.choice(letters) for _ in range(rnd.randint(0, most))) for _ in range(n)))


@pytest.mark.parametrize("most", [3, 30, 64, 65, 200])
def test_a_block_scores_as_pairs_do(most):
    rnd = random.Random(most)
    texts = words(rnd, 120, "abcdeü漢𝒳", most)
    block = TextBlock(texts)
    for a in [*texts[:12], "", "zzz"]:
        scores = block.scores(a, block.masks(a), np.arange(len(texts)))
        assert scores.tolist() == [ratio(a, t) for t in texts] and (block.bounds(a) >= scores).all()
        prefixes = [0, 5, 5, 50, len(texts)]
        for end, (at, got) in zip(prefixes, block.nearest(a, 4, prefixes), strict=True):
            assert list(zip((-got).tolist(), at.tolist(), strict=True)) == sorted((-ratio(a, t), i) for i, t in enumerate(texts[:end]) if t != a)[:4]
    assert TextBlock([]).nearest("a", 3, [0])[0][0].tolist() == []


def test_few_pairs_are_scored():
    """Names of a few families: bounds leave less than a tenth of all pairs."""
    rnd = random.Random(2)
    heads = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(14)) for _ in range(600)]
    texts = sorted({h[:i] + rnd.choice("xyz") + h[i + 1 :] for h in heads for i in (2, 5, 8, 11, 13)})
    block, before = TextBlock(texts), range(0, len(texts), 10)
    for a in texts[::100]:
        at, got = block.nearest(a, 3, [len(texts)])[0]
        assert list(zip((-got).tolist(), at.tolist(), strict=True)) == sorted((-ratio(a, t), i) for i, t in enumerate(texts) if t != a)[:3]
    assert block.scored < len(texts) * len(texts[::100]) / 10
    block.scored = 0
    block.nearest(texts[7], 3, list(before))  # every day of a history at once costs no more than a few texts each
    assert block.scored < len(texts)


def test_nearest_before_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "KEYS_PER_BLOCK", 20)
    monkeypatch.setattr(S, "ASKED_PER_BLOCK", 7)
    rnd = random.Random(4)
    keys = [(k, rnd.randrange(9), rnd.randrange(3)) for k in words(rnd, 90, "abc", 9)]
    asked = {(rnd.choice(keys)[0], rnd.randrange(10)) for _ in range(60)} | {("nothing alike", 9)}
    pool = spark.createDataFrame([*keys, (None, 0, 0)], "b string, since long, tie long")
    ask = spark.createDataFrame([*asked, *list(asked)[:5], (None, 3), ("abc", None)], "a string, before long")
    got = {}
    for r in S.nearest(ask, pool, 3).collect():
        got.setdefault((r.a, r.before), []).append((r["rank"], r.b, r.score))
    want = {}
    for a, day in asked:
        best = sorted((-ratio(a, b), since, tie, b) for b, since, tie in keys if since < day and b != a)[:3]
        if best:
            want[a, day] = [(i + 1, b, -s) for i, (s, _, _, b) in enumerate(best)]
    assert {k: sorted(v) for k, v in got.items()} == want
    assert S.nearest(ask.limit(0), pool, 3).count() == 0 and S.nearest(ask, pool.limit(0), 3).count() == 0


def test_partial_ratios_see_all_stretches_at_once():
    from ledgerloom.functions.block_similarity import partial_ratio

    rnd = random.Random(5)
    for most in (4, 20, 150):
        for _ in range(60):
            a, b = ("".join(rnd.choice("abcé漢") for _ in range(rnd.randint(0, most))) for _ in "xy")
            best = lambda s, t: (0.0 if t else 100.0) if not s else max(ratio(s, t[max(0, i) : i + len(s)]) for i in range(1 - len(s), len(t)))
            want = max(best(a, b), best(b, a)) if len(a) == len(b) else best(*sorted((a, b), key=len))
            assert partial_ratio(a, b) == want == partial_ratio(b, a)
    assert partial_ratio("abcd", "xxabcdxx") == 100.0 and partial_ratio("abcd", "xxabxx") == 50.0 and partial_ratio("abcd", "cdxx") == partial_ratio("cdxx", "abcd")


def test_every_pair_of_names_has_a_ratio(spark, tmp_path):
    from ledgerloom.plans.catalogue import QUERIES

    names = ["abc", "abd", "xyz", "q"]
    spark.createDataFrame([(n,) for n in names], "p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {(r.a, r.b): r.score for r in QUERIES["q_indel_ratio"](spark, str(tmp_path)).collect()}
    assert set(got) == {(a, b) for a in names for b in names if a != b} and got["abc", "abd"] == 66.6667 and got["abc", "q"] == 0.0


LEAVES = ("LogicalRDD", "Relation [", "LocalRelation", "Range (")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def normalized_by_row(df):
    """Steps of the plan that normalize texts of rows as they are read, not of groups."""
    plan, found = plan_of(df), 0
    for i, line in enumerate(plan):
        steps = line.split("], [")[0] if "Aggregate [" in line else line
        if "regexp_replace" in steps:
            below = next(x for x in plan[i + 1 :] if "Aggregate" in x or any(leaf in x for leaf in LEAVES))
            found += "Aggregate" not in below
    return found


def dated(spark):
    rows = [(1, 1, "A b", "x"), (2, 1, "A b", "y"), (3, 2, "a B!", "x"), (4, 2, "A b", "x"), (5, 3, "A c", "z"), (6, None, "A b", "x"), (7, 3, None, "x"), (8, 4, "", "x"), (9, 4, "a b", "y"), (10, 5, "A b", "y")]
    o = spark.createDataFrame([(i, d, c, x, i % 4, 100) for i, d, c, x in rows], "id long, d int, content string, label string, account long, value long")
    return o.selectExpr("id", "date_add(date'2024-01-01', d) AS day", "content", "label", "account", "value", "id % 3 = 0 AS complex", "2000 + CAST(id / 6 AS int) AS fy")


def test_texts_are_normalized_by_group(spark):
    o = dated(spark)
    for df in (S.staged_predictions(o, ascii_only=True), S.candidates_before(o, ascii_only=True)):
        assert normalized_by_row(df) == 0
    got = {r.id: (r.stage, r.pred, r.hist_n, r.days_since_last) for r in S.staged_predictions(o, ascii_only=True).collect()}
    assert got[2] == ("none", None, None, None) and got[6] == ("none", None, None, None) and set(got) == {1, 2, 3, 4, 5, 6, 9, 10}
    assert got[3] == ("norm_exact", "y", 2, 1) and got[4] == ("raw_exact", "y", 2, 1) and got[5][0] == "fuzzy" and got[9] == ("norm_exact", "x", 4, 2) and got[10] == ("raw_exact", "x", 3, 3)


def test_static_texts_are_normalized_by_group(spark):
    o = dated(spark)
    df = S.static_predictions(o.where("id < 5"), o.where("id >= 5"), ascii_only=True)
    assert normalized_by_row(df) == 0
    got = {r.id: (r.stage, r.pred, r.hist_n, r.days_since_last, r.account_seen) for r in df.collect()}
    assert got == {5: ("fuzzy", "x", 4, 1, None), 6: ("raw_exact", "x", 3, None, True), 7: ("none", None, None, None, None), 8: ("none", None, None, None, None), 9: ("norm_exact", "x", 4, 2, True), 10: ("raw_exact", "x", 3, 3, True)}


def test_seen_accounts_need_no_histories(spark):
    o = dated(spark).where("day is not null")
    plain = {r.id: r.account_seen for r in R.history_features(o).collect()}
    assert {r.id: r.account_seen for r in R.accounts_seen(o).collect()} == plain and set(plain.values()) == {None, True, False}
    windows = lambda df: sum("Window [" in x for x in plan_of(df))
    sf = "/root/testdata/sf0.001"
    assert windows(QR.items(spark, sf)) == windows(QR.staged(spark, sf))
