import datetime as dt
import random

from ledgerloom.operators import backtest as B
from ledgerloom.operators import history as H
from ledgerloom.operators import similarity as S

SCHEMA = "id long, day date, content string, label string, complex boolean, fy int, account long, value long"


def obs(spark, rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(d), c, x, k, int(d[:4]), 1, 100) for i, (d, c, x, k) in enumerate(rows)], SCHEMA)


def seq(labels, year=2020):
    return [(f"{year}-01-{i + 1:02d}", "X", x, False) for i, x in enumerate(labels)]


def last(spark, labels):
    rows = [*seq(labels), ("2020-02-01", "X", "?", False)]
    return H.before(obs(spark, rows), years=[2020]).orderBy("id").collect()[-1]


def test_ties_go_to_the_recent_label(spark):
    assert last(spark, "AABB").mode == "B" and last(spark, "BBAA").mode == "A"


def test_change_detection(spark):
    r = last(spark, "AAAAAABBB")
    assert (r.run, r.previous, r.last_label) == (3, "A", "B")
    r = last(spark, "AAAAB")
    assert (r.run, r.previous) == (1, "A")
    assert last(spark, "BBB").previous is None


def test_weights_prefer_recent_years(spark):
    rows = [("2019-01-01", "X", "A", False), ("2019-01-02", "X", "A", False), ("2019-01-03", "X", "A", False), ("2023-01-01", "X", "B", False), ("2024-01-01", "X", "?", False)]
    r = H.before(obs(spark, rows), "fy", list(range(2019, 2025))).orderBy("id").collect()[-1]
    assert r.weighted == "B" and r.mode == "A"


def test_same_day_is_invisible(spark):
    rows = [("2023-09-01", "X", "A", False), ("2024-09-01", "X", "B", False), ("2024-09-01", "X", "B", False), ("2024-10-01", "X", "B", False)]
    r = H.before(obs(spark, rows)).orderBy("id").collect()
    assert [x.hist_n for x in r] == [None, 1, 1, 3] and [x.mode for x in r] == [None, "A", "A", "B"]


def test_against_a_plain_loop(spark):
    rnd = random.Random(3)
    rows = sorted((f"20{rnd.randint(20, 23)}-0{rnd.randint(1, 9)}-0{rnd.randint(1, 9)}", rnd.choice("XYZ"), rnd.choice("ABC"), rnd.random() < 0.3) for _ in range(300))
    got = {r.id: r for r in H.before(obs(spark, rows)).collect()}
    for i, (d, c, _, _) in enumerate(rows):
        past = [(x, k) for e, cc, x, k in rows if cc == c and e < d]
        r = got[i]
        if not past:
            assert r.mode is None
            continue
        labels = [x for x, _ in past]
        best = lambda w: max(set(w), key=lambda x: (w.count(x), max(j for j, y in enumerate(w) if y == x)))
        run = next((j for j, x in enumerate(reversed(labels)) if x != labels[-1]), len(labels))
        plain = next((j for j, (_, k) in enumerate(reversed(past)) if k), len(past))
        assert (r.mode, r.n, r.hist_n, r.run, r.since_complex, r.distinct_labels) == (best(labels), len(past), len(past), run, plain, len(set(labels)))
        assert list(r.tail) == labels[-5:]


def test_rules(spark):
    rows = [("2021-01-01", "X", "A", False), ("2021-01-02", "X", "A", False), ("2023-01-01", "X", "B", False), ("2023-01-02", "X", "B", False), ("2023-01-03", "X", "B", True), ("2024-02-01", "X", "B", False)]
    rules = [(3, 3, -1, False, False), (3, 3, -1, False, True), (3, 3, -1, True, False), (3, 10, -1, False, False), (3, 3, 1, False, False)]
    g = {r.rule: r.n for r in B.evaluate_rules(obs(spark, rows), rules=rules).where("fy = 2024").collect()}
    assert g == {0: 1, 1: 0, 2: 0, 3: 0, 4: 1}
    assert len(B.rule_grid()) == 168


def test_past_only_backtest(spark):
    rows = [("2022-05-01", "X", "A", False), ("2023-05-01", "X", "B", False), ("2024-05-01", "X", "B", False), ("2024-05-02", "NEW", "C", False), ("2025-05-01", "X", "Z", False)]
    r = {x.fy: x for x in B.year_backtest(obs(spark, rows)).collect()}
    assert (r[2024].test, r[2024].covered, r[2024].mode_correct, r[2024].latest_correct) == (2, 1, 0, 1)
    assert (r[2023].covered, r[2023].mode_correct) == (1, 0)
    u = {(x.fy, x.threshold): x.n for x in B.unanimous_backtest(obs(spark, rows)).collect()}
    assert u[2024, 1] == 0 and u[2023, 1] == 1


def test_content_stats(spark):
    rows = [("2022-05-01", "X", "A", False), ("2022-06-01", "X", "A", False), ("2023-05-01", "X", "B", False), ("2023-05-01", "", "B", False)]
    r = H.content_stats(H.usable(obs(spark, rows))).collect()
    assert [(x["count"], x.distinct_labels, x.top_label, x.latest_label, dict(x.labels)) for x in r] == [(3, 2, "A", "B", {"A": 2, "B": 1})]


def test_stages(spark):
    rows = [("2024-01-01", "Cafe Moon", "FOOD", False), ("2024-02-01", "Cafe Moon", "FOOD", False), ("2024-02-01", "CAFE  MOON", "FOOD", False), ("2024-02-02", "Cafe Moons", "FOOD", False), ("2024-02-02", "???", "X", False), ("2024-01-01", "zz", "Y", False)]
    p = {r.id: r for r in S.staged_predictions(obs(spark, rows)).collect()}
    assert [p[i].stage for i in range(6)] == ["none", "raw_exact", "norm_exact", "fuzzy", "none", "none"]
    assert p[3].score >= 90 and p[3].top3_keys == ["cafemoon", "zz"] and p[3].pred == "FOOD" and p[3].hist_n == 3
    low = {r.id: r.stage for r in S.apply_threshold(S.staged_predictions(obs(spark, rows)), None).collect()}
    assert low[3] == "none" and low[2] == "norm_exact"


def test_empty(spark):
    e = obs(spark, [("2024-01-01", "", "A", False)])
    assert H.before(H.usable(e)).count() == 0 and B.evaluate_rules(e).count() == 0


def test_snapshots_of_a_hot_key_against_a_plain_loop(spark):
    """Half of all rows share a content, many a day; years may interleave within a day."""
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        day = dt.date(2022, 12, 20) + dt.timedelta(days=rnd.randrange(25))
        rows.append((i, day, rnd.choice(["hot", "hot", "hot", "a", "b"]), rnd.choice("AAAB"), rnd.random() < 0.1, rnd.choice([2022, 2023]) if day.day == 31 else day.year, rnd.randrange(3), rnd.randrange(9000)))
    df = spark.createDataFrame(rows, SCHEMA)
    for block in ("day", "fy"):
        of = (lambda r: (r[1] - dt.date(1970, 1, 1)).days) if block == "day" else lambda r: r[5]
        got = {(r.content, r.block): r for r in H.snapshots_before(df, block).collect()}
        want = 0
        for content in ("hot", "a", "b"):
            mine = sorted((r for r in rows if r[2] == content), key=lambda r: (r[1], r[0]))
            blocks = sorted({of(r) for r in mine})
            for prior, block_now in zip(blocks, blocks[1:]):
                want += 1
                past = mine[: max(i for i, r in enumerate(mine) if of(r) == prior) + 1]
                labels = [r[3] for r in past]
                run = next((j for j, x in enumerate(reversed(labels)) if x != labels[-1]), len(labels))
                r = got[content, block_now]
                since = next((j for j, x in enumerate(reversed(past)) if x[4]), len(past))
                changed = len(labels) > run
                assert (r.n, r.last_label, r.run, r.previous, r.change_day) == (len(past), labels[-1], run, labels[-run - 1] if changed else None, past[-run][1] if changed else None)
                assert (r.since_complex, r.any_complex, r.all_complex, r.tail, r.first_day, r.last_account) == (since, any(x[4] for x in past), all(x[4] for x in past), labels[-5:], past[0][1], past[-1][6])
        assert want == len(got)
