import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import checks as K
from ledgerloom.operators import close as C
from ledgerloom.operators import quality as U
from ledgerloom.operators import routing as R

DAY = dt.date(2024, 4, 1)
L = "journal_id int, branch_index int, date date, remark string, debit_account string, debit_sub string, credit_account string, credit_sub string, value long"


def line(j, b, dr, cr, v, day=DAY, remark="r"):
    return (j, b, day, remark, dr, "s" if dr else None, cr, "t" if cr else None, v)


def test_legs_do_not_depend_on_layout(spark):
    df = spark.createDataFrame([line(1, 1, "X", "B", 10), line(2, 1, "X", None, 10), line(2, 2, None, "B", 10)], L)
    assert len({r.legs for r in C.legs(df).collect()}) == 1


def test_duplicate_levels(spark):
    new = spark.createDataFrame([line(1, 1, "X", "B", 10), line(2, 1, "X", "B", 10, DAY + dt.timedelta(2)), line(3, 1, "Y", "Q", 10)], L)
    old = spark.createDataFrame([line(9, 1, "X", None, 10), line(9, 2, None, "B", 10)], L)
    assert {(r.new_id, r.level) for r in C.duplicate_candidates(new, old).collect()} == {(1, "high"), (2, "low")}


def test_internal_duplicates(spark):
    df = spark.createDataFrame([line(1, 1, "X", "B", 10), line(2, 1, "X", "B", 10), line(3, 1, "X", "B", 10, remark="other")], L)
    assert [(r.n, r["first"], r["last"]) for r in C.internal_duplicates(df).collect()] == [(2, 1, 2)]


def test_personal_card(spark):
    rows = [(1, DAY, "EXPENSE", 10000, "EXP", "personal"), (2, DAY, "INCOME", 3000, "EXP", "personal"), (3, DAY, "EXPENSE", 5000, "EXP", "card")]
    t = spark.createDataFrame(rows, "transaction_id int, date date, side string, amount long, account string, funding string").withColumns({"payable": F.lit("payable"), "loan": F.lit("loan")})
    b = C.journal_branches(t)
    assert b.where("transaction_id = 3").count() == 1
    r = {x.funding: x for x in C.reconcile(b).collect()}
    assert (r["personal"].payable_net, r["personal"].loan_net, r["personal"].journals) == (0, -7000, 2)


def test_decisions(spark):
    acc = spark.createDataFrame([("a1", "Travel"), ("a2", "Food")], "account_id string, name string")
    g = spark.createDataFrame([(1, "approve", None, "a1"), (2, None, None, None)], "group_id int, decision string, corrected string, proposed string")
    m = [(1, 1, None, None), (2, 1, "correct", "Food"), (3, 1, "split", None), (4, 2, None, None), (5, 2, "approve", None), (6, 1, "correct", "zz"), (7, 1, "huh", None), (8, 1, " Hold ", None)]
    out = {r.transaction_id: (r.status, r.account_id) for r in C.expand_decisions(spark.createDataFrame(m, "transaction_id int, group_id int, decision string, corrected string"), g, acc).collect()}
    assert out == {1: ("approved", "a1"), 2: ("corrected", "a2"), 3: ("split", None), 4: ("undecided", None), 5: ("invalid", None), 6: ("invalid", None), 7: ("invalid", None), 8: ("held", None)}


def test_prefix_repair(spark):
    k = spark.createDataFrame([("coffee shop", False), ("coffee", True), ("tea house", False), ("tea hut", False), ("tea h", True), ("abc", True)], "key string, cut boolean")
    assert {r.key: r.merchant for r in C.prefix_repair(k, F.col("cut")).collect()} == {"coffee shop": "coffee shop", "coffee": "coffee shop", "tea house": "tea house", "tea hut": "tea hut", "tea h": "tea h", "abc": "abc"}


def test_final_checks_name_what_fails(spark):
    b = spark.createDataFrame([(1, 5), (1, 5), (2, 0)], "id int, amount long")
    rep = K.report(K.unique_ids(b, ["id"], "unique"), K.row_checks(b, {"positive": F.col("amount") > 0, "there": F.col("id").isNotNull()}), K.expected_count(b, None, "total"))
    assert {r.check: r.result for r in rep.collect()} == {"unique": "fail", "positive": "fail", "there": "pass", "total": "fail"}
    try:
        K.require(rep)
        raise AssertionError
    except ValueError as e:
        assert "positive: 1" in str(e)


def test_plan_table(spark):
    base = {"high_confidence": False, "account_seen": True, "model_label": "a", "conf": 0.95, "needs_review": False, "rule_valid": True, "agree": True}
    cases = [({}, "model"), ({"high_confidence": True}, "rule"), ({"high_confidence": True, "account_seen": None}, "human"), ({"conf": 0.85}, "human"), ({"needs_review": None}, "human"), ({"agree": False}, "human"), ({"account_seen": None}, "model"), ({"account_seen": False}, "human"), ({"model_label": None}, "human"), ({"rule_valid": False, "agree": False}, "model")]
    schema = "high_confidence boolean, account_seen boolean, model_label string, conf double, needs_review boolean, rule_valid boolean, agree boolean"
    df = spark.createDataFrame([tuple((base | c).values()) for c, _ in cases], schema)
    assert [r.p for r in df.select(R.plan(F.lit(0.9)).alias("p")).collect()] == [w for _, w in cases]


def test_layers(spark):
    rows = [("raw_exact", 5, 1.0, 10, 100.0), ("raw_exact", 2, 1.0, 10, 100.0), ("norm_exact", 5, 0.5, 400, 100.0), ("fuzzy", 5, 1.0, 10, 80.0), ("fuzzy", 5, 1.0, 10, 60.0), ("none", None, None, None, None)]
    df = spark.createDataFrame(rows, "stage string, hist_n long, agreement double, days_since_last int, score double")
    assert [r.layer for r in R.classify(df).collect()] == ["H", "E", "C+D", "B", "A", "A"]


def test_profile_hides_values(spark):
    df = spark.createDataFrame([("a@b.example", {"x": 1}), ("", None)], "t string, m struct<x:int>")
    p = {r.field: r for r in U.profile(df).collect()}
    assert (p["t"].non_empty, p["t"].email, p["m.x"].non_empty) == (1, 1, 1)
    assert U.flatten(df).columns == ["t", "m.x"]


def test_internal_duplicates_over_all_branches(spark):
    """The registered query against plain Python over every line; some groups have several branches a journal."""
    from collections import Counter, defaultdict

    from ledgerloom.plans import catalogue
    from ledgerloom.plans.adapters import lines

    d = "/root/testdata/sf0.01"
    journals = defaultdict(list)
    for r in lines(spark, d).collect():
        journals[r.journal_id].append(r)
    groups = defaultdict(list)
    for j, rows in journals.items():
        head = min(rows, key=lambda r: r.branch_index)
        legs = Counter()
        for r in rows:
            legs += Counter({(s, a, b, r.value // 5000000): 1 for s, a, b in (("D", r.debit_account, r.debit_sub), ("C", r.credit_account, r.credit_sub))})
        groups[(f"{head.date.year}-01-01", head.part % 3, frozenset(legs.items()))].append(j)
    want = {(k[0], k[1], len(v), min(v), max(v)) for k, v in groups.items() if len(v) > 1}
    got = {(r.date, r.remark, r.n, r["first"], r["last"]) for r in catalogue.QUERIES["q_internal_duplicates"](spark, d).collect()}
    assert got == want and any(len(journals[r[3]]) > 1 for r in got)


def test_profile_of_json_without_a_schema(spark):
    from ledgerloom.operators import quality as U

    texts = ['{"a": {"b": [1, "x", {"c": null}]}, "d": "2024-05-06 a@b.jp"}', '{"a": 5, "d": "2023-01-02"}', '{"a": [], "d": {}, "e\\"[{": true}', "no json", None, "[[1.5], []]", '"}{"', "null"]
    got = {r.field: tuple(r)[1:] for r in U.profile_json(spark.createDataFrame([(t,) for t in texts], "j string"), "j", "d").collect()}
    assert got["a"] == ("array|number|object", 3, 2, 0, 0, 0, None, None) and got["a.b"][:3] == ("array", 1, 1) and got["a.b[]"][:3] == ("number|object|string", 3, 3)
    assert got["a.b[].c"][:3] == ("null", 1, 0) and got["d"] == ("object|string", 3, 2, 1, 0, 0, "2023-01-02", "2024-05-06") and got['e"[{'][:3] == ("boolean", 1, 1)
    assert got["[]"][:3] == ("array", 2, 1) and got["[][]"][:3] == ("number", 1, 1) and len(got) == 8
    assert U.profile_json(spark.createDataFrame([], "j string"), "j").count() == 0


def test_duplicates_that_share_several_amounts_are_told_once_after_the_last_join(spark):
    new = spark.createDataFrame([line(1, 1, "X", "B", 10), line(1, 2, "Y", "B", 20)], L)
    old = spark.createDataFrame([line(9, 1, "X", "B", 10), line(9, 2, "Y", "B", 20), line(8, 1, "Y", "Q", 20), line(8, 2, "X", "Q", 10)], L)
    found = C.duplicate_candidates(new, old)
    assert sorted((r.new_id, r.old_id, r.level) for r in found.collect()) == [(1, 8, "medium"), (1, 9, "high")]
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Aggregate" in x and "new_id" in x and "old_id" in x]  # pairs of journals are not made distinct


def shuffled(spark, run):
    """Bytes that run() writes to shuffles."""
    sc = spark.sparkContext
    gw = sc._gateway

    def written():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, gw.new_array(gw.jvm.double, 0), gw.jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (stages.apply(i) for i in range(stages.size()))}

    before = written()
    run()
    return sum(n for k, n in written().items() if k not in before)


def test_duplicate_levels_send_lines_once_and_narrowly(spark):
    from ledgerloom.plans import catalogue

    q = catalogue.QUERIES["q_duplicate_levels"](spark, "/root/testdata/sf0.01")
    n = shuffled(spark, lambda: q.write.format("noop").mode("overwrite").save())
    assert n < 60_000 * 90, n  # 60,000 lines


def test_journal_lines_travel_narrowly_without_a_change(spark, tmp_path):
    import random

    from ledgerloom.plans.adapters import journal_lines, lines

    draw = random.Random(4)
    pick = lambda *x: draw.choice(x)
    rows = [
        (draw.randrange(400), pick(1, 1, 2, 300, None), pick(1, 2**40, -3), pick(5, 2**33), pick(1.0, 2.5, 200.0, -0.0, 0.0, float("nan")), pick(100.0, 100.001, 100.0011, 3e9, 0.005), pick(0.07, 0.070001, None, float("inf")), pick(0.1, 0.1 + 1e-17, 0.29), pick("A", "", None), pick("F", "O"), dt.datetime(1969, 12, 30) + dt.timedelta(draw.randrange(6)) if draw.random() < 0.95 else None)
        for _ in range(3000)
    ]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    a, b = lines(spark, str(tmp_path)), journal_lines(spark, str(tmp_path))
    cols = ["journal_id", "debit_account", "debit_sub", "credit_account", "credit_sub", "value", "date"]
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))
    head = lambda x: {r.journal_id: r.h for r in x.groupBy("journal_id").agg(F.min(F.struct("branch_index", "date"))["date"].alias("h")).collect()}
    assert head(a) == head(b)
    found = lambda x: sorted(map(tuple, C.duplicate_candidates(x.where("journal_id % 2 = 0"), x.where("journal_id % 2 = 1")).collect()))
    assert found(a) == found(b) and found(a)


def test_duplicate_levels_equal_brute_force_over_days_and_shared_pairs(spark):
    import random

    draw = random.Random(9)
    rows = [line(j, b, draw.choice("XYZ"), draw.choice(["B", "C", None]), draw.choice([0, 10, 20, 30]), day) for j in range(240) for day in [dt.date(1969, 12, 20) + dt.timedelta(draw.randrange(30))] for b in range(draw.choice([1, 1, 2, 4]))]
    df = spark.createDataFrame(rows, L)
    journals = {}
    for j, _, day, _, da, ds, ca, cs, v in rows:
        x = journals.setdefault(j, (day, set(), []))
        for side, account, sub in (("D", da, ds), ("C", ca, cs)):
            if account and v:
                x[1].add((account, v))
                x[2].append((side, account, sub, v))
    want = []
    for i, (d, p, l) in journals.items():
        for k, (e, q, m) in journals.items():
            if i % 2 == 0 and k % 2 == 1 and p & q and abs((d - e).days) <= 3:
                want.append((i, k, "low" if d != e else "high" if sorted(l) == sorted(m) else "medium"))
    got = C.duplicate_candidates(df.where("journal_id % 2 = 0"), df.where("journal_id % 2 = 1")).collect()
    assert sorted(map(tuple, got)) == sorted(want) and {x[2] for x in want} == {"low", "medium", "high"}
