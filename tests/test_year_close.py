"""The closing chain on small frames."""

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks as K
from ledgerloom.operators import ordering
from ledgerloom.operators import year_close as Y

DAY = datetime.date


def column(spark, schema, rows, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_final_decision(spark):
    rows = [
        ("approve", "human_review", "a1", None), ("approve", "human_review", None, None), ("existing_auto_candidate", "rule_candidate", "a1", None), ("existing_auto_candidate", "human_review", "a1", None),
        ("correct", "human_review", "a1", "a2"), ("correct", "human_review", "a1", None), ("exclude", "x", "a1", None), ("ask", "x", "a1", None), (None, "x", "a1", None), (" approve ", "x", "a1", None),
    ]
    got = column(spark, "r string, t string, p string, c string", rows, Y.final_decision(F.col("r"), F.col("t"), F.col("p"), F.col("c")))
    assert [(g.status, g.account_id) for g in got] == [
        ("confirmed", "a1"), ("invalid", None), ("confirmed", "a1"), ("invalid", None), ("confirmed", "a2"), ("invalid", None), ("excluded", None), ("undecided", None), ("invalid", None), ("confirmed", "a1"),
    ]
    assert [g.problem is None for g in got] == [True, False, True, False, True, False, True, False, False, True]


def test_proposal_status(spark):
    rows = [("unconfirmed", "EXPENSE", "a", "confirmed"), ("other", "EXPENSE", "a", "confirmed"), ("personal", "INCOME", "a", "confirmed"), ("personal", "EXPENSE", "loan", "confirmed"), ("bank", "INCOME", "loan", "confirmed"), ("bank", "EXPENSE", None, "confirmed"), ("bank", "EXPENSE", "a", None)]
    got = column(spark, "f string, s string, a string, d string", rows, Y.proposal_status(F.col("f"), F.col("s"), F.col("a"), F.col("d"), ["loan"]))
    assert got == ["funding_unconfirmed", "not_applicable", "refund_review", "structure_review", "ready", "no_proposed_account", "awaiting_decision"]


def overrides(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, action string, account string, counter_sub_account string, target_transaction_id string, reason string")


def test_overrides(spark):
    tx = spark.createDataFrame([(t,) for t in "abcdefg"], "transaction_id string")
    accounts, subs = spark.createDataFrame([("1", "Cash")], "account_id string, name string"), spark.createDataFrame([("9", "Main")], "sub_account_id string, name string")
    rows = [
        ("a", "exclude", None, None, None, "r"), ("b", "set_account", "Cash", None, None, None), ("c", "set_account", "Gold", None, None, None), ("d", "merged_into", None, None, "a", None), ("e", "merged_into", None, None, "e", None),
        ("f", "set_counter_sub_account", None, "Main", None, None), ("g", "burn", None, None, None, None), ("z", "exclude", None, None, None, None),
    ]
    good, bad = Y.resolve_overrides(overrides(spark, rows), tx, accounts, subs)
    assert {r.transaction_id: (r.override_account_id, r.override_sub_id) for r in good.collect()} == {"a": (None, None), "b": ("1", None), "f": (None, "9")}
    assert {r.transaction_id: r.problem for r in bad.collect()} == {"c": "unknown account", "d": "target is excluded", "e": "bad target", "g": "unknown action", "z": "unknown line item"}
    with pytest.raises(ValueError, match="unknown account: 1"):
        Y.require_none(bad, "overrides")
    good, bad = Y.resolve_overrides(overrides(spark, [rows[0], rows[0]]), tx, accounts, subs)
    assert good.count() == 0 and {r.problem for r in bad.collect()} == {"repeated"}
    Y.require_none(bad.limit(0), "overrides")


def items(spark):
    rows = [("t1", DAY(2024, 5, 1), 100, "EXPENSE", "bank", 1), ("t2", DAY(2024, 5, 2), 200, "INCOME", "personal", 2), ("t3", DAY(2024, 5, 3), 300, "EXPENSE", "personal", 3), ("t4", DAY(2024, 5, 4), 400, "EXPENSE", "unconfirmed", 1), ("t5", DAY(2024, 5, 5), 500, "EXPENSE", "bank", 4), ("t6", DAY(2024, 5, 6), 600, "EXPENSE", "bank", 5)]
    return spark.createDataFrame(rows, "transaction_id string, date date, amount long, side string, funding string, review_group int")


def groups(spark):
    rows = [(1, "approve", "human_review", "bank_account", None), (2, "existing_auto_candidate", "rule_candidate", "fees", None), (3, "correct", "human_review", "x", "Loan"), (4, "exclude", "human_review", "x", None), (5, "ask", "human_review", "x", None)]
    return spark.createDataFrame(rows, "review_group int, recommendation string, routing string, proposed string, correction string")


def closing(spark, over):
    accounts = spark.createDataFrame([("loan", "Loan"), ("bank_account", "Bank")], "account_id string, name string")
    good, _ = Y.resolve_overrides(overrides(spark, over), items(spark), accounts, spark.createDataFrame([("s", "Sub")], "sub_account_id string, name string"))
    return Y.closing_rows(items(spark), groups(spark), good, accounts, ["payable", "loan"], "bank_account")


def test_closing_status_and_override_precedence(spark):
    r = {x.transaction_id: x for x in closing(spark, []).collect()}
    assert {k: v.journal_status for k, v in r.items()} == {"t1": "generated", "t2": "refund_review", "t3": "structure_review", "t4": "funding_unconfirmed", "t5": "excluded", "t6": "undecided"}
    assert [k for k, v in r.items() if v.needs_bankbook_review] == ["t1"]
    over = [("t1", "set_counter_sub_account", None, "Sub", None, None), ("t2", "confirm_refund", None, None, None, None), ("t5", "merged_into", None, None, "t1", "same"), ("t6", "set_account", "Bank", None, None, None)]
    r = {x.transaction_id: x for x in closing(spark, over).collect()}
    assert (r["t1"].needs_bankbook_review, r["t1"].sub_account_id, r["t2"].journal_status, r["t5"].journal_status, r["t5"].merged_into, r["t6"].account_id) == (False, "s", "generated", "merged_transfer", "t1", "bank_account")


BRANCH = "journal_id string, transaction_id string, date date, branch int, debit string, credit string, debit_sub string, credit_sub string, amount long, credit_amount long, funding string"


def final(spark, branches, over=()):
    c = Y.final_checks(closing(spark, list(over)), spark.createDataFrame(branches, BRANCH), "2024-01-01", "2024-12-31")
    return {r.check: r["count"] for r in c.collect()}


def test_final_checks_find_each_fault(spark):
    d = DAY(2024, 5, 1)
    good = [("j1", "t1", d, 1, "bank_account", "bank", None, None, 100, 100, "bank"), ("j3", "t3", d, 1, "x", "payable", "c", "c", 300, 300, "personal"), ("j3", "t3", d, 2, "payable", "loan", "c", "c", 300, 300, "personal")]
    n = final(spark, good)
    assert n["journals balance"] == n["one journal a line item"] == n["the payable nets to zero in one sub-account"] == n["within the year"] == n["excluded and merged items have no journal"] == 0
    assert n["every other item has a journal"] == 4 and n["no open questions"] == 1
    assert final(spark, [*good[:2], (*good[2][:6], "c", "c", 250, 250, "personal")])["the payable nets to zero in one sub-account"] == 1
    assert final(spark, [*good[:2], (*good[2][:6], "d", "d", 300, 300, "personal")])["the payable nets to zero in one sub-account"] == 1
    assert final(spark, [(*good[0][:9], 90, "bank"), *good[1:]])["journals balance"] == 2  # the journal and the total
    assert final(spark, [*good, ("j5", "t5", DAY(2023, 1, 1), 1, "a", "b", None, None, 0, 0, "bank")])["excluded and merged items have no journal"] == 1
    n = final(spark, [*good, ("j9", "t1", DAY(2023, 1, 1), 1, "a", "b", None, None, 0, 0, "bank")])
    assert (n["one journal a line item"], n["within the year"], n["no zero or negative amounts"]) == (1, 1, 1)
    assert final(spark, good, [("t5", "merged_into", None, None, "t6", None)])["merge targets have a journal"] == 1


def test_lineage_and_duplicates(spark):
    rows = [("s1", "Card One", "ＳＨＯＰ order", True), ("s2", "Bank", "shop web services", True), ("s3", None, "shop", False), ("s4", "Bank", None, True)]
    df = spark.createDataFrame(rows, "s string, v string, c string, card boolean")
    r = df.select(Y.lineage(F.col("s"), F.col("v"), {"one": "Card One"}), Y.keyword_duplicate(F.col("c"), F.col("card"), ["SHOP"], ["SHOP WEB"])).collect()
    assert [tuple(x) for x in r] == [("lineage:one", True), ("s2", False), ("s3", False), ("s4", False)]


def test_past_summary(spark):
    rows = [("k", DAY(2024, 1, 1), 1, "m", 96, 5, "a:5"), ("k", DAY(2024, 1, 1), 2, "k", 100, 2, "b:2"), ("q", DAY(2024, 1, 1), 1, "m", 80, 4, "c:4"), ("q", DAY(2024, 1, 1), 2, "o", 70, 9, "d:9")]
    c = spark.createDataFrame(rows, "key string, day date, rank int, match string, similarity long, occurrences long, labels string")
    assert {r.key: (r.n, r.text) for r in Y.past_summary(c).collect()} == {"k": (2, "exact: b:2"), "q": (0, "similar 80 m: c:4")}


def test_numbers_over_parts(spark):
    df = spark.createDataFrame([(p, i) for p in ("b", None, "a") for i in (3, 1, 2)], "p string, i int")
    got = [(r.p, r.i, r.no) for r in ordering.numbered(df, ["p"], ["i"]).orderBy("no").collect()]
    assert got == [(p, i, n) for n, (p, i) in enumerate([(p, i) for p in (None, "a", "b") for i in (1, 2, 3)], 1)]
    ids = spark.createDataFrame([(str(x),) for x in (5, 5, -3, 2_000_000, 1_999_999, 7)], "j string")
    assert {r.j: r.no for r in ordering.dense_numbers(ids, "j").collect()} == {-3: 1, 5: 2, 7: 3, 1_999_999: 4, 2_000_000: 5}


JOURNAL = "id string, transaction_date string, branches array<struct<debitor:struct<value:string>, creditor:struct<value:string>>>"


def test_load_checks(spark):
    one = [{"debitor": {"value": "5"}, "creditor": None}]
    rows = [("a", "2024-02-30", one), ("b", "2024-03-01T00:00", one), ("b", "2025-01-01", []), (None, None, None), ("c", "2024-01-01", [{"debitor": None, "creditor": None}]), ("d", "2024-01-01", [{"debitor": {"value": "1.5"}, "creditor": None}])]
    totals = spark.createDataFrame([(7,)], "total_count long")
    n = {r.check.removeprefix("journals: "): r["count"] for r in K.journal_checks(spark.createDataFrame(rows, JOURNAL), totals, "2024-01-01", "2024-12-31").collect()}
    assert n == {"count is the declared total": 1, "ids are unique": 1, "id is there": 1, "date within the range": 3, "branches are there": 2, "every branch has a side": 1, "values are whole numbers": 1}
    none = K.declared_totals(spark.createDataFrame(rows, JOURNAL), totals.limit(0), "x").first()
    assert none.result == "fail"
    with pytest.raises(TypeError):
        K.text_typed(spark.createDataFrame([(1,)], "transaction_id long").schema, "transaction_id")
    tx = spark.createDataFrame([("a", "2024-01-01", "5", "INCOME", "none", "s"), ("b", "x", "5.0", "UP", "lost", "")], "id string, date string, value string, side string, journalizing_status string, connected_sub_account_id string")
    n = [r["count"] for r in K.line_item_checks(tx, spark.createDataFrame([(2,)], "total_count long"), "2024-01-01", "2024-12-31", ["none"]).collect()]
    assert n == [0, 0, 0, 1, 1, 1, 1, 1]
