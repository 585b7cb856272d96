"""Metrics of journals and line items."""

from ledgerloom.operators import quality as U


def test_journals_without_any_side_move_nothing(spark):
    side = "struct<sub_account_id: string, value: long>"
    journals = spark.createDataFrame(
        [(1, [(None, None)]), (2, [(None, None), (("a", 5), None)]), (3, [(("b", 5), ("a", 7))]), (4, [((None, 5), None)]), (5, None)],
        f"transaction_id long, branches array<struct<debitor: {side}, creditor: {side}>>",
    )
    tx = spark.createDataFrame([(i, "INCOME", None if i == 4 else "a") for i in range(1, 7)], "transaction_id long, side string, bank_sub string")
    assert {r.transaction_id: r.net for r in U.bank_side_net(journals, tx).collect()} == {2: 5, 3: -7, 4: 5}


def test_escaped_quotes_hide_no_levels(spark):
    one = spark.createDataFrame([(r'{"a": "]]\"", "b": {"c": {"d": 1}}}',)], "j string")
    assert {r.field for r in U.profile_json(one, "j").collect()} == {"a", "b", "b.c", "b.c.d"}
    texts = [r'{"a": "x\"]]", "b": {"c": {"d": [1, []]}}}', r'{"a": "\\", "b": {}}', "[[{}]]", "7"]
    got = {r.field: (r.types, r.present, r.non_empty) for r in U.profile_json(spark.createDataFrame([(t,) for t in texts], "j string"), "j").collect()}
    assert got == {
        "a": ("string", 2, 2), "b": ("object", 2, 1), "b.c": ("object", 1, 1), "b.c.d": ("array", 1, 1), "b.c.d[]": ("array|number", 2, 1), "[]": ("array", 1, 1), "[][]": ("object", 1, 0),
    }


def test_json_is_parsed_once(spark):
    df = U.profile_json(spark.createDataFrame([('{"a": {"b": {"c": 1}}}',)], "j string"), "j")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
