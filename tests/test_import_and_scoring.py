"""The import file's round trip, payloads, answers and budgets."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import import_format as I
from ledgerloom.operators import scoring as O

LINE = "journal_no string, branch string, transaction_id string, date date, debit_account string, debit_sub string, debit_tax string, debit_amount string, debit_tax_value string, credit_account string, credit_sub string, credit_tax string, credit_amount string, credit_tax_value string, remark string"


def lines(spark, remark="a, \"b\""):
    d = datetime.date(2024, 4, 1)
    t = I.NO_TAX
    rows = [("10", "1", "x", d, "Fees", "", t, "500", "0", "Bank", "Main", t, "500", "0", remark), ("10", "2", "x", d, "Bank", "Main", t, "500", "0", "Loan", "", t, "500", "0", "second"), ("9", "1", "y", d, "Fees", "Web", t, "70", "0", "Bank", "Main", t, "70", "0", "plain")]
    return spark.createDataFrame(rows, LINE)


def masters(spark):
    accounts = spark.createDataFrame([("1", "Fees"), ("2", "Bank"), ("3", "Loan")], "account_id string, name string")
    subs = spark.createDataFrame([("s1", "2", "Main"), ("s2", "1", "Web")], "sub_account_id string, account_id string, name string")
    tx = spark.createDataFrame([("x", "confirmed", None), ("y", "confirmed", None), ("z", "excluded", None), ("m", "merged", "x")], "transaction_id string, status string, merged_into string")
    return accounts, subs, tx


def whole(lines):
    return lines.withColumns({c: F.col(c).cast("long") for c in ("debit_amount", "credit_amount")})


def test_import_round_trip(spark, tmp_path):
    l, path = lines(spark), f"file://{tmp_path}/import.csv"
    I.write_import_file(I.import_rows(l), path)
    raw = (tmp_path / "import.csv").read_bytes()
    assert raw.startswith(",".join(I.COLUMNS).encode()) and b"\r" not in raw and len(raw.splitlines()) == 4
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["import.csv"]
    assert {r.result for r in I.file_checks(spark, path).collect()} == {"pass"}
    back = I.parse_rows(I.read_import_file(spark, path))
    got = [(r.no, r.branch, r.date, r.debit_account, r.debit_amount, r.credit_sub, r.remark) for r in back.orderBy("no", "branch").collect()]
    assert got == [(1, 1, "2024-04-01", "Fees", 70, "Main", "plain"), (2, 1, "2024-04-01", "Fees", 500, "Main", 'a, "b"'), (2, 2, "2024-04-01", "Bank", 500, "", "second")]
    checks = I.import_checks(back, whole(l), I.journal_index(l), *masters(spark))
    assert {r.check: r["count"] for r in checks.collect() if r["count"]} == {}
    assert [len(r.lines) for r in I.group_journals(back).orderBy("no").collect()] == [1, 2]


def test_import_checks_find_each_fault(spark):
    l = lines(spark, remark=" ")
    rows = I.import_rows(l).withColumn("position", F.col("branch"))
    rows = rows.withColumns({"タグ": F.when(F.col("取引No") == 1, "x").otherwise(""), "借方金額(円)": F.when(F.col("取引No") == 1, 71).otherwise(F.col("借方金額(円)")), "貸方勘定科目": F.when(F.col("branch") == 2, "Gold").otherwise(F.col("貸方勘定科目"))})
    accounts, subs, tx = masters(spark)
    tx = tx.withColumn("status", F.when(F.col("transaction_id") == "y", "excluded").otherwise(F.col("status"))).withColumn("merged_into", F.when(F.col("status") == "merged", "q"))
    c = I.import_checks(I.parse_rows(rows), whole(l), I.journal_index(l), accounts, subs, tx)
    assert {r.check: r["count"] for r in c.collect() if r["count"]} == {
        "blank columns are blank": 1, "debits as in the source": 1, "debits equal credits": 2, "accounts net as in the source": 3, "sub-accounts net as in the source": 3,
        "date, amount and remark are there": 1, "accounts exist, sub-accounts are unique": 1, "excluded items are not there": 1, "merged items are not there, their targets are": 1,
    }
    assert I.covered(l, l.where("transaction_id = 'x'")).select("transaction_id").distinct().first()[0] == "y"


def test_file_checks_see_marks_and_returns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfx,y\r\n")
    assert {r.check: r.result for r in I.file_checks(spark, f"file://{tmp_path}/a.csv").collect()} == {"columns in order": "fail", "UTF-8 without mark, LF": "fail"}


def test_payload_holds_no_ids_or_numbers(spark):
    df = spark.createDataFrame([("tx-1", "Shop 090-1234-5678 a@b.jp 1234567", "EXPENSE", 4200, "2024-01-02", "bank")], "id string, c string, s string, v long, d string, k string")
    cands = F.array(F.struct(F.lit("old").alias("content"), F.lit(98).alias("similarity")))
    p = df.select(O.payload(F.col("c"), F.col("s"), F.col("v"), F.col("d"), F.col("k"), cands)).first()[0]
    body = json.loads(p)
    assert body["transaction"] == {"account_kind": "bank", "amount_band": "1千〜5千円", "content": "Shop <PHONE> <EMAIL> <NUM>", "date": "2024-01-02", "side": "出金"} and "tx-1" not in p
    assert list(body) == sorted(body) and list(body["transaction"]) == sorted(body["transaction"])
    assert O.answer_schema(["A2", "A1"], True)["properties"]["primary_account_code"]["anyOf"][0]["enum"] == ["A1", "A2"]


def test_answers(spark):
    ok = {"primary_account_code": "A1", "confidence": 0.5, "reason": "r", "needs_review": False, "insufficient_information": False}
    rows = [("a", "end_turn", json.dumps(ok)), ("b", "end_turn", json.dumps(ok | {"primary_account_code": None})), ("c", "max_tokens", json.dumps(ok)), ("d", "end_turn", "{"), ("e", "end_turn", json.dumps(ok | {"primary_account_code": "A9"})), ("f", "end_turn", json.dumps(ok | {"confidence": -0.1})), ("g", "end_turn", json.dumps(ok | {"confidence": None})), ("h", "end_turn", None)]
    r = {x.transaction_id: x for x in O.parse_answers(spark.createDataFrame(rows, "transaction_id string, stop_reason string, text string"), spark.createDataFrame([("A1", "acc")], "code string, account_id string")).collect()}
    assert [r[k].problem for k in "abcdefgh"] == [None, None, "unexpected stop", "not JSON", "unknown account code", "confidence out of range", "confidence out of range", "no text"]
    assert (r["a"].account_id, r["b"].account_id, r["a"].needs_review) == ("acc", None, False)


def test_scoring_needs_approval_and_stops_at_its_limit(spark):
    items = spark.createDataFrame([(f"t{i}",) for i in range(6)], "transaction_id string").coalesce(1)
    scorer = lambda xs: [{"transaction_id": x["transaction_id"], "cost": 1.0} for x in xs]
    with pytest.raises(PermissionError):
        O.score(items, scorer, "transaction_id string, cost double")
    assert O.score(items, scorer, "transaction_id string, cost double", approved=True).count() == 6
    with pytest.raises(Exception, match="more than its limit"):
        O.score(items, scorer, "transaction_id string, cost double", approved=True, price=lambda a: a["cost"], max_cost=3.0).collect()


def test_budget(spark):
    t = spark.createDataFrame([(1000, 400), (1000, 700)], "counted long, estimated long")
    b = O.budget(t, 600, 100, (2.0, 10.0, 0.2), 1.0).first()
    assert (b.items, b.counted, b.problem) == (2, 2000, None) and b.cost_cached == pytest.approx((800 * 2 + 600 * 2.5 + 600 * 0.2 + 2000) / 1e6)
    assert O.budget(t, 600, 100, (2.0, 10.0, 0.2), 0.001).first().problem == "cost above the limit"
    assert O.budget(t.withColumn("estimated", F.lit(1)), 0, 0, (1.0, 1.0, 1.0), 1.0).first().problem == "more tokens than estimated"


def test_answers_outlive_a_failing_scorer(spark, tmp_path):
    """Item 7 of 10 fails: 6 paid answers stay, and the next run asks for the rest only."""
    items = spark.createDataFrame([(f"t{i:02d}",) for i in range(1, 11)], "transaction_id string")
    asked, path, schema = tmp_path / "asked", f"file://{tmp_path}/answers", "transaction_id string, text string"

    def scorer(fails_at):
        def run(xs):
            with open(asked, "a") as f:
                f.write(xs[0]["transaction_id"] + "\n")
            if xs[0]["transaction_id"] == fails_at:
                raise ValueError("no answer")
            return [{"transaction_id": xs[0]["transaction_id"], "text": "ok"}]

        return run

    with pytest.raises(PermissionError):
        O.score_durably(items, scorer(None), path, schema)
    with pytest.raises(RuntimeError, match="no answer"):
        O.score_durably(items, scorer("t07"), path, schema, approved=True, price=lambda a: 0.5)
    assert sorted(r.transaction_id for r in O.scored(spark, path, schema).collect()) == [f"t{i:02d}" for i in range(1, 7)]
    first = asked.read_text().split()
    got = O.score_durably(items, scorer(None), path, schema, approved=True, price=lambda a: 0.5, batch=3)
    assert sorted(r.transaction_id for r in got.collect()) == [f"t{i:02d}" for i in range(1, 11)] and got.agg(F.sum("_cost")).first()[0] == 5.0
    assert first == [f"t{i:02d}" for i in range(1, 8)] and sorted(asked.read_text().split()[7:]) == ["t07", "t08", "t09", "t10"]
    assert O.score_durably(items, scorer("t01"), path, schema, approved=True).count() == 10  # nothing is left to ask
    assert not [p for p in tmp_path.iterdir() if "queue" in p.name]


def test_the_limit_is_held_against_all_runs(spark, tmp_path):
    items = spark.createDataFrame([(f"t{i}",) for i in range(6)], "transaction_id string")
    path, schema, scorer = f"file://{tmp_path}/answers", "transaction_id string", lambda xs: [{"transaction_id": xs[0]["transaction_id"]}]
    for limit, there in ((1.5, 2), (1.5, 2), (3.0, 4)):
        with pytest.raises(RuntimeError, match="more than its limit"):
            O.score_durably(items, scorer, path, schema, approved=True, price=lambda a: 1.0, max_cost=limit, batch=2)
        assert O.scored(spark, path, schema).count() == there
    assert O.score_durably(items, scorer, path, schema, approved=True, price=lambda a: 1.0, max_cost=9.0).count() == 6
    with pytest.raises(Exception, match="without a key"):
        O.score_durably(spark.createDataFrame([(None,)], "transaction_id string"), scorer, path, schema, approved=True)


def test_the_schema_of_an_answer_is_what_is_read():
    shape = O.answer_schema(["B", "A"])
    assert shape["required"] == list(shape["properties"]) == [f.name for f in O.ANSWER][:5] and shape["additionalProperties"] is False
    assert shape["properties"]["primary_account_code"] == {"anyOf": [{"type": "string", "enum": ["A", "B"]}, {"type": "null"}]}
    assert [shape["properties"][n]["type"] for n in shape["required"][1:]] == ["number", "string", "boolean", "boolean"]
    assert O.answer_schema([], True)["properties"]["reason_category"] == {"type": "string", "enum": O.REASON_CATEGORIES}


def test_import_checks_read_the_lines_three_times(spark, tmp_path):
    l = lines(spark)
    path = f"file://{tmp_path}/back"
    I.parse_rows(I.import_rows(l).withColumn("position", F.monotonically_increasing_id())).write.parquet(path)
    back = spark.read.parquet(path)
    plan = I.import_checks(back, whole(l), I.journal_index(l), *masters(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("filled_blanks") and len([x for x in plan.split("\n") if "parquet" in x and "Relation" in x]) <= 3
