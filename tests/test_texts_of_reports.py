"""Texts that people or a model read: profiles, tables, catalogues, summaries, merchants."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.operators import close as C
from ledgerloom.operators import quality as U
from ledgerloom.operators import scoring as O
from ledgerloom.operators import year_close as Y


def test_a_profile_as_text_holds_counts_and_dates_only(spark):
    p = U.profile_json(spark.createDataFrame([('{"d": "2024-05-06", "secret": "a@b.jp"}',), ('{"d": "2023-01-02", "secret": ""}',)], "j string"), "j", "d").withColumnRenamed("types", "type")
    assert U.summary_text(p) == "d: string, 2/2, 2023-01-02 to 2024-05-06\nsecret: string, 1/2"


def test_a_report_as_markdown(spark):
    r = spark.createDataFrame([(1, "b", "2", None), (0, "a", "1", "x")], 'row int, label string, `2023` string, `2024` string')
    assert U.markdown(r.fillna("-"), ["2023", "2024"]) == "| metric | 2023 | 2024 |\n|---|---:|---:|\n| a | 1 | x |\n| b | 2 | - |"


def test_system_text(spark):
    c = spark.createDataFrame([("B", "two", None, "k"), ("A", "one", "g", "k")], "code string, name string, `group` string, category string")
    assert O.system_text(c, "Codes:\n").first().text == "Codes:\nA\tone\tg\tk\nB\ttwo\t\tk"
    assert O.system_text(c.limit(0), "Codes:\n").first().text == "Codes:\n"
    assert c.limit(1).select(O.prompt(F.lit("{}"), "Account?")).first()[0] == "Account?\n{}"


def test_past_summary(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", day, 1, "a", 100, 7, "L:7"), ("a", day, 2, "ab", 90, 3, "M:3"), ("b", day, 1, "bb", 99, 5, "L:5"), ("b", day, 2, "x", 80, 1, "N:1"), ("c", day, 2, "c2", 100, 4, "L:4"), ("c", day, 1, "c1", 99, 9, "M:9")]
    c = spark.createDataFrame(rows, "key string, day date, rank int, match string, similarity long, occurrences long, labels string")
    assert {r.key: (r.n, r.text) for r in Y.past_summary(c).collect()} == {"a": (7, "exact: L:7"), "b": (0, "similar 99 bb: L:5"), "c": (4, "exact: L:4")}


def test_merchants_of_real_texts(spark):
    rows = [(1, "Shop ＡＢＣ Tokyo 2024/01/02"), (2, "shop abc tokyo"), (3, "SHOP ABC TOK(cut"), (4, "shop(cut"), (5, "shop abd"), (6, None), (7, "Cafe no.12"), (8, "café"), (9, "")]
    got = {r.id: r.merchant for r in C.with_merchants(spark.createDataFrame(rows, "id int, content string"), r"\(cut$", (r" ?\d{4}/\d\d/\d\d$", r" no\.\d+$", r"\(cut$")).collect()}
    assert got == {1: "shopabctokyo", 2: "shopabctokyo", 3: "shopabctokyo", 4: "shop", 5: "shopabd", 6: "", 7: "cafe", 8: "café", 9: ""}
    assert [r[0] for r in spark.createDataFrame([("A no.1",), (None,)], "c string").select(X.merchant_key(F.col("c"), (r" no\.\d+$",))).collect()][0] == "a"


def test_close_layers_tell_three_ways(spark):
    schema = "id long, day date, content string, label string, complex boolean, fy int, account string, value long"
    h = spark.createDataFrame([(i, dt.date(2023, 1, 1 + i), "steady", "A", False, 2023, "lineage:shop", 5) for i in range(4)] + [(9, dt.date(2023, 6, 1), "split", "A", False, 2023, "7", 5), (10, dt.date(2023, 6, 2), "split", "B", False, 2023, "7", 5)], schema)
    t = spark.createDataFrame([(20, dt.date(2023, 9, 1), "steady", "A", False, 2023, "lineage:shop", 5), (21, dt.date(2023, 9, 1), "steady", "A", False, 2023, "7", 5), (22, dt.date(2023, 9, 1), "split", "A", False, 2023, "7", 5), (23, dt.date(2023, 9, 1), "qqqqqqqq", "A", False, 2023, "7", 5)], schema)
    r = {x.id: (x.routing, x.account_seen) for x in Y.classify_targets(h, t).collect()}
    assert (r[20], r[21], r[22][1], r[23][1]) == ((Y.RULE, True), (Y.HUMAN, False), True, None) and r[22][0] in ("model", Y.HUMAN)
