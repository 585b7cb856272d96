import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as X


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(
    ("level", "given", "expected"),
    [
        ("raw", "　ABC \t", "ABC"), ("n1", "ＡＢＣ　ｶﾌｪ  X", "abc カフェ x"), ("n2", "A-B (C)", "a b c"), ("n3", "A-B (C)", "abc"),
        ("n4", "Shop 1234567 12345", "shop#"), ("n4", "Shop 12345", "shop12345"), ("n5", "Shop 1/23 12345 12", "shop##12"), ("n1", "Straße", "strasse"), ("n2", "コーヒー・店", "コーヒー 店"),
    ],
)
def test_normalizers(spark, level, given, expected):
    assert one(spark, given, lambda c: X.normalize(c, level)) == expected


def test_ascii_path_agrees(spark):
    texts = ["Abc  DEF-12", "  x ", "A1234567", "", "a.b,c"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    for level in ("n1", "n2", "n3", "n4", "n5"):
        r = df.select(X.normalize(F.col("c"), level).alias("a"), X.normalize(F.col("c"), level, True).alias("b")).collect()
        assert all(x.a == x.b for x in r)


def test_masking(spark):
    s = lambda v: one(spark, v, X.sanitize)
    assert s("card 1234 5678 9012 3456 end") == "card <NUM>end"
    assert s("a@b.example 03-1234-5678 shop 12345") == "<EMAIL> <PHONE> shop 12345"
    assert s("no 1234567") == "no <NUM>" and s("no 123456") == "no 123456"
    assert s(None) == "" and s("  ") == "" and s("xx12 **345") == "<NUM> <NUM>"


def test_bands(spark):
    b = lambda v: one(spark, v, X.amount_band, "long")
    assert [b(v) for v in (0, 999, 1000, -4999, 5000, 999_999, 1_000_000, None)] == ["〜1千円", "〜1千円", "1千〜5千円", "1千〜5千円", "5千〜1万円", "50万〜100万円", "100万円以上", "不明"]
    c = lambda v: one(spark, v, X.confidence_band, "double")
    assert [c(v) for v in (0.95, 0.9499, 0.5, 0.1, None)] == ["0.95-1.00", "0.90-0.95", "0.50-0.70", "<0.50", "none"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def test_indel_ratio_both_ways(spark):
    pairs = [("abc", "abd"), ("", ""), ("", "x"), ("kitten", "sitting"), ("aaaa", "aa"), ("ab", "ba"), ("カフェ", "カフエ")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", X.indel_ratio(F.col("a"), F.col("b")).alias("x"), X.indel_ratio_arrow(F.col("a"), F.col("b")).alias("y")).collect():
        want = 200.0 * lcs(r.a, r.b) / (len(r.a) + len(r.b)) if r.a or r.b else 100.0
        assert r.x == pytest.approx(want) and r.y == pytest.approx(want)


def test_nfkc_over_documents_matches_python(spark):
    texts = ["ｱﾊﾟｰﾄ ①②", "ﬁn", None, ""]
    got = [r.r for r in spark.createDataFrame([(t,) for t in texts], "c string").select(X.nfkc(F.col("c")).alias("r")).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]


def test_rate_and_tokens_and_reasons(spark):
    r = spark.range(1).select(X.rate(F.lit(1), F.lit(3)).alias("a"), X.rate(F.lit(1), F.lit(0)).alias("b"), X.estimate_tokens(F.lit("abcdefg日本")).alias("t"), X.reason_categories(F.lit("As in the past, unclear")).alias("c"), X.reason_categories(F.lit(None).cast("string")).alias("d")).first()
    assert (r.a, r.b, r.t, r.c, r.d) == (0.3333, None, 5, ["insufficient", "history"], ["other"])


def test_weighted_ratio(spark):
    assert X.weighted_ratio("abc def", "abc def") == 100 and X.weighted_ratio("", "x") == 0
    assert X.weighted_ratio("def abc", "abc def") == 95  # the same words in another order
    assert X.weighted_ratio("coffee shop", "coffee shop shibuya station") == 90  # a part of a longer text
    assert X.weighted_ratio("ab", "ab" + "x" * 40) == 60  # of a far longer one
    df = spark.createDataFrame([("a b", "b a"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(X.weighted_ratio_arrow(F.col("a"), F.col("b"))).collect()] == [95.0, None]


def test_bands_and_percent(spark):
    df = spark.createDataFrame([("raw_exact", 100.0, 1, 1.0, 31), ("fuzzy", 84.9, 4, 0.8, 91), ("fuzzy", 12.0, 12, 0.5, 400)], "s string, v double, n int, a double, d int")
    got = df.select(X.stage_band(F.col("s"), F.col("v")), X.use_band(F.col("n")), X.agreement_band(F.col("a")), X.age_band(F.col("d")), X.count_band(F.col("n")), X.share_band(F.col("a")), X.percent(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("raw_exact", "1", "100%", "<=31", "1", "100%", "100.0%"), ("fuzzy 80-84", "3-4", "80-99%", "91-365", "2-4", "70-89%", "80.0%"), ("fuzzy <70", "10+", "<80%", ">365", "10+", "50-69%", "50.0%")]
    assert df.select(X.is_truncated(F.lit("ＡＢ(cut"), r"\(cut$")).first()[0] and not df.select(X.is_truncated(F.lit(None).cast("string"), "x")).first()[0]
    leaks = X.leak_counts(F.lit("a@b.jp 1234567 090-1111-2222"))
    assert df.select(*(v.alias(k) for k, v in leaks.items())).first().asDict() == {"email": 1, "phone": 1, "digits": 1}
    assert df.select(X.reason_categories_fixed(F.lit("過去と金額"))).first()[0] == ["過去履歴を根拠", "金額/入出金方向を根拠"]


def test_pairs_above_a_floor_are_all_found(spark):
    import random

    from ledgerloom.functions.text import lcs_length
    from ledgerloom.operators.similarity import pair_scores

    rnd = random.Random(3)
    keys = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(60)})
    df = spark.createDataFrame([(k,) for k in keys], "a string")
    got = {(r.a, r.b) for r in pair_scores(df, df.withColumnRenamed("a", "b"), arrow=True, floor=70.0).collect()}
    assert got == {(a, b) for a in keys for b in keys if a != b and len(a) + len(b) and 200 * lcs_length(a, b) / (len(a) + len(b)) >= 70}
