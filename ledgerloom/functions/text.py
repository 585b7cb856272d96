"""Text, band and ratio functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, band edges and labels that results must carry as they are.
EMAIL = r"[\w.+-]+@[\w-]+\.[\w.-]+"
PHONE = r"0\d{1,4}-\d{1,4}-\d{3,4}|\b0[5789]0\d{8}\b"
PHONE_LOOSE = PHONE + r"|\b0\d{9}\b"
CARD = r"(?i)(?:\d[ -]?){12,19}|\*{2,}\d{2,4}|x{2,}\d{2,4}"
LONG_DIGITS = r"\d{7,}"
DATES = r"\d{1,2}/\d{1,2}|\d{1,2}月\d{1,2}日|20\d{6}|\d{2}\.\d{1,2}\.\d{1,2}"
AMOUNT_BANDS = [
    (1_000, "〜1千円"), (5_000, "1千〜5千円"), (10_000, "5千〜1万円"), (50_000, "1万〜5万円"),
    (100_000, "5万〜10万円"), (500_000, "10万〜50万円"), (1_000_000, "50万〜100万円"),
]
AMOUNT_TOP, AMOUNT_NONE = "100万円以上", "不明"
REASON_WORDS = [
    ("情報不足", ("不足", "不明", "判断できない", "特定できない", "判別できない", "情報が少な")),
    ("過去履歴を根拠", ("過去", "履歴", "これまで", "一貫", "従来", "前回")),
    ("類似取引を根拠", ("類似", "似た", "同様", "近い", "同種")),
    ("金額/入出金方向を根拠", ("金額", "入金", "出金", "少額", "高額")),
    ("contentの意味から判断", ("摘要", "内容", "名称", "サービス", "店", "利用", "手数料", "から判断", "と考え", "と推定")),
]
REASON_NONE = "その他"
# End of fixed values.

#: Reason keywords of this engine's own reports: (category, keywords), several may hold.
REASONS = [
    ("insufficient", ("unknown", "unclear", "cannot")),
    ("history", ("history", "past", "before", "always")),
    ("similarity", ("similar", "alike", "close to")),
    ("amount", ("amount", "income", "expense")),
    ("meaning", ("name", "service", "content", "fee")),
]


def rate(a: Column, b: Column) -> Column:
    """a / b to four places; null where b is 0."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), 4)


def _nfkc_casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x).casefold(), na_action="ignore")


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc_casefold(c: Column) -> Column:
    """NFKC and case folding, which Spark has no function for; one Arrow batch at a time."""
    return F.pandas_udf(_nfkc_casefold, "string")(c)


def nfkc(c: Column) -> Column:
    return F.pandas_udf(_nfkc, "string")(c)


def _squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    """Without white space, in Unicode's sense, at either end."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def normalize(c: Column, level: str = "n4", ascii_only: bool = False) -> Column:
    """raw, n1 (folded, single blanks), n2 (symbols to blanks), n3 (no blanks), n4 (6 and more digits to #), n5 (dates and 4 digits to #).

    ascii_only folds by lower() and needs no Python; it is exact for ASCII text.
    """
    if level == "raw":
        return strip(c)
    n1 = _squeeze(F.lower(c) if ascii_only else nfkc_casefold(c))
    if level == "n1":
        return n1
    if level == "n5":
        masked = F.regexp_replace(F.regexp_replace(n1, "(?U)" + DATES, "#"), r"(?U)\d{4,}", "#")
        return F.regexp_replace(F.regexp_replace(masked, r"(?U)[^\w\sー#]", " "), r"(?U)\s+", "")
    n2 = _squeeze(F.regexp_replace(n1, r"(?U)[^\w\sー]", " "))
    if level == "n2":
        return n2
    n3 = F.regexp_replace(n2, r"(?U)\s+", "")
    return n3 if level == "n3" else F.regexp_replace(n3, r"(?U)\d{6,}", "#")


def merchant_key(c: Column, noise: tuple[str, ...] = (), ascii_only: bool = False) -> Column:
    """n4 of the text without the given noise patterns, which see it after NFKC."""
    t = c if ascii_only else nfkc(c)
    for pattern in noise:
        t = F.regexp_replace(t, pattern, "")
    return normalize(t, "n4", ascii_only)


def is_truncated(c: Column, marker: str, ascii_only: bool = False) -> Column:
    """Whether the text, after NFKC, matches a pattern that tells that its name was cut off."""
    t = F.coalesce(c, F.lit(""))
    return (t if ascii_only else nfkc(t)).rlike(marker)


def percent(c: Column, none: str = "-") -> Column:
    """A share as per cent text with one place."""
    return F.coalesce(F.concat(F.format_number(c * 100, 1), F.lit("%")), F.lit(none))


def sanitize(c: Column) -> Column:
    """E-mails, phones, card-like numbers and 7 or more digits masked, in this order; null gives ''."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)" + EMAIL, "<EMAIL>")
    t = F.regexp_replace(t, "(?U)" + PHONE, "<PHONE>")
    t = F.regexp_replace(t, "(?U)" + CARD, "<NUM>")
    return strip(F.regexp_replace(t, "(?U)" + LONG_DIGITS, "<NUM>"))


def amount_band(v: Column, bands=AMOUNT_BANDS, top: str = AMOUNT_TOP, none: str = AMOUNT_NONE) -> Column:
    out = F.when(v.isNull(), none)
    for upper, label in bands:
        out = out.when(F.abs(v) < upper, label)
    return out.otherwise(top)


def band(v: Column, edges: list[tuple[float, str]], low: str, none: str | None = None) -> Column:
    """The label of the highest edge that v reaches."""
    out = F.when(v.isNull(), none)
    for edge, label in sorted(edges, reverse=True):
        out = out.when(v >= edge, label)
    return out.otherwise(low)


CONFIDENCE = [(0.95, "0.95-1.00"), (0.90, "0.90-0.95"), (0.80, "0.80-0.90"), (0.70, "0.70-0.80"), (0.50, "0.50-0.70")]


def confidence_band(v: Column) -> Column:
    return band(v, CONFIDENCE, "<0.50", "none")


SCORE_BANDS = [(95, "95-99"), (90, "90-94"), (85, "85-89"), (80, "80-84"), (70, "70-79")]
USE_BANDS = [(10, "10+"), (5, "5-9"), (3, "3-4"), (2, "2")]
AGREEMENT_BANDS = [(1.0, "100%"), (0.8, "80-99%")]
SHARE_BANDS = [(1.0, "100%"), (0.9, "90-99%"), (0.7, "70-89%"), (0.5, "50-69%")]
COUNT_BANDS = [(10, "10+"), (5, "5-9"), (2, "2-4")]


def stage_band(stage: Column, score: Column) -> Column:
    """The stage of an exact prediction, the score's band of a fuzzy one."""
    return F.when(stage.isin("raw_exact", "norm_exact"), stage).otherwise(F.concat(F.lit("fuzzy "), band(score, SCORE_BANDS, "<70", "none")))


def use_band(n: Column) -> Column:
    return band(n, USE_BANDS, "1")


def agreement_band(v: Column) -> Column:
    return band(v, AGREEMENT_BANDS, "<80%")


def share_band(v: Column) -> Column:
    return band(v, SHARE_BANDS, "<50%")


def count_band(n: Column) -> Column:
    return band(n, COUNT_BANDS, "1")


def age_band(days: Column) -> Column:
    """Days since the last use: up to a month, a quarter, a year, and more."""
    return F.when(days.isNull(), None).when(days <= 31, "<=31").when(days <= 90, "32-90").when(days <= 365, "91-365").otherwise(">365")


def leak_counts(c: Column) -> dict[str, Column]:
    """Per kind, how often an outbound text still holds what masking should have removed."""
    return {n: F.regexp_count(F.coalesce(c, F.lit("")), F.lit("(?U)" + p)) for n, p in (("email", EMAIL), ("phone", PHONE), ("digits", LONG_DIGITS))}


def estimate_tokens(c: Column) -> Column:
    """3.5 ASCII characters or one other character a token, rounded down, and one more."""
    ascii_ = F.length(F.regexp_replace(c, r"[^\x00-\x7F]", ""))
    return (F.floor(ascii_ / F.lit(3.5) + (F.length(c) - ascii_)) + 1).cast("long")


def reason_categories(c: Column, reasons=REASONS, default: str = "other") -> Column:
    """array<string> of the categories whose keywords the text holds, the default if none."""
    text = F.lower(F.coalesce(c, F.lit("")))
    hits = [F.when(F.greatest(*(F.contains(text, F.lit(k)) for k in words)), F.lit(name)) for name, words in reasons]
    found = F.array_compact(F.array(*hits))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def reason_categories_fixed(c: Column) -> Column:
    """reason_categories by the fixed words of reasons in Japanese."""
    return reason_categories(c, REASON_WORDS, REASON_NONE)


def value_range(low: Column, high: Column) -> Column:
    """'' if there are no values, the value if all are equal, else low-high."""
    return F.when(low.isNull(), "").when(low == high, low.cast("string")).otherwise(F.concat(low.cast("string"), F.lit("-"), high.cast("string")))


def indel_ratio(a: Column, b: Column) -> Column:
    """200 x longest common subsequence / total length, without Python; 100 for two empty texts."""
    step = lambda prev, ch: F.aggregate(
        F.sequence(F.lit(1), F.length(a)), F.array(F.lit(0)),
        lambda cur, i: F.array_append(cur, F.when(F.substring(a, i, F.lit(1)) == ch, F.element_at(prev, i) + 1).otherwise(F.greatest(F.element_at(prev, i + 1), F.element_at(cur, -1)))),
    )
    lcs = F.aggregate(F.split(b, ""), F.array_repeat(F.lit(0), F.length(a) + 1), step, lambda acc: F.element_at(acc, -1))
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 100.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(200.0 * lcs / both)


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel length of the longest common subsequence."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        match = where.get(ch, 0)
        row = ((row + (row & match)) | (row & ~match)) & full if match else row
    return len(a) - row.bit_count()


def _indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = zip(a, b, strict=True)
    return pd.Series([None if x is None or y is None else 100.0 if not x and not y else 200.0 * lcs_length(x, y) / (len(x) + len(y)) for x, y in pairs], dtype="float64")


def indel_ratio_arrow(a: Column, b: Column) -> Column:
    """indel_ratio for many pairs: one Arrow batch, bit-parallel."""
    return F.pandas_udf(_indel_ratio, "double")(a, b)


def _ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs_length(a, b) / (len(a) + len(b))


def _token_ratio(a: str, b: str, of) -> float:
    """The best of sorted words, and of what is common to both sets of words with the rest of either."""
    x, y = set(a.split()), set(b.split())
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    best = of(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    if both:
        if not left or not right:
            return 100.0
        one, other = f"{both} {left}", f"{both} {right}"
        best = max(best, of(one, other), of(both, one), of(both, other))
    return best


def weighted_ratio(a: str, b: str) -> float:
    """A blend of whole, partial and word-wise ratios: word orders count 0.95, and texts of unlike lengths (half as long again and
    more) are compared in parts, at 0.9, or 0.6 if one is more than eight times as long."""
    if not a or not b:
        return 0.0
    from .block_similarity import partial_ratio

    best, unlike = _ratio(a, b), max(len(a), len(b)) / min(len(a), len(b))
    if unlike < 1.5:
        return max(best, 0.95 * _token_ratio(a, b, _ratio))
    scale = 0.9 if unlike <= 8 else 0.6
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * _token_ratio(a, b, partial_ratio))


def _weighted_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else weighted_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def weighted_ratio_arrow(a: Column, b: Column) -> Column:
    """weighted_ratio, one Arrow batch at a time; for comparison with indel_ratio only."""
    return F.pandas_udf(_weighted_ratios, "double")(a, b)
