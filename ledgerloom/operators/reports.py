"""The tables that the analysis steps print: counts and rates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import band, count_band, rate, share_band
from .quality import with_total


def bank_methods(rows: DataFrame) -> DataFrame:
    """By fiscal year and in total: rows, one column a way in which the bank side was found, and rows whose net is the amount.

    rows: (fiscal_year, method, amount_match).
    """
    ways = ("fy_sub_account_map", "fy_service_map", "journal_amount", "current_master", "unresolved")
    return with_total(rows, "fiscal_year", F.count("*").alias("n"), *(F.count_if(F.col("method") == w).alias(w) for w in ways), F.count_if("amount_match").alias("amount_match"))


def map_differences(inferred: DataFrame, master: DataFrame, least: int = 3) -> DataFrame:
    """One row (maps, differ): inferred keys (fiscal_year, connected_sub_account_id, account, sub, support) of enough support, and how
    many of them the current master (connected_sub_account_id, account, sub) has otherwise."""
    m = master.select("connected_sub_account_id", F.col("account").alias("_a"), F.col("sub").alias("_s"))
    i = inferred.where((F.col("support") >= least) & F.col("account").isNotNull()).join(m, "connected_sub_account_id", "left")
    same = F.col("account").eqNullSafe(F.col("_a")) & F.col("sub").eqNullSafe(F.col("_s"))
    return i.agg(F.count("*").alias("maps"), F.count_if(~same).alias("differ"))


def label_report(rows: DataFrame) -> DataFrame:
    """By number of counter accounts: labelled rows and those with a negative one; rows: (label, counter_count, has_negative)."""
    return rows.where("label is not null").groupBy("counter_count").agg(F.count("*").alias("n"), F.count_if("has_negative").alias("negative"))


def content_report(stats: DataFrame) -> DataFrame:
    """(field, value, contents, rows): contents by how often they occur, by the share of their top label, and by its being the
    latest one; stats as history.content_stats gives them. Shares and latest labels of contents that occur once say nothing."""
    several = F.col("count") > 1
    one = F.explode(F.array(
        F.struct(F.lit("count").alias("field"), count_band(F.col("count")).alias("value")), F.struct(F.lit("top share").alias("field"), F.when(several, share_band(F.col("top_ratio"))).alias("value")),
        F.struct(F.lit("labels").alias("field"), F.when(several, F.when(F.col("distinct_labels") > 1, "several").otherwise("one")).alias("value")),
        F.struct(F.lit("latest is top").alias("field"), F.when(several, (F.col("latest_label") == F.col("top_label")).cast("string")).alias("value")),
    ))
    return stats.select("count", one.alias("_f")).where("_f.value is not null").groupBy("_f.field", "_f.value").agg(F.count("*").alias("contents"), F.sum("count").alias("rows"))


def year_report(years: DataFrame) -> DataFrame:
    """By number of years a repeated content occurs in: contents, and those whose top label changes between years; years as
    history.content_years gives them."""
    return years.where("count > 1").groupBy("years").agg(F.count("*").alias("contents"), F.count_if("fy_label_change").alias("changed"))


def bucket_accuracy(preds: DataFrame, bucket: Column, order: list[str]) -> DataFrame:
    """(place, bucket, n, accuracy) of predictions by a bucket, in the given order; buckets without rows are left out."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("bucket"))
    g = preds.where("stage <> 'none'").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.count_if("correct").alias("_ok"))
    return g.select(place.alias("place"), "bucket", "n", rate(F.col("_ok"), F.col("n")).alias("accuracy")).where("place > 0")


def combination_accuracy(preds: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n, share, accuracy) of the predictions that a condition holds for; share of all rows, predicted or not."""
    one = F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.coalesce(c & (F.col("stage") != "none"), F.lit(False)).alias("hit")) for k, c in rules.items())))
    g = preds.select("correct", one.alias("_r")).groupBy("_r.rule").agg(F.count("*").alias("_all"), F.count_if("_r.hit").alias("n"), F.count_if(F.col("_r.hit") & F.col("correct")).alias("_ok"))
    return g.select("rule", "n", rate(F.col("n"), F.col("_all")).alias("share"), rate(F.col("_ok"), F.col("n")).alias("accuracy"))


def best_normalizer(scored: dict[str, DataFrame], years: list[int]) -> DataFrame:
    """One row (normalizer, correct) of the normalizer with the most right predictions in the years; ties to the first given.

    scored: predictions (fy, stage, correct) by normalizer, after their threshold.
    """
    each = None
    for i, (name, preds) in enumerate(scored.items()):
        one = preds.where(F.col("fy").isin(*years) & (F.col("stage") != "none")).agg(F.count_if("correct").alias("correct")).select(F.lit(name).alias("normalizer"), "correct", F.lit(-i).alias("_place"))
        each = one if each is None else each.unionByName(one)
    return each.agg(F.max(F.struct("correct", "_place", "normalizer")).alias("_b")).select("_b.normalizer", "_b.correct")


def select_rules(grid: DataFrame, years: tuple[int, int], accuracy: float = 0.98, least: int = 20, top: int = 6) -> DataFrame:
    """The rules that reach an accuracy on enough rows in both years, widest coverage of the two first: a top-k report.

    grid: (rule, fy, n, coverage, accuracy); ties go to the smaller rule.
    """
    ok = grid.where(F.col("fy").isin(*years) & (F.col("accuracy") >= accuracy) & (F.col("n") >= least))
    both = ok.groupBy("rule").agg(F.count_distinct("fy").alias("_years"), F.round(F.sum("coverage"), 6).alias("coverage")).where("_years = 2")
    return both.orderBy(F.desc("coverage"), "rule").limit(top).select("rule", "coverage")


def best_coverage(grid: DataFrame, year: int, floors: list[float], least: int = 20) -> DataFrame:
    """By accuracy floor, the rule of the widest coverage in a year that reaches it on enough rows; ties to the smaller rule."""
    g = grid.where((F.col("fy") == year) & (F.col("n") >= least)).withColumn("floor", F.explode(F.array(*map(F.lit, floors)))).where("accuracy >= floor")
    return g.groupBy("floor").agg(F.min(F.struct((-F.col("coverage")).alias("m"), "rule", "n", "accuracy")).alias("_b")).select("floor", "_b.rule", (-F.col("_b.m")).alias("coverage"), "_b.n", "_b.accuracy")


def link_report(tx: DataFrame, journals: DataFrame) -> DataFrame:
    """By status: line items, and those that a journal links to. tx: (transaction_id, status); journals: (transaction_id)."""
    linked = journals.where("transaction_id is not null").select("transaction_id").distinct().withColumn("_linked", F.lit(True))
    t = tx.join(linked, "transaction_id", "left")
    return t.groupBy(F.coalesce(F.col("status").cast("string"), F.lit("None")).alias("status")).agg(F.count("*").alias("n"), F.count_if("_linked").alias("linked"))


def answer_report(items: DataFrame) -> DataFrame:
    """(field, value, n, model_right, rule_right, mean_confidence, needs_review, insufficient) of answered items by layer, complexity,
    confidence band and flags, and over all. items: (layer, complex, conf, needs_review, insufficient, model_ok, rule_ok)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    yes = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    sure = band(F.col("conf"), [(0.9, "0.90+"), (0.8, "0.80-0.89"), (0.7, "0.70-0.79")], "<0.70", "None")
    fields = {"all": F.lit("all"), "layer": text("layer"), "complex": text("complex"), "confidence": sure, "needs_review": text("needs_review"), "insufficient": text("insufficient")}
    one = F.explode(F.array(*(F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in fields.items())))
    g = items.select("conf", "needs_review", "insufficient", "model_ok", "rule_ok", one.alias("_f")).groupBy("_f.field", "_f.value")
    return g.agg(F.count("*").alias("n"), yes("model_ok").alias("model_right"), yes("rule_ok").alias("rule_right"), F.round(F.avg("conf"), 4).alias("mean_confidence"), yes("needs_review").alias("needs_review"), yes("insufficient").alias("insufficient"))


def rule_against_model(items: DataFrame) -> DataFrame:
    """(layer, both, model_only, rule_only, neither), and a row for all layers."""
    ok, rule = (F.coalesce(c, F.lit(False)) for c in (F.col("model_ok"), F.col("rule_ok")))
    cells = (F.count_if(ok & rule).alias("both"), F.count_if(ok & ~rule).alias("model_only"), F.count_if(~ok & rule).alias("rule_only"), F.count_if(~ok & ~rule).alias("neither"))
    return with_total(items, "layer", *cells)
