"""Who decides a line item: the rules, the scoring model or a person; and how well that went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import amount_band, rate
from . import history as H
from .similarity import FUZZY_FLOOR

# Categories by letter and the least confidence of each plan.
CATEGORIES = {"A": "A_候補なし", "B": "B_fuzzy候補のみ", "C": "C_科目が割れている", "D": "D_365日以上未使用", "E": "E_exact過去1〜2回"}
PLANS = {"Aggressive": 0.80, "Balanced": 0.90, "Conservative": 0.95}
MODEL_LAYERS = ("A", "B", "C", "C+D", "D")
# End of fixed values.


def history_features(obs: DataFrame) -> DataFrame:
    """As-of features of each observation's content; only hist_n and the band without a history."""
    o = H.usable(obs)
    h = H.snapshots_before(o).join(H.year_modes_before(o), ["content", "block"], "left")
    t = obs.withColumn("block", F.unix_date("day")).join(h, ["content", "block"], "left")
    band = amount_band(F.col("value"))
    sides = {"side_seen": F.col("side")} if "side" in obs.columns else {}
    t = H.seen_before(t, o, {"band_seen": band, "account_seen": F.col("account")} | sides)
    known = lambda c: F.when(F.col("n").isNotNull(), F.col(c)).alias(c)
    tail = lambda k: F.when(F.col("n") >= k, F.col("run") >= k).alias(f"tail{k}_same")
    return t.select(
        *obs.columns, F.coalesce("n", F.lit(0)).alias("hist_n"), band.alias("tx_band"), F.datediff("day", "last_day").alias("days_since_last"),
        F.datediff("last_day", "first_day").alias("hist_span_days"), "distinct_labels", "last_label", tail(2), tail(3), tail(5),
        known("band_seen"), (band == F.col("last_band")).alias("band_same_as_last"), known("account_seen"), (F.col("account") == F.col("last_account")).alias("account_same_as_last"),
        F.col("any_complex").alias("past_complex"), *map(known, sides), "fy_label_change", F.col("fy_count").alias("hist_fy_count"),
    )


def accounts_seen(obs: DataFrame) -> DataFrame:
    """(id, account_seen) as history_features tells it, null without a history, from the first days of contents and accounts alone."""
    o = H.usable(obs)
    first = o.groupBy("content").agg(F.min(F.unix_date("day")).alias("_first"))
    t = H.seen_before(obs.withColumn("block", F.unix_date("day")), o, {"account_seen": F.col("account")}).join(first, "content", "left")
    return t.select("id", F.when(F.col("_first") < F.col("block"), F.col("account_seen")).alias("account_seen"))


def classify(preds: DataFrame) -> DataFrame:
    """Adds high_confidence, model_target, categories (array) and layer (their letters) to staged predictions."""
    exact = F.col("stage").isin("raw_exact", "norm_exact")
    high = exact & (F.col("hist_n") >= 3) & (F.col("agreement") == 1) & (F.col("days_since_last") <= 365)
    fuzzy = (F.col("stage") == "fuzzy") & (F.col("score") >= FUZZY_FLOOR)
    letters = F.array_compact(F.array(
        F.when(~exact & fuzzy, "B").when(~exact, "A"), F.when(exact & (F.col("agreement") < 1), "C"), F.when(exact & (F.col("days_since_last") > 365), "D"),
    ))
    target = (F.size(letters) > 0) & ~high
    letters = F.when((F.size(letters) == 0) & ~high, F.array(F.lit("E"))).otherwise(letters)
    names = F.create_map(*(F.lit(x) for kv in CATEGORIES.items() for x in kv))
    layer = F.when(F.size(letters) == 0, "H").otherwise(F.array_join(letters, "+"))
    return preds.withColumns({"high_confidence": high, "model_target": target, "categories": F.transform(letters, lambda x: names[x]), "layer": layer})


def gate(conf: Column, needs_review: Column, insufficient: Column, account: Column, layer: Column, least: float = 0.90) -> Column:
    """model if the layer may be automatic, there is an account, enough confidence and both flags are false, not null."""
    ok = layer.isin(*MODEL_LAYERS) & account.isNotNull() & (conf >= least) & (needs_review == F.lit(False)) & (insufficient == F.lit(False))
    return F.when(F.coalesce(ok, F.lit(False)), "model").otherwise("human")


def plan(least: Column) -> Column:
    """rule, model or human, from what is known at run time. A missing account_seen passes the model's branch only."""
    unsure = F.col("model_label").isNull() | (F.col("conf") < least) | ~F.col("needs_review").eqNullSafe(F.lit(False))
    against = F.col("rule_valid") & ~F.col("agree")
    return (
        F.when(F.col("high_confidence"), F.when(F.coalesce("account_seen", F.lit(False)), "rule").otherwise("human"))
        .when(unsure | against | F.col("account_seen").eqNullSafe(F.lit(False)), "human").otherwise("model")
    )


def route(items: DataFrame, plans: dict[str, float] | None = None) -> DataFrame:
    """By plan: n, auto, coverage, accuracy, errors and how many each decides; items need rule_ok and model_ok."""
    at = items.withColumn("_p", F.explode(F.array(*(F.struct(F.lit(n).alias("plan"), F.lit(v).alias("least")) for n, v in (plans or PLANS).items()))))
    at = at.withColumn("by", plan(F.col("_p.least")))
    auto = F.col("by") != "human"
    ok = ((F.col("by") == "rule") & F.col("rule_ok")) | ((F.col("by") == "model") & F.col("model_ok"))
    g = at.groupBy("_p.plan").agg(F.count("*").alias("n"), F.count_if(auto).alias("auto"), F.count_if(ok).alias("ok"), F.count_if(F.col("by") == "rule").alias("rule"), F.count_if(F.col("by") == "model").alias("model"), F.count_if(F.col("by") == "human").alias("human"))
    return g.select("plan", "n", "auto", rate(F.col("auto"), F.col("n")).alias("coverage"), rate(F.col("ok"), F.col("auto")).alias("accuracy"), (F.col("auto") - F.col("ok")).alias("errors"), "rule", "model", "human")


def calibration(items: DataFrame, edges: list[float]) -> DataFrame:
    """By least confidence: how many answers reach it and how many of them are right."""
    at = items.where("model_label is not null").withColumn("least", F.explode(F.array(*(F.lit(e) for e in edges))))
    hit = F.col("conf") >= F.col("least")
    return at.groupBy("least").agg(F.count_if(hit).alias("n"), rate(F.count_if(hit), F.count("*")).alias("share"), rate(F.count_if(hit & F.col("model_ok")), F.count_if(hit)).alias("accuracy"))


def stratified_sample(df: DataFrame, strata: list[str], n: int, key: Column) -> DataFrame:
    """n rows, in turn from each stratum, within a stratum by `key` (a hash of the id and a seed); fewer if there are fewer."""
    from pyspark.sql import Window as W

    ranked = df.withColumn("_k", key).withColumn("_r", F.row_number().over(W.partitionBy(*strata).orderBy("_k")))
    return ranked.where(F.col("_r") <= n).orderBy("_r", *strata).limit(n).drop("_k", "_r")


def compare_models(items: DataFrame) -> DataFrame:
    """One row a (a_right, b_right, same) with n; items: (a, b, label), the choices of two models and the answer. A choice that is
    missing is not right and not the same as anything."""
    right = lambda c: F.coalesce(F.col(c) == F.col("label"), F.lit(False))
    return items.groupBy(right("a").alias("a_right"), right("b").alias("b_right"), F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("same")).agg(F.count("*").alias("n"))


def join_answers(a: DataFrame, b: DataFrame, answers: DataFrame, key: str = "transaction_id") -> DataFrame:
    """(key, a, a_confidence, b, b_confidence, label) of the items that both models and the answers have; a, b: (key, choice, confidence)."""
    left = a.select(key, F.col("choice").alias("a"), F.col("confidence").alias("a_confidence"))
    right = b.select(key, F.col("choice").alias("b"), F.col("confidence").alias("b_confidence"))
    return left.join(right, key).join(answers.select(key, "label"), key)


def ensembles(items: DataFrame, least: float = 0.7) -> DataFrame:
    """By ensemble (both agree, only a, only b): n, coverage and accuracy at a least confidence; items as join_answers gives them."""
    sure = lambda c: F.coalesce(F.col(f"{c}_confidence") >= least, F.lit(False))
    right = lambda c: F.coalesce(F.col(c) == F.col("label"), F.lit(False))
    parts = {"both": (sure("a") & sure("b") & F.coalesce(F.col("a") == F.col("b"), F.lit(False)), right("a")), "a": (sure("a"), right("a")), "b": (sure("b"), right("b"))}
    one = F.explode(F.array(*(F.struct(F.lit(k).alias("ensemble"), took.alias("took"), (took & ok).alias("ok")) for k, (took, ok) in parts.items())))
    g = items.select(one.alias("_e")).groupBy("_e.ensemble").agg(F.count("*").alias("_all"), F.count_if("_e.took").alias("n"), F.count_if("_e.ok").alias("_ok"))
    return g.select("ensemble", "n", rate(F.col("n"), F.col("_all")).alias("coverage"), rate(F.col("_ok"), F.col("n")).alias("accuracy"))


def category_report(items: DataFrame) -> DataFrame:
    """Accuracy by category, which overlap, and by layer, which don't: (kind, value, n, accuracy); items: categories, layer, ok."""
    by_category = items.select(F.lit("category").alias("kind"), F.explode("categories").alias("value"), "ok")
    both = by_category.unionByName(items.select(F.lit("layer").alias("kind"), F.col("layer").alias("value"), "ok"))
    return both.groupBy("kind", "value").agg(F.count("*").alias("n"), rate(F.count_if("ok"), F.count("*")).alias("accuracy"))


def simulate(items: DataFrame, thresholds: list[float]) -> DataFrame:
    """Automation by threshold and mode: (least, mode, auto, coverage, accuracy, errors).

    items: (high_confidence, rule_ok, model_label, conf, needs_review, agree, model_ok). Modes: model (rules where sure, else the
    model at the threshold), unflagged (and without its review flag), agreed (and only where it agrees with the rules).
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    at = items.withColumn("least", F.explode(F.array(*map(F.lit, thresholds))))
    sure = F.col("model_label").isNotNull() & (F.col("conf") >= F.col("least"))
    modes = {"model": sure, "unflagged": sure & F.col("needs_review").eqNullSafe(F.lit(False)), "agreed": sure & yes("agree")}
    at = at.withColumn("_m", F.explode(F.array(*(F.struct(F.lit(k).alias("mode"), F.coalesce(c, F.lit(False)).alias("took")) for k, c in modes.items()))))
    rule = yes("high_confidence")
    auto = rule | F.col("_m.took")
    ok = F.when(rule, yes("rule_ok")).otherwise(F.col("_m.took") & yes("model_ok"))
    g = at.groupBy("least", "_m.mode").agg(F.count("*").alias("_n"), F.count_if(auto).alias("auto"), F.count_if(ok).alias("_ok"))
    return g.select("least", "mode", "auto", rate(F.col("auto"), F.col("_n")).alias("coverage"), rate(F.col("_ok"), F.col("auto")).alias("accuracy"), (F.col("auto") - F.col("_ok")).alias("errors"))


def build_items(preds: DataFrame, features: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """Predictions (classified, with their label) beside as-of features and model results, judged: model_label, conf,
    needs_review, insufficient, account_seen, rule_valid, rule_ok, model_ok, agree.

    Every prediction stays; without a feature or a result its columns are null. A rule is valid where it predicts and the row
    isn't in the category without candidates.
    """
    no = lambda c: F.coalesce(c, F.lit(False))
    p = preds.join(features.select(key, "account_seen"), key, "left").join(results.select(key, "model_label", "conf", "needs_review", "insufficient"), key, "left")
    p = p.withColumn("high_confidence", no(F.col("high_confidence"))).withColumn("rule_valid", F.col("pred").isNotNull() & ~F.array_contains("categories", CATEGORIES["A"]))
    return p.withColumns({
        "rule_ok": no(F.col("rule_valid") & (F.col("pred") == F.col("label"))), "model_ok": no(F.col("model_label") == F.col("label")),
        "agree": no(F.col("rule_valid") & (F.col("pred") == F.col("model_label"))),
    })
