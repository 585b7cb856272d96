"""Scoring predictors of a label against what was known before."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import rate
from .history import FY_WEIGHTS, before, tail_mode, usable

#: Rules of a grid; they are sent to every task.
MOST_RULES = 10_000
#: Agreement thresholds of the unanimous-history report.
UNANIMOUS = (10, 5, 3, 2, 1)


def predictors(with_history: DataFrame) -> dict:
    """Column by predictor name; null where there is no history."""
    change = lambda k: F.when((F.col("run") >= k) & F.col("previous").isNotNull(), F.col("last_label")).otherwise(F.col("mode"))
    out = {"mode": F.col("mode"), "last": F.col("last_label"), "mode_of_3": tail_mode(F.col("tail"), 3), "mode_of_5": tail_mode(F.col("tail"), 5)}
    return out | {w: F.col(w) for w in FY_WEIGHTS} | {"change_2": change(2), "change_3": change(3)}


def compare_methods(obs: DataFrame, years: list[int], block: str = "day") -> DataFrame:
    """By target year and predictor: test, covered, coverage, accuracy, and accuracy on simple and complex rows."""
    h = before(usable(obs), block, years)
    p = predictors(h)
    long = h.select("fy", "label", "complex", F.explode(F.array(*(F.struct(F.lit(k).alias("predictor"), v.alias("pred")) for k, v in p.items()))).alias("_p"))
    ok, got = F.col("_p.pred") == F.col("label"), F.col("_p.pred").isNotNull()
    out = long.groupBy("fy", "_p.predictor").agg(
        F.count("*").alias("test"), F.count_if(got).alias("covered"), F.count_if(ok).alias("correct"), F.count_if(got & ~F.col("complex")).alias("simple_n"),
        F.count_if(ok & ~F.col("complex")).alias("simple_ok"), F.count_if(got & F.col("complex")).alias("complex_n"), F.count_if(ok & F.col("complex")).alias("complex_ok"),
    )
    return out.select(
        "fy", "predictor", "test", "covered", rate(F.col("covered"), F.col("test")).alias("coverage"), rate(F.col("correct"), F.col("covered")).alias("accuracy"),
        "simple_n", rate(F.col("simple_ok"), F.col("simple_n")).alias("simple_accuracy"), "complex_n", rate(F.col("complex_ok"), F.col("complex_n")).alias("complex_accuracy"),
    )


def rule_grid() -> list[tuple]:
    """Distinct (last_k, min_total, recency, simple_only, unanimous): recency is the most years back, -1 for any."""
    grid = product((2, 3, 4, 5, 7, 10), (0, 5, 10), (-1, 2, 1), (False, True), (False, True))
    return sorted({(k, max(k, extra), gap, simple, same) for k, extra, gap, simple, same in grid})


def evaluate_rules(obs: DataFrame, block: str = "day", rules: list[tuple] | None = None) -> DataFrame:
    """By target year and rule: n, coverage, accuracy, correct, test.

    A rule looks at few facts of a history (total, last run, years back, distance to a complex one), each only up to its
    largest threshold: rows are first counted by those facts, and the rules meet the counts.
    """
    rules = rules or rule_grid()
    h = before(usable(obs), block)
    cap = max(max(r[0], r[1]) for r in rules)
    upto = lambda c, most: F.when(c.isNotNull(), F.least(c, F.lit(most)))  # noqa: E731  least() alone would skip nulls
    facts = h.select(
        "fy", upto(F.col("n"), cap).alias("n"), upto(F.col("run"), cap).alias("run"), (F.col("run") == F.col("n")).alias("same"),
        upto(F.col("since_complex"), cap).alias("plain"), upto(F.col("fy") - F.col("last_fy"), 3).alias("gap"), (F.col("last_label") == F.col("label")).alias("ok"),
    )
    counts = facts.groupBy("fy", "n", "run", "same", "plain", "gap").agg(F.count("*").alias("rows"), F.count_if("ok").alias("ok"))
    spark = obs.sparkSession
    rows = ", ".join(f"({i}, {k}, {t}, {g}, {str(s).lower()}, {str(u).lower()})" for i, (k, t, g, s, u) in enumerate(rules))
    r = spark.sql(f"SELECT * FROM VALUES {rows} AS r(rule, last_k, min_total, recency, simple_only, unanimous)")
    hit = (F.col("n") >= F.col("min_total")) & (F.col("run") >= F.col("last_k")) & (~F.col("unanimous") | F.col("same")) & (~F.col("simple_only") | (F.col("plain") >= F.col("last_k"))) & ((F.col("recency") < 0) | (F.col("gap") <= F.col("recency")))
    hit = F.coalesce(hit, F.lit(False))
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules are compared at a time")
    both = counts.join(F.broadcast(r), F.lit(True))  # rules are literals, checked above
    out = both.groupBy("fy", "rule", "last_k", "min_total", "recency", "simple_only", "unanimous").agg(
        F.sum("rows").alias("test"), F.sum(F.when(hit, F.col("rows")).otherwise(0)).alias("n"), F.sum(F.when(hit, F.col("ok")).otherwise(0)).alias("correct")
    )
    return out.withColumn("coverage", rate(F.col("n"), F.col("test"))).withColumn("accuracy", rate(F.col("correct"), F.col("n")))


def structure_shift(obs: DataFrame) -> DataFrame:
    """By target year, past structure (simple, complex, mixed) and present one: rows and distinct contents."""
    h = before(usable(obs), "fy").where("n is not null")
    past = F.when(~F.col("any_complex"), "simple").when(F.col("all_complex"), "complex").otherwise("mixed")
    h = h.select("fy", "content", past.alias("past"), F.when(F.col("complex"), "complex").otherwise("simple").alias("now"))
    return h.groupBy("fy", "past", "now").agg(F.count("*").alias("rows"), F.countDistinct("content").alias("contents"))


def year_backtest(obs: DataFrame) -> DataFrame:
    """By target year over earlier years: test, covered, mode and latest correct; the mode's ties go to the label used first."""
    u = usable(obs)
    return _first_modes(u).groupBy("fy").agg(
        F.count("*").alias("test"), F.count("pred").alias("covered"), F.count_if(F.col("pred") == F.col("label")).alias("mode_correct"),
        F.count_if(F.col("last_label") == F.col("label")).alias("latest_correct"), rate(F.count("pred"), F.count("*")).alias("coverage"),
    )


def _first_modes(u: DataFrame) -> DataFrame:
    from .history import label_counts_before, snapshots_before

    firsts = u.groupBy("content", "label").agg(F.min(F.struct("day", "id")).alias("first"))
    c = label_counts_before(u, "fy").join(firsts, ["content", "label"])
    best = c.groupBy("content", "block").agg(F.min(F.struct((-F.col("n")).alias("m"), "first", "label")).alias("_b"), F.sum("n").alias("total"))
    best = best.select("content", "block", F.col("_b.label").alias("pred"), (-F.col("_b.m")).alias("pred_n"), "total")
    last = snapshots_before(u, "fy").select("content", "block", "last_label")
    return u.withColumn("block", F.col("fy").cast("long")).join(best, ["content", "block"], "left").join(last, ["content", "block"], "left")


def unanimous_backtest(obs: DataFrame, thresholds: tuple = UNANIMOUS) -> DataFrame:
    """By target year and threshold: rows whose past is unanimous with that many observations, and how many it predicts."""
    m = _first_modes(usable(obs))
    at = m.withColumn("threshold", F.explode(F.array(*(F.lit(t) for t in thresholds))))
    hit = F.coalesce((F.col("pred_n") == F.col("total")) & (F.col("total") >= F.col("threshold")), F.lit(False))
    out = at.groupBy("fy", "threshold").agg(F.count("*").alias("test"), F.count_if(hit).alias("n"), F.count_if(hit & (F.col("pred") == F.col("label"))).alias("ok"))
    return out.select("fy", "threshold", "n", rate(F.col("n"), F.col("test")).alias("share_of_test"), rate(F.col("ok"), F.col("n")).alias("accuracy"))


def unanimous_compound(obs: DataFrame) -> DataFrame:
    """By target year: rows whose past is unanimous in a compound label (several accounts, joined by "|"), and its accuracy."""
    m = _first_modes(usable(obs))
    hit = F.coalesce((F.col("pred_n") == F.col("total")) & F.contains(F.col("pred"), F.lit("|")), F.lit(False))
    out = m.groupBy("fy").agg(F.count_if("complex").alias("test_complex"), F.count_if(hit).alias("n"), F.count_if(hit & (F.col("pred") == F.col("label"))).alias("_ok"))
    return out.select("fy", "test_complex", "n", rate(F.col("_ok"), F.col("n")).alias("accuracy"))
