"""Queries of histories and back-tests over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import rate
from ..operators import backtest as B
from ..operators import history as H
from .adapters import OBS_SQL, obs

Q, SQL = {}, {}
YEARS = [2000, 2001, 2002, 2003, 2004]


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: past: a row a (target, earlier observation), numbered in order; by day or by year block.
def past_sql(cond: str) -> str:
    return f"""{OBS_SQL}, past AS (
  SELECT t.id AS t, t.fy AS tfy, t.label AS actual, t.complex AS tcomplex, t.content, t.day AS tday, h.label, h.fy, h.day, h.complex, h.account, h.value,
    row_number() OVER (PARTITION BY t.id ORDER BY h.day, h.id) AS i, count(*) OVER (PARTITION BY t.id) AS n
  FROM obs t JOIN obs h ON h.content = t.content AND {cond})"""


ROLLING, YEARLY = past_sql("h.day < t.day"), past_sql("h.fy < t.fy")


def mode_sql(name: str, where: str = "true", score: str = "count(*)") -> str:
    return f"{name} AS (SELECT t, label AS pred FROM past WHERE {where} GROUP BY t, label, n QUALIFY row_number() OVER (PARTITION BY t ORDER BY {score} DESC, max(i) DESC) = 1)"


def weight_sql(one, two, three, older) -> str:
    return f"round(sum(CASE greatest(tfy - fy, 1) WHEN 1 THEN {one} WHEN 2 THEN {two} WHEN 3 THEN {three} ELSE {older} END), 6)"


STATE_SQL = """state AS (
  SELECT t, any_value(tfy) AS tfy, any_value(actual) AS actual, any_value(tcomplex) AS tcomplex, any_value(content) AS content, any_value(tday) AS tday, any_value(p.n) AS n,
    any_value(l.last) AS last, any_value(p.n) - coalesce(max(i) FILTER (label <> l.last), 0) AS run, arg_max(label, i) FILTER (label <> l.last) AS previous,
    max(i) FILTER (complex) AS lastc, arg_max(fy, i) AS last_fy, arg_max(day, i) AS last_day, min(day) AS first_day,
    count(DISTINCT label) AS distinct_labels, bool_or(complex) AS any_complex, bool_and(complex) AS all_complex
  FROM past p JOIN (SELECT t AS lt, label AS last FROM past WHERE i = n) l ON t = lt GROUP BY t)"""


@query("q_mode_recency", f"""
WITH {ROLLING}, {mode_sql('m')}
SELECT fy, count(*) AS test, count(pred) AS covered, count(*) FILTER (pred = label) AS correct, round(count(pred) / count(*), 4) AS coverage,
  CASE WHEN count(pred) > 0 THEN round(count(*) FILTER (pred = label) / count(pred), 4) END AS accuracy
FROM obs LEFT JOIN m ON t = id GROUP BY fy""")
def mode_recency(spark, d):
    o = obs(spark, d)
    m = H.modes_before(H.usable(o)).select("content", "block", F.col("mode").alias("pred"))
    t = o.withColumn("block", F.unix_date("day")).join(m, ["content", "block"], "left")
    ok = F.count_if(F.col("pred") == F.col("label"))
    return t.groupBy("fy").agg(F.count("*").alias("test"), F.count("pred").alias("covered"), ok.alias("correct"), rate(F.count("pred"), F.count("*")).alias("coverage"), rate(ok, F.count("pred")).alias("accuracy"))


@query("q_rolling_hist", f"""
WITH {ROLLING}, {mode_sql('m')}, {STATE_SQL}, top AS (SELECT t, max(c) AS c FROM (SELECT t, label, count(*) AS c FROM past GROUP BY ALL) GROUP BY t)
SELECT id, pred, n AS hist_n, round(c / n, 4) AS agreement, date_diff('day', last_day, tday) AS days_since_last, date_diff('day', first_day, last_day) AS span_days
FROM obs LEFT JOIN m ON m.t = id LEFT JOIN state s ON s.t = id LEFT JOIN top ON top.t = id""")
def rolling_hist(spark, d):
    h = H.before(H.usable(obs(spark, d)))
    return h.select("id", F.col("mode").alias("pred"), "hist_n", rate(F.col("mode_n"), F.col("hist_n")).alias("agreement"), F.datediff("day", "last_day").cast("long").alias("days_since_last"), F.datediff("last_day", "first_day").cast("long").alias("span_days"))


@query("q_year_block_pairs", f"WITH {YEARLY}, {mode_sql('m')}, {STATE_SQL} SELECT id, pred, n AS hist_n, last AS last_label FROM obs LEFT JOIN m ON m.t = id LEFT JOIN state s ON s.t = id")
def year_block_pairs(spark, d):
    return H.before(H.usable(obs(spark, d)), "fy").select("id", F.col("mode").alias("pred"), "hist_n", "last_label")


@query("q_last_k_mode", f"WITH {ROLLING}, {mode_sql('a', 'i > n - 3')}, {mode_sql('b', 'i > n - 5')} SELECT id, a.pred AS mode3, b.pred AS mode5 FROM obs LEFT JOIN a ON a.t = id LEFT JOIN b ON b.t = id")
def last_k_mode(spark, d):
    h = H.before(H.usable(obs(spark, d)))
    return h.select("id", H.tail_mode(F.col("tail"), 3).alias("mode3"), H.tail_mode(F.col("tail"), 5).alias("mode5"))


@query("q_fy_weighted", f"""
WITH {ROLLING}, {mode_sql('a', score=weight_sql(1, .7, .5, .3))}, {mode_sql('b', score=weight_sql(1, .5, .25, .1))}
SELECT id, a.pred AS weighted, b.pred AS weighted_steep FROM obs LEFT JOIN a ON a.t = id LEFT JOIN b ON b.t = id""")
def fy_weighted(spark, d):
    return H.before(H.usable(obs(spark, d)), years=YEARS).select("id", "weighted", "weighted_steep")


@query("q_change_detect", f"""
WITH {ROLLING}, {STATE_SQL}
SELECT id, last AS current, previous, CASE WHEN previous IS NOT NULL THEN run END AS since_change, previous IS NOT NULL AND run >= 2 AS change_detected, n AS total
FROM state JOIN obs ON t = id""")
def change_detect(spark, d):
    h = H.before(H.usable(obs(spark, d))).where("n is not null")
    p = F.col("previous").isNotNull()
    return h.select("id", F.col("last_label").alias("current"), "previous", F.when(p, F.col("run")).alias("since_change"), (p & (F.col("run") >= 2)).alias("change_detected"), F.col("n").alias("total"))


@query("q_window_stats", f"""
WITH {ROLLING}, k AS (SELECT unnest([2, 3, 5]) AS k), w AS (SELECT t, tfy, k, label, count(*) AS c, any_value(least(n, k)) AS n FROM past, k WHERE i > n - k GROUP BY t, tfy, k, label)
SELECT tfy AS fy, k, count(*) AS targets, CAST(sum(top) AS BIGINT) AS agreeing, CAST(sum(n) AS BIGINT) AS observations, count(*) FILTER (kinds > 1) AS changed
FROM (SELECT t, tfy, k, max(c) AS top, any_value(n) AS n, count(*) AS kinds FROM w GROUP BY t, tfy, k) GROUP BY tfy, k""")
def window_stats(spark, d):
    h = H.before(H.usable(obs(spark, d))).where("n is not null")
    h = h.withColumn("k", F.explode(F.array(F.lit(2), F.lit(3), F.lit(5))))
    w = F.slice("tail", F.greatest(F.size("tail") - F.col("k") + 1, F.lit(1)), F.col("k"))
    h = h.withColumn("w", w)
    top = F.array_max(F.transform("w", lambda x: F.size(F.filter("w", lambda y: y == x))))
    return h.groupBy("fy", "k").agg(F.count("*").alias("targets"), F.sum(top).alias("agreeing"), F.sum(F.size("w")).alias("observations"), F.count_if(F.size(F.array_distinct("w")) > 1).alias("changed"))


@query("q_tail_same", f"""
WITH {ROLLING}, {STATE_SQL}
SELECT t AS id, CASE WHEN n >= 2 THEN run >= 2 END AS tail2, CASE WHEN n >= 3 THEN run >= 3 END AS tail3, CASE WHEN n >= 5 THEN run >= 5 END AS tail5 FROM state""")
def tail_same(spark, d):
    h = H.before(H.usable(obs(spark, d))).where("n is not null")
    return h.select("id", *(F.when(F.col("n") >= k, F.col("run") >= k).alias(f"tail{k}") for k in (2, 3, 5)))


PREDICTORS_SQL = ", ".join([
    mode_sql("p_mode"), "p_last AS (SELECT t, label AS pred FROM past WHERE i = n)", mode_sql("p_mode_of_3", "i > n - 3"), mode_sql("p_mode_of_5", "i > n - 5"),
    mode_sql("p_weighted", score=weight_sql(1, 0.7, 0.5, 0.3)), mode_sql("p_weighted_steep", score=weight_sql(1, 0.5, 0.25, 0.1)),
    *(f"p_change_{k} AS (SELECT t, CASE WHEN previous IS NOT NULL AND run >= {k} THEN last ELSE pred END AS pred FROM state JOIN p_mode USING (t))" for k in (2, 3)),
])
NAMES = ["mode", "last", "mode_of_3", "mode_of_5", "weighted", "weighted_steep", "change_2", "change_3"]


def compare_sql(past: str) -> str:
    union = " UNION ALL ".join(f"SELECT '{n}' AS predictor, t, pred FROM p_{n}" for n in NAMES)
    r = lambda a, b: f"CASE WHEN {b} > 0 THEN round({a} / {b}, 4) END"
    return f"""WITH {past}, {STATE_SQL}, {PREDICTORS_SQL}, names AS (SELECT unnest({NAMES}) AS predictor), preds AS ({union}),
all_ AS (SELECT fy, predictor, label, complex, pred FROM obs CROSS JOIN names LEFT JOIN preds ON preds.t = obs.id AND preds.predictor = names.predictor),
c AS (SELECT fy, predictor, count(*) AS test, count(pred) AS covered, count(*) FILTER (pred = label) AS ok, count(pred) FILTER (NOT complex) AS simple_n,
  count(*) FILTER (pred = label AND NOT complex) AS simple_ok, count(pred) FILTER (complex) AS complex_n, count(*) FILTER (pred = label AND complex) AS complex_ok FROM all_ GROUP BY ALL)
SELECT fy, predictor, test, covered, {r('covered', 'test')} AS coverage, {r('ok', 'covered')} AS accuracy, simple_n, {r('simple_ok', 'simple_n')} AS simple_accuracy,
  complex_n, {r('complex_ok', 'complex_n')} AS complex_accuracy FROM c""".replace("FROM names", "FROM names").replace("all_ AS (SELECT fy, predictor,", "all_ AS (SELECT fy, names.predictor,")


@query("q_compare_methods", compare_sql(ROLLING))
def compare_methods(spark, d):
    return B.compare_methods(obs(spark, d), YEARS)


@query("q_compare_methods_year", compare_sql(YEARLY))
def compare_methods_year(spark, d):
    return B.compare_methods(obs(spark, d), YEARS, "fy")


RULES_SQL = "rules(rule, last_k, min_total, recency, simple_only, unanimous) AS (VALUES " + ", ".join(f"({i}, {k}, {t}, {g}, {s}, {u})" for i, (k, t, g, s, u) in enumerate(B.rule_grid())) + ")"
GRID_SQL = f"""WITH {ROLLING}, {STATE_SQL}, {RULES_SQL}, tests AS (SELECT fy, count(*) AS test FROM obs GROUP BY fy),
hits AS (SELECT rule, tfy AS fy, count(*) AS n, count(*) FILTER (last = actual) AS correct FROM state JOIN rules
  ON n >= greatest(last_k, min_total) AND run >= last_k AND (NOT unanimous OR run = n) AND (NOT simple_only OR n - coalesce(lastc, 0) >= last_k) AND (recency < 0 OR tfy - last_fy <= recency) GROUP BY ALL),
grid AS (SELECT fy, rule, last_k, min_total, recency, simple_only, unanimous, test, coalesce(n, 0) AS n, coalesce(correct, 0) AS correct,
  round(coalesce(n, 0) / test, 4) AS coverage, CASE WHEN n > 0 THEN round(correct / n, 4) END AS accuracy
  FROM tests CROSS JOIN rules LEFT JOIN hits USING (fy, rule))"""


@query("q_rule_grid", f"{GRID_SQL} SELECT * FROM grid")
def rule_grid(spark, d):
    return B.evaluate_rules(obs(spark, d))


@query("q_rule_best", f"""{GRID_SQL}
SELECT fy, rule, n, coverage, accuracy FROM (SELECT * FROM grid WHERE n >= 20 AND accuracy >= 0.15)
QUALIFY row_number() OVER (PARTITION BY fy ORDER BY coverage DESC, accuracy DESC, rule) <= 6""")
def rule_best(spark, d):
    from pyspark.sql import Window as W

    g = B.evaluate_rules(obs(spark, d)).where("n >= 20 and accuracy >= 0.15")
    w = W.partitionBy("fy").orderBy(F.desc("coverage"), F.desc("accuracy"), "rule")
    return g.withColumn("r", F.row_number().over(w)).where("r <= 6").select("fy", "rule", "n", "coverage", "accuracy")


@query("q_structure_shift", f"""
WITH {YEARLY}, {STATE_SQL}
SELECT tfy AS fy, CASE WHEN NOT any_complex THEN 'simple' WHEN all_complex THEN 'complex' ELSE 'mixed' END AS past, CASE WHEN tcomplex THEN 'complex' ELSE 'simple' END AS now,
  count(*) AS rows, count(DISTINCT content) AS contents FROM state GROUP BY ALL""")
def structure_shift(spark, d):
    return B.structure_shift(obs(spark, d))


FIRST_SQL = f"""WITH {YEARLY}, best AS (SELECT t, label AS pred, count(*) AS c, any_value(n) AS n FROM past GROUP BY t, label QUALIFY row_number() OVER (PARTITION BY t ORDER BY count(*) DESC, min(i)) = 1),
latest AS (SELECT t, label AS last FROM past WHERE i = n),
m AS (SELECT obs.*, pred, c, n, last FROM obs LEFT JOIN best ON best.t = id LEFT JOIN latest ON latest.t = id)"""


@query("q_backtest", f"""{FIRST_SQL}
SELECT fy, count(*) AS test, count(pred) AS covered, count(*) FILTER (pred = label) AS mode_correct, count(*) FILTER (last = label) AS latest_correct, round(count(pred) / count(*), 4) AS coverage FROM m GROUP BY fy""")
def backtest(spark, d):
    return B.year_backtest(obs(spark, d))


@query("q_backtest_confidence", f"""{FIRST_SQL}, th AS (SELECT unnest([10, 5, 3, 2, 1]) AS threshold)
SELECT fy, threshold, count(*) FILTER (c = n AND n >= threshold) AS n, round(count(*) FILTER (c = n AND n >= threshold) / count(*), 4) AS share_of_test,
  CASE WHEN count(*) FILTER (c = n AND n >= threshold) > 0 THEN round(count(*) FILTER (c = n AND n >= threshold AND pred = label) / count(*) FILTER (c = n AND n >= threshold), 4) END AS accuracy
FROM m CROSS JOIN th GROUP BY ALL""")
def backtest_confidence(spark, d):
    return B.unanimous_backtest(obs(spark, d))


@query("q_content_stats", f"""
WITH {OBS_SQL}, use AS (SELECT content, label, count(*) AS n, min((day, id)) AS first, max((day, id)) AS last FROM obs GROUP BY ALL)
SELECT content, CAST(sum(n) AS BIGINT) AS count, count(*) AS distinct_labels, arg_min(label, (-n, first)) AS top_label, round(max(n) / sum(n), 4) AS top_ratio, arg_max(label, last) AS latest_label FROM use GROUP BY content""")
def content_stats(spark, d):
    return H.content_stats(obs(spark, d)).select("content", "count", "distinct_labels", "top_label", "top_ratio", "latest_label")


@query("q_label_hist", f"""
WITH {OBS_SQL}, use AS (SELECT content, label, count(*) AS n FROM obs GROUP BY ALL)
SELECT content, string_agg(label || ':' || n, ',' ORDER BY label) AS labels FROM use GROUP BY content""")
def label_hist(spark, d):
    m = H.content_stats(obs(spark, d))
    return m.select("content", F.array_join(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias("labels"))
