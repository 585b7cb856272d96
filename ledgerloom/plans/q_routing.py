"""Queries of routing and calibration. Model answers are a function of the id: the engine takes them as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import AMOUNT_BANDS, AMOUNT_NONE, AMOUNT_TOP, amount_band, confidence_band, estimate_tokens, rate, reason_categories, sanitize
from ..operators import history as H
from ..operators import routing as R
from ..operators import similarity as S
from ..operators import year_close as Y
from .adapters import OBS_SQL, obs, table
from .q_similarity import STAGED_SQL, STATIC_SQL, staged, varied

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


BAND_SQL = lambda c: f"CASE WHEN {c} IS NULL THEN '{AMOUNT_NONE}' " + " ".join(f"WHEN abs({c}) < {u} THEN '{n}'" for u, n in AMOUNT_BANDS) + f" ELSE '{AMOUNT_TOP}' END"

FEATURES_SQL = f"""features AS (
  SELECT t.id AS fid, count(h.id) AS fn, date_diff('day', max(h.day), any_value(t.day)) AS days_since_last, date_diff('day', min(h.day), max(h.day)) AS hist_span_days,
    count(DISTINCT h.label) AS distinct_labels, arg_max(h.label, (h.day, h.id)) AS last_label, bool_or({BAND_SQL('h.value')} = {BAND_SQL('t.value')}) AS band_seen,
    arg_max({BAND_SQL('h.value')}, (h.day, h.id)) = any_value({BAND_SQL('t.value')}) AS band_same_as_last, bool_or(h.account = t.account) AS account_seen,
    arg_max(h.account, (h.day, h.id)) = any_value(t.account) AS account_same_as_last, bool_or(h.complex) AS past_complex
  FROM {{obs}} t JOIN {{obs}} h ON h.content = t.content AND h.day < t.day GROUP BY t.id)"""


@query("q_history_features", f"""
WITH {OBS_SQL}, {FEATURES_SQL.format(obs='obs')}
SELECT id, coalesce(fn, 0) AS hist_n, {BAND_SQL('value')} AS tx_band, days_since_last, hist_span_days, distinct_labels, last_label, band_seen, band_same_as_last, account_seen, account_same_as_last, past_complex
FROM obs LEFT JOIN features ON fid = id""")
def history_features(spark, d):
    f = R.history_features(obs(spark, d))
    return f.select("id", "hist_n", "tx_band", F.col("days_since_last").cast("long"), F.col("hist_span_days").cast("long"), F.col("distinct_labels").cast("long"), "last_label", "band_seen", "band_same_as_last", "account_seen", "account_same_as_last", "past_complex")


LAYER_SQL = """layered AS (
  SELECT p.*, stage IN ('raw_exact', 'norm_exact') AS exact,
    coalesce(stage IN ('raw_exact', 'norm_exact') AND hist_n >= 3 AND agreement = 1 AND days_since_last <= 365, false) AS high,
    list_filter([CASE WHEN stage = 'fuzzy' AND score >= 70 THEN 'B' WHEN stage NOT IN ('raw_exact', 'norm_exact') THEN 'A' END,
                 CASE WHEN stage IN ('raw_exact', 'norm_exact') AND agreement < 1 THEN 'C' END,
                 CASE WHEN stage IN ('raw_exact', 'norm_exact') AND days_since_last > 365 THEN 'D' END], lambda x: x IS NOT NULL) AS letters FROM preds p),
classified AS (SELECT *, len(letters) > 0 AND NOT high AS model_target, CASE WHEN len(letters) > 0 THEN array_to_string(letters, '+') WHEN high THEN 'H' ELSE 'E' END AS layer FROM layered)"""


@query("q_classify_layers", f"{STAGED_SQL}, {LAYER_SQL} SELECT id, high AS high_confidence, model_target, layer FROM classified")
def classify_layers(spark, d):
    return R.classify(staged(spark, d)).select("id", F.coalesce("high_confidence", F.lit(False)).alias("high_confidence"), F.coalesce("model_target", F.lit(False)).alias("model_target"), "layer")


#: Accounts of one family count as one on both sides.
LINEAGE_SQL = "CASE WHEN account IN (1, 2) THEN 'lineage:shop' ELSE account::VARCHAR END AS account"


@query("q_close_layers", f"""{STATIC_SQL.replace('h AS (SELECT * FROM', f'h AS (SELECT * REPLACE ({LINEAGE_SQL}) FROM').replace('t AS (SELECT * FROM', f't AS (SELECT * REPLACE ({LINEAGE_SQL}) FROM')}, preds AS (SELECT * FROM s), {LAYER_SQL}
SELECT id, layer, account_seen, CASE WHEN high AND coalesce(account_seen, false) THEN '{Y.RULE}' WHEN high THEN '{Y.HUMAN}' WHEN layer IN ({", ".join(repr(x) for x in R.MODEL_LAYERS)}) THEN 'model' ELSE '{Y.HUMAN}' END AS routing FROM classified""")
def close_layers(spark, d):
    """A year's rows against everything before it, as its close sees them."""
    o = varied(spark, d)
    o = o.withColumn("account", Y.lineage(F.col("account"), F.when(F.col("account").isin(1, 2), "service"), {"shop": "service"}))
    return Y.classify_targets(H.in_years(o, 0, 2003), H.target_rows(o, 2004), ascii_only=True).select("id", "layer", "account_seen", "routing")


ITEMS_SQL = f"""{LAYER_SQL}, {FEATURES_SQL.format(obs='keyed')},
items AS (
  SELECT c.*, account_seen, CASE WHEN id % 17 = 0 THEN NULL WHEN id % 10 < 8 THEN label ELSE 'other' END AS model_label, (id * 7919 % 1000) / 1000.0 AS conf,
    CASE WHEN id % 13 = 0 THEN NULL ELSE id % 11 = 0 END AS needs_review, id % 19 = 0 AS insufficient, pred IS NOT NULL AND NOT list_contains(letters, 'A') AS rule_valid
  FROM classified c LEFT JOIN features ON fid = id),
judged AS (SELECT *, rule_valid AND pred = label AS rule_ok, model_label IS NOT NULL AND model_label = label AS model_ok, rule_valid AND model_label IS NOT NULL AND pred = model_label AS agree FROM items)"""


def items(spark, d):
    p, i = R.classify(staged(spark, d)), F.col("id")
    results = obs(spark, d).select(
        i, F.when(i % 17 != 0, F.when(i % 10 < 8, F.col("label")).otherwise("other")).alias("model_label"), (i * 7919 % 1000 / 1000.0).alias("conf"),
        F.when(i % 13 != 0, i % 11 == 0).alias("needs_review"), (i % 19 == 0).alias("insufficient"),
    )
    return R.build_items(p, R.accounts_seen(varied(spark, d)), results)


PLAN_SQL = """plans(plan, least) AS (VALUES ('Aggressive', 0.80), ('Balanced', 0.90), ('Conservative', 0.95)),
planned AS (
  SELECT *, CASE WHEN high THEN CASE WHEN coalesce(account_seen, false) THEN 'rule' ELSE 'human' END
    WHEN model_label IS NULL OR conf < least OR needs_review IS DISTINCT FROM false THEN 'human' WHEN rule_valid AND NOT coalesce(agree, false) THEN 'human' WHEN account_seen IS NOT DISTINCT FROM false THEN 'human' ELSE 'model' END AS by_
  FROM judged CROSS JOIN plans)"""


@query("q_route_plan", f"{STAGED_SQL}, {ITEMS_SQL}, {PLAN_SQL} SELECT id, by_ AS decision FROM planned WHERE plan = 'Balanced'")
def route_plan(spark, d):
    return items(spark, d).select("id", R.plan(F.lit(R.PLANS["Balanced"])).alias("decision"))


@query("q_route_eval", f"""{STAGED_SQL}, {ITEMS_SQL}, {PLAN_SQL}, g AS (SELECT plan, count(*) AS n, count(*) FILTER (by_ <> 'human') AS auto, count(*) FILTER ((by_ = 'rule' AND rule_ok) OR (by_ = 'model' AND model_ok)) AS ok,
  count(*) FILTER (by_ = 'rule') AS rule, count(*) FILTER (by_ = 'model') AS model, count(*) FILTER (by_ = 'human') AS human FROM planned GROUP BY plan)
SELECT plan, n, auto, round(auto / n, 4) AS coverage, CASE WHEN auto > 0 THEN round(ok / auto, 4) END AS accuracy, auto - ok AS errors, rule, model, human FROM g""")
def route_eval(spark, d):
    return R.route(items(spark, d))


@query("q_gate", f"""{STAGED_SQL}, {ITEMS_SQL}
SELECT id, CASE WHEN layer IN ('A', 'B', 'C', 'C+D', 'D') AND model_label IS NOT NULL AND conf >= 0.9 AND needs_review = false AND insufficient = false THEN 'model' ELSE 'human' END AS decision FROM judged""")
def gate(spark, d):
    return items(spark, d).select("id", R.gate(F.col("conf"), F.col("needs_review"), F.col("insufficient"), F.col("model_label"), F.col("layer")).alias("decision"))


SCORES_SQL = f"""{OBS_SQL}, scored AS (SELECT *, CASE WHEN id % 10 < 8 THEN label ELSE 'other' END AS a, CASE WHEN id % 7 < 6 THEN label ELSE 'none' END AS b, (id * 7919 % 1000) / 1000.0 AS conf FROM obs)"""


def scored(spark, d):
    i = F.col("id")
    return obs(spark, d).withColumns({"a": F.when(i % 10 < 8, F.col("label")).otherwise("other"), "b": F.when(i % 7 < 6, F.col("label")).otherwise("none"), "conf": (i * 7919 % 1000) / 1000.0})


@query("q_calibration", f"""WITH {SCORES_SQL}, e AS (SELECT unnest([0.7, 0.8, 0.9, 0.95])::DOUBLE AS least)
SELECT least, count(*) FILTER (conf >= least) AS n, round(count(*) FILTER (conf >= least) / count(*), 4) AS share, round(count(*) FILTER (conf >= least AND a = label) / count(*) FILTER (conf >= least), 4) AS accuracy FROM scored CROSS JOIN e GROUP BY least""")
def calibration(spark, d):
    s = scored(spark, d).withColumns({"model_label": F.col("a"), "model_ok": F.col("a") == F.col("label")})
    return R.calibration(s, [0.7, 0.8, 0.9, 0.95])


@query("q_conf_band", f"""WITH {SCORES_SQL} SELECT CASE WHEN conf >= .95 THEN '0.95-1.00' WHEN conf >= .9 THEN '0.90-0.95' WHEN conf >= .8 THEN '0.80-0.90' WHEN conf >= .7 THEN '0.70-0.80' WHEN conf >= .5 THEN '0.50-0.70' ELSE '<0.50' END AS band,
  count(*) AS n, round(count(*) FILTER (a = label) / count(*), 4) AS accuracy FROM scored GROUP BY 1""")
def conf_band(spark, d):
    s = scored(spark, d)
    return s.groupBy(confidence_band(F.col("conf")).alias("band")).agg(F.count("*").alias("n"), rate(F.count_if(F.col("a") == F.col("label")), F.count("*")).alias("accuracy"))


@query("q_model_compare", f"WITH {SCORES_SQL} SELECT a = label AS a_right, b = label AS b_right, a = b AS same, count(*) AS n FROM scored GROUP BY ALL")
def model_compare(spark, d):
    i, s = F.col("id"), scored(spark, d)
    one = lambda c: s.select(i, F.col(c).alias("choice"), F.col("conf").alias("confidence"))
    return R.compare_models(R.join_answers(one("a"), one("b"), s.select("id", "label"), "id"))


@query("q_simulation_grid", f"""WITH {SCORES_SQL}, e AS (SELECT unnest([0.6, 0.7, 0.8, 0.9])::DOUBLE AS least), m AS (SELECT unnest([0, 1, 2]) AS mode),
r AS (SELECT least, mode, label, CASE mode WHEN 0 THEN conf >= least WHEN 1 THEN conf >= least AND a = b ELSE conf >= least OR a = b END AS auto, a FROM scored CROSS JOIN e CROSS JOIN m)
SELECT least, mode, count(*) FILTER (auto) AS auto, round(count(*) FILTER (auto) / count(*), 4) AS coverage, round(count(*) FILTER (auto AND a = label) / count(*) FILTER (auto), 4) AS accuracy FROM r GROUP BY ALL""")
def simulation_grid(spark, d):
    s = scored(spark, d).withColumn("least", F.explode(F.array(*map(F.lit, [0.6, 0.7, 0.8, 0.9])))).withColumn("mode", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    sure, same = F.col("conf") >= F.col("least"), F.col("a") == F.col("b")
    auto = F.when(F.col("mode") == 0, sure).when(F.col("mode") == 1, sure & same).otherwise(sure | same)
    n = F.count_if(auto)
    return s.groupBy("least", "mode").agg(n.alias("auto"), rate(n, F.count("*")).alias("coverage"), rate(F.count_if(auto & (F.col("a") == F.col("label"))), n).alias("accuracy"))


@query("q_stratified_sample", f"""WITH {OBS_SQL} SELECT id, label, complex FROM (SELECT *, row_number() OVER (PARTITION BY label, complex ORDER BY md5(id || ':7')) AS r FROM obs) WHERE r <= 40 ORDER BY r, label, complex LIMIT 40""")
def stratified_sample(spark, d):
    return R.stratified_sample(obs(spark, d), ["label", "complex"], 40, F.md5(F.concat(F.col("id").cast("string"), F.lit(":7")))).select("id", "label", "complex")


@query("q_amount_band", f"WITH {OBS_SQL} SELECT {BAND_SQL('value')} AS band, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM obs GROUP BY 1")
def q_amount_band(spark, d):
    return obs(spark, d).groupBy(amount_band(F.col("value")).alias("band")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


#: RE2 knows no Unicode classes behind \\w and \\d; the tables' digits are ASCII, and their e-mails too.
@query("q_mask_pii", r"""
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
  '[\w.+-]+@[\w-]+\.[\w.-]+', '<EMAIL>', 'g'), '0\d{1,4}-\d{1,4}-\d{3,4}|\b0[5789]0\d{8}\b', '<PHONE>', 'g'), '(?i)(?:\d[ -]?){12,19}|\*{2,}\d{2,4}|x{2,}\d{2,4}', '<NUM>', 'g'), '\d{7,}', '<NUM>', 'g'), E' \n\t')) AS masked
FROM documents""")
def mask_pii(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(sanitize(F.col("text"))).alias("masked"))


@query("q_pii_counts", r"""
SELECT count(*) FILTER (regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.-]+')) AS email, count(*) FILTER (regexp_matches(text, '0\d{1,4}-\d{1,4}-\d{3,4}|\b0[5789]0\d{8}\b|\b0\d{9}\b')) AS phone,
  count(*) FILTER (regexp_matches(text, '\d{7,}')) AS digits FROM documents""")
def pii_counts(spark, d):
    from ..functions.text import EMAIL, LONG_DIGITS, PHONE_LOOSE

    t = table(spark, d, "documents")
    return t.agg(*(F.count_if(F.col("text").rlike(p)).alias(n) for n, p in (("email", EMAIL), ("phone", PHONE_LOOSE), ("digits", LONG_DIGITS))))


@query("q_leak_check", r"""
WITH m AS (SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
  '[\w.+-]+@[\w-]+\.[\w.-]+', '<EMAIL>', 'g'), '0\d{1,4}-\d{1,4}-\d{3,4}|\b0[5789]0\d{8}\b', '<PHONE>', 'g'), '(?i)(?:\d[ -]?){12,19}|\*{2,}\d{2,4}|x{2,}\d{2,4}', '<NUM>', 'g'), '\d{7,}', '<NUM>', 'g'), E' \n\t') AS t FROM documents)
SELECT count(*) FILTER (regexp_matches(t, '\d{7,}')) AS digits, count(*) FILTER (regexp_matches(t, '[\w.+-]+@[\w-]+\.[\w.-]+')) AS email FROM m""")
def leak_check(spark, d):
    from ..functions.text import EMAIL, LONG_DIGITS

    t = table(spark, d, "documents").select(sanitize(F.col("text")).alias("t"))
    return t.agg(F.count_if(F.col("t").rlike(LONG_DIGITS)).alias("digits"), F.count_if(F.col("t").rlike(EMAIL)).alias("email"))


@query("q_token_estimate", r"SELECT doc_id, CAST(floor(len(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / 3.5::DOUBLE + (len(text) - len(regexp_replace(text, '[^\x00-\x7F]', '', 'g')))) AS BIGINT) + 1 AS tokens FROM documents")
def token_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", estimate_tokens(F.col("text")).alias("tokens"))


@query("q_cost_estimate", r"""WITH t AS (SELECT CAST(floor(len(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / 3.5::DOUBLE + (len(text) - len(regexp_replace(text, '[^\x00-\x7F]', '', 'g')))) AS BIGINT) + 1 AS n FROM documents)
SELECT count(*) AS items, CAST(sum(n) AS BIGINT) AS input_tokens, round((sum(n) * 2.0 + 6000 * 1.25 * 2.0 + 6000 * (count(*) - 1) * 0.2 + count(*) * 300 * 10.0) / 1e6, 4) AS cost FROM t""")
def cost_estimate(spark, d):
    """2.0 in, 10.0 out, 0.2 cached for a million tokens; 6000 shared ones written once at 1.25; 300 out an item."""
    t = table(spark, d, "documents").select(estimate_tokens(F.col("text")).alias("n"))
    n, items_ = F.sum("n"), F.count("*")
    return t.agg(items_.alias("items"), n.alias("input_tokens"), F.round((n * 2.0 + 6000 * 1.25 * 2.0 + 6000 * (items_ - 1) * 0.2 + items_ * 300 * 10.0) / 1e6, 4).alias("cost"))


@query("q_reason_keywords", f"""WITH {OBS_SQL}, r AS (SELECT id, label || CASE id % 4 WHEN 0 THEN ' as in the past' WHEN 1 THEN ' similar amount' WHEN 2 THEN ' unclear' ELSE '' END AS reason FROM obs),
k(name, word) AS (VALUES ('insufficient', 'unknown'), ('insufficient', 'unclear'), ('insufficient', 'cannot'), ('history', 'history'), ('history', 'past'), ('history', 'before'), ('history', 'always'), ('similarity', 'similar'), ('similarity', 'alike'), ('similarity', 'close to'), ('amount', 'amount'), ('amount', 'income'), ('amount', 'expense'), ('meaning', 'name'), ('meaning', 'service'), ('meaning', 'content'), ('meaning', 'fee')),
h AS (SELECT DISTINCT id, name FROM r JOIN k ON contains(lower(reason), word))
SELECT category, count(*) AS n FROM (SELECT name AS category FROM h UNION ALL SELECT 'other' FROM r WHERE id NOT IN (SELECT id FROM h)) GROUP BY 1""")
def reason_keywords(spark, d):
    i = F.col("id") % 4
    reason = F.concat("label", F.when(i == 0, " as in the past").when(i == 1, " similar amount").when(i == 2, " unclear").otherwise(""))
    return obs(spark, d).select(F.explode(reason_categories(reason)).alias("category")).groupBy("category").agg(F.count("*").alias("n"))
