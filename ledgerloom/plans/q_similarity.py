"""Queries of text similarity and staged prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalize, rate, weighted_ratio_arrow
from ..operators import similarity as S
from .adapters import OBS_SQL, obs, table

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def ratio_sql(a: str, b: str) -> str:
    row = f"list_reduce(range(1, len({a}) + 1), lambda cur, i: list_append(cur, CASE WHEN {a}[i] = ch THEN prev[i] + 1 ELSE greatest(prev[i + 1], cur[-1]) END), [0::BIGINT])"
    lcs = f"list_reduce(string_split({b}, ''), lambda prev, ch: {row}, list_resize([]::BIGINT[], len({a}) + 1, 0))[-1]"
    return f"200.0 * ({lcs})::DOUBLE / (len({a}) + len({b}))"


NAMES_SQL = f"""names AS (SELECT DISTINCT p_name AS k FROM part),
scores AS (SELECT a.k AS a, b.k AS b, {ratio_sql('a.k', 'b.k')} AS score FROM names a JOIN names b ON a.k <> b.k)"""


def names(spark, d):
    return table(spark, d, "part").select(F.col("p_name").alias("a")).distinct()


@query("q_indel_ratio", f"WITH {NAMES_SQL} SELECT a, b, round(score, 4) AS score FROM scores")
def indel(spark, d):
    n = names(spark, d)
    return S.pair_scores(n, n.withColumnRenamed("a", "b")).select("a", "b", F.round("score", 4).alias("score"))


def _or_sql(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 100.0 WHEN len({a}) * len({b}) = 0 THEN 0.0 ELSE {ratio_sql(a, b)} END"


#: Pairs of like lengths: whole texts, sorted words, and what both sets of words share with the rest of either.
@query("q_weighted_ratio", f"""WITH {NAMES_SQL}, w AS (SELECT a, b, score, list_sort(string_split(a, ' ')) AS x, list_sort(string_split(b, ' ')) AS y FROM scores WHERE score >= {S.FUZZY_FLOOR} AND greatest(len(a), len(b)) < 1.5 * least(len(a), len(b))),
s AS (SELECT a, b, score, array_to_string(x, ' ') AS sx, array_to_string(y, ' ') AS sy, array_to_string(list_filter(list_distinct(x), lambda v: list_contains(y, v)).list_sort(), ' ') AS both_,
  array_to_string(list_filter(list_distinct(x), lambda v: NOT list_contains(y, v)).list_sort(), ' ') AS l, array_to_string(list_filter(list_distinct(y), lambda v: NOT list_contains(x, v)).list_sort(), ' ') AS r FROM w),
j AS (SELECT *, both_ || ' ' || l AS one, both_ || ' ' || r AS other FROM s)
SELECT a, b, round(greatest(score, 0.95 * greatest({_or_sql('sx', 'sy')}, CASE WHEN both_ = '' THEN 0.0 WHEN l = '' OR r = '' THEN 100.0 ELSE greatest({_or_sql('one', 'other')}, {_or_sql('both_', 'one')}, {_or_sql('both_', 'other')}) END)), 4) AS score FROM j""")
def weighted(spark, d):
    n = names(spark, d)
    pairs = S.pair_scores(n, n.withColumnRenamed("a", "b"), floor=S.FUZZY_FLOOR).where("greatest(length(a), length(b)) < 1.5 * least(length(a), length(b))")
    return pairs.select("a", "b", F.round(weighted_ratio_arrow(F.col("a"), F.col("b")), 4).alias("score"))


@query("q_fuzzy_top3", f"WITH {NAMES_SQL} SELECT a, b, round(score, 4) AS score, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank FROM scores QUALIFY rank <= 3")
def fuzzy_top3(spark, d):
    return S.top_similar(names(spark, d), names(spark, d).withColumnRenamed("a", "b")).select("a", "b", F.round("score", 4).alias("score"), "rank")


@query("q_fuzzy_threshold", f"""
WITH {NAMES_SQL}, best AS (SELECT a, max(score) AS score FROM scores GROUP BY a), th AS (SELECT unnest([70, 80, 90]) AS threshold)
SELECT threshold, count(*) FILTER (score >= threshold) AS n, round(count(*) FILTER (score >= threshold) / count(*), 4) AS share FROM best CROSS JOIN th GROUP BY 1""")
def fuzzy_threshold(spark, d):
    best = S.top_similar(names(spark, d), names(spark, d).withColumnRenamed("a", "b"), 1).withColumn("threshold", F.explode(F.array(F.lit(70), F.lit(80), F.lit(90))))
    n = F.count_if(F.col("score") >= F.col("threshold"))
    return best.groupBy("threshold").agg(n.alias("n"), rate(n, F.count("*")).alias("share"))


def norm_sql(c: str) -> str:
    n1 = f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))"
    n3 = f"regexp_replace(regexp_replace({n1}, '[^\\w\\s]', ' ', 'g'), '\\s+', '', 'g')"
    return f"regexp_replace({n3}, '\\d{{6,}}', '#', 'g')"


#: Texts that differ in case or punctuation, appear late or only once, so that every stage has rows.
VARIED_SQL = f"""{OBS_SQL.replace('obs AS (', 'plain AS (')},
varied AS (
  SELECT * REPLACE (CASE WHEN id % 10 = 3 THEN upper(content) WHEN id % 10 = 4 THEN content || '!' WHEN id % 50 = 5 THEN content || ' x' || (day - DATE '2024-01-01')::VARCHAR ELSE content END AS content) FROM plain),
keyed AS (SELECT *, trim(content) AS raw, {norm_sql('content')} AS key FROM varied)"""


def varied(spark, d):
    i, c = F.col("id") % 10, F.col("content")
    day = F.datediff("day", F.lit("2024-01-01").cast("date")).cast("string")
    changed = F.when(i == 3, F.upper(c)).when(i == 4, F.concat(c, F.lit("!"))).when(F.col("id") % 50 == 5, F.concat(c, F.lit(" x"), day)).otherwise(c)
    return obs(spark, d).withColumn("content", changed)


def uses_sql(name: str, on: str) -> str:
    """The label counts of everything before the day of each row of a relation, over keys equal on `on`."""
    return f"""{name} AS (SELECT t.id AS t, h.label, count(*) AS n, max((h.day, h.id)) AS last, min((h.day, h.id)) AS first FROM keyed t JOIN keyed h ON h.{on} = t.{on} AND h.day < t.day GROUP BY ALL)"""


STAGED_SQL = f"""WITH {VARIED_SQL}, {uses_sql('raws', 'raw')}, {uses_sql('norms', 'key')},
raw_best AS (SELECT t, arg_max(label, (n, last)) AS mode, CAST(sum(n) AS BIGINT) AS hist_n, max(n) AS mode_n, max(last)[1] AS last_day FROM raws GROUP BY t),
norm_best AS (SELECT t, arg_max(label, (n, last)) AS mode, CAST(sum(n) AS BIGINT) AS hist_n, max(n) AS mode_n, max(last)[1] AS last_day FROM norms GROUP BY t),
seen AS (SELECT key, min((day, id)) AS seen FROM keyed GROUP BY key),
asked AS (SELECT DISTINCT key, day FROM keyed WHERE key <> '' AND id NOT IN (SELECT t FROM raw_best) AND id NOT IN (SELECT t FROM norm_best)),
pairs AS (SELECT a.key AS a, b.key AS b, {ratio_sql('a.key', 'b.key')} AS score FROM (SELECT DISTINCT key FROM asked) a JOIN seen b ON a.key <> b.key AND b.key <> ''),
near AS (SELECT asked.key, asked.day, b AS match, score FROM asked JOIN pairs ON a = key JOIN seen ON seen.key = b AND seen.seen[1] < asked.day
  QUALIFY row_number() OVER (PARTITION BY asked.key, asked.day ORDER BY score DESC, seen.seen) = 1),
near_uses AS (SELECT near.key, near.day, any_value(score) AS score, label, count(*) AS n, max((h.day, h.id)) AS last FROM near JOIN keyed h ON h.key = match AND h.day < near.day GROUP BY near.key, near.day, label),
near_best AS (SELECT key, day, any_value(score) AS score, arg_max(label, (n, last)) AS mode, CAST(sum(n) AS BIGINT) AS hist_n, max(n) AS mode_n, max(last)[1] AS last_day FROM near_uses GROUP BY key, day),
preds AS (
  SELECT k.*, CASE WHEN r.t IS NOT NULL THEN 'raw_exact' WHEN m.t IS NOT NULL THEN 'norm_exact' WHEN f.key IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS stage,
    CASE WHEN r.t IS NOT NULL THEN r.mode WHEN m.t IS NOT NULL THEN m.mode ELSE f.mode END AS pred,
    CASE WHEN r.t IS NOT NULL OR m.t IS NOT NULL THEN 100.0::DOUBLE ELSE f.score END AS score,
    CASE WHEN r.t IS NOT NULL THEN r.hist_n WHEN m.t IS NOT NULL THEN m.hist_n ELSE f.hist_n END AS hist_n,
    round(CASE WHEN r.t IS NOT NULL THEN r.mode_n / r.hist_n WHEN m.t IS NOT NULL THEN m.mode_n / m.hist_n ELSE f.mode_n / f.hist_n END, 4) AS agreement,
    date_diff('day', CASE WHEN r.t IS NOT NULL THEN r.last_day WHEN m.t IS NOT NULL THEN m.last_day ELSE f.last_day END, k.day) AS days_since_last
  FROM keyed k LEFT JOIN raw_best r ON r.t = k.id LEFT JOIN norm_best m ON m.t = k.id LEFT JOIN near_best f ON f.key = k.key AND f.day = k.day AND r.t IS NULL AND m.t IS NULL)"""


def staged(spark, d):
    return S.staged_predictions(varied(spark, d), ascii_only=True)


@query("q_staged_prediction", f"{STAGED_SQL} SELECT id, stage, pred, round(score, 4) AS score, hist_n, agreement, days_since_last, pred = label AS correct FROM preds")
def staged_prediction(spark, d):
    return staged(spark, d).select("id", "stage", "pred", F.round("score", 4).alias("score"), "hist_n", "agreement", F.col("days_since_last").cast("long").alias("days_since_last"), "correct")


@query("q_stage_summary", f"""{STAGED_SQL}, both_ AS (SELECT fy, stage, pred, label, complex FROM preds UNION ALL SELECT fy, 'total', pred, label, complex FROM preds WHERE stage <> 'none')
SELECT fy, stage, count(*) AS n, round(count(*) / (SELECT count(*) FROM preds p WHERE p.fy = both_.fy), 4) AS share,
  CASE WHEN stage <> 'none' THEN round(count(*) FILTER (pred = label) / count(*), 4) END AS accuracy, count(*) FILTER (NOT complex) AS simple_n,
  CASE WHEN stage <> 'none' AND count(*) FILTER (NOT complex) > 0 THEN round(count(*) FILTER (pred = label AND NOT complex) / count(*) FILTER (NOT complex), 4) END AS simple_accuracy, count(*) FILTER (complex) AS complex_n,
  CASE WHEN stage <> 'none' AND count(*) FILTER (complex) > 0 THEN round(count(*) FILTER (pred = label AND complex) / count(*) FILTER (complex), 4) END AS complex_accuracy
FROM both_ GROUP BY fy, stage""")
def stage_summary(spark, d):
    return S.stage_summary(staged(spark, d))


@query("q_fuzzy_applied", f"""{STAGED_SQL}, th AS (SELECT unnest([70, 80, 90]) AS threshold)
SELECT threshold, count(*) FILTER (stage <> 'none' AND (stage <> 'fuzzy' OR score >= threshold)) AS covered, count(*) FILTER (pred = label AND (stage <> 'fuzzy' OR score >= threshold)) AS correct FROM preds CROSS JOIN th GROUP BY 1""")
def fuzzy_applied(spark, d):
    p = staged(spark, d).withColumn("threshold", F.explode(F.array(F.lit(70), F.lit(80), F.lit(90))))
    p = p.withColumn("_low", (F.col("stage") == "fuzzy") & (F.col("score") < F.col("threshold")))
    return p.groupBy("threshold").agg(F.count_if(~F.col("_low") & (F.col("stage") != "none")).alias("covered"), F.count_if(~F.col("_low") & F.coalesce("correct", F.lit(False))).alias("correct"))


@query("q_bucket_accuracy", f"""{STAGED_SQL}
SELECT CASE WHEN hist_n >= 10 THEN '10+' WHEN hist_n >= 5 THEN '5-9' WHEN hist_n >= 2 THEN '2-4' ELSE '1' END AS bucket, count(*) AS n, round(count(*) FILTER (pred = label) / count(*), 4) AS accuracy
FROM preds WHERE stage <> 'none' GROUP BY 1""")
def bucket_accuracy(spark, d):
    from ..functions.text import band

    p = staged(spark, d).where("stage <> 'none'")
    b = band(F.col("hist_n"), [(10, "10+"), (5, "5-9"), (2, "2-4")], "1")
    return p.groupBy(b.alias("bucket")).agg(F.count("*").alias("n"), rate(F.count_if("correct"), F.count("*")).alias("accuracy"))


CANDIDATES_SQL = f"""WITH {VARIED_SQL}, seen AS (SELECT key, min((day, id)) AS seen FROM keyed GROUP BY key), asked AS (SELECT DISTINCT key, day FROM keyed),
pairs AS (SELECT a.key AS a, b.key AS b, {ratio_sql('a.key', 'b.key')} AS score FROM seen a JOIN seen b ON a.key <> b.key AND a.key <> '' AND b.key <> ''),
near AS (SELECT asked.key, asked.day, seen.key AS match, CASE WHEN seen.key = asked.key THEN 100.0 ELSE score END AS score,
    row_number() OVER (PARTITION BY asked.key, asked.day ORDER BY seen.key = asked.key DESC, score DESC, seen.seen) AS rank
  FROM asked JOIN seen ON seen.seen[1] < asked.day LEFT JOIN pairs ON a = asked.key AND b = seen.key WHERE score IS NOT NULL OR seen.key = asked.key QUALIFY rank <= 8),
uses AS (SELECT match, near.day, label, count(*) AS n, min((h.day, h.id)) AS first, max(h.day) AS last FROM (SELECT DISTINCT match, day FROM near) near JOIN keyed h ON h.key = match AND h.day < near.day GROUP BY ALL),
tops AS (SELECT match, day, CAST(sum(n) AS BIGINT) AS occurrences, max(last) AS last_used,
    array_to_string(list_slice(list(label || ':' || n ORDER BY n DESC, first), 1, 3), ',') AS labels FROM uses GROUP BY ALL)"""


@query("q_candidates_before", f"{CANDIDATES_SQL} SELECT key, day::VARCHAR AS day, rank, match, CAST(round_even(score, 0) AS BIGINT) AS similarity, occurrences, last_used::VARCHAR AS last_used, labels FROM near JOIN tops USING (match, day)")
def candidates(spark, d):
    c = S.candidates_before(varied(spark, d), ascii_only=True)
    return c.withColumns({"day": F.col("day").cast("string"), "last_used": F.col("last_used").cast("string")})


@query("q_normalize_ascii", f"""
WITH texts AS (SELECT DISTINCT p_name || ' #' || p_partkey || '-' || p_size * 123457 AS text FROM part UNION SELECT DISTINCT props FROM events)
SELECT text, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS n1, {norm_sql('text')} AS n4 FROM texts""")
def normalize_ascii(spark, d):
    p = table(spark, d, "part").select(F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"), F.lit("-"), (F.col("p_size") * 123457).cast("string")).alias("text"))
    t = p.union(table(spark, d, "events").select(F.col("props").alias("text"))).distinct()
    return t.select("text", normalize(F.col("text"), "n1", True).alias("n1"), normalize(F.col("text"), "n4", True).alias("n4"))


@query("q_normalize_nfkc")
def normalize_nfkc(spark, d):
    """No SQL twin: DuckDB has neither NFKC nor case folding; the tests hold it against Python."""
    t = table(spark, d, "documents")
    return t.select("doc_id", *(F.md5(normalize(F.col("text"), n)).alias(n) for n in ("n1", "n4", "n5")))


STATIC_SQL = f"""WITH {VARIED_SQL}, h AS (SELECT * FROM keyed WHERE fy < 2004), t AS (SELECT * FROM keyed WHERE fy = 2004),
ru AS (SELECT raw, label, count(*) AS n, max((day, id)) AS last FROM h GROUP BY ALL), ku AS (SELECT key, label, count(*) AS n, max((day, id)) AS last FROM h GROUP BY ALL),
rm AS (SELECT raw, arg_max(label, (n, last)) AS mode, CAST(sum(n) AS BIGINT) AS hist_n, max(n) AS mode_n, max(last)[1] AS last_day FROM ru GROUP BY raw), km AS (SELECT key, arg_max(label, (n, last)) AS mode, CAST(sum(n) AS BIGINT) AS hist_n, max(n) AS mode_n, max(last)[1] AS last_day FROM ku GROUP BY key),
seen AS (SELECT key, min((day, id)) AS seen FROM h GROUP BY key), open_ AS (SELECT DISTINCT key FROM t WHERE key NOT IN (SELECT key FROM seen)),
near AS (SELECT a.key AS a, b.key AS b, {ratio_sql('a.key', 'b.key')} AS score, seen FROM open_ a JOIN seen b ON true QUALIFY row_number() OVER (PARTITION BY a.key ORDER BY score DESC, seen) = 1),
s AS (SELECT t.*, CASE WHEN rm.raw IS NOT NULL THEN 'raw_exact' WHEN km.key IS NOT NULL THEN 'norm_exact' WHEN near.a IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS stage,
  CASE WHEN rm.raw IS NOT NULL THEN rm.mode WHEN km.key IS NOT NULL THEN km.mode ELSE f.mode END AS pred, CASE WHEN km.key IS NOT NULL THEN 100.0::DOUBLE ELSE near.score END AS score,
  CASE WHEN rm.raw IS NOT NULL THEN rm.hist_n WHEN km.key IS NOT NULL THEN km.hist_n ELSE f.hist_n END AS hist_n,
  round(CASE WHEN rm.raw IS NOT NULL THEN rm.mode_n / rm.hist_n WHEN km.key IS NOT NULL THEN km.mode_n / km.hist_n ELSE f.mode_n / f.hist_n END, 4) AS agreement,
  date_diff('day', CASE WHEN rm.raw IS NOT NULL THEN rm.last_day WHEN km.key IS NOT NULL THEN km.last_day ELSE f.last_day END, t.day) AS days_since_last,
  CASE WHEN rm.raw IS NOT NULL THEN EXISTS (SELECT 1 FROM h WHERE h.raw = t.raw AND h.account = t.account) WHEN km.key IS NOT NULL THEN EXISTS (SELECT 1 FROM h WHERE h.key = t.key AND h.account = t.account) END AS account_seen
  FROM t LEFT JOIN rm ON rm.raw = t.raw LEFT JOIN km ON km.key = t.key LEFT JOIN near ON near.a = t.key LEFT JOIN km f ON f.key = near.b)"""


def static(spark, d):
    o = varied(spark, d)
    return S.static_predictions(o.where("fy < 2004"), o.where("fy = 2004"), ascii_only=True)


@query("q_static_predictions", f"{STATIC_SQL} SELECT id, stage, pred, round(score, 4) AS score, hist_n FROM s")
def static_predictions(spark, d):
    return static(spark, d).select("id", "stage", "pred", F.round("score", 4).alias("score"), "hist_n")


@query("q_account_seen", f"{STATIC_SQL} SELECT stage, account_seen, count(*) AS n FROM s GROUP BY ALL")
def account_seen(spark, d):
    return static(spark, d).groupBy("stage", "account_seen").agg(F.count("*").alias("n"))
