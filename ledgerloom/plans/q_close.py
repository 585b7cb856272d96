"""Queries of year close: groups, decisions, journals, checks, duplicates, layouts; and of data quality and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks as K
from ..operators import close as C
from ..operators import import_format as I
from ..operators import quality as U
from ..operators import sets as S
from ..operators import year_close as Y
from .adapters import LINE_ORDER, LINES_SQL, OBS_SQL, TERMS_SQL, TX_SQL, journal_lines, lines, obs, table, terms, tx
from .q_similarity import norm_sql

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


TYPES_SQL = "types AS (SELECT DISTINCT p_type AS name FROM part)"

CATALOG_SQL = f"""WITH {TYPES_SQL}, a AS (SELECT name, split_part(name, ' ', 1) AS g, split_part(name, ' ', 2) AS c, len(name) % 5 > 0 AS available FROM types)
SELECT 'A' || lpad(row_number() OVER (ORDER BY g, c, name)::VARCHAR, 3, '0') AS code, name FROM a WHERE available"""


@query("q_catalog_codes", CATALOG_SQL)
def catalog_codes(spark, d):
    t = table(spark, d, "part").select(F.col("p_type").alias("name")).distinct()
    t = t.select("name", F.col("name").alias("account_id"), F.split_part("name", F.lit(" "), F.lit(1)).alias("account_group"), F.split_part("name", F.lit(" "), F.lit(2)).alias("category"), (F.length("name") % 5 > 0).alias("available"))
    return C.catalog_codes(t).select("code", "name")


@query("q_prefix_merge", """
WITH n AS (SELECT DISTINCT CASE WHEN p_partkey % 9 = 0 THEN substr(p_name, 1, len(p_name) - 1) ELSE p_name END AS key, p_partkey % 9 = 0 AS cut FROM part),
k AS (SELECT key, bool_and(cut) AS cut FROM n GROUP BY key),
hit AS (SELECT c.key, min(f.key) AS merchant FROM k c JOIN k f ON c.cut AND NOT f.cut AND len(c.key) >= 4 AND starts_with(f.key, c.key) GROUP BY c.key HAVING count(*) = 1)
SELECT key, coalesce(merchant, key) AS merchant FROM k LEFT JOIN hit USING (key)""")
def prefix_merge(spark, d):
    cut = F.col("p_partkey") % 9 == 0
    keys = table(spark, d, "part").select(F.when(cut, F.expr("substring(p_name, 1, length(p_name) - 1)")).otherwise(F.col("p_name")).alias("key"), cut.alias("_cut"))
    return C.prefix_repair(keys, F.col("_cut"))


#: Contents with a reference number at the end of some, and others cut off with a bracket.
CUT_SQL = f"""{OBS_SQL.replace('obs AS (', 'plain AS (')}, cut_ AS (SELECT * REPLACE (CASE WHEN id % 5 = 1 THEN upper(content) || ' TOKYO no.' || id WHEN id % 7 = 3 THEN content || ' Tok(' WHEN id % 7 = 4 THEN substr(content, 1, 2) || ' (' ELSE content || ' Tokyo' END AS content) FROM plain)"""


@query("q_merchant_keys", f"""WITH {CUT_SQL}, k AS (SELECT id, {norm_sql("regexp_replace(content, ' no[.][0-9]+$', '')")} AS key, content LIKE '%(' AS cut FROM cut_),
kinds AS (SELECT key, bool_and(cut) AS cut FROM k GROUP BY key),
hit AS (SELECT c.key, min(f.key) AS full_key FROM kinds c JOIN kinds f ON c.cut AND NOT f.cut AND len(c.key) >= 4 AND starts_with(f.key, c.key) GROUP BY c.key HAVING count(*) = 1)
SELECT id, coalesce(full_key, key) AS merchant FROM k LEFT JOIN hit USING (key)""")
def merchant_keys(spark, d):
    i, c = F.col("id"), F.col("content")
    cut = F.when(i % 5 == 1, F.concat(F.upper(c), F.lit(" TOKYO no."), i.cast("string"))).when(i % 7 == 3, F.concat(c, F.lit(" Tok("))).when(i % 7 == 4, F.concat(F.substring(c, 1, 2), F.lit(" ("))).otherwise(F.concat(c, F.lit(" Tokyo")))
    return C.with_merchants(obs(spark, d).withColumn("content", cut), r"\($", (" no[.][0-9]+$",), ascii_only=True).select("id", "merchant")


ROWS_SQL = f"""{OBS_SQL}, rows_ AS (SELECT id AS transaction_id, CASE WHEN complex THEN 'human' ELSE 'model' END AS routing, content AS merchant, label AS account, value AS amount, day AS date, (id * 7919 % 1000) / 1000.0 AS confidence FROM obs)"""


def review_rows(spark, d):
    return obs(spark, d).select(F.col("id").alias("transaction_id"), F.when(F.col("complex"), "human").otherwise("model").alias("routing"), F.col("content").alias("merchant"), F.col("label").alias("account"), F.col("value").alias("amount"), F.col("day").alias("date"), (F.col("id") * 7919 % 1000 / 1000.0).alias("confidence"))


RANGE_SQL = lambda c: f"CASE WHEN min({c}) IS NULL THEN '' WHEN min({c}) = max({c}) THEN min({c})::VARCHAR ELSE min({c})::VARCHAR || '-' || max({c})::VARCHAR END"
GROUPS_SQL = f"""WITH {ROWS_SQL}, g AS (
  SELECT routing, merchant, account, count(*) AS size, CAST(sum(amount) AS BIGINT) AS total, {RANGE_SQL('amount')} AS amount_range, {RANGE_SQL('date')} AS date_range,
    max(confidence) AS mc, arg_min(transaction_id, (-confidence, date, transaction_id)) AS representative FROM rows_ GROUP BY ALL)
SELECT row_number() OVER (ORDER BY routing, account_size DESC, account, mc DESC, merchant) AS rank, routing, merchant, account, size, total, amount_range, date_range, representative, account_size
FROM g JOIN (SELECT account, CAST(sum(size) AS BIGINT) AS account_size FROM g GROUP BY account) USING (account)"""


@query("q_review_groups", GROUPS_SQL)
def review_groups(spark, d):
    return C.review_groups(review_rows(spark, d))


DECISIONS = [("approve", None), ("correct", "view"), ("correct", "Click"), ("hold", None), ("split", None), (None, None), ("correct", "nothing"), ("what", None)]
ACCOUNTS = [("click", "Click"), ("view", "View"), ("error", "Error"), ("purchase", "Purchase")]


@query("q_expand_decisions", f"""
WITH {OBS_SQL}, g AS (SELECT content AS group_id, min(label) AS proposed, CAST(hash_ AS INT) AS h FROM (SELECT content, label, len(content) % 3 AS hash_ FROM obs) GROUP BY ALL),
words(i, decision, corrected) AS (VALUES {', '.join(f"({i}, {'NULL' if a is None else repr(a)}, {'NULL' if b is None else repr(b)})" for i, (a, b) in enumerate(DECISIONS))}),
accounts(account_id, name) AS (VALUES {', '.join(map(str, ACCOUNTS))}), named AS (SELECT account_id AS k, account_id AS f FROM accounts UNION ALL SELECT name, account_id FROM accounts),
gg AS (SELECT group_id, CASE WHEN h = 0 THEN NULL ELSE proposed END AS proposed, w.decision, w.corrected FROM (SELECT group_id, max(proposed) AS proposed, max(h) AS h FROM g GROUP BY 1) JOIN words w ON i = len(group_id) % 8),
m AS (SELECT id, proposed, CASE WHEN own.decision IS NOT NULL THEN own.decision ELSE gg.decision END AS dec, CASE WHEN own.decision IS NOT NULL THEN own.corrected ELSE gg.corrected END AS cor
  FROM obs JOIN gg ON group_id = content LEFT JOIN words own ON own.i = CASE WHEN id % 4 = 0 THEN id // 4 % 8 ELSE 5 END),
r AS (SELECT m.*, f FROM m LEFT JOIN named ON k = cor)
SELECT id AS transaction_id, CASE WHEN dec IS NULL THEN 'undecided' WHEN dec = 'approve' THEN CASE WHEN proposed IS NULL THEN 'invalid' ELSE 'approved' END WHEN dec = 'correct' THEN CASE WHEN f IS NULL THEN 'invalid' ELSE 'corrected' END
  WHEN dec = 'hold' THEN 'held' WHEN dec = 'split' THEN 'split' ELSE 'invalid' END AS status,
  CASE WHEN dec = 'approve' THEN proposed WHEN dec = 'correct' THEN f END AS account_id,
  CASE WHEN dec = 'approve' AND proposed IS NULL THEN 'no proposed account' WHEN dec = 'correct' AND f IS NULL THEN 'unknown account' WHEN dec NOT IN ('approve', 'correct', 'hold', 'split') THEN 'unknown decision' END AS problem FROM r""")
def expand_decisions(spark, d):
    o = obs(spark, d)
    words = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(DECISIONS)], "i int, decision string, corrected string")
    g = o.groupBy(F.col("content").alias("group_id")).agg(F.min("label").alias("lo")).withColumn("h", F.length("group_id") % 3)
    g = g.withColumn("proposed", F.when(F.col("h") != 0, F.col("lo")))
    groups = g.join(words, F.col("i") == F.length("group_id") % 8).select("group_id", "decision", "corrected", "proposed")
    own = F.when(F.col("id") % 4 == 0, (F.col("id") / 4).cast("long") % 8).otherwise(5)
    members = o.select("id", F.col("content").alias("group_id"), own.alias("_i")).join(words, F.col("_i") == F.col("i"), "left")
    members = members.select(F.col("id").alias("transaction_id"), "group_id", "decision", "corrected")
    return C.expand_decisions(members, groups, spark.createDataFrame(ACCOUNTS, "account_id string, name string"))


FUNDING = [("c_mktsegment", "auto", "company_card"), ("c_name", "0007", "personal"), ("c_mktsegment", "BUILD", "bank"), ("c_name", "#00000001", "cash")]
FUNDING_SQL = "CASE " + " ".join(f"WHEN contains(lower({c}), '{t.lower()}') THEN '{s}'" for c, t, s in FUNDING) + " ELSE 'unconfirmed' END"


@query("q_funding_rules", f"SELECT c_custkey, {FUNDING_SQL} AS funding FROM customer")
def funding_rules(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", C.funding_source(c, FUNDING).alias("funding"))


DECIDED_SQL = f"""{TX_SQL}, decided AS (SELECT transaction_id, date, side, value AS amount, 'acct' || connected_account_id AS account, CASE connected_account_id WHEN 0 THEN 'personal' WHEN 1 THEN 'cash' ELSE 'bank' END AS funding FROM tx),
branches AS (
  SELECT transaction_id, date, 1 AS branch, CASE WHEN side = 'EXPENSE' THEN account ELSE via END AS debit, CASE WHEN side = 'EXPENSE' THEN via ELSE account END AS credit, amount, funding, side
  FROM (SELECT *, CASE WHEN funding = 'personal' THEN 'payable' ELSE funding END AS via FROM decided)
  UNION ALL SELECT transaction_id, date, 2, CASE WHEN side = 'EXPENSE' THEN 'payable' ELSE 'loan' END, CASE WHEN side = 'EXPENSE' THEN 'loan' ELSE 'payable' END, amount, funding, side FROM decided WHERE funding = 'personal')"""


def branches(spark, d):
    a = F.col("connected_account_id")
    t = tx(spark, d).select("transaction_id", "date", "side", F.col("value").alias("amount"), F.concat(F.lit("acct"), a.cast("string")).alias("account"), F.when(a == 0, "personal").when(a == 1, "cash").otherwise("bank").alias("funding"), F.lit("payable").alias("payable"), F.lit("loan").alias("loan"))
    return C.journal_branches(t)


@query("q_journal_branches", f"WITH {DECIDED_SQL} SELECT transaction_id, branch, debit, credit, amount FROM branches")
def journal_branches(spark, d):
    return branches(spark, d).select("transaction_id", "branch", "debit", "credit", "amount")


@query("q_reconcile", f"""WITH {DECIDED_SQL}
SELECT funding, count(*) FILTER (branch = 1) AS journals, CAST(coalesce(sum(amount) FILTER (branch = 1 AND side = 'EXPENSE'), 0) AS BIGINT) AS out, CAST(coalesce(sum(amount) FILTER (branch = 1 AND side = 'INCOME'), 0) AS BIGINT) AS "in",
  CAST(sum(CASE WHEN debit = 'payable' THEN amount ELSE 0 END - CASE WHEN credit = 'payable' THEN amount ELSE 0 END) AS BIGINT) AS payable_net,
  CAST(sum(CASE WHEN debit = 'loan' THEN amount ELSE 0 END - CASE WHEN credit = 'loan' THEN amount ELSE 0 END) AS BIGINT) AS loan_net FROM branches GROUP BY funding""")
def reconcile(spark, d):
    return C.reconcile(branches(spark, d))


@query("q_validate_final", f"""WITH {DECIDED_SQL}, {TERMS_SQL},
c AS (SELECT 'unbalanced journals' AS "check", (SELECT count(*) FROM (SELECT transaction_id FROM (SELECT transaction_id, amount FROM branches WHERE debit IS NOT NULL UNION ALL SELECT transaction_id, -amount FROM branches WHERE credit IS NOT NULL) GROUP BY 1 HAVING sum(amount) <> 0)) AS count
UNION ALL SELECT 'zero or negative amounts', count(*) FROM branches WHERE NOT amount > 0
UNION ALL SELECT 'outside the fiscal year', count(*) FROM branches WHERE NOT date BETWEEN DATE '1996-08-01' AND DATE '1997-07-31'
UNION ALL SELECT 'several journals for a line item', (SELECT count(*) FROM (SELECT transaction_id FROM branches WHERE branch = 1 GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'payable left in a journal', (SELECT count(*) FROM (SELECT transaction_id FROM branches WHERE funding = 'personal' GROUP BY 1 HAVING sum(CASE WHEN debit = 'payable' THEN amount ELSE 0 END - CASE WHEN credit = 'payable' THEN amount ELSE 0 END) <> 0)))
SELECT "check", 'error' AS level, CASE WHEN count = 0 THEN 'pass' ELSE 'fail' END AS result, count FROM c""")
def validate_final(spark, d):
    b = branches(spark, d)
    sided = b.select("transaction_id", F.explode(F.array(F.when(F.col("debit").isNotNull(), F.col("amount")), F.when(F.col("credit").isNotNull(), -F.col("amount")))).alias("a"))
    pay = F.when(F.col("debit") == "payable", F.col("amount")).otherwise(0) - F.when(F.col("credit") == "payable", F.col("amount")).otherwise(0)
    return K.report(
        K.check("unbalanced journals", sided.groupBy("transaction_id").agg(F.sum("a").alias("s")).where("s <> 0")),
        K.row_checks(b, {"zero or negative amounts": F.col("amount") > 0, "outside the fiscal year": F.col("date").between("1996-08-01", "1997-07-31")}),
        K.unique_ids(b.where("branch = 1"), ["transaction_id"], "several journals for a line item"),
        K.check("payable left in a journal", b.where("funding = 'personal'").groupBy("transaction_id").agg(F.sum(pay).alias("s")).where("s <> 0")),
    )


@query("q_validate_load", """
WITH c AS (SELECT 'count is the declared total' AS "check", (SELECT abs(count(*) - max(o_orderkey)) FROM orders) AS count
UNION ALL SELECT 'ids are unique', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'line keys are unique', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'dates within range', (SELECT count(*) FROM orders WHERE NOT o_orderdate::DATE BETWEEN DATE '1995-06-01' AND DATE '2000-12-31')
UNION ALL SELECT 'known status', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')) UNION ALL SELECT 'id is there', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL))
SELECT "check", 'error' AS level, CASE WHEN count = 0 THEN 'pass' ELSE 'fail' END AS result, count FROM c""")
def validate_load(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    return K.report(
        K.declared_totals(o, o.agg(F.max("o_orderkey").alias("total_count")), "count is the declared total"), K.unique_ids(o, ["o_orderkey"], "ids are unique"), K.unique_ids(li, ["l_orderkey", "l_linenumber"], "line keys are unique"),
        K.row_checks(o, {"dates within range": F.col("o_orderdate").cast("date").between("1995-06-01", "2000-12-31"), "known status": F.col("o_orderstatus").isin("O", "F"), "id is there": F.col("o_orderkey").isNotNull()}),
    )


LEGS_SQL = """sided AS (SELECT journal_id, 'D' AS side, debit_account AS account, debit_sub AS sub, value FROM lines UNION ALL SELECT journal_id, 'C', credit_account, credit_sub, value FROM lines),
legs AS (SELECT journal_id, list_aggregate(list_sort(list(leg)), 'string_agg', '|') AS legs FROM (
  SELECT journal_id, side || ':' || account || ':' || coalesce(sub::VARCHAR, 'None') || ':' || value || ':' || count(*) AS leg FROM sided WHERE value <> 0 AND account <> '' GROUP BY journal_id, side, account, sub, value) GROUP BY 1),
heads AS (SELECT journal_id, arg_min(date, branch_index) AS date, arg_min(part, branch_index) % 3 AS remark FROM lines GROUP BY 1)"""


@query("q_legs", f"WITH {LINES_SQL}, {LEGS_SQL} SELECT journal_id, legs FROM legs")
def legs(spark, d):
    return C.legs(lines(spark, d))


#: Amounts of three sizes and years on every branch, so that equal journals of several branches exist.
WHOLE_SQL = f"""WITH {LINES_SQL.replace('lines AS (', 'all_lines AS (')}, lines AS (SELECT * REPLACE (value // 5000000 * 100 + 1 AS value, date_trunc('year', date)::DATE AS date) FROM all_lines), {LEGS_SQL}"""


@query("q_internal_duplicates", f"""{WHOLE_SQL}
SELECT date::VARCHAR AS date, legs, remark, count(*) AS n, min(journal_id) AS first, max(journal_id) AS last FROM legs JOIN heads USING (journal_id) GROUP BY ALL HAVING count(*) > 1""")
def internal_duplicates(spark, d):
    l = lines(spark, d).withColumns({"value": (F.expr("value div 5000000") * 100 + 1), "date": F.trunc("date", "year"), "remark": F.col("part") % 3})
    return C.internal_duplicates(l).withColumn("date", F.col("date").cast("string"))


@query("q_duplicate_levels", f"""WITH {LINES_SQL.replace('lines AS (', 'all_lines AS (')}, lines AS (SELECT * REPLACE (value // 10000 AS value) FROM all_lines), {LEGS_SQL}, k AS (SELECT DISTINCT journal_id, account, value, date FROM sided JOIN heads USING (journal_id) WHERE value <> 0),
p AS (SELECT DISTINCT a.journal_id AS new_id, b.journal_id AS old_id, a.date AS nd, b.date AS od FROM k a JOIN k b ON a.account = b.account AND a.value = b.value AND a.journal_id % 2 = 0 AND b.journal_id % 2 = 1 AND abs(date_diff('day', a.date, b.date)) <= 3)
SELECT new_id, old_id, CASE WHEN nd = od AND a.legs = b.legs THEN 'high' WHEN nd = od THEN 'medium' ELSE 'low' END AS level FROM p JOIN legs a ON a.journal_id = new_id JOIN legs b ON b.journal_id = old_id""")
def duplicate_levels(spark, d):
    l = journal_lines(spark, d).withColumn("value", F.expr("value div 10000"))
    return C.duplicate_candidates(l.where("journal_id % 2 = 0"), l.where("journal_id % 2 = 1"))


@query("q_amount_band_join", f"""WITH {OBS_SQL}, o AS (SELECT id, value // 100 AS amount, day AS date, label FROM obs)
SELECT a.id, count(b.id) AS n FROM o a LEFT JOIN o b ON a.amount = b.amount AND b.label = 'purchase' AND abs(date_diff('day', a.date, b.date)) <= 7 GROUP BY a.id""")
def amount_band_join(spark, d):
    o = obs(spark, d).select("id", F.expr("value div 100").alias("amount"), F.col("day").alias("date"), "label")
    return C.near_amounts(o, o.where("label = 'purchase'"), 7).select("id", "n")


@query("q_transfer_pairs", f"""WITH {OBS_SQL}, o AS (SELECT id, value // 100 AS amount, day AS date, CASE WHEN complex THEN 'INCOME' ELSE 'EXPENSE' END AS side, account FROM obs)
SELECT id FROM o a WHERE EXISTS (SELECT 1 FROM o b WHERE a.amount = b.amount AND a.side <> b.side AND a.account <> b.account AND abs(date_diff('day', a.date, b.date)) <= 3)""")
def transfer_pairs(spark, d):
    o = obs(spark, d).select("id", F.expr("value div 100").alias("amount"), F.col("day").alias("date"), F.when(F.col("complex"), "INCOME").otherwise("EXPENSE").alias("side"), "account")
    return C.transfer_pairs(o).select("id")


@query("q_prior_refunds", f"""WITH {OBS_SQL} SELECT id FROM obs t WHERE fy = 2003 AND label = 'purchase' AND EXISTS (SELECT 1 FROM obs h WHERE h.fy < 2003 AND h.value // 100 = t.value // 100 AND substr(trim(h.content), 1, 12) = substr(trim(t.content), 1, 12))""")
def prior_refunds(spark, d):
    o = obs(spark, d).withColumn("amount", F.expr("value div 100"))
    return Y.prior_refunds(o.where("fy = 2003 and label = 'purchase'"), o.where("fy < 2003")).select("id")


@query("q_import_layout", f"""WITH {LINES_SQL} SELECT dense_rank() OVER (ORDER BY journal_id) AS no, branch_index, strftime(date, '%Y/%m/%d') AS date, debit_account, credit_account, value FROM lines""")
def import_layout(spark, d):
    return C.import_layout(lines(spark, d)).select("no", "branch_index", "date", "debit_account", "credit_account", "value")


@query("q_net_compare", f"""WITH {LINES_SQL}, n AS (SELECT account, CAST(sum(v) FILTER (p) AS BIGINT) AS a, CAST(sum(v) FILTER (NOT p) AS BIGINT) AS b FROM (
  SELECT debit_account AS account, value AS v, journal_id % 2 = 0 AS p FROM lines UNION ALL SELECT credit_account, -value, journal_id % 2 = 0 FROM lines) GROUP BY 1)
SELECT account, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(a, 0) - coalesce(b, 0) AS difference FROM n""")
def net_compare(spark, d):
    l = lines(spark, d).withColumns({"debit_amount": F.col("value"), "credit_amount": F.col("value")})
    one = lambda w, n: I.net_by(l.where(w), ["account"]).withColumnRenamed("net", n)
    j = one("journal_id % 2 = 0", "a").join(one("journal_id % 2 = 1", "b"), "account", "full").fillna(0, ["a", "b"])
    return j.withColumn("difference", F.col("a") - F.col("b"))


@query("q_line_diff", f"""WITH {LINES_SQL}, b AS (SELECT journal_id, branch_index, CASE WHEN part % 50 = 0 THEN value + 1 ELSE value END AS value, CASE WHEN part % 70 = 0 THEN 'X' ELSE debit_account END AS debit_account FROM lines WHERE journal_id % 100 <> 0)
SELECT journal_id, branch_index, CASE WHEN b.value IS NULL THEN 'a' ELSE 'both' END AS only_in, concat_ws(',', CASE WHEN a.value IS DISTINCT FROM b.value THEN 'value' END, CASE WHEN a.debit_account IS DISTINCT FROM b.debit_account THEN 'debit_account' END) AS fields
FROM lines a LEFT JOIN b USING (journal_id, branch_index) WHERE b.value IS NULL OR a.value <> b.value OR a.debit_account <> b.debit_account""")
def line_diff(spark, d):
    a = lines(spark, d)
    b = a.where("journal_id % 100 <> 0").withColumns({"value": F.when(F.col("part") % 50 == 0, F.col("value") + 1).otherwise(F.col("value")), "debit_account": F.when(F.col("part") % 70 == 0, "X").otherwise(F.col("debit_account"))})
    return C.line_diff(a, b, ["journal_id", "branch_index"], ["value", "debit_account"])


FINAL_SQL = "CASE WHEN connected_account_id = 4 THEN 'excluded' WHEN transaction_id % 50 = 0 THEN 'merged_transfer' WHEN transaction_id % 20 = 0 THEN 'undecided' WHEN connected_account_id = 3 AND side = 'INCOME' THEN 'refund_review' WHEN n > 6 THEN 'structure_review' WHEN n IS NULL THEN 'funding_unconfirmed' ELSE 'generated' END"


@query("q_final_status", f"WITH {TX_SQL} SELECT {FINAL_SQL} AS status, side, count(*) AS n_items, CAST(sum(value) AS BIGINT) AS total FROM tx LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = transaction_id GROUP BY ALL")
def final_status(spark, d):
    n = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("transaction_id")).agg(F.count("*").alias("n"))
    t = tx(spark, d).join(n, "transaction_id", "left")
    s = (F.when(F.col("connected_account_id") == 4, "excluded").when(F.col("transaction_id") % 50 == 0, "merged_transfer").when(F.col("transaction_id") % 20 == 0, "undecided")
         .when((F.col("connected_account_id") == 3) & (F.col("side") == "INCOME"), "refund_review").when(F.col("n") > 6, "structure_review").when(F.col("n").isNull(), "funding_unconfirmed").otherwise("generated"))
    return t.groupBy(s.alias("status"), "side").agg(F.count("*").alias("n_items"), F.sum("value").alias("total"))


QUALITY_SQL = f"""WITH {TX_SQL}, {TERMS_SQL}, j AS (SELECT l_orderkey, count(DISTINCT l_suppkey % 2) AS n, CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS total FROM lineitem GROUP BY 1),
t AS (SELECT fiscal_year, side, CASE WHEN transaction_id % 4 = 0 THEN '' WHEN transaction_id % 4 = 1 THEN content || transaction_id ELSE content || ' ' END AS content, coalesce(n, 0) AS journals, coalesce(total % 7 = 0, false) AS amount_match
  FROM tx LEFT JOIN j ON l_orderkey = transaction_id JOIN terms ON date BETWEEN start_date AND end_date),
s AS (SELECT trim(content) AS c, count(*) AS seen FROM t GROUP BY 1), r AS (SELECT t.*, trim(content) AS c, seen FROM t JOIN s ON trim(content) = s.c),
m AS (SELECT coalesce(fiscal_year::VARCHAR, 'total') AS fiscal_year, count(*) AS transactions, count(*) FILTER (journals > 0) AS linked, count(*) FILTER (journals > 1) AS multi_journal, count(*) FILTER (journals > 0 AND amount_match) AS amount_match,
  count(*) FILTER (c <> '') AS content_present, count(*) FILTER (c <> '' AND seen > 1) AS content_repeated, count(*) FILTER (c <> '' AND seen = 1) AS content_unique, count(*) FILTER (side = 'INCOME') AS income FROM r GROUP BY ROLLUP (fiscal_year)),
q AS (SELECT *, round(linked / transactions, 4) AS linked_rate, round(amount_match / linked, 4) AS amount_match_rate, round(content_present / transactions, 4) AS content_rate FROM m)"""


def quality(spark, d):
    from ..operators.ledger import with_term

    li = table(spark, d, "lineitem")
    j = li.groupBy(F.col("l_orderkey").alias("transaction_id")).agg(F.countDistinct(F.col("l_suppkey") % 2).alias("n"), F.sum(F.round(F.col("l_extendedprice") * 100)).cast("long").alias("total"))
    t = with_term(tx(spark, d), terms(spark)).join(j, "transaction_id", "left")
    i = F.col("transaction_id") % 4
    content = F.when(i == 0, "").when(i == 1, F.concat("content", F.col("transaction_id").cast("string"))).otherwise(F.concat("content", F.lit(" ")))
    t = t.select("fiscal_year", "side", content.alias("content"), F.coalesce("n", F.lit(0)).alias("journals"), F.coalesce(F.col("total") % 7 == 0, F.lit(False)).alias("amount_match"))
    return U.line_item_quality(t)


@query("q_quality_report", f"{QUALITY_SQL} SELECT * FROM q")
def quality_report(spark, d):
    return quality(spark, d)


METRICS = ["transactions", "linked", "content_unique"]


@query("q_quality_long", QUALITY_SQL + " UNION ALL ".join(f" SELECT fiscal_year, '{m}' AS metric, {m}::DOUBLE AS value FROM q" for m in METRICS))
def quality_long(spark, d):
    return U.long_form(quality(spark, d), "fiscal_year", METRICS)


@query("q_field_profile", r"""
SELECT 'lang' AS field, 'string' AS type, count(*) AS present, count(*) FILTER (lang <> '') AS non_empty, count(*) FILTER (regexp_matches(lang, '@')) AS email, 0::BIGINT AS digits FROM documents
UNION ALL SELECT 'text', 'string', count(*), count(*) FILTER (text <> ''), count(*) FILTER (regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.-]+')), count(*) FILTER (regexp_matches(text, '\d{7,}')) FROM documents
UNION ALL SELECT 'n_chars', 'bigint', count(*), count(n_chars), 0, 0 FROM documents""")
def field_profile(spark, d):
    t = table(spark, d, "documents")
    return U.profile(t.select("lang", "text", "n_chars")).select("field", "type", "present", "non_empty", "email", "digits")


@query("q_value_counts", "SELECT coalesce(event_type, 'None') AS value, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, d):
    return U.value_counts(table(spark, d, "events"), "event_type")


@query("q_flatten_props", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "p.k" FROM events""")
def flatten_props(spark, d):
    e = table(spark, d, "events").select("event_id", F.from_json("props", T.StructType([T.StructField("k", T.LongType())])).alias("p"))
    return U.flatten(e)


@query("q_dedupe_first", f"WITH d AS (SELECT l_orderkey, l_linenumber, md5(concat_ws('|', l_partkey, l_suppkey)) AS v, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS r FROM lineitem) SELECT l_orderkey, l_linenumber, v FROM d WHERE r = 1")
def dedupe_first(spark, d):
    f = S.first_of(table(spark, d, "lineitem").select("l_orderkey", *LINE_ORDER), ["l_orderkey", "l_linenumber"], LINE_ORDER[1:])
    return f.select("l_orderkey", "l_linenumber", F.md5(F.concat_ws("|", "l_partkey", "l_suppkey")).alias("v"))


@query("q_union_sources", "SELECT source || '#' || id AS key, n FROM (SELECT 'orders' AS source, o_custkey AS id, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'events', user_id, count(*) FROM events GROUP BY ALL)")
def union_sources(spark, d):
    frames = {"orders": table(spark, d, "orders").select(F.col("o_custkey").alias("id")), "events": table(spark, d, "events").select(F.col("user_id").alias("id"))}
    return S.union_sources(frames, "id").groupBy("key").agg(F.count("*").alias("n"))


@query("q_resume_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resume_anti(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("q_set_diff", """SELECT 'ids' AS "check", 'error' AS level, CASE WHEN count = 0 THEN 'pass' ELSE 'fail' END AS result, count FROM (
  SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)) + (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)) AS count)""")
def set_diff(spark, d):
    return K.same_rows(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "ids")


ACTIONS = ["exclude", "set_account", "merged_into", "confirm_refund", "drop"]


@query("q_overrides_checked", f"""WITH {TX_SQL}, o AS (
  SELECT transaction_id + CASE WHEN transaction_id % 97 = 0 THEN 100000000 ELSE 0 END AS transaction_id, {ACTIONS}[transaction_id % 5 + 1] AS action, CASE WHEN transaction_id % 4 = 0 THEN 'nowhere' ELSE 'acct' || connected_account_id END AS account, transaction_id - 2 AS target FROM tx
  UNION ALL SELECT transaction_id, 'exclude', NULL, NULL FROM tx WHERE transaction_id % 101 = 0),
n AS (SELECT transaction_id, count(*) AS n FROM o GROUP BY 1), gone AS (SELECT DISTINCT transaction_id FROM o WHERE action = 'exclude'),
p AS (SELECT o.transaction_id, action, CASE WHEN n > 1 THEN 'repeated' WHEN o.transaction_id NOT IN (SELECT transaction_id FROM tx) THEN 'unknown line item' WHEN action = 'drop' THEN 'unknown action'
  WHEN action = 'set_account' AND account NOT IN ('acct0', 'acct1', 'acct2', 'acct3', 'acct4') THEN 'unknown account' WHEN action = 'merged_into' AND target NOT IN (SELECT transaction_id FROM tx) THEN 'unknown target'
  WHEN action = 'merged_into' AND target IN (SELECT transaction_id FROM gone) THEN 'target is excluded' END AS problem FROM o JOIN n USING (transaction_id))
SELECT transaction_id, action, problem FROM p WHERE problem IS NOT NULL""")
def overrides_checked(spark, d):
    t = tx(spark, d)
    i = F.col("transaction_id")
    o = t.select((i + F.when(i % 97 == 0, 100000000).otherwise(0)).alias("transaction_id"), F.element_at(F.array(*map(F.lit, ACTIONS)), (i % 5 + 1).cast("int")).alias("action"), F.when(i % 4 == 0, "nowhere").otherwise(F.concat(F.lit("acct"), F.col("connected_account_id").cast("string"))).alias("account"), (i - 2).alias("target_transaction_id"))
    o = o.unionByName(t.where(i % 101 == 0).select("transaction_id", F.lit("exclude").alias("action"), F.lit(None).cast("string").alias("account"), F.lit(None).cast("long").alias("target_transaction_id")))
    accounts = spark.range(5).select(F.concat(F.lit("acct"), F.col("id").cast("string")).alias("name"))
    return C.check_overrides(o, t, accounts)
