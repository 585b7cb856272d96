"""Queries of the year's end and of what surrounds it: final states, import file, load checks, quality, answers, reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators import backtest as B
from ..operators import checks as K
from ..operators import close as C
from ..operators import history as H
from ..operators import import_format as I
from ..operators import quality as U
from ..operators import ledger as L
from ..operators import reports as P
from ..operators import routing as R
from ..operators import scoring as O
from ..operators import sets as S
from ..operators import similarity as M
from ..operators import year_close as Y
from .adapters import LINES_SQL, OBS_SQL, TERMS_SQL, TX_SQL, lines, obs, table, terms, tx
from .q_history import GRID_SQL
from .q_ledger import CHAIN, LABEL_SQL, RESOLVED_SQL, linked, map_sql, resolved
from .q_routing import ITEMS_SQL, items
from .q_similarity import CANDIDATES_SQL, STAGED_SQL, norm_sql, staged, varied

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


FUNDING_SQL = "CASE connected_account_id WHEN 0 THEN 'personal' WHEN 1 THEN 'cash' WHEN 2 THEN 'unconfirmed' ELSE 'bank' END"
RECOMMENDATIONS = ["approve", "existing_auto_candidate", "correct", "exclude", "ask", "approve", "existing_auto_candidate", "nonsense"]
ROUTING_SQL = "CASE connected_sub_account_id % 3 WHEN 0 THEN 'rule_candidate' WHEN 1 THEN 'model_auto_candidate' ELSE 'human_review' END"
GROUPS_SQL = f"""groups_ AS (
  SELECT DISTINCT connected_sub_account_id AS review_group, {RECOMMENDATIONS}[connected_sub_account_id % 8 + 1] AS recommendation, {ROUTING_SQL} AS routing,
    CASE WHEN connected_sub_account_id = 8 THEN NULL WHEN connected_sub_account_id % 6 = 1 THEN 'loan' ELSE 'acct' || connected_sub_account_id % 4 END AS proposed,
    CASE WHEN connected_sub_account_id = 10 THEN 'nowhere' ELSE 'Name' || connected_sub_account_id % 4 END AS correction FROM tx),
decided AS (
  SELECT *, CASE WHEN recommendation = 'exclude' THEN 'excluded' WHEN recommendation = 'approve' OR (recommendation = 'existing_auto_candidate' AND routing <> 'human_review') THEN CASE WHEN proposed IS NULL THEN 'invalid' ELSE 'confirmed' END
      WHEN recommendation = 'correct' THEN CASE WHEN correction = 'nowhere' THEN 'invalid' ELSE 'confirmed' END WHEN recommendation = 'ask' THEN 'undecided' ELSE 'invalid' END AS status,
    CASE WHEN recommendation = 'approve' OR (recommendation = 'existing_auto_candidate' AND routing <> 'human_review') THEN proposed WHEN recommendation = 'correct' AND correction <> 'nowhere' THEN 'acct' || replace(correction, 'Name', '') END AS account_id,
    CASE WHEN (recommendation = 'approve' OR (recommendation = 'existing_auto_candidate' AND routing <> 'human_review')) AND proposed IS NULL THEN 'no proposed account' WHEN recommendation = 'correct' AND correction = 'nowhere' THEN 'unknown account'
      WHEN recommendation = 'existing_auto_candidate' AND routing = 'human_review' THEN 'not an automatic routing' WHEN recommendation = 'ask' THEN 'open question' WHEN recommendation = 'nonsense' THEN 'unknown recommendation' END AS problem FROM groups_)"""


def groups(spark, d):
    g = F.col("connected_sub_account_id")
    rec = F.element_at(F.array(*map(F.lit, RECOMMENDATIONS)), (g % 8 + 1).cast("int"))
    routing = F.when(g % 3 == 0, "rule_candidate").when(g % 3 == 1, "model_auto_candidate").otherwise("human_review")
    proposed = F.when(g == 8, F.lit(None)).when(g % 6 == 1, "loan").otherwise(F.concat(F.lit("acct"), (g % 4).cast("string")))
    correction = F.when(g == 10, "nowhere").otherwise(F.concat(F.lit("Name"), (g % 4).cast("string")))
    return tx(spark, d).select(g).distinct().select(g.alias("review_group"), rec.alias("recommendation"), routing.alias("routing"), proposed.alias("proposed"), correction.alias("correction"))


def accounts(spark):
    return spark.range(4).select(F.concat(F.lit("acct"), F.col("id").cast("string")).alias("account_id"), F.concat(F.lit("Name"), F.col("id").cast("string")).alias("name"))


@query("q_final_decision", f"WITH {TX_SQL}, {GROUPS_SQL} SELECT review_group, status, account_id, problem FROM decided")
def final_decision(spark, d):
    names = accounts(spark).withColumnsRenamed({"name": "correction", "account_id": "found"})
    g = groups(spark, d).join(names, "correction", "left")
    return g.select("review_group", Y.final_decision(F.col("recommendation"), F.col("routing"), F.col("proposed"), F.col("found")).alias("d")).select("review_group", "d.*")


OVERRIDES_SQL = """o AS (
  SELECT transaction_id, CASE transaction_id % 5 WHEN 0 THEN 'exclude' WHEN 1 THEN 'set_account' WHEN 2 THEN 'merged_into' WHEN 3 THEN 'confirm_refund' ELSE 'set_counter_sub_account' END AS action,
    'Name' || transaction_id % 6 AS account, 'Sub' || transaction_id % 3 AS counter_sub_account, CASE WHEN transaction_id % 5 = 2 THEN transaction_id + CASE WHEN transaction_id % 7 = 0 THEN 0 ELSE 1 END END AS target, 'by hand' AS reason
  FROM tx WHERE transaction_id % 40 BETWEEN 3 AND 9),
times AS (SELECT transaction_id, count(*) AS n FROM o GROUP BY 1), gone AS (SELECT transaction_id FROM o WHERE action = 'exclude'),
p AS (SELECT o.*, CASE WHEN n > 1 THEN 'repeated' WHEN action = 'set_counter_sub_account' AND counter_sub_account = 'Sub2' THEN 'unknown sub-account' WHEN action = 'set_account' AND account IN ('Name4', 'Name5') THEN 'unknown account'
  WHEN action = 'merged_into' AND (target = transaction_id OR target NOT IN (SELECT transaction_id FROM tx)) THEN 'bad target' WHEN action = 'merged_into' AND target IN (SELECT transaction_id FROM gone) THEN 'target is excluded' END AS problem FROM o JOIN times USING (transaction_id)),
resolved AS (SELECT transaction_id, action, CASE WHEN action = 'set_account' THEN 'acct' || replace(account, 'Name', '') END AS override_account_id, CASE WHEN action = 'set_counter_sub_account' THEN 's' || replace(counter_sub_account, 'Sub', '') END AS override_sub_id,
  CASE WHEN action = 'merged_into' THEN target END AS merged_into, reason FROM p WHERE problem IS NULL)"""


def overrides(spark, d):
    i = F.col("transaction_id")
    a = F.when(i % 5 == 0, "exclude").when(i % 5 == 1, "set_account").when(i % 5 == 2, "merged_into").when(i % 5 == 3, "confirm_refund").otherwise("set_counter_sub_account")
    o = tx(spark, d).where((i % 40).between(3, 9)).select(
        i, a.alias("action"), F.concat(F.lit("Name"), (i % 6).cast("string")).alias("account"), F.concat(F.lit("Sub"), (i % 3).cast("string")).alias("counter_sub_account"),
        F.when(i % 5 == 2, i + F.when(i % 7 == 0, 0).otherwise(1)).alias("target_transaction_id"), F.lit("by hand").alias("reason"),
    )
    subs = spark.range(2).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("sub_account_id"), F.concat(F.lit("Sub"), F.col("id").cast("string")).alias("name"))
    return Y.resolve_overrides(o, tx(spark, d), accounts(spark), subs)


@query("q_override_problems", f"WITH {TX_SQL}, {OVERRIDES_SQL} SELECT transaction_id, action, problem FROM p WHERE problem IS NOT NULL")
def override_problems(spark, d):
    return overrides(spark, d)[1]


@query("q_overrides_resolved", f"WITH {TX_SQL}, {OVERRIDES_SQL} SELECT transaction_id, action, override_account_id, override_sub_id, merged_into FROM resolved")
def overrides_resolved(spark, d):
    return overrides(spark, d)[0].drop("reason")


CLOSING_SQL = f"""{TX_SQL}, {GROUPS_SQL}, {OVERRIDES_SQL},
items AS (SELECT transaction_id, date, value AS amount, side, {FUNDING_SQL} AS funding, connected_sub_account_id AS review_group FROM tx),
stated AS (
  SELECT i.*, recommendation, routing, coalesce(action, '') AS act, merged_into, override_sub_id, reason, d.problem AS group_problem,
    CASE coalesce(action, '') WHEN 'exclude' THEN 'excluded' WHEN 'merged_into' THEN 'merged' WHEN 'set_account' THEN 'confirmed' ELSE d.status END AS status,
    CASE coalesce(action, '') WHEN 'exclude' THEN NULL WHEN 'set_account' THEN override_account_id ELSE d.account_id END AS account_id
  FROM items i JOIN decided d USING (review_group) LEFT JOIN resolved USING (transaction_id)),
closing AS (
  SELECT *, CASE WHEN status = 'excluded' THEN 'excluded' WHEN status = 'merged' THEN 'merged_transfer' WHEN status <> 'confirmed' THEN 'undecided' WHEN funding IN ('unconfirmed', 'other') THEN 'funding_unconfirmed'
    WHEN funding <> 'bank' AND side = 'INCOME' AND recommendation = 'existing_auto_candidate' AND act <> 'confirm_refund' THEN 'refund_review' WHEN funding <> 'bank' AND account_id IN ('payable', 'loan') THEN 'structure_review' ELSE 'generated' END AS journal_status FROM stated)"""


def closing(spark, d):
    a = F.col("connected_account_id")
    funding = F.when(a == 0, "personal").when(a == 1, "cash").when(a == 2, "unconfirmed").otherwise("bank")
    t = tx(spark, d).select("transaction_id", "date", F.col("value").alias("amount"), "side", funding.alias("funding"), F.col("connected_sub_account_id").alias("review_group"))
    return Y.closing_rows(t, groups(spark, d), overrides(spark, d)[0], accounts(spark), ["payable", "loan"], "acct0")


@query("q_closing_rows", f"""WITH {CLOSING_SQL} SELECT transaction_id, status, journal_status, account_id, merged_into, journal_status = 'generated' AND funding = 'bank' AND coalesce(account_id = 'acct0', false) AND override_sub_id IS NULL AS needs_bankbook_review,
  CASE WHEN journal_status = 'refund_review' THEN 'automatic refund, not reviewed' WHEN journal_status = 'structure_review' THEN 'account would undo the transfer' WHEN act IN ('exclude', 'merged_into') THEN 'override: by hand' WHEN act <> 'set_account' THEN group_problem END AS problem FROM closing""")
def closing_rows(spark, d):
    return closing(spark, d).select("transaction_id", "status", "journal_status", "account_id", "merged_into", "needs_bankbook_review", "problem")


@query("q_close_summary", f"""WITH {CLOSING_SQL} SELECT field, value, count(*) AS n, CAST(sum(amount) AS BIGINT) AS amount FROM (
  SELECT 'status' AS field, status AS value, amount FROM closing UNION ALL SELECT 'journal_status', journal_status, amount FROM closing UNION ALL SELECT 'funding', funding, amount FROM closing UNION ALL SELECT 'recommendation', recommendation, amount FROM closing) GROUP BY ALL""")
def close_summary(spark, d):
    return Y.close_summary(closing(spark, d), ["status", "journal_status", "funding", "recommendation"])


JOURNALS_SQL = f"""{CLOSING_SQL},
made AS (SELECT *, CASE WHEN funding = 'personal' THEN 'payable' ELSE funding END AS via, review_group % 4 AS card FROM closing WHERE journal_status = 'generated'),
branches AS (
  SELECT transaction_id AS journal_id, transaction_id, date, 1 AS branch, CASE WHEN side = 'EXPENSE' THEN account_id ELSE via END AS debit, CASE WHEN side = 'EXPENSE' THEN via ELSE account_id END AS credit, card, amount, funding FROM made
  UNION ALL SELECT transaction_id, transaction_id, date, 2, CASE WHEN side = 'EXPENSE' THEN 'payable' ELSE 'loan' END, CASE WHEN side = 'EXPENSE' THEN 'loan' ELSE 'payable' END, CASE WHEN card = 3 AND transaction_id % 9 = 0 THEN 0 ELSE card END, amount, funding FROM made WHERE funding = 'personal'
  UNION ALL SELECT transaction_id + 50000000, transaction_id, date, 1, account_id, via, card, amount, funding FROM made WHERE transaction_id % 113 = 0)"""


def final_branches(spark, d):
    t = closing(spark, d).where("journal_status = 'generated'").withColumn("card", F.col("review_group") % 4)
    j = C.journal_branches(t.select("transaction_id", "date", "side", "amount", F.col("account_id").alias("account"), "funding", F.lit("payable").alias("payable"), F.lit("loan").alias("loan")))
    j = j.join(t.select("transaction_id", "card"), "transaction_id")
    sub = F.when((F.col("branch") == 2) & (F.col("card") == 3) & (F.col("transaction_id") % 9 == 0), 0).otherwise(F.col("card"))
    j = j.select(F.col("transaction_id").alias("journal_id"), "transaction_id", "date", "branch", "debit", "credit", sub.alias("debit_sub"), sub.alias("credit_sub"), "amount", F.col("amount").alias("credit_amount"), "funding")
    again = t.where("transaction_id % 113 = 0").withColumn("via", F.when(F.col("funding") == "personal", "payable").otherwise(F.col("funding")))
    again = again.select((F.col("transaction_id") + 50000000).alias("journal_id"), "transaction_id", "date", F.lit(1).alias("branch"), F.col("account_id").alias("debit"), F.col("via").alias("credit"), F.col("card").alias("debit_sub"), F.col("card").alias("credit_sub"), "amount", F.col("amount").alias("credit_amount"), "funding")
    return j.unionByName(again)


CHECK_ROW = """SELECT "check", 'error' AS level, CASE WHEN count = 0 THEN 'pass' ELSE 'fail' END AS result, count FROM c"""


@query("q_final_checks", f"""WITH {JOURNALS_SQL},
legs AS (SELECT journal_id, funding, debit AS account, card AS sub, amount AS v FROM branches UNION ALL SELECT journal_id, funding, credit, card, -amount FROM branches),
c AS (SELECT 'journals balance' AS "check", (SELECT count(*) FROM (SELECT journal_id FROM legs GROUP BY 1 HAVING sum(v) <> 0)) AS count
UNION ALL SELECT 'no zero or negative amounts', count(*) FROM branches WHERE amount <= 0 UNION ALL SELECT 'within the year', count(*) FROM branches WHERE NOT date BETWEEN DATE '1995-08-01' AND DATE '2000-07-31'
UNION ALL SELECT 'excluded and merged items have no journal', count(*) FROM closing WHERE status IN ('excluded', 'merged') AND transaction_id IN (SELECT transaction_id FROM branches)
UNION ALL SELECT 'every other item has a journal', count(*) FROM closing WHERE status NOT IN ('excluded', 'merged') AND journal_status <> 'generated'
UNION ALL SELECT 'merge targets have a journal', count(*) FROM closing WHERE status = 'merged' AND merged_into NOT IN (SELECT transaction_id FROM branches)
UNION ALL SELECT 'no open questions', count(*) FROM closing WHERE recommendation = 'ask'
UNION ALL SELECT 'the payable nets to zero in one sub-account', count(*) FROM (SELECT DISTINCT journal_id FROM branches WHERE funding = 'personal' EXCEPT SELECT journal_id FROM (SELECT journal_id, sub, sum(v) AS net FROM legs WHERE funding = 'personal' AND account = 'payable' GROUP BY ALL) GROUP BY 1 HAVING bool_and(net = 0))
UNION ALL SELECT 'one journal a line item', count(*) FROM (SELECT transaction_id FROM branches GROUP BY 1 HAVING count(DISTINCT journal_id) > 1)) {CHECK_ROW}""")
def final_checks(spark, d):
    return Y.final_checks(closing(spark, d), final_branches(spark, d), "1995-08-01", "2000-07-31")


@query("q_journal_numbers", f"WITH {CLOSING_SQL} SELECT row_number() OVER (ORDER BY date, transaction_id) AS journal_no, transaction_id FROM closing WHERE journal_status = 'generated'")
def journal_numbers(spark, d):
    return Y.number_journals(closing(spark, d).where("journal_status = 'generated'").select("transaction_id", "date")).select(F.col("journal_no").cast("long"), "transaction_id")


PROPOSAL_SQL = f"""CASE WHEN funding = 'unconfirmed' THEN 'funding_unconfirmed' WHEN funding = 'other' THEN 'not_applicable' WHEN side = 'INCOME' AND funding <> 'bank' THEN 'refund_review' WHEN funding <> 'bank' AND coalesce(account IN ('payable', 'loan'), false) THEN 'structure_review'
  WHEN coalesce(account, '') = '' THEN 'no_proposed_account' WHEN status IS DISTINCT FROM 'confirmed' THEN 'awaiting_decision' ELSE 'ready' END"""


@query("q_proposal_status", f"""WITH {TX_SQL}, t AS (SELECT transaction_id, side, CASE connected_account_id WHEN 4 THEN 'other' ELSE {FUNDING_SQL} END AS funding, CASE WHEN transaction_id % 11 = 0 THEN NULL WHEN transaction_id % 13 = 0 THEN 'loan' ELSE 'acct1' END AS account, CASE WHEN transaction_id % 3 = 0 THEN 'confirmed' WHEN transaction_id % 3 = 1 THEN 'hold' END AS status FROM tx)
SELECT transaction_id, {PROPOSAL_SQL} AS journal_status FROM t""")
def proposal_status(spark, d):
    i, a = F.col("transaction_id"), F.col("connected_account_id")
    funding = F.when(a == 4, "other").when(a == 0, "personal").when(a == 1, "cash").when(a == 2, "unconfirmed").otherwise("bank")
    account = F.when(i % 11 == 0, F.lit(None)).when(i % 13 == 0, "loan").otherwise("acct1")
    status = F.when(i % 3 == 0, "confirmed").when(i % 3 == 1, "hold")
    return tx(spark, d).select(i, Y.proposal_status(funding, F.col("side"), account, status, ["payable", "loan"]).alias("journal_status"))


REVIEW_SQL = f"""{OBS_SQL}, items AS (SELECT id AS transaction_id, day AS date, content, value AS amount, CASE WHEN complex THEN 'INCOME' ELSE 'EXPENSE' END AS side, CASE id % 3 WHEN 0 THEN 'rule_candidate' WHEN 1 THEN 'model' ELSE 'human_review' END AS routing, CASE WHEN id % 4 > 0 THEN label END AS pred, CASE WHEN id % 10 = 0 THEN 'E' ELSE 'A' END AS layer FROM obs),
results AS (SELECT id AS rid, CASE WHEN id % 17 > 0 THEN label END AS account, (id * 7919 % 1000) / 1000.0 AS conf, id % 11 = 0 AS review FROM obs WHERE id % 5 > 0),
r AS (SELECT i.*, CASE WHEN routing <> 'model' THEN routing WHEN layer = 'A' AND account IS NOT NULL AND conf >= 0.9 AND NOT review THEN 'model_auto_candidate' ELSE 'human_review' END AS to_, CASE WHEN routing = 'model' THEN account ELSE pred END AS account_id,
    CASE WHEN routing = 'model' THEN 'model' WHEN routing = 'rule_candidate' THEN 'rule' WHEN pred IS NOT NULL THEN 'rule_reference' ELSE 'none' END AS source, regexp_replace(regexp_replace(lower(content), '[^a-z0-9_]', '', 'g'), '[0-9]{{6,}}', '#', 'g') AS key
  FROM items i LEFT JOIN results ON rid = transaction_id),
k AS (SELECT *, CASE to_ WHEN 'rule_candidate' THEN 0 WHEN 'model_auto_candidate' THEN 1 ELSE 2 END AS o, coalesce(account_id, '') AS aid FROM r),
gs AS (SELECT o, aid, key, count(*) AS group_size, min((date, transaction_id)) AS first FROM k GROUP BY ALL),
g AS (SELECT *, row_number() OVER (ORDER BY o, CASE WHEN aid = '' THEN '' ELSE 'n-' || aid END, key, first) AS review_group FROM gs)"""


@query("q_review_rows", f"WITH {REVIEW_SQL} SELECT review_group, group_size, transaction_id, to_ AS routing, source, account_id FROM k JOIN g USING (o, aid, key)")
def review_rows(spark, d):
    return reviewed(spark, d).select(F.col("review_group").cast("long"), "group_size", "transaction_id", "routing", "source", "account_id")


def reviewed(spark, d):
    o, i = obs(spark, d), F.col("id")
    routing = F.when(i % 3 == 0, "rule_candidate").when(i % 3 == 1, "model").otherwise("human_review")
    t = o.select(i.alias("transaction_id"), F.col("day").alias("date"), "content", F.col("value").alias("amount"), F.when(F.col("complex"), "INCOME").otherwise("EXPENSE").alias("side"), routing.alias("routing"), F.when(i % 4 > 0, F.col("label")).alias("pred"), F.when(i % 10 == 0, "E").otherwise("A").alias("layer"))
    r = o.where(i % 5 > 0).select(i.alias("transaction_id"), F.when(i % 17 > 0, F.col("label")).alias("account_id"), (i * 7919 % 1000 / 1000.0).alias("confidence"), (i % 11 == 0).alias("needs_review"), F.lit(False).alias("insufficient"))
    names = o.select(F.col("label").alias("account_id")).distinct().withColumn("name", F.concat(F.lit("n-"), "account_id"))
    return Y.review_rows(t, r, names, ascii_only=True)


@query("q_past_counter_accounts", f"""WITH {OBS_SQL}, n AS (SELECT account AS sub_account, content AS merchant, 'bank' || value % 3 AS counter_sub, count(*) AS n, max(day) AS last FROM obs WHERE label = 'purchase' AND value % 3 > 0 GROUP BY ALL)
SELECT sub_account, merchant, string_agg(counter_sub || ' x' || n || ', last ' || last, '; ' ORDER BY n DESC, counter_sub) AS text FROM n GROUP BY ALL""")
def past_counter_accounts(spark, d):
    v = F.col("value") % 3
    h = obs(spark, d).select(F.col("account").alias("sub_account"), F.col("content").alias("merchant"), F.col("day").alias("date"), F.col("label").alias("account_id"), F.when(v > 0, F.concat(F.lit("bank"), v.cast("string"))).alias("counter_sub"))
    return Y.past_counter_accounts(h, "purchase")


@query("q_prior_refund_items", f"""WITH {OBS_SQL} SELECT id FROM obs t WHERE fy = 2003 AND EXISTS (SELECT 1 FROM obs h WHERE h.fy < 2003 AND h.value // 100 = t.value // 100 AND substr(trim(h.content), 1, 12) = substr(trim(t.content), 1, 12))""")
def prior_refund_items(spark, d):
    o = obs(spark, d).withColumn("amount", F.expr("value div 100"))
    return Y.prior_refunds(o.where("fy = 2003"), o.where("fy < 2003")).select("id")


@query("q_target_parts", f"""WITH {OBS_SQL}, t AS (SELECT id, 'svc' || account AS service, account % 2 = 0 AND contains(upper(content), '7') AND NOT contains(upper(content), '17') AS dup FROM obs) SELECT id, CASE WHEN service IN ('svc3') THEN 'excluded_service' WHEN dup THEN 'duplicate_candidate' ELSE 'target' END AS part,
  CASE WHEN service IN ('svc1') THEN 'lineage:f' WHEN service = 'svc2' THEN 'lineage:g' ELSE replace(service, 'svc', '') END AS lineage FROM t""")
def target_parts(spark, d):
    service = F.concat(F.lit("svc"), F.col("account").cast("string"))
    dup = Y.keyword_duplicate(F.col("content"), F.col("account") % 2 == 0, ["7"], ["17"], ascii_only=True)
    return obs(spark, d).select("id", Y.target_part(service, ["svc3"], dup).alias("part"), Y.lineage(F.col("account"), service, {"f": "svc1", "g": "svc2"}).alias("lineage"))


# Import file.

IMPORT_SQL = f"""{LINES_SQL}, src AS (
  SELECT journal_id * 7 AS journal_no, branch_index AS branch, 't' || journal_id AS transaction_id, date, debit_account, 's' || debit_sub AS debit_sub, credit_account, CASE WHEN credit_sub > 0 THEN 's' || credit_sub ELSE '' END AS credit_sub, value AS amount,
    CASE WHEN part % 97 = 0 THEN 5 ELSE 0 END AS tax_value, CASE WHEN branch_index = 1 AND journal_id % 31 = 0 THEN '' ELSE 'r' || part END AS remark FROM lines),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY journal_no) AS no FROM src)"""


def import_lines(spark, d):
    l = lines(spark, d)
    one = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    tax = F.when(F.col("part") % 97 == 0, 5).otherwise(0)
    return l.select(
        (F.col("journal_id") * 7).cast("string").alias("journal_no"), F.col("branch_index").alias("branch"), F.concat(F.lit("t"), F.col("journal_id").cast("string")).alias("transaction_id"), "date", "debit_account", one("debit_sub").alias("debit_sub"), F.lit(I.NO_TAX).alias("debit_tax"),
        F.col("value").alias("debit_amount"), tax.alias("debit_tax_value"), "credit_account", F.when(F.col("credit_sub") > 0, one("credit_sub")).otherwise("").alias("credit_sub"), F.lit(I.NO_TAX).alias("credit_tax"), F.col("value").alias("credit_amount"), F.lit(0).alias("credit_tax_value"),
        F.when((F.col("branch_index") == 1) & (F.col("journal_id") % 31 == 0), "").otherwise(F.concat(F.lit("r"), F.col("part").cast("string"))).alias("remark"),
    )


def _import_columns() -> str:
    values = {"取引No": "no", "取引日": "strftime(date, '%Y/%m/%d')", "借方勘定科目": "debit_account", "借方補助科目": "debit_sub", "借方税区分": f"'{I.NO_TAX}'", "借方金額(円)": "amount", "借方税額": "CAST(tax_value AS BIGINT)", "貸方勘定科目": "credit_account", "貸方補助科目": "credit_sub", "貸方税区分": f"'{I.NO_TAX}'", "貸方金額(円)": "amount", "貸方税額": "CAST(0 AS BIGINT)", "摘要": "remark"}
    return ", ".join(f"""{values.get(c, "''")} AS "{c}\"""" for c in I.COLUMNS)


@query("q_import_rows", f"WITH {IMPORT_SQL} SELECT {_import_columns()}, CAST(branch AS BIGINT) AS branch FROM numbered")
def import_rows(spark, d):
    return I.import_rows(import_lines(spark, d))


@query("q_import_index", f"WITH {IMPORT_SQL} SELECT no, journal_no, transaction_id, date FROM numbered WHERE branch = 1")
def import_index(spark, d):
    return I.journal_index(import_lines(spark, d))


def parsed(spark, d):
    """What the import file says when it is read back, a few of its rows changed."""
    rows = I.import_rows(import_lines(spark, d)).withColumn("position", F.col("取引No") * 1000 + F.col("branch"))
    changed = rows.withColumns({"タグ": F.when(F.col("取引No") % 501 == 0, "x").otherwise(""), "取引日": F.when(F.col("取引No") % 701 == 0, F.replace("取引日", F.lit("/"), F.lit("-"))).otherwise(F.col("取引日"))})
    return I.parse_rows(changed.drop("branch"))


@query("q_import_parsed", f"""WITH {IMPORT_SQL} SELECT no, CAST(branch AS INT) AS branch, date::VARCHAR AS date, debit_account, debit_sub, amount AS debit_amount, credit_account, credit_sub, remark, CASE WHEN no % 501 = 0 THEN 'タグ' ELSE '' END AS filled FROM numbered""")
def import_parsed(spark, d):
    return parsed(spark, d).select("no", "branch", "date", "debit_account", "debit_sub", "debit_amount", "credit_account", "credit_sub", "remark", F.array_join("filled_blanks", ",").alias("filled"))


@query("q_import_journals", f"""WITH {IMPORT_SQL} SELECT no, count(*) AS n, string_agg(debit_account || ':' || amount, ',' ORDER BY branch) AS debits FROM numbered GROUP BY no""")
def import_journals(spark, d):
    g = I.group_journals(parsed(spark, d))
    return g.select("no", F.size("lines").cast("long").alias("n"), F.array_join(F.transform("lines", lambda x: F.concat(x["debit_account"], F.lit(":"), x["debit_amount"].cast("string"))), ",").alias("debits"))


@query("q_import_checks", f"""WITH {IMPORT_SQL}, s AS (SELECT no, debit_account AS account, debit_sub AS sub, tax_value, amount FROM numbered UNION ALL SELECT no, credit_account, credit_sub, 0, amount FROM numbered),
used AS (SELECT DISTINCT account, sub FROM s), tx_ AS (SELECT 't' || o_orderkey AS id, CASE WHEN o_orderkey % 300 = 0 THEN 'excluded' WHEN o_orderkey % 300 = 1 THEN 'merged' END AS status, 't' || (o_orderkey + 1) AS target FROM orders),
c AS (SELECT 'blank columns are blank' AS "check", (SELECT count(*) FROM numbered WHERE no % 501 = 0) AS count UNION ALL SELECT 'dates have slashes', count(*) FROM numbered WHERE no % 701 = 0
UNION ALL SELECT 'every journal is there', 0 UNION ALL SELECT 'debits as in the source', 0 UNION ALL SELECT 'credits as in the source', 0 UNION ALL SELECT 'debits equal credits', 0 UNION ALL SELECT 'accounts net as in the source', 0 UNION ALL SELECT 'sub-accounts net as in the source', 0
UNION ALL SELECT 'date, amount and remark are there', count(DISTINCT no) FROM numbered WHERE amount = 0 OR (branch = 1 AND trim(remark) = '')
UNION ALL SELECT 'accounts exist, sub-accounts are unique', count(*) FROM used WHERE account = 'O' OR (sub <> '' AND (account = 'F' OR sub IN ('s2', 's3')))
UNION ALL SELECT 'no tax', count(*) FROM s WHERE tax_value <> 0 UNION ALL SELECT 'no side without an amount', count(*) FROM s WHERE amount <= 0
UNION ALL SELECT 'one journal a line item', count(*) FROM (SELECT transaction_id FROM numbered WHERE branch = 1 GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'excluded items are not there', count(*) FROM tx_ WHERE status = 'excluded' AND id IN (SELECT transaction_id FROM numbered)
UNION ALL SELECT 'merged items are not there, their targets are', count(*) FILTER (id IN (SELECT transaction_id FROM numbered)) + count(*) FILTER (target NOT IN (SELECT transaction_id FROM numbered)) FROM tx_ WHERE status = 'merged') {CHECK_ROW}""")
def import_checks(spark, d):
    """Accounts A, N, R and F exist, O does not; s0 and s1 are unique under the first three."""
    i = F.col("o_orderkey")
    t = table(spark, d, "orders").select(F.concat(F.lit("t"), i.cast("string")).alias("transaction_id"), F.when(i % 300 == 0, "excluded").when(i % 300 == 1, "merged").alias("status"), F.concat(F.lit("t"), (i + 1).cast("string")).alias("merged_into"))
    known = spark.createDataFrame([(a, a) for a in "ANRF"], "account_id string, name string")
    subs = spark.createDataFrame([(f"{a}{s}{k}", a, f"s{s}") for a in "ANR" for s in range(3) for k in range(1 + (s == 2))], "sub_account_id string, account_id string, name string")
    source = import_lines(spark, d)
    return I.import_checks(parsed(spark, d), source, I.journal_index(source), known, subs, t)


@query("q_expected_legs", f"""WITH {LINES_SQL}, l AS (SELECT journal_id, list_aggregate(list_sort(list(leg)), 'string_agg', '|') AS legs FROM (SELECT journal_id, side || ':' || account || ':' || sub || ':' || value || ':' || count(*) AS leg FROM (
  SELECT journal_id, 'D' AS side, debit_account AS account, debit_sub AS sub, value FROM lines UNION ALL SELECT journal_id, 'C', credit_account, credit_sub, value FROM lines) WHERE value <> 0 GROUP BY journal_id, side, account, sub, value) GROUP BY 1)
SELECT o_orderkey AS transaction_id, CASE WHEN legs IS NULL THEN 'no journal' WHEN o_orderkey % 10 = 0 THEN 'a journal' ELSE 'other legs' END AS problem FROM orders LEFT JOIN l ON journal_id = o_orderkey
WHERE (o_orderkey % 10 = 0 AND legs IS NOT NULL) OR (o_orderkey % 10 = 1) OR (o_orderkey % 10 > 1 AND legs IS NULL)""")
def expected_legs(spark, d):
    """What journals have is expected, but nothing of every tenth line item, and something else of the next."""
    i = F.col("transaction_id")
    have = C.legs(lines(spark, d)).withColumnRenamed("journal_id", "transaction_id")
    e = tx(spark, d).select("transaction_id").join(have, "transaction_id", "left").withColumn("legs", F.when(i % 10 == 0, "").when(i % 10 == 1, "X").otherwise(F.coalesce("legs", F.lit("?"))))
    return I.expected_legs(lines(spark, d), e)


# Load checks and quality over nested journals.


def nested(spark, d):
    """Orders' lines as nested journals: a branch of every fiftieth part has no debit side, every hundredth part no side at all."""
    l = lines(spark, d)
    side = lambda s, gone: F.when(~gone, F.struct(F.col(f"{s}_sub").cast("string").alias("sub_account_id"), F.col("value"), F.when(F.col("part") % 7 == 0, F.lit("p")).otherwise("").alias("trade_partner_code"), F.lit(None).cast("string").alias("trade_partner_name")))
    p = F.col("part")
    b = F.struct("branch_index", F.when(p % 3 == 0, "").otherwise("r").alias("remark"), side("debit", p % 50 == 0).alias("debitor"), side("credit", p % 100 == 0).alias("creditor"))
    j = l.groupBy("journal_id").agg(F.array_sort(F.collect_list(b)).alias("branches"), F.min("date").alias("date"))
    i = F.col("journal_id")
    return j.select(i, F.when(i % 600 != 0, i).alias("id"), F.when(i % 9 != 0, i).alias("transaction_id"), F.when(i % 40 == 0, U.OPENING).otherwise("NORMAL").alias("entered_by"), F.when(i % 55 != 0, F.col("date").cast("string")).otherwise("none").alias("transaction_date"), "date", "branches")


NESTED_SQL = f"""{LINES_SQL}, b AS (SELECT *, part % 50 = 0 AS no_d, part % 100 = 0 AS no_c FROM lines),
j AS (SELECT journal_id, min(date) AS date, CASE WHEN journal_id % 9 <> 0 THEN journal_id END AS transaction_id, journal_id % 40 = 0 AS opening, count(*) AS n, bool_or(part % 3 <> 0) AS remark, bool_or(part % 7 = 0 AND NOT (no_d AND no_c)) AS partner, bool_or(no_d AND no_c) AS bare FROM b GROUP BY 1)"""


@query("q_journal_checks", f"""WITH {NESTED_SQL}, c AS (SELECT 'journals: count is the declared total' AS "check", (SELECT abs(max(o_orderkey) - (SELECT count(*) FROM j)) FROM orders) AS count
UNION ALL SELECT 'journals: ids are unique', (SELECT CASE WHEN count(*) > 1 THEN 1 ELSE 0 END FROM j WHERE journal_id % 600 = 0) UNION ALL SELECT 'journals: id is there', count(*) FROM j WHERE journal_id % 600 = 0
UNION ALL SELECT 'journals: date within the range', count(*) FROM j WHERE journal_id % 55 = 0 OR NOT date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31'
UNION ALL SELECT 'journals: branches are there', 0 UNION ALL SELECT 'journals: every branch has a side', count(*) FROM j WHERE bare UNION ALL SELECT 'journals: values are whole numbers', 0) {CHECK_ROW}""")
def journal_checks(spark, d):
    totals = table(spark, d, "orders").agg(F.max("o_orderkey").alias("total_count"))
    return K.journal_checks(nested(spark, d), totals, "1995-06-01", "2000-12-31")


@query("q_line_item_checks", f"""WITH {TX_SQL}, c AS (SELECT 'line items: count is the declared total' AS "check", (SELECT abs(count(*) - max(transaction_id)) FROM tx) AS count UNION ALL SELECT 'line items: ids are unique', 0 UNION ALL SELECT 'line items: id is there', 0
UNION ALL SELECT 'line items: date within the range', count(*) FROM tx WHERE transaction_id % 77 = 0 OR NOT date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31' UNION ALL SELECT 'line items: value is a whole number', count(*) FROM tx WHERE transaction_id % 78 = 0
UNION ALL SELECT 'line items: known side', count(*) FROM tx WHERE transaction_id % 79 = 0 UNION ALL SELECT 'line items: known status', count(*) FROM tx WHERE status NOT IN ('O', 'F') UNION ALL SELECT 'line items: sub-account is there', count(*) FROM tx WHERE connected_sub_account_id = 0) {CHECK_ROW}""")
def line_item_checks(spark, d):
    i = F.col("transaction_id")
    t = tx(spark, d).select(i.alias("id"), F.when(i % 77 == 0, "soon").otherwise(F.col("date").cast("string")).alias("date"), F.when(i % 78 == 0, "1.5").otherwise(F.col("value").cast("string")).alias("value"), F.when(i % 79 == 0, "OTHER").otherwise(F.col("side")).alias("side"),
                            F.col("status").alias("journalizing_status"), F.when(F.col("connected_sub_account_id") > 0, F.col("connected_sub_account_id").cast("string")).alias("connected_sub_account_id"))
    return K.line_item_checks(t, t.agg(F.max("id").alias("total_count")), "1995-06-01", "2000-12-31", ["O", "F"])


METRICS_SQL = f"""{TX_SQL}, {TERMS_SQL}, {NESTED_SQL},
jf AS (SELECT j.*, fiscal_year FROM j JOIN terms ON date BETWEEN start_date AND end_date),
jm AS (SELECT coalesce(fiscal_year::VARCHAR, 'total') AS fiscal_year, count(*) AS journals_total, count(*) FILTER (NOT opening) AS journals_normal, count(*) FILTER (NOT opening AND transaction_id IS NOT NULL) AS journals_with_transaction_id,
  count(*) FILTER (NOT opening AND transaction_id IN (SELECT transaction_id FROM tx)) AS journals_with_transaction_id_matched, count(*) FILTER (NOT opening AND n > 1) AS journals_multi_branch, count(*) FILTER (NOT opening AND remark) AS journals_with_remark, count(*) FILTER (NOT opening AND partner) AS journals_with_trade_partner FROM jf GROUP BY ROLLUP (fiscal_year)),
net AS (SELECT t.transaction_id, CAST(sum(CASE WHEN s.sub = t.bank THEN CASE WHEN side = 'EXPENSE' THEN -v ELSE v END ELSE 0 END) AS BIGINT) AS net FROM (SELECT *, connected_sub_account_id % 3 AS bank FROM tx) t JOIN (SELECT journal_id, debit_sub AS sub, value AS v FROM b WHERE NOT no_d UNION ALL SELECT journal_id, credit_sub, -value FROM b WHERE NOT no_c) s ON s.journal_id = t.transaction_id AND t.transaction_id % 9 <> 0 GROUP BY 1),
tf AS (SELECT tx.transaction_id, fiscal_year, CASE WHEN tx.transaction_id % 4 = 0 THEN '' WHEN tx.transaction_id % 4 = 1 THEN content || tx.transaction_id // 6 ELSE content || ' ' END AS content, side, status, tx.transaction_id % 9 <> 0 AND tx.transaction_id IN (SELECT journal_id FROM j) AS linked, CASE WHEN tx.transaction_id % 5 = 0 THEN net ELSE value END = net AS match
  FROM tx JOIN terms ON date BETWEEN start_date AND end_date LEFT JOIN net ON net.transaction_id = tx.transaction_id),
seen AS (SELECT trim(content) AS c, count(*) AS k FROM tf WHERE trim(content) <> '' GROUP BY 1), tt AS (SELECT tf.*, trim(content) AS c, k FROM tf LEFT JOIN seen ON trim(content) = c),
tm AS (SELECT coalesce(fiscal_year::VARCHAR, 'total') AS fiscal_year, count(*) AS transactions, count(*) FILTER (status = 'O') AS transactions_journalized, count(*) FILTER (linked) AS transactions_linked, count(*) FILTER (linked AND status = 'O') AS made_linked, 0::BIGINT AS transactions_multi_journal,
  count(*) FILTER (linked AND match) AS transactions_amount_match, count(*) FILTER (c <> '') AS content_present, count(*) FILTER (c = '') AS content_empty, count(*) FILTER (k > 1) AS content_repeated_rows, count(DISTINCT CASE WHEN k > 1 THEN c END) AS content_repeated_distinct, count(*) FILTER (k = 1) AS content_unique_rows FROM tt GROUP BY ROLLUP (fiscal_year)),
q AS (SELECT *, round(journals_with_remark / journals_normal, 4) AS journals_with_remark_rate, round(journals_with_trade_partner / journals_normal, 4) AS journals_with_trade_partner_rate, round(transactions_linked / transactions, 4) AS transactions_linked_rate, round(made_linked / nullif(transactions_journalized, 0), 4) AS transactions_linked_rate_of_journalized,
  round(transactions_amount_match / nullif(transactions_linked, 0), 4) AS transactions_amount_match_rate, round(content_present / transactions, 4) AS content_present_rate FROM jm FULL JOIN tm USING (fiscal_year))"""


def metrics_input(spark, d):
    from ..operators.ledger import with_term

    i = F.col("transaction_id")
    content = F.when(i % 4 == 0, "").when(i % 4 == 1, F.concat("content", F.expr("transaction_id div 6").cast("string"))).otherwise(F.concat("content", F.lit(" ")))
    j = with_term(nested(spark, d), terms(spark))
    t = with_term(tx(spark, d), terms(spark)).withColumns({"content": content, "bank_sub": (F.col("connected_sub_account_id") % 3).cast("string"), "status": F.when(F.col("status") == "O", "registered").otherwise("none")})
    net = U.bank_side_net(j, t)
    return j, t.join(net, "transaction_id", "left").withColumn("value", F.when(i % 5 == 0, F.coalesce("net", "value")).otherwise(F.col("value"))).drop("net")


@query("q_quality_metrics", f"WITH {METRICS_SQL} SELECT * EXCLUDE (made_linked) FROM q")
def quality_metrics(spark, d):
    return U.quality_metrics(*metrics_input(spark, d))


PIVOT = [("journals", "journals_total", None), ("linked", "transactions_linked", "transactions_linked_rate"), ("of journalized", None, "transactions_linked_rate_of_journalized"), ("content", "content_present", "content_present_rate")]
PIVOT_YEARS = ["1995", "1996", "total"]
_COUNT_SQL = lambda c: f"format('{{:,}}', {c})"
_SHARE_SQL = lambda c: f"format('{{:.1f}}%', {c} * 100)"
_CELL_SQL = [_COUNT_SQL("journals_total"), f"{_COUNT_SQL('transactions_linked')} || ' (' || {_SHARE_SQL('transactions_linked_rate')} || ')'", _SHARE_SQL("transactions_linked_rate_of_journalized"), f"{_COUNT_SQL('content_present')} || ' (' || {_SHARE_SQL('content_present_rate')} || ')'"]


@query("q_quality_pivot", f"WITH {METRICS_SQL} " + " UNION ALL ".join(f"SELECT {i} AS row, '{PIVOT[i][0]}' AS label, " + ", ".join(f"""coalesce(max({c}) FILTER (fiscal_year = '{y}'), '-') AS "{y}\"""" for y in PIVOT_YEARS) + " FROM q" for i, c in enumerate(_CELL_SQL)))
def quality_pivot(spark, d):
    return U.pivot_report(U.quality_metrics(*metrics_input(spark, d)), PIVOT, PIVOT_YEARS)


@query("q_quality_counts", f"WITH {METRICS_SQL} SELECT coalesce(fiscal_year::VARCHAR, 'total') AS fiscal_year, 'entered_by' AS metric, CASE WHEN opening THEN '{U.OPENING}' ELSE 'NORMAL' END AS value, count(*) AS n FROM jf GROUP BY GROUPING SETS ((fiscal_year, opening), (opening)) UNION ALL SELECT coalesce(fiscal_year::VARCHAR, 'total'), 'side', side, count(*) FROM tt GROUP BY GROUPING SETS ((fiscal_year, side), (side))")
def quality_counts(spark, d):
    j, t = metrics_input(spark, d)
    return U.year_counts(j, "entered_by", "entered_by").unionByName(U.year_counts(t, "side", "side"))


#: The nested journals as JSON text whose types differ from row to row: numbers that are texts, a null, an object or a list in another's place.
RAW_SQL = f"""WITH {LINES_SQL}, e AS (SELECT journal_id, branch_index, journal_id % 11 = 0 AS texts, part, value, debit_sub, date FROM lines),
raw AS (SELECT journal_id, to_json({{'id': journal_id, 'date': min(date)::VARCHAR, 'note': CASE journal_id % 4 WHEN 0 THEN '""' WHEN 1 THEN 'null' WHEN 2 THEN '"a' || journal_id || '@b.jp 090-1111-2222"' ELSE '{{"text": "1234567", "tags": []}}' END::JSON,
  'branches': list({{'value': CASE WHEN texts THEN to_json(value::VARCHAR) ELSE to_json(value) END, 'debitor': CASE WHEN part % 50 = 0 THEN 'null'::JSON ELSE to_json({{'sub_account_id': debit_sub::VARCHAR}}) END}} ORDER BY branch_index)}})::JSON AS json FROM e GROUP BY journal_id),
tree AS (SELECT trim(regexp_replace(regexp_replace(fullkey, '\\[\\d+\\]', '[]', 'g'), '^\\$\\.?', '')) AS field, type, atom, value, atom ->> '$' AS text FROM raw, json_tree(raw.json))"""


@query("q_nested_profile", f"""{RAW_SQL}, k AS (SELECT field, CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind, value::VARCHAR AS value, CASE WHEN type = 'VARCHAR' THEN text END AS text FROM tree WHERE field <> '')
SELECT field, string_agg(DISTINCT kind, '|' ORDER BY kind) AS types, count(*) AS present, count(*) FILTER (kind <> 'null' AND value NOT IN ('""', '[]', '{{}}')) AS non_empty, count(*) FILTER (regexp_matches(text, '{X.EMAIL}')) AS email, count(*) FILTER (regexp_matches(text, '{X.PHONE_LOOSE}')) AS phone, count(*) FILTER (regexp_matches(text, '{X.LONG_DIGITS}')) AS digits,
  min(CASE WHEN field = 'date' THEN substr(text, 1, 10) END) AS first, max(CASE WHEN field = 'date' THEN substr(text, 1, 10) END) AS last FROM k GROUP BY field""")
def nested_profile(spark, d):
    i, l = F.col("journal_id"), lines(spark, d)
    raw_value = F.when(i % 11 == 0, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).otherwise(F.col("value").cast("string"))
    debitor = F.when(F.col("part") % 50 == 0, "null").otherwise(F.concat(F.lit('{"sub_account_id": "'), F.col("debit_sub").cast("string"), F.lit('"}')))
    b = F.struct("branch_index", F.concat(F.lit('{"value": '), raw_value, F.lit(', "debitor": '), debitor, F.lit("}")).alias("b"))
    j = l.groupBy(i).agg(F.array_join(F.sort_array(F.collect_list(b))["b"], ", ").alias("branches"), F.min("date").cast("string").alias("date"))
    note = F.when(i % 4 == 0, '""').when(i % 4 == 1, "null").when(i % 4 == 2, F.concat(F.lit('"a'), i.cast("string"), F.lit('@b.jp 090-1111-2222"'))).otherwise('{"text": "1234567", "tags": []}')
    raw = j.select(F.concat(F.lit('{"id": '), i.cast("string"), F.lit(', "date": "'), "date", F.lit('", "note": '), note, F.lit(', "branches": ['), "branches", F.lit("]}")).alias("json"))
    return U.profile_json(raw, "json", "date")


# Answers, payloads and reports.

ANSWERS = ['{"primary_account_code": "A001", "confidence": 0.9, "reason": "x", "needs_review": false, "insufficient_information": false}', '{"primary_account_code": null, "confidence": 0.2, "reason": "x", "needs_review": true, "insufficient_information": true}', "no json", '{"primary_account_code": "A999", "confidence": 0.5}', '{"primary_account_code": "A002", "confidence": 1.5}', None, '{"primary_account_code": "A002", "confidence": 1.0, "needs_review": false}']
ANSWERS_SQL = "[" + ", ".join("NULL" if a is None else f"'{a}'" for a in ANSWERS) + "]"


@query("q_parse_answers", f"""WITH {OBS_SQL}, a AS (SELECT id, CASE WHEN id % 23 = 0 THEN 'max_tokens' ELSE 'end_turn' END AS stop, id % 7 AS k FROM obs)
SELECT id AS transaction_id, CASE k WHEN 0 THEN 'acc1' WHEN 4 THEN 'acc2' WHEN 6 THEN 'acc2' END AS account_id, CASE k WHEN 0 THEN 0.9 WHEN 1 THEN 0.2 WHEN 3 THEN 0.5 WHEN 4 THEN 1.5 WHEN 6 THEN 1.0 END::DOUBLE AS confidence,
  CASE k WHEN 0 THEN false WHEN 1 THEN true WHEN 6 THEN false END AS needs_review, CASE WHEN stop <> 'end_turn' THEN 'unexpected stop' WHEN k = 5 THEN 'no text' WHEN k = 2 THEN 'not JSON' WHEN k = 3 THEN 'unknown account code' WHEN k = 4 THEN 'confidence out of range' END AS problem FROM a""")
def parse_answers(spark, d):
    i = F.col("id")
    a = obs(spark, d).select(i.alias("transaction_id"), F.when(i % 23 == 0, "max_tokens").otherwise("end_turn").alias("stop_reason"), F.element_at(F.array(*map(F.lit, ANSWERS)), (i % 7 + 1).cast("int")).alias("text"))
    catalog = spark.createDataFrame([("A001", "acc1"), ("A002", "acc2")], "code string, account_id string")
    return O.parse_answers(a, catalog).select("transaction_id", "account_id", "confidence", "needs_review", "problem")


@query("q_payloads", f"""WITH {OBS_SQL} SELECT id, '{{"past_similar_transactions":[{{"content":"c","similarity":' || id % 100 || '}}],"transaction":{{"account_kind":"' || CASE WHEN account = 0 THEN 'bank' WHEN account = 1 THEN 'liability' ELSE 'other' END || '","amount_band":"' || CASE {' '.join(f"WHEN abs(value) < {u} THEN '{n}'" for u, n in X.AMOUNT_BANDS)} ELSE '{X.AMOUNT_TOP}' END
  || '","content":"' || label || ' <NUM>","date":"' || day || '","side":"' || CASE WHEN complex THEN '入金' ELSE '出金' END || '"}}}}' AS payload FROM obs""")
def payloads(spark, d):
    a = F.col("account")
    kind = Y.account_kind(F.when(a == 0, "CASH_AND_DEPOSITS"), F.when(a == 1, "LIABILITY"))
    cands = F.array(F.struct(F.lit("c").alias("content"), (F.col("id") % 100).alias("similarity")))
    side = F.when(F.col("complex"), "INCOME").otherwise("EXPENSE")
    return obs(spark, d).select("id", O.payload(F.concat("label", F.lit(" 12345678")), side, F.col("value"), F.col("day"), kind, cands).alias("payload"))


CATALOGUE_SQL = "catalogue AS (SELECT p_brand AS code, min(p_name) AS name, min(p_type) AS grp, count(*)::VARCHAR AS category FROM part GROUP BY p_brand)"


@query("q_prompts", f"""WITH {OBS_SQL}, {CATALOGUE_SQL}, system_ AS (SELECT 'Codes:' || chr(10) || string_agg(concat_ws(chr(9), code, name, grp, category), chr(10) ORDER BY code) AS text FROM catalogue)
SELECT id, md5(text || chr(10) || 'Account?' || chr(10) || '{{"content":' || to_json(content)::VARCHAR || ',"value":' || value || '}}') AS prompt, length(text)::BIGINT AS system_length FROM obs CROSS JOIN system_""")
def prompts(spark, d):
    """The system text is one row of a bounded catalogue, the request one a line item."""
    catalogue = table(spark, d, "part").groupBy(F.col("p_brand").alias("code")).agg(F.min("p_name").alias("name"), F.min("p_type").alias("group"), F.count("*").cast("string").alias("category"))
    system = O.system_text(catalogue, "Codes:\n").scalar()
    asked = obs(spark, d).select("id", O.prompt(F.to_json(F.struct("content", "value")), "Account?").alias("request")).withColumn("system", system)
    return asked.select("id", F.md5(F.concat("system", F.lit("\n"), "request")).alias("prompt"), F.length("system").cast("long").alias("system_length"))


@query("q_past_summary", f"""{CANDIDATES_SQL}, c AS (SELECT near.key, near.day, rank, match, CAST(round_even(score, 0) AS BIGINT) AS similarity, occurrences, labels FROM near JOIN tops ON tops.match = near.match AND tops.day = near.day),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY key, day ORDER BY similarity <> 100, rank) = 1)
SELECT key, day::VARCHAR AS day, CASE WHEN similarity = 100 THEN occurrences ELSE 0 END AS n, CASE WHEN similarity = 100 THEN 'exact: ' || labels ELSE 'similar ' || similarity || ' ' || match || ': ' || labels END AS text FROM best""".replace("SELECT near.key, near.day, rank, match,", "SELECT near.key, near.day, rank, near.match,"))
def past_summary(spark, d):
    return Y.past_summary(M.candidates_before(varied(spark, d), ascii_only=True)).withColumn("day", F.col("day").cast("string"))


@query("q_usage_cost", f"""WITH {OBS_SQL} SELECT CASE id % 2 WHEN 0 THEN 'm' ELSE 's' END AS model, round(sum(((id % 900) * p + (id % 50) * p * 1.25 + (id % 70) * c + (id % 30) * o) / 1e6), 6) AS cost FROM obs JOIN (VALUES (0, 2.0, 10.0, 0.2), (1, 1.0, 5.0, 0.1)) AS v(k, p, o, c) ON id % 2 = k GROUP BY 1""")
def usage_cost(spark, d):
    i = F.col("id")
    u = obs(spark, d).select(i.alias("transaction_id"), F.when(i % 2 == 0, "m").otherwise("s").alias("model"), (i % 900).alias("input"), (i % 30).alias("output"), (i % 50).alias("cache_write"), (i % 70).alias("cache_read"))
    prices = spark.createDataFrame([("m", 2.0, 10.0, 0.2), ("s", 1.0, 5.0, 0.1)], "model string, input_price double, output_price double, cache_price double")
    return O.cost(u, prices).groupBy("model").agg(F.round(F.sum("cost"), 6).alias("cost"))


@query("q_budget", f"""WITH {OBS_SQL}, t AS (SELECT count(*) AS items, CAST(sum(id % 500 + 1000) AS BIGINT) AS counted, CAST(sum(id % 500 + 900) AS BIGINT) AS estimated FROM obs),
b AS (SELECT *, round(((counted - items * 600) * 2.0 + 600 * 2.0 * 1.25 + (items - 1) * 600 * 0.2 + items * 300 * 10.0) / 1e6, 6) AS cost_cached, round((counted * 2.0 + items * 300 * 10.0) / 1e6, 6) AS cost_plain FROM t) SELECT *, CASE WHEN counted > 2 * estimated THEN 'more tokens than estimated' WHEN cost_cached > 5.0 THEN 'cost above the limit' END AS problem FROM b""")
def budget(spark, d):
    i = F.col("id")
    return O.budget(obs(spark, d).select((i % 500 + 1000).alias("counted"), (i % 500 + 900).alias("estimated")), 600, 300, (2.0, 10.0, 0.2), 5.0)


@query("q_year_features", f"""WITH {OBS_SQL}, y AS (SELECT t.id, h.fy, h.label, count(*) AS n, min((h.day, h.id)) AS first FROM obs t JOIN obs h ON h.content = t.content AND h.day < t.day GROUP BY ALL),
top AS (SELECT id, fy, arg_min(label, (-n, first)) AS label FROM y GROUP BY ALL) SELECT obs.id, CASE WHEN count(top.id) > 0 THEN count(top.id) END AS hist_fy_count, CASE WHEN count(top.id) > 0 THEN count(DISTINCT top.label) > 1 END AS fy_label_change FROM obs LEFT JOIN top ON top.id = obs.id GROUP BY obs.id""")
def year_features(spark, d):
    o = obs(spark, d)
    return R.history_features(o).select("id", "hist_fy_count", "fy_label_change")


@query("q_side_seen", f"""WITH {OBS_SQL}, s AS (SELECT *, CASE WHEN value % 3 = 0 THEN 'INCOME' ELSE 'EXPENSE' END AS side FROM obs) SELECT t.id, bool_or(h.side = t.side) AS side_seen FROM s t LEFT JOIN s h ON h.content = t.content AND h.day < t.day GROUP BY t.id""")
def side_seen(spark, d):
    o = obs(spark, d).withColumn("side", F.when(F.col("value") % 3 == 0, "INCOME").otherwise("EXPENSE"))
    return R.history_features(o).select("id", "side_seen")


@query("q_window_report", f"""WITH {OBS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY day DESC, id DESC) AS r, count(*) OVER (PARTITION BY content) AS total FROM obs WHERE fy < 2004), w(w) AS (VALUES (0), (10), (5), (3), (2)),
u AS (SELECT content, w, label, count(*) AS n, max((day, id)) AS last FROM r, w WHERE (w = 0 OR r <= w) AND total >= 2 GROUP BY ALL),
s AS (SELECT content, w, arg_max(label, (n, last)) AS mode, max(n) / sum(n) AS agreement, count(*) > 1 AS changed FROM u GROUP BY ALL)
SELECT s.w AS "window", count(*) AS contents, round(avg(round(s.agreement, 4)), 4) AS agreement, count(*) FILTER (round(s.agreement, 4) = 1) AS unanimous, count(*) FILTER (s.changed) AS changed, count(*) FILTER (s.mode <> a.mode) AS other_mode FROM s JOIN (SELECT content, mode FROM s WHERE w = 0) a USING (content) GROUP BY 1""")
def window_report(spark, d):
    return H.window_report(H.window_stats(obs(spark, d).where("fy < 2004")))


@query("q_mode_changes", f"""WITH {OBS_SQL}, p AS (SELECT content, arg_max(label, (n, last)) AS m FROM (SELECT content, label, count(*) AS n, max((day, id)) AS last FROM obs WHERE fy < 2004 GROUP BY ALL) GROUP BY 1),
q AS (SELECT content, arg_min(label, (-n, first)) AS m FROM (SELECT content, label, count(*) AS n, min((day, id)) AS first FROM obs WHERE fy = 2004 GROUP BY ALL) GROUP BY 1) SELECT count(*) AS contents, count(*) FILTER (p.m <> q.m) AS changed FROM p JOIN q USING (content)""")
def mode_changes(spark, d):
    return H.mode_changes(obs(spark, d), 2004)


@query("q_content_report", f"""WITH {OBS_SQL}, u AS (SELECT content || id // 900 AS content, label, count(*) AS n, min((day, id)) AS first, max((day, id)) AS last FROM obs GROUP BY ALL), s AS (SELECT content, sum(n) AS count, count(*) AS labels, arg_min(label, (-n, first)) AS top, max(n) / sum(n) AS ratio, arg_max(label, last) AS latest FROM u GROUP BY 1)
SELECT field, value, count(*) AS contents, CAST(sum(count) AS BIGINT) AS rows FROM (SELECT 'count' AS field, CASE WHEN count >= 10 THEN '10+' WHEN count >= 5 THEN '5-9' WHEN count >= 2 THEN '2-4' ELSE '1' END AS value, count FROM s
UNION ALL SELECT 'top share', CASE WHEN round(ratio, 4) >= 1 THEN '100%' WHEN round(ratio, 4) >= .9 THEN '90-99%' WHEN round(ratio, 4) >= .7 THEN '70-89%' WHEN round(ratio, 4) >= .5 THEN '50-69%' ELSE '<50%' END, count FROM s WHERE count > 1
UNION ALL SELECT 'labels', CASE WHEN labels > 1 THEN 'several' ELSE 'one' END, count FROM s WHERE count > 1 UNION ALL SELECT 'latest is top', (latest = top)::VARCHAR, count FROM s WHERE count > 1) GROUP BY ALL""")
def content_report(spark, d):
    o = obs(spark, d).withColumn("content", F.concat("content", F.expr("id div 900").cast("string")))
    return P.content_report(H.content_stats(o))


@query("q_content_years", f"""WITH {OBS_SQL}, u AS (SELECT content, fy, label, count(*) AS n, min((day, id)) AS first FROM obs GROUP BY ALL), t AS (SELECT content, fy, arg_min(label, (-n, first)) AS top, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY ALL),
c AS (SELECT content, sum(n) AS n, count(*) AS years, count(DISTINCT top) > 1 AS changed FROM t GROUP BY 1) SELECT years, count(*) AS contents, count(*) FILTER (changed) AS changed FROM c WHERE n > 1 GROUP BY 1""")
def content_years(spark, d):
    return P.year_report(H.content_years(obs(spark, d)))


@query("q_labels_by_year", f"""WITH {OBS_SQL}, u AS (SELECT content, fy, label, count(*) AS n, min((day, id)) AS first FROM obs GROUP BY ALL) SELECT content, fy, string_agg(label || ':' || n, ',' ORDER BY n DESC, first) AS labels FROM u GROUP BY ALL""")
def labels_by_year(spark, d):
    return H.labels_by_year(obs(spark, d))


@query("q_link_report", f"WITH {TX_SQL} SELECT status, count(*) AS n, count(*) FILTER (transaction_id IN (SELECT l_orderkey FROM lineitem)) AS linked FROM tx GROUP BY 1")
def link_report(spark, d):
    return P.link_report(tx(spark, d), lines(spark, d))


@query("q_stage_buckets", f"""{STAGED_SQL}, b AS (SELECT *, CASE WHEN stage IN ('raw_exact', 'norm_exact') THEN stage WHEN score >= 95 THEN 'fuzzy 95-99' WHEN score >= 90 THEN 'fuzzy 90-94' WHEN score >= 85 THEN 'fuzzy 85-89' WHEN score >= 80 THEN 'fuzzy 80-84' WHEN score >= 70 THEN 'fuzzy 70-79' ELSE 'fuzzy <70' END AS bucket FROM preds WHERE stage <> 'none')
SELECT list_position(['raw_exact', 'norm_exact', 'fuzzy 95-99', 'fuzzy 90-94', 'fuzzy 85-89', 'fuzzy 80-84', 'fuzzy 70-79', 'fuzzy <70'], bucket) AS place, bucket, count(*) AS n, round(count(*) FILTER (pred = label) / count(*), 4) AS accuracy FROM b GROUP BY ALL""")
def stage_buckets(spark, d):
    order = ["raw_exact", "norm_exact", *(f"fuzzy {b}" for b in ("95-99", "90-94", "85-89", "80-84", "70-79", "<70"))]
    return P.bucket_accuracy(staged(spark, d), X.stage_band(F.col("stage"), F.col("score")), order).withColumn("place", F.col("place").cast("int"))


@query("q_combinations", f"""{STAGED_SQL}, r AS (SELECT rule, coalesce(hit AND stage <> 'none', false) AS hit, pred = label AS ok FROM (
  SELECT 'exact, 3 uses, unanimous' AS rule, stage IN ('raw_exact', 'norm_exact') AND hist_n >= 3 AND agreement = 1 AS hit, stage, pred, label FROM preds UNION ALL SELECT 'exact, 80 %', stage IN ('raw_exact', 'norm_exact') AND agreement >= 0.8, stage, pred, label FROM preds UNION ALL SELECT 'fuzzy 85', stage = 'fuzzy' AND score >= 85, stage, pred, label FROM preds))
SELECT rule, count(*) FILTER (hit) AS n, round(count(*) FILTER (hit) / count(*), 4) AS share, CASE WHEN count(*) FILTER (hit) > 0 THEN round(count(*) FILTER (hit AND ok) / count(*) FILTER (hit), 4) END AS accuracy FROM r GROUP BY 1""")
def combinations(spark, d):
    exact = F.col("stage").isin("raw_exact", "norm_exact")
    rules = {"exact, 3 uses, unanimous": exact & (F.col("hist_n") >= 3) & (F.col("agreement") == 1), "exact, 80 %": exact & (F.col("agreement") >= 0.8), "fuzzy 85": (F.col("stage") == "fuzzy") & (F.col("score") >= 85)}
    return P.combination_accuracy(staged(spark, d), rules)


@query("q_simulation", f"""{STAGED_SQL}, {ITEMS_SQL}, e AS (SELECT unnest([0.6, 0.7, 0.8, 0.9])::DOUBLE AS least), m AS (SELECT unnest(['model', 'unflagged', 'agreed']) AS mode),
r AS (SELECT least, mode, high, rule_ok, model_ok, coalesce(model_label IS NOT NULL AND conf >= least AND CASE mode WHEN 'model' THEN true WHEN 'unflagged' THEN needs_review IS NOT DISTINCT FROM false ELSE coalesce(agree, false) END, false) AS took FROM judged CROSS JOIN e CROSS JOIN m),
g AS (SELECT least, mode, count(*) AS n, count(*) FILTER (high OR took) AS auto, count(*) FILTER (CASE WHEN high THEN coalesce(rule_ok, false) ELSE took AND model_ok END) AS ok FROM r GROUP BY ALL)
SELECT least, mode, auto, round(auto / n, 4) AS coverage, round(ok / nullif(auto, 0), 4) AS accuracy, auto - ok AS errors FROM g""")
def simulation(spark, d):
    return R.simulate(items(spark, d), [0.6, 0.7, 0.8, 0.9])


@query("q_category_report", f"""{STAGED_SQL}, {ITEMS_SQL} SELECT kind, value, count(*) AS n, round(count(*) FILTER (model_ok) / count(*), 4) AS accuracy FROM (
  SELECT 'layer' AS kind, layer AS value, model_ok FROM judged UNION ALL SELECT 'category', CASE x {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in R.CATEGORIES.items())} END, model_ok FROM (SELECT unnest(CASE WHEN len(letters) = 0 AND NOT high THEN ['E'] ELSE letters END) AS x, model_ok FROM judged)) GROUP BY ALL""")
def category_report(spark, d):
    return R.category_report(items(spark, d).withColumn("ok", F.col("model_ok")))


@query("q_ensembles", f"""WITH {OBS_SQL}, s AS (SELECT label, CASE WHEN id % 10 < 8 THEN label ELSE 'other' END AS a, CASE WHEN id % 7 < 6 THEN label ELSE 'none' END AS b, (id * 7919 % 1000) / 1000.0 AS ac, (id * 6007 % 1000) / 1000.0 AS bc FROM obs WHERE id % 3 > 0 AND id % 4 > 0),
r AS (SELECT 'both' AS ensemble, ac >= .7 AND bc >= .7 AND a = b AS took, a = label AS ok FROM s UNION ALL SELECT 'a', ac >= .7, a = label FROM s UNION ALL SELECT 'b', bc >= .7, b = label FROM s)
SELECT ensemble, count(*) FILTER (took) AS n, round(count(*) FILTER (took) / count(*), 4) AS coverage, round(count(*) FILTER (took AND ok) / count(*) FILTER (took), 4) AS accuracy FROM r GROUP BY 1""")
def ensembles(spark, d):
    o, i = obs(spark, d), F.col("id")
    a = o.where(i % 3 > 0).select(i.alias("transaction_id"), F.when(i % 10 < 8, F.col("label")).otherwise("other").alias("choice"), (i * 7919 % 1000 / 1000.0).alias("confidence"))
    b = o.where(i % 4 > 0).select(i.alias("transaction_id"), F.when(i % 7 < 6, F.col("label")).otherwise("none").alias("choice"), (i * 6007 % 1000 / 1000.0).alias("confidence"))
    return R.ensembles(R.join_answers(a, b, o.select(i.alias("transaction_id"), "label")))


@query("q_set_ops", "SELECT 'only_orders' AS kind, count(*) AS n FROM (SELECT o_custkey FROM orders EXCEPT SELECT user_id FROM events) UNION ALL SELECT 'both', count(*) FROM (SELECT o_custkey FROM orders INTERSECT SELECT user_id FROM events)")
def set_ops(spark, d):
    a, b = table(spark, d, "orders").select(F.col("o_custkey").alias("id")), table(spark, d, "events").select(F.col("user_id").alias("id"))
    count = lambda x, kind: x.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(S.only_in(a, b, "id"), "only_orders").unionByName(count(S.in_both(a, b, "id"), "both"))


@query("q_first_source", "SELECT id, source FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o, pos) AS r FROM (SELECT o_custkey AS id, 'orders' AS source, 0 AS o, o_orderkey AS pos FROM orders UNION ALL SELECT user_id, 'events', 1, event_id FROM events)) WHERE r = 1")
def first_source(spark, d):
    frames = [table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.lit("orders").alias("source"), F.col("o_orderkey").alias("at")), table(spark, d, "events").select(F.col("user_id").alias("id"), F.lit("events").alias("source"), F.col("event_id").alias("at"))]
    return S.first_source(frames, ["id"], ["at"]).select("id", "source")


@query("q_reasons_fixed", f"""WITH {OBS_SQL}, r AS (SELECT id, CASE id % 4 WHEN 0 THEN '過去の履歴と一貫' WHEN 1 THEN '金額が不明' WHEN 2 THEN 'x' ELSE '類似の店' END AS t FROM obs),
k(name, word) AS (VALUES {", ".join(f"('{n}', '{w}')" for n, ws in X.REASON_WORDS for w in ws)}), h AS (SELECT DISTINCT id, name FROM r JOIN k ON contains(t, word)) SELECT category, count(*) AS n FROM (SELECT name AS category FROM h UNION ALL SELECT '{X.REASON_NONE}' FROM r WHERE id NOT IN (SELECT id FROM h)) GROUP BY 1""")
def reasons_fixed(spark, d):
    i = F.col("id") % 4
    t = F.when(i == 0, "過去の履歴と一貫").when(i == 1, "金額が不明").when(i == 2, "x").otherwise("類似の店")
    return obs(spark, d).select(F.explode(X.reason_categories_fixed(t)).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query("q_raw_only", f"{STAGED_SQL} SELECT fy, count(*) FILTER (stage = 'raw_exact') AS covered, count(*) FILTER (stage = 'raw_exact' AND pred = label) AS correct FROM preds GROUP BY 1")
def raw_only(spark, d):
    p = M.raw_only(staged(spark, d))
    return p.groupBy("fy").agg(F.count("pred").alias("covered"), F.count_if("correct").alias("correct"))


@query("q_select_rules", f"""{GRID_SQL}, ok AS (SELECT * FROM grid WHERE fy IN (2002, 2003) AND accuracy >= 0.15 AND n >= 20) SELECT rule, round(sum(coverage), 6) AS coverage FROM ok GROUP BY rule HAVING count(DISTINCT fy) = 2 ORDER BY coverage DESC, rule LIMIT 6""")
def select_rules(spark, d):
    """A floor of 0.15 instead of 0.98: the events' labels are all but random."""
    return P.select_rules(B.evaluate_rules(obs(spark, d)), (2002, 2003), 0.15)


@query("q_best_coverage", f"""{GRID_SQL}, f AS (SELECT unnest([0.15, 0.2, 0.25])::DOUBLE AS floor), g AS (SELECT floor, rule, n, coverage, accuracy FROM grid JOIN f ON accuracy >= floor WHERE fy = 2004 AND n >= 20)
SELECT floor, rule, coverage, n, accuracy FROM g QUALIFY row_number() OVER (PARTITION BY floor ORDER BY coverage DESC, rule) = 1""")
def best_coverage(spark, d):
    return P.best_coverage(B.evaluate_rules(obs(spark, d)), 2004, [0.15, 0.2, 0.25])


@query("q_unanimous_compound", f"""WITH {OBS_SQL.replace('obs AS (', 'plain AS (')}, obs AS (SELECT * REPLACE ('a|' || CASE WHEN hash_ < 3 THEN 'same' ELSE label END AS label) FROM (SELECT *, len(content) % 5 AS hash_ FROM plain)),
h AS (SELECT t.id, h.label, count(*) AS n, min((h.day, h.id)) AS first FROM obs t JOIN obs h ON h.content = t.content AND h.fy < t.fy GROUP BY ALL), b AS (SELECT id, count(*) AS kinds, any_value(label) AS pred FROM h GROUP BY 1)
SELECT fy, count(*) FILTER (complex) AS test_complex, count(*) FILTER (kinds = 1) AS n, CASE WHEN count(*) FILTER (kinds = 1) > 0 THEN round(count(*) FILTER (kinds = 1 AND pred = label) / count(*) FILTER (kinds = 1), 4) END AS accuracy FROM obs LEFT JOIN b USING (id) GROUP BY fy""")
def unanimous_compound(spark, d):
    o = obs(spark, d)
    return B.unanimous_compound(o.withColumn("label", F.concat(F.lit("a|"), F.when(F.length("content") % 5 < 3, "same").otherwise(F.col("label")))))


@query("q_answer_report", f"""{STAGED_SQL}, {ITEMS_SQL}, f AS (
  SELECT 'all' AS field, 'all' AS value, * FROM judged UNION ALL SELECT 'layer', layer, * FROM judged UNION ALL SELECT 'complex', complex::VARCHAR, * FROM judged UNION ALL SELECT 'confidence', CASE WHEN conf >= .9 THEN '0.90+' WHEN conf >= .8 THEN '0.80-0.89' WHEN conf >= .7 THEN '0.70-0.79' ELSE '<0.70' END, * FROM judged
  UNION ALL SELECT 'needs_review', coalesce(needs_review::VARCHAR, 'None'), * FROM judged UNION ALL SELECT 'insufficient', insufficient::VARCHAR, * FROM judged)
SELECT field, value, count(*) AS n, count(*) FILTER (model_ok) AS model_right, count(*) FILTER (rule_ok) AS rule_right, round(avg(conf), 4) AS mean_confidence, count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (insufficient) AS insufficient FROM f GROUP BY ALL""")
def answer_report(spark, d):
    return P.answer_report(items(spark, d))


@query("q_rule_against_model", f"""{STAGED_SQL}, {ITEMS_SQL} SELECT coalesce(layer, 'total') AS layer, count(*) FILTER (model_ok AND coalesce(rule_ok, false)) AS "both", count(*) FILTER (model_ok AND NOT coalesce(rule_ok, false)) AS model_only, count(*) FILTER (NOT model_ok AND coalesce(rule_ok, false)) AS rule_only, count(*) FILTER (NOT model_ok AND NOT coalesce(rule_ok, false)) AS neither FROM judged GROUP BY ROLLUP (layer)""")
def rule_against_model(spark, d):
    return P.rule_against_model(items(spark, d))


@query("q_bank_methods", f"""{CHAIN}, {RESOLVED_SQL} SELECT coalesce(fiscal_year::VARCHAR, 'total') AS fiscal_year, count(*) AS n, {", ".join(f"count(*) FILTER (bank_method = '{w}') AS {w}" for w in ("fy_sub_account_map", "fy_service_map", "journal_amount", "current_master", "unresolved"))}, count(*) FILTER (value % 2 = 0) AS amount_match FROM resolved WHERE fiscal_year IS NOT NULL GROUP BY ROLLUP (fiscal_year)""")
def bank_methods(spark, d):
    r = resolved(spark, d)
    return P.bank_methods(r.select("fiscal_year", F.col("bank_method").alias("method"), (F.col("value") % 2 == 0).alias("amount_match")))


@query("q_map_differences", f"""{CHAIN}, {map_sql('connected_sub_account_id')} SELECT count(*) AS maps, count(*) FILTER (account IS DISTINCT FROM 'A' OR sub IS DISTINCT FROM connected_sub_account_id % 3) AS differ FROM m WHERE support >= 3 AND account IS NOT NULL""")
def map_differences(spark, d):
    master = spark.range(20).select(F.col("id").alias("connected_sub_account_id"), F.lit("A").alias("account"), (F.col("id") % 3).alias("sub"))
    ln, ls = linked(spark, d)
    return P.map_differences(L.bank_map(ln, L.bank_candidates(ln, L.debit_nets(ls)), "connected_sub_account_id"), master)


@query("q_label_report", f"""{CHAIN}, {RESOLVED_SQL}, {LABEL_SQL} SELECT coalesce(n, 0) AS counter_count, count(*) AS n, count(*) FILTER (neg) AS negative FROM resolved LEFT JOIN labels USING (transaction_id) WHERE bank_account IS NOT NULL AND label_account IS NOT NULL GROUP BY 1""")
def label_report(spark, d):
    l = L.counter_labels(resolved(spark, d))
    return P.label_report(l.select(F.col("label_account").alias("label"), "counter_count", F.col("has_negative_counter").alias("has_negative")))


#: Line items before it are the earlier years, whose refunds come back.
PAST_BEFORE = "1996-01-01"


@query("q_closing_warnings", f"""WITH {JOURNALS_SQL}, t AS (SELECT transaction_id, amount // 1000000 AS amount, date, side, review_group % 4 AS account, funding, status, journal_status, act, account_id, transaction_id % 7 AS content FROM closing), hist AS (SELECT DISTINCT value // 1000000 AS amount, transaction_id % 7 AS content FROM tx WHERE date < DATE '{PAST_BEFORE}'),
own AS (SELECT * FROM t WHERE transaction_id IN (SELECT transaction_id FROM branches WHERE debit = 'acct0' AND credit = 'bank')), rf AS (SELECT * FROM t WHERE side = 'INCOME' AND funding <> 'bank' AND (amount, content) IN (SELECT (amount, content) FROM hist)),
c AS (SELECT 'a transfer is journaled from both accounts' AS "check", 'warning' AS level, (SELECT count(*) FROM own a WHERE EXISTS (SELECT 1 FROM own b WHERE a.amount = b.amount AND a.side <> b.side AND a.account <> b.account AND abs(date_diff('day', a.date, b.date)) <= 3)) AS count
UNION ALL SELECT 'refunds of earlier years are left out', 'warning', count(*) FROM rf WHERE status = 'excluded' AND act <> 'exclude' UNION ALL SELECT 'refunds of earlier years are left out as told', 'info', count(*) FROM rf WHERE status = 'excluded' AND act = 'exclude'
UNION ALL SELECT 'refunds of earlier years are journaled', 'warning', count(*) FROM rf WHERE journal_status IN ('generated', 'refund_review') UNION ALL SELECT 'transfers need the bank book', 'info', count(*) FROM closing WHERE journal_status = 'generated' AND funding = 'bank' AND account_id = 'acct0' AND override_sub_id IS NULL)
SELECT "check", level, CASE WHEN count = 0 THEN 'pass' ELSE 'fail' END AS result, count FROM c""")
def closing_warnings(spark, d):
    r = closing(spark, d).withColumns({"amount": F.expr("amount div 1000000"), "content": (F.col("transaction_id") % 7).cast("string"), "connected_account": F.col("review_group") % 4})
    j = final_branches(spark, d).withColumn("credit", F.when(F.col("credit") == "bank", "acct0").otherwise(F.col("credit")))
    j = j.where(~((F.col("debit") == "acct0") & (F.col("credit") == "acct0") & (F.col("funding") != "bank")))
    hist = tx(spark, d).where(f"date < date'{PAST_BEFORE}'").select(F.expr("value div 1000000").alias("amount"), (F.col("transaction_id") % 7).cast("string").alias("content"))
    return Y.closing_warnings(r, j, hist, overrides(spark, d)[0].select("transaction_id", "action"), "acct0")


@query("q_group_report", f"""WITH {REVIEW_SQL}, r2 AS (SELECT *, substr(content, 1, 7) AS merchant, CASE WHEN routing = 'model' THEN conf END AS confidence, CASE WHEN routing = 'model' THEN review END AS rev, transaction_id % 9 AS past_n FROM r LEFT JOIN results ON rid = transaction_id),
tx_ AS (SELECT to_, merchant, account_id, content, count(*) AS n, min((date, transaction_id)) AS first FROM r2 GROUP BY ALL),
d AS (SELECT to_, merchant, account_id, string_agg(CASE WHEN n > 1 THEN content || ' x' || n ELSE content END, ' | ' ORDER BY n DESC, first) AS descriptions FROM tx_ GROUP BY ALL),
g2 AS (SELECT to_, merchant, account_id, count(*) AS size, CAST(sum(amount) AS BIGINT) AS total, max(past_n) AS past_uses, count(*) FILTER (rev) AS needs_review, string_agg(DISTINCT layer, '/' ORDER BY layer) AS layer, arg_min(content, (-coalesce(confidence, -1), -date_diff('day', DATE '1970-01-01', date), transaction_id)) AS representative FROM r2 GROUP BY ALL)
SELECT g2.to_ AS routing, g2.merchant, g2.account_id, size, total, past_uses, needs_review, layer, descriptions, representative, count(*) OVER (PARTITION BY g2.to_, g2.merchant) - 1 AS other_groups FROM g2 JOIN d ON d.to_ = g2.to_ AND d.merchant = g2.merchant AND d.account_id IS NOT DISTINCT FROM g2.account_id""")
def group_report(spark, d):
    rows = reviewed(spark, d).withColumn("merchant", F.substring("content", 1, 7))
    past = obs(spark, d).select(F.col("id").alias("transaction_id"), (F.col("id") % 9).alias("past_n"), F.lit("p").alias("past_text"))
    return Y.group_report(rows, past).select("routing", "merchant", "account_id", "size", "total", "past_uses", "needs_review", "layer", "descriptions", "representative", "other_groups")


@query("q_normal_journals", f"WITH {NESTED_SQL} SELECT journal_id FROM j WHERE NOT opening")
def normal_journals(spark, d):
    return L.without_openings(nested(spark, d)).select("journal_id")


@query("q_latest_texts", f"""WITH {OBS_SQL}, q AS (SELECT DISTINCT content AS match, day FROM obs) SELECT match, q.day, arg_max(h.content || ' <EMAIL>', (h.day, h.id)) AS content FROM q JOIN obs h ON h.content = q.match AND h.day < q.day GROUP BY ALL""")
def latest_texts(spark, d):
    o = obs(spark, d)
    asked = o.select(F.col("content").alias("match"), "day").distinct()
    keyed = o.withColumn("content", F.concat("content", F.lit(" a@b.jp")))
    norm = X.normalize(F.concat("match", F.lit(" a@b.jp")), "n4", True)
    c = asked.select(F.col("match").alias("plain"), norm.alias("match"), "day")
    out = M.latest_texts(c, keyed, ascii_only=True).where("content is not null")
    return out.select(F.col("plain").alias("match"), "day", "content")


#: The n1 form, lower case with single blanks, in the place of the n4 form of the staged predictions' SQL.
N1_SQL = r"trim(regexp_replace(lower(content), '\s+', ' ', 'g'))"
_RIGHT_SQL = "SELECT count(*) FILTER (pred = label) FROM preds WHERE fy IN (2002, 2003) AND stage <> 'none' AND NOT (stage = 'fuzzy' AND score < 90)"


@query("q_best_normalizer", f"""SELECT normalizer, correct FROM (SELECT 'n1' AS normalizer, 0 AS place, ({STAGED_SQL.replace(norm_sql('content'), N1_SQL)} {_RIGHT_SQL}) AS correct
UNION ALL SELECT 'n4', 1, ({STAGED_SQL} {_RIGHT_SQL})) ORDER BY correct DESC, place LIMIT 1""")
def best_normalizer(spark, d):
    o = varied(spark, d)
    scored = {level: M.apply_threshold(M.staged_predictions(o, level, ascii_only=True), 90.0) for level in ("n1", "n4")}
    return P.best_normalizer(scored, [2002, 2003])
