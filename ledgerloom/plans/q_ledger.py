"""Queries of the ledger operators: branches, terms, pairs, bank inference, labels."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import ledger as L
from ..operators import reports as P
from .adapters import LINES_SQL, TERMS_SQL, TX_SQL, lines, table, terms, tx

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: Line items with the sub-account that stands for the bank; one service has none.
BANKED_SQL = "banked AS (SELECT *, CASE WHEN connected_sub_account_id = 19 THEN NULL ELSE connected_sub_account_id % 3 END AS bank_sub FROM tx)"
#: A line item that pays exactly its first branch, so that amounts match somewhere.
PAID_SQL = """paid AS (
  SELECT t.* REPLACE (CASE WHEN t.transaction_id % 3 > 0 THEN coalesce(g.gross, t.value) ELSE t.value END AS value)
  FROM tx t LEFT JOIN (SELECT transaction_id, value + tax_value AS gross FROM lines WHERE branch_index = 1) g USING (transaction_id))"""


def banked(spark, d):
    s = F.col("connected_sub_account_id")
    return tx(spark, d).withColumn("bank_sub", F.when(s != 19, s % 3))


def paid(spark, d):
    g = lines(spark, d).where("branch_index = 1").select("transaction_id", (F.col("value") + F.col("tax_value")).alias("gross"))
    t = tx(spark, d)
    return t.join(g, "transaction_id", "left").withColumn("value", F.when(F.col("transaction_id") % 3 > 0, F.coalesce("gross", "value")).otherwise(F.col("value"))).select(*t.columns)


def nested_journals(spark, d):
    """Journals with their branches nested, as a source delivers them."""
    side = lambda s: F.struct(F.col(f"{s}_account").alias("account_id"), F.col(f"{s}_sub").alias("sub_account_id"), "value", "tax_value")
    b = F.struct("branch_index", F.struct(F.col("part").cast("string").alias("remark"), F.when(F.col("part") % 7 > 0, side("debit")).alias("debitor"), side("credit").alias("creditor")).alias("b"))
    j = lines(spark, d).groupBy("journal_id").agg(F.transform(F.array_sort(F.collect_list(b)), lambda x: x["b"]).alias("branches"))
    return j.withColumn("tags", F.array(F.lit("a"), (F.col("journal_id") % 3).cast("string")))


@query("q_branch_explode", f"""
WITH {LINES_SQL}
SELECT journal_id, branch_index, count(*) OVER (PARTITION BY journal_id) AS branch_count, 'a|' || journal_id % 3 AS tags, part::VARCHAR AS remark,
       CASE WHEN part % 7 > 0 THEN debit_account END AS debit_account_id, CASE WHEN part % 7 > 0 THEN value END AS debit_value,
       credit_account AS credit_account_id, tax_value AS credit_tax_value FROM lines""")
def branch_explode(spark, d):
    out = L.explode_branches(nested_journals(spark, d))
    return out.select("journal_id", "branch_index", "branch_count", "tags", "remark", "debit_account_id", "debit_value", "credit_account_id", "credit_tax_value")


@query("q_term_interval", f"""
WITH {TX_SQL}, {TERMS_SQL}
SELECT transaction_id, date::VARCHAR AS date, fiscal_year, tax_method FROM tx LEFT JOIN terms ON date BETWEEN start_date AND end_date""")
def term_interval(spark, d):
    return L.with_term(tx(spark, d), terms(spark)).select("transaction_id", F.col("date").cast("string").alias("date"), "fiscal_year", "tax_method")


#: Each year's terms run from its first order to its last one.
ORDER_TERMS_SQL = "terms AS (SELECT year(o_orderdate) AS fiscal_year, min(o_orderdate)::DATE AS start_date, max(o_orderdate)::DATE AS end_date FROM orders GROUP BY 1)"


def order_terms(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return o.groupBy(F.year("day").cast("long").alias("fiscal_year")).agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"))


@query("q_date_split", f"""
WITH {ORDER_TERMS_SQL}
SELECT fiscal_year, s::DATE::VARCHAR AS window_start, least(s::DATE + 99, end_date)::DATE::VARCHAR AS window_end
FROM (SELECT *, unnest(generate_series(start_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 100 DAY)) AS s FROM terms)""")
def date_split(spark, d):
    return L.date_windows(order_terms(spark, d), 99).select("fiscal_year", F.col("window_start").cast("string"), F.col("window_end").cast("string"))


@query("q_period_clip", f"""
WITH {ORDER_TERMS_SQL}
SELECT fiscal_year, greatest(start_date, DATE '1996-03-01')::VARCHAR AS start_date, least(end_date, DATE '1999-12-31')::VARCHAR AS end_date
FROM terms WHERE end_date >= DATE '1996-03-01' AND start_date <= DATE '1999-12-31'""")
def period_clip(spark, d):
    t = order_terms(spark, d)
    return L.clip_periods(t.union(t), "1996-03-01", "1999-12-31").select("fiscal_year", F.col("start_date").cast("string"), F.col("end_date").cast("string"))


@query("q_tx_enriched", f"""
WITH {TX_SQL}, {TERMS_SQL}
SELECT transaction_id, date::VARCHAR AS date, value, side, c_name AS connected_name, n_name AS nation, coalesce(n, 0) AS linked_journal_count, fiscal_year
FROM tx JOIN orders ON o_orderkey = transaction_id LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = transaction_id
LEFT JOIN terms ON date BETWEEN start_date AND end_date""")
def tx_enriched(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    dim = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("c_custkey").alias("connected_sub_account_id"), F.col("c_name").alias("connected_name"), F.col("n_name").alias("nation"))
    t = tx(spark, d).drop("connected_sub_account_id").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("connected_sub_account_id")), "transaction_id")
    # Every line of an order stands for a journal of its own here.
    journals = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("transaction_id"), F.monotonically_increasing_id().alias("journal_id"))
    out = L.enrich_line_items(t, dim, journals, terms(spark))
    return out.select("transaction_id", F.col("date").cast("string"), "value", "side", "connected_name", "nation", "linked_journal_count", "fiscal_year")


NETS_SQL = """sides AS (
  SELECT journal_id, debit_account AS account, debit_sub AS sub, value + tax_value AS gross, value, 1 AS sign FROM lines
  UNION ALL SELECT journal_id, credit_account, credit_sub, value + tax_value, value, -1 FROM lines),
nets AS (SELECT journal_id, account, sub, CAST(sum(sign * gross) AS BIGINT) AS net FROM sides GROUP BY ALL)"""


@query("q_net_gross", f"WITH {LINES_SQL}, {NETS_SQL} SELECT * FROM nets")
def net_gross(spark, d):
    return L.debit_nets(lines(spark, d))


BANK_NET_SQL = """bank_net AS (
  SELECT transaction_id, journal_id, any_value(side) AS side, any_value(bank_sub) AS bank_sub, any_value(b.value) AS tx_value, count(*) AS n,
    CAST(sum(CASE WHEN debit_sub {op} bank_sub THEN l.value ELSE 0 END) AS BIGINT) AS dr,
    CAST(sum(CASE WHEN credit_sub {op} bank_sub THEN l.value ELSE 0 END) AS BIGINT) AS cr
  FROM banked b JOIN lines l USING (transaction_id) GROUP BY ALL)"""


@query("q_bank_net", f"""
WITH {TX_SQL}, {LINES_SQL}, {BANKED_SQL}, {BANK_NET_SQL.format(op='=')}
SELECT transaction_id, journal_id, CASE WHEN bank_sub IS NOT NULL THEN CASE WHEN side = 'EXPENSE' THEN cr - dr ELSE dr - cr END END AS bank_net_amount FROM bank_net""")
def bank_net(spark, d):
    return L.bank_net_by_value(banked(spark, d), lines(spark, d))


@query("q_bank_net_nullsafe", f"""
WITH {TX_SQL}, {LINES_SQL}, {BANKED_SQL}, {BANK_NET_SQL.format(op='IS NOT DISTINCT FROM')}
SELECT transaction_id, journal_id, CASE WHEN side = 'EXPENSE' THEN cr - dr ELSE dr - cr END AS bank_net_amount FROM bank_net""")
def bank_net_nullsafe(spark, d):
    return L.bank_net_by_value(banked(spark, d), lines(spark, d), null_safe=True)


PAIRS_SQL = """pairs AS (
  SELECT transaction_id, journal_id, branch_index, b.value AS tx_value, n AS branch_count,
    CASE WHEN b.bank_sub IS NOT NULL THEN CASE WHEN b.side = 'EXPENSE' THEN cr - dr ELSE dr - cr END END AS bank_net_amount,
    CASE WHEN debit_sub = b.bank_sub AND credit_sub = b.bank_sub THEN 'both' WHEN debit_sub = b.bank_sub THEN 'debit' WHEN credit_sub = b.bank_sub THEN 'credit' ELSE 'none' END AS bank_side
  FROM banked b JOIN lines l USING (transaction_id) JOIN bank_net n USING (transaction_id, journal_id))"""


@query("q_training_pairs", f"""
WITH {TX_SQL}, {LINES_SQL}, {BANKED_SQL}, {BANK_NET_SQL.format(op='=')}, {PAIRS_SQL}
SELECT transaction_id, branch_index, branch_count, bank_side, bank_net_amount, bank_net_amount = tx_value AS amount_matches_tx, 1::BIGINT AS journals_per_transaction FROM pairs""")
def training_pairs(spark, d):
    return L.training_pairs(banked(spark, d), lines(spark, d)).select("transaction_id", "branch_index", "branch_count", "bank_side", "bank_net_amount", "amount_matches_tx", "journals_per_transaction")


@query("q_pair_stats", f"""
WITH {TX_SQL}, {LINES_SQL}, {BANKED_SQL}, {BANK_NET_SQL.format(op='=')}, {PAIRS_SQL}
SELECT (SELECT count(*) FROM tx) AS transactions, count(DISTINCT transaction_id) AS transactions_linked, count(DISTINCT journal_id) AS journals_linked,
  count(DISTINCT CASE WHEN branch_count > 1 THEN journal_id END) AS multi_branch_journals,
  count(DISTINCT CASE WHEN bank_net_amount = tx_value THEN journal_id END) AS amount_matches_tx, count(*) AS rows,
  round(count(DISTINCT transaction_id) / (SELECT count(*) FROM tx), 4) AS link_rate FROM pairs""")
def pair_stats(spark, d):
    t = banked(spark, d)
    return L.pair_stats(t, L.training_pairs(t, lines(spark, d)))


#: Journals by supplier and part count several to a line item.
SPLIT_SQL = """split AS (
  SELECT l_orderkey AS transaction_id, l_orderkey * 10 + l_suppkey % 4 AS journal_id, max(l_linenumber) AS number FROM lineitem GROUP BY ALL)"""


@query("q_first_journal", f"""
WITH {TX_SQL}, {SPLIT_SQL}
SELECT transaction_id, arg_min(journal_id, (number, journal_id)) AS journal_id, count(*) AS journals_per_transaction FROM tx JOIN split USING (transaction_id) GROUP BY ALL""")
def first_journal(spark, d):
    li = table(spark, d, "lineitem")
    j = li.groupBy(F.col("l_orderkey").alias("transaction_id"), (F.col("l_orderkey") * 10 + F.col("l_suppkey") % 4).alias("journal_id")).agg(F.max("l_linenumber").alias("number"))
    return L.first_journal(tx(spark, d), j).select("transaction_id", "journal_id", "journals_per_transaction")


LINKED_SQL = """linked AS (
  SELECT p.*, p.transaction_id AS journal_id, fiscal_year FROM paid p LEFT JOIN terms ON date BETWEEN start_date AND end_date
  WHERE transaction_id IN (SELECT transaction_id FROM lines)),
candidates AS (SELECT l.*, account, sub FROM linked l JOIN nets USING (journal_id) WHERE CASE WHEN side = 'EXPENSE' THEN -net ELSE net END = value)"""
#: Materialized, as DuckDB would otherwise make the nets again wherever they are named.
CHAIN = f"WITH {TX_SQL}, {LINES_SQL}, {PAID_SQL}, {TERMS_SQL}, {NETS_SQL}, {LINKED_SQL}"
for _name in ("lines", "nets", "linked", "candidates"):
    CHAIN = CHAIN.replace(f"{_name} AS (", f"{_name} AS MATERIALIZED (", 1)


def linked(spark, d):
    ls = lines(spark, d)
    t = L.with_term(paid(spark, d), terms(spark))
    return L.first_journal(t, ls.groupBy("transaction_id", "journal_id").agg(F.lit(1).alias("number"))), ls


def map_sql(level: str, name: str = "m") -> str:
    return f"""{name} AS (
  SELECT t.fiscal_year, t.{level}, v.account, v.sub, coalesce(v.support, 0) AS support, t.journals, round(coalesce(v.support, 0) / t.journals, 4) AS ratio
  FROM (SELECT fiscal_year, {level}, count(*) AS journals FROM linked GROUP BY ALL) t LEFT JOIN (
    SELECT * FROM (SELECT fiscal_year, {level}, account, sub, count(*) AS support FROM candidates GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY fiscal_year, {level} ORDER BY support DESC, account, sub) = 1) v
  ON t.fiscal_year = v.fiscal_year AND t.{level} = v.{level})"""


@query("q_bank_candidates", f"{CHAIN} SELECT transaction_id, account, sub FROM candidates")
def bank_candidates(spark, d):
    ln, ls = linked(spark, d)
    return L.bank_candidates(ln, L.debit_nets(ls)).select("transaction_id", "account", "sub")


@query("q_bank_map_sub", f"{CHAIN}, {map_sql('connected_sub_account_id')} SELECT * FROM m")
def bank_map_sub(spark, d):
    ln, ls = linked(spark, d)
    return L.bank_map(ln, L.bank_candidates(ln, L.debit_nets(ls)), "connected_sub_account_id")


@query("q_bank_map_service", f"{CHAIN}, {map_sql('connected_account_id')} SELECT * FROM m")
def bank_map_service(spark, d):
    ln, ls = linked(spark, d)
    return L.bank_map(ln, L.bank_candidates(ln, L.debit_nets(ls)), "connected_account_id")


RESOLVED_SQL = f"""{map_sql('connected_sub_account_id', 'ms')}, {map_sql('connected_account_id', 'mv')},
single AS (SELECT journal_id, count(*) AS n, min(account) AS account, min(sub) AS sub FROM candidates GROUP BY 1),
resolved AS (
  SELECT l.*, CASE WHEN na.net IS NOT NULL THEN 'fy_sub_account_map' WHEN nb.net IS NOT NULL THEN 'fy_service_map' WHEN single.n = 1 THEN 'journal_amount'
              WHEN nm.net IS NOT NULL THEN 'current_master' ELSE 'unresolved' END AS bank_method,
         CASE WHEN na.net IS NOT NULL THEN ms.account WHEN nb.net IS NOT NULL THEN mv.account WHEN single.n = 1 THEN single.account WHEN nm.net IS NOT NULL THEN 'A' END AS bank_account,
         CASE WHEN na.net IS NOT NULL THEN ms.sub WHEN nb.net IS NOT NULL THEN mv.sub WHEN single.n = 1 THEN single.sub WHEN nm.net IS NOT NULL THEN l.connected_sub_account_id % 3 END AS bank_sub
  FROM linked l
  LEFT JOIN ms ON ms.fiscal_year = l.fiscal_year AND ms.connected_sub_account_id = l.connected_sub_account_id AND ms.support >= 3
  LEFT JOIN mv ON mv.fiscal_year = l.fiscal_year AND mv.connected_account_id = l.connected_account_id AND mv.support >= 3
  LEFT JOIN nets na ON na.journal_id = l.journal_id AND na.account = ms.account AND na.sub = ms.sub
  LEFT JOIN nets nb ON nb.journal_id = l.journal_id AND nb.account = mv.account AND nb.sub = mv.sub
  LEFT JOIN nets nm ON nm.journal_id = l.journal_id AND nm.account = 'A' AND nm.sub = l.connected_sub_account_id % 3
  LEFT JOIN single ON single.journal_id = l.journal_id)"""


for _name in ("ms", "mv", "single", "resolved"):
    RESOLVED_SQL = RESOLVED_SQL.replace(f"{_name} AS (", f"{_name} AS MATERIALIZED (", 1)


def resolved(spark, d):
    ln, ls = linked(spark, d)
    master = spark.range(20).select(F.col("id").alias("connected_sub_account_id"), F.lit("A").alias("account"), (F.col("id") % 3).alias("sub"))
    # Dealt by journal once: nets, their arrays, votes and joins follow without another shuffle of the lines.
    return L.resolve_bank(ln, L.debit_nets(ls.repartition("journal_id")), master, keep_nets=True)


@query("q_bank_resolved", f"{CHAIN}, {RESOLVED_SQL} SELECT transaction_id, bank_method, bank_account, bank_sub FROM resolved")
def bank_resolved(spark, d):
    return resolved(spark, d).select("transaction_id", "bank_method", "bank_account", "bank_sub")


#: Each step is computed once, from the counters on: a key and its place in the order of primaries, then plain aggregates over the line item.
LABEL_SQL = """counters AS MATERIALIZED (
  SELECT transaction_id, account, sub, c, CASE WHEN c < 0 THEN '-' ELSE '' END || account AS label, CASE WHEN c < 0 THEN '-' ELSE '' END || account || '/' || coalesce(sub::VARCHAR, 'None') AS full_label
  FROM (SELECT r.transaction_id, n.account, n.sub, CASE WHEN r.side = 'EXPENSE' THEN n.net ELSE -n.net END AS c
    FROM (SELECT transaction_id, journal_id, side, bank_account, bank_sub FROM resolved WHERE bank_account IS NOT NULL) r JOIN nets n ON n.journal_id = r.journal_id
    WHERE n.net <> 0 AND (n.account <> r.bank_account OR n.sub <> r.bank_sub))),
primaries AS MATERIALIZED (
  SELECT transaction_id, account AS primary_account, sub AS primary_sub FROM counters
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY CASE WHEN c > 0 THEN 0 ELSE 1 END, -abs(c), account, sub) = 1),
texts AS MATERIALIZED (
  SELECT transaction_id, count(*) AS n, bool_or(c < 0) AS neg, string_agg(DISTINCT label, '|' ORDER BY label) AS label_account, string_agg(DISTINCT full_label, '|' ORDER BY full_label) AS label_account_sub
  FROM counters GROUP BY transaction_id),
labels AS MATERIALIZED (SELECT texts.*, primary_account, primary_sub FROM texts JOIN primaries USING (transaction_id))"""


@query("q_counter_label", f"""{CHAIN}, {RESOLVED_SQL}, {LABEL_SQL}
SELECT transaction_id, coalesce(n, 0) > 1 AS complex_journal, coalesce(n, 0) AS counter_count, coalesce(neg, false) AS has_negative_counter, label_account, label_account_sub
FROM resolved LEFT JOIN labels USING (transaction_id) WHERE bank_account IS NOT NULL""")
def counter_label(spark, d):
    out = L.counter_labels(resolved(spark, d))
    return out.select("transaction_id", "complex_journal", "counter_count", "has_negative_counter", "label_account", "label_account_sub")


@query("q_primary_account", f"""{CHAIN}, {RESOLVED_SQL}, {LABEL_SQL}
SELECT transaction_id, primary_account, primary_sub FROM resolved LEFT JOIN labels USING (transaction_id) WHERE bank_account IS NOT NULL""")
def primary_account(spark, d):
    return L.counter_labels(resolved(spark, d)).select("transaction_id", "primary_account", "primary_sub")


@query("q_link_stats", f"""
WITH {TX_SQL} SELECT status, count(*) AS n, count(*) FILTER (transaction_id IN (SELECT l_orderkey FROM lineitem)) AS linked FROM tx GROUP BY 1""")
def link_stats(spark, d):
    return P.link_report(tx(spark, d), lines(spark, d))
