"""Ledger views over the driver's tables, in Spark and, word for word, in SQL.

orders play line items, lineitem journal lines, events the labelled history. Money is whole cents.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Fiscal years begin on 1 August.
TERMS = [(y, f"{y}-08-01", f"{y + 1}-07-31", "exclusive" if y % 2 else "inclusive") for y in range(1994, 2002)]
#: Lines repeat their (order, number): branches are numbered by all columns.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cents(c) -> F.Column:
    return F.round(c * 100).cast("long")


def terms(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({y}, date'{a}', date'{b}', '{m}')" for y, a, b, m in TERMS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(fiscal_year, start_date, end_date, tax_method)")


TERMS_SQL = "terms(fiscal_year, start_date, end_date, tax_method) AS (VALUES " + ", ".join(f"({y}, DATE '{a}', DATE '{b}', '{m}')" for y, a, b, m in TERMS) + ")"


def tx(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_orderdate").cast("date").alias("date"), cents(F.col("o_totalprice")).alias("value"),
        F.when(F.col("o_orderstatus") == "O", "INCOME").otherwise("EXPENSE").alias("side"),
        (F.col("o_custkey") % 20).alias("connected_sub_account_id"), (F.col("o_custkey") % 5).alias("connected_account_id"),
        F.col("o_orderpriority").alias("content"), F.col("o_orderstatus").alias("status"),
    )


TX_SQL = """tx AS (
  SELECT o_orderkey AS transaction_id, o_orderdate::DATE AS date, CAST(round(o_totalprice * 100) AS BIGINT) AS value,
         CASE WHEN o_orderstatus = 'O' THEN 'INCOME' ELSE 'EXPENSE' END AS side,
         o_custkey % 20 AS connected_sub_account_id, o_custkey % 5 AS connected_account_id,
         o_orderpriority AS content, o_orderstatus AS status FROM orders)"""


def lines(spark: SparkSession, d: str) -> DataFrame:
    """One row a branch: journal = order, both sides filled."""
    li = table(spark, d, "lineitem")
    branch = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    return li.select(
        F.col("l_orderkey").alias("journal_id"), F.col("l_orderkey").alias("transaction_id"), branch.alias("branch_index"),
        F.col("l_returnflag").alias("debit_account"), (F.col("l_suppkey") % 3).alias("debit_sub"),
        F.col("l_linestatus").alias("credit_account"), (F.col("l_suppkey") % 4).alias("credit_sub"),
        cents(F.col("l_extendedprice")).alias("value"), cents(F.col("l_extendedprice") * F.col("l_tax")).alias("tax_value"),
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_partkey").alias("part"),
    )


#: Numbers of a line that mostly are small, or fit an int, as units (1) or hundredths (100).
SMALL = {"l_linenumber": 1, "l_quantity": 1, "l_discount": 100, "l_tax": 100}
INTS = {"l_partkey": 1, "l_suppkey": 1, "l_extendedprice": 100}


def journal_lines(spark: SparkSession, d: str) -> DataFrame:
    """lines(), dealt by journal once and narrowly: `branch_index` is what numbers the branches, the date left out, not their number.

    Numbers travel as bytes and ints (`_small`, `_ints`), or, if any of a line's would change by that, as they are (`_wide`).
    Branches that tie in `branch_index` are in the order of their dates, as l_shipdate is last in LINE_ORDER.
    """
    whole = lambda c, by, kind: (F.round(F.col(c) * by) if by > 1 else F.col(c)).try_cast(kind)
    real = lambda n, by: n / F.lit(float(by)) if by > 1 else n
    narrow = {c: whole(c, by, "tinyint") for c, by in SMALL.items()} | {c: whole(c, by, "int") for c, by in INTS.items()}
    units = SMALL | INTS
    date = F.col("l_shipdate").cast("date")
    fits = F.coalesce(F.expr("l_shipdate is not null") & reduce(and_, (real(n, units[c]) == F.col(c) for c, n in narrow.items())), F.lit(False))
    sent = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("journal_id"), F.when(fits, F.array(*(narrow[c] for c in SMALL))).alias("_small"),
        F.when(fits, F.array(*(narrow[c] for c in INTS), F.unix_date(date))).alias("_ints"), F.when(~fits, F.struct(*units, date.alias("date"))).alias("_wide"),
        F.col("l_returnflag").alias("debit_account"), F.col("l_linestatus").alias("credit_account"),
    ).repartition("journal_id")
    at = {c: F.col("_small")[i] for i, c in enumerate(SMALL)} | {c: F.col("_ints")[i] for i, c in enumerate(INTS)}
    got = sent.withColumns({c: F.coalesce(real(n, units[c]), F.col("_wide")[c]) for c, n in at.items()} | {"date": F.coalesce(F.date_from_unix_date(F.col("_ints")[len(INTS)]), F.col("_wide.date"))})
    order = [{"l_returnflag": "debit_account", "l_linestatus": "credit_account"}.get(c, c) for c in LINE_ORDER if c != "l_shipdate"]
    return got.select(
        "journal_id", F.struct(*order).alias("branch_index"), "debit_account", (F.col("l_suppkey") % 3).alias("debit_sub"), "credit_account", (F.col("l_suppkey") % 4).alias("credit_sub"),
        cents(F.col("l_extendedprice")).alias("value"), "date",
    )


LINES_SQL = f"""lines AS (
  SELECT l_orderkey AS journal_id, l_orderkey AS transaction_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS INTEGER) AS branch_index,
         l_returnflag AS debit_account, l_suppkey % 3 AS debit_sub, l_linestatus AS credit_account, l_suppkey % 4 AS credit_sub,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS value, CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) AS tax_value,
         l_shipdate::DATE AS date, l_partkey AS part FROM lineitem)"""


def obs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    day = F.col("ts").cast("date")
    return e.select(
        F.col("event_id").alias("id"), day.alias("day"), F.col("props").alias("content"), F.col("event_type").alias("label"),
        (F.col("user_id") % 7).alias("account"), cents(F.col("value")).alias("value"), (F.col("event_id") % 5 == 0).alias("complex"),
        (2000 + F.floor(F.datediff(day, F.lit("2024-01-01").cast("date")) / 6)).cast("int").alias("fy"),
    )


OBS_SQL = """obs AS (
  SELECT event_id AS id, ts::DATE AS day, props AS content, event_type AS label, user_id % 7 AS account,
         CAST(round(value * 100) AS BIGINT) AS value, event_id % 5 = 0 AS complex,
         CAST(2000 + floor(date_diff('day', DATE '2024-01-01', ts::DATE) / 6) AS INTEGER) AS fy FROM events)"""
