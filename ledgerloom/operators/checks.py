"""Validation: every check is a row (check, level, result, count), never the offending values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("INCOME", "EXPENSE")


def check(name: str, bad: DataFrame, level: str = "error") -> DataFrame:
    """pass if `bad` has no rows."""
    n = bad.agg(F.count("*").alias("count"))
    return n.select(F.lit(name).alias("check"), F.lit(level).alias("level"), F.when(F.col("count") == 0, "pass").otherwise("fail").alias("result"), "count")


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def row_checks(df: DataFrame, tests: dict[str, Column], level: str = "error") -> DataFrame:
    """One pass over df for all row-wise tests; a row fails a test unless it is true."""
    n = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in tests.items()))
    long = n.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("count")) for k in tests))).alias("_c"))
    return long.select("_c.check", F.lit(level).alias("level"), F.when(F.col("_c.count") == 0, "pass").otherwise("fail").alias("result"), F.col("_c.count").alias("count"))


def unique_ids(df: DataFrame, key: list[str], name: str) -> DataFrame:
    return check(name, df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"))


def expected_count(df: DataFrame, total: int | None, name: str) -> DataFrame:
    """A missing total fails as well."""
    return df.agg((F.count("*") - F.lit(total).cast("long")).alias("d")).select(
        F.lit(name).alias("check"), F.lit("error").alias("level"), F.when(F.coalesce(F.col("d") == 0, F.lit(False)), "pass").otherwise("fail").alias("result"), F.coalesce(F.abs("d"), F.lit(0)).alias("count")
    )


def same_rows(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Multiset equality, both ways."""
    return check(name, a.exceptAll(b).union(b.exceptAll(a)))


def require(checks: DataFrame) -> None:
    """Raises with the names and counts of failed errors."""
    failed = [f"{r.check}: {r['count']}" for r in checks.where("level = 'error' and result = 'fail'").collect()]
    if failed:
        raise ValueError("checks failed: " + "; ".join(sorted(failed)))


def declared_totals(df: DataFrame, totals: DataFrame, name: str) -> DataFrame:
    """The count against a manifest's (total_count), one row; a missing total fails."""
    n = df.agg(F.count("*").alias("_n")).unionByName(totals.agg(F.max("total_count").alias("_t")), allowMissingColumns=True).agg(F.max("_n").alias("_n"), F.max("_t").alias("_t"))
    bad = ~F.coalesce(F.col("_n") == F.col("_t"), F.lit(False))
    return n.select(F.lit(name).alias("check"), F.lit("error").alias("level"), F.when(bad, "fail").otherwise("pass").alias("result"), F.coalesce(F.abs(F.col("_n") - F.col("_t")), F.lit(0)).cast("long").alias("count"))


def _dated(column: str, start: str, end: str) -> Column:
    """Whether the first ten characters are a date within [start, end]; what is no date is not."""
    return F.coalesce(F.try_to_date(F.substring(F.col(column).cast("string"), 1, 10)).between(F.lit(start), F.lit(end)), F.lit(False))


def journal_checks(journals: DataFrame, totals: DataFrame, start: str, end: str) -> DataFrame:
    """Load checks of nested journals (id, transaction_date, branches, ...), one row each: count, ids, dates, branches, sides, values.

    Values are taken as texts or numbers, whole numbers only; a side that is missing is not judged.
    """
    b = F.coalesce("branches", F.array().cast(journals.schema["branches"].dataType))
    whole = lambda side: F.forall(b, lambda x: x[side].isNull() | F.coalesce(x[side]["value"].cast("string").rlike(r"^-?\d+$"), F.lit(False)))
    tests = {
        "journals: id is there": F.coalesce(F.col("id").cast("string"), F.lit("")) != "", "journals: date within the range": _dated("transaction_date", start, end),
        "journals: branches are there": F.size(b) > 0, "journals: every branch has a side": F.forall(b, lambda x: x["debitor"].isNotNull() | x["creditor"].isNotNull()),
        "journals: values are whole numbers": whole("debitor") & whole("creditor"),
    }
    return report(declared_totals(journals, totals, "journals: count is the declared total"), unique_ids(journals, ["id"], "journals: ids are unique"), row_checks(journals, tests))


def text_typed(schema, column: str) -> DataFrame | None:
    """Raises if a landed column is not of text, as a link id must be; nothing is read."""
    kind = schema[column].dataType.typeName()
    if kind not in ("string", "void"):
        raise TypeError(f"{column} is {kind}, not text")


def line_item_checks(tx: DataFrame, totals: DataFrame, start: str, end: str, statuses: list[str], sides: tuple[str, ...] = SIDES) -> DataFrame:
    """Load checks of line items (id, date, value, side, journalizing_status, connected_sub_account_id), one row each."""
    tests = {
        "line items: id is there": F.coalesce(F.col("id").cast("string"), F.lit("")) != "", "line items: date within the range": _dated("date", start, end),
        "line items: value is a whole number": F.col("value").cast("string").rlike(r"^-?\d+$"), "line items: known side": F.col("side").isin(*sides),
        "line items: known status": F.col("journalizing_status").isin(*statuses), "line items: sub-account is there": F.coalesce(F.col("connected_sub_account_id").cast("string"), F.lit("")) != "",
    }
    return report(declared_totals(tx, totals, "line items: count is the declared total"), unique_ids(tx, ["id"], "line items: ids are unique"), row_checks(tx, tests))
