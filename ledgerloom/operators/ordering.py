"""Numbers over whole tables without one task that holds all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Whole numbers within so many of one another share a part.
SPAN = 1_000_000


def numbered(df: DataFrame, parts: list[str], order: list, out: str = "no") -> DataFrame:
    """df with numbers from 1 in the order of parts (nulls first), then of `order`.

    Windows run within one part; only one row a part, its count, meets in one task.
    """
    counts = df.groupBy(*parts).agg(F.count("*").alias("_count"))
    before = F.coalesce(F.sum("_count").over(W.orderBy(*parts).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*(F.col(p).alias(f"_part{i}") for i, p in enumerate(parts)), before.alias("_before"))
    same = reduce(Column.__and__, (F.col(p).eqNullSafe(F.col(f"_part{i}")) for i, p in enumerate(parts)))
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*parts).orderBy(*order)))
    return ranked.join(starts, same).withColumn(out, F.col("_before") + F.col("_rank")).drop("_rank", "_before", *(f"_part{i}" for i in range(len(parts))))


def dense_numbers(df: DataFrame, key: str, out: str = "no") -> DataFrame:
    """(key, out): the distinct whole numbers of a column, numbered from 1. A part holds at most SPAN of them."""
    ids = df.select(F.col(key).cast("long").alias(key)).distinct().withColumn("_span", F.expr(f"floor(`{key}` / {SPAN})"))
    return numbered(ids, ["_span"], [key], out).select(key, out)
