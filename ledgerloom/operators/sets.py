"""Concatenation, first-wins deduplication and differences of sets of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first by `order`, which must tell rows apart: an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in key and c not in order]
    g = df.groupBy(*key).agg(F.min(F.struct(*(c for c in order if c not in key), *rest)).alias("_f"))
    return g.select(*(F.col(c) if c in key else F.col(f"_f.{c}").alias(c) for c in df.columns))


def first_source(frames: list[DataFrame], key: list[str], order: list[str]) -> DataFrame:
    """The frames one after the other; of rows with equal keys the first frame's, within a frame the first by `order`."""
    both = reduce(DataFrame.unionByName, (f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)))
    return first_of(both, key, ["_source", *order]).drop("_source")


def union_sources(frames: dict[str, DataFrame], key: str, out: str = "key") -> DataFrame:
    """The frames one after the other, with a key that names the source: <source>#<key>."""
    return reduce(DataFrame.unionByName, (f.withColumn(out, F.concat(F.lit(f"{name}#"), F.col(key).cast("string"))) for name, f in frames.items()))


def only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a that b lacks."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys that both have."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")
