"""Exact deduplication by progressive refinement: length, then a hash of the first bytes, then the hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fresh, read_table, settled, text_or_empty

#: Characters under the prefix hash.
PREFIX = 64


def _length(text: Column) -> Column:
    return F.octet_length(text)


def _prefix(text: Column) -> Column:
    return F.xxhash64(F.substring(text, 1, PREFIX))


def _shared(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The (length, prefix) that several of the rows (length, prefix, copies) have, looked for among shared lengths only.

    Each stage's keys are written, so that a join with them can split the partition of a common length or prefix, which
    it can't beside an aggregate of its key.
    """
    lengths = scratch.write(rows.groupBy("length").agg(F.sum("copies").alias("n")).where("n > 1").select("length"))
    prefixes = rows.join(lengths, "length", "left_semi").groupBy("length", "prefix").agg(F.sum("copies").alias("n")).where("n > 1")
    return scratch.write(prefixes.select("length", "prefix"))


def _groups(rows: DataFrame) -> DataFrame:
    """(length, text_sha256, keep_id, group_size) of the texts that several of the rows have."""
    return rows.groupBy("length", "text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")).where("group_size > 1")


def exact_groups(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    As the hash of every text is asked for, it is made in the one scan; length and prefix then decide which rows are grouped by it at
    all (drop_exact_copies, which returns no hash, makes it for those rows only). Null text counts as empty. The row with the
    largest id stays; null ids lose to any other, and a group without any id has a null keep_id and keeps one row. Of
    repeated rows with the largest id one is kept. Other columns are not read. An empty table gives an empty one.
    """
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), _length(text).alias("length"), _prefix(text).alias("prefix"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))
    rows = scratch.write(rows.groupBy("length", "prefix", "text_sha256", "doc_id").agg(F.count("*").alias("copies")))
    groups = scratch.write(_groups(rows.join(_shared(rows, scratch), ["length", "prefix"], "left_semi")))
    out = rows.join(groups, ["length", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    out = out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256", "copies")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever those are called; see exact_groups for which stay.

    The first scan takes lengths and prefixes; whole texts are hashed only for rows that share both with another row. Null
    text counts as empty; a null id is an id of its own, which loses to any other. Of rows equal in id and text one stays, whatever
    their other columns hold. An empty table gives an empty one.
    """
    doc, text = F.col(f"`{id_col}`"), text_or_empty(F.col(f"`{text_col}`"))
    rows = docs.select(doc.alias("doc_id"), _length(text).alias("length"), _prefix(text).alias("prefix"), text.alias("text"))
    shared = _shared(rows.groupBy("length", "prefix").agg(F.count("*").alias("copies")), scratch)
    whole = rows.join(shared, ["length", "prefix"], "left_semi")
    whole = whole.select("doc_id", "length", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.xxhash64("text").alias("hash"))
    whole = scratch.write(whole.groupBy("length", "text_sha256", "hash", "doc_id").agg(F.count("*").alias("copies")))
    decided = whole.join(scratch.write(_groups(whole)), ["length", "text_sha256"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # The rows to go, and those of which one comes back as they are there several times.
    gone = scratch.write(decided.where(~stays | (F.col("copies") > 1)).select("doc_id", "length", "hash", stays.alias("back")))
    a, b, c = fresh(docs, "gone_id", "gone_length", "gone_hash")
    named = lambda d: d.select(F.col("doc_id").alias(a), F.col("length").alias(b), F.col("hash").alias(c))
    same = doc.eqNullSafe(F.col(a)) & (_length(text) == F.col(b)) & (F.xxhash64(text) == F.col(c))
    left = docs.join(named(gone), same, "left_anti")
    back = gone.where("back")
    if back.isEmpty():
        return left
    back = docs.join(named(back), same, "inner").dropDuplicates([a, b, c]).drop(a, b, c)
    return left.unionByName(back)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "exact", lambda scratch: exact_groups(read_table(spark, sf_dir, "documents"), scratch))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
