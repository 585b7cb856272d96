"""Sharding by jump consistent hashing: a stable key and the number of shards decide the shard, no ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import read_table, text_or_empty

SHARDS = 16
#: Rows of a shard are numbered within so many buckets of their key's hash; the bucket counts are all that is broadcast.
BUCKETS = 1024
#: Jumps made before the rare key with more of them takes the second, longer loop.
FIRST_JUMPS = 48


def _draw(key: Column, step: Column) -> Column:
    """32 uniform bits of a key for one step."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), step.cast("string"))), 1, 8), 16, 10).cast("long")


def jump_hash(key: Column, shards: int) -> Column:
    """struct(shard, grown): a string key's shard among `shards`, and among one more.

    The k-th jump goes from shard b to floor((b + 1) / u) with u the key's k-th uniform draw in (0, 1]; the jumps do not
    depend on the number of shards, so that the last one below each limit is the answer for that limit.
    """
    if shards < 1:
        raise ValueError("shards must be positive")

    def jump(s: Column, k: Column) -> Column:
        after = F.expr("0L") + (s["j"] + 1) * F.lit(1 << 32)
        following = F.floor(after / (_draw(key, k) + 1).cast("double")).cast("long")
        return F.when(
            s["j"] <= shards,
            F.struct(
                F.when(s["j"] < shards, s["j"]).otherwise(s["shard"]).alias("shard"), s["j"].alias("grown"), following.alias("j")
            ),
        ).otherwise(s)

    start = F.struct(F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"), F.lit(0).cast("long").alias("j"))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards + 1, FIRST_JUMPS))), start, jump)
    if shards + 1 > FIRST_JUMPS:
        rest = F.aggregate(F.sequence(F.lit(FIRST_JUMPS + 1), F.lit(shards + 1)), state, jump)
        state = F.when(state["j"] > shards, state).otherwise(rest)
    return state


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    Null text: size 1 and the CRC of no bytes. A null id is a key of its own. Equal rows share a shard and get slots of
    their own: they are counted first and spread out last, so that copies never meet in one window. Other columns of
    docs are not read; an empty table gives an empty one. Slots run from 0 in the order of a hash bucket of the id, id, size and CRC.
    """
    text = F.col(text_col)
    size = F.octet_length(text_or_empty(text)).cast("long") + 1
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"), key.alias("key"))
    rows = rows.groupBy("doc_id", "size", "text_crc32", "key").agg(F.count("*").alias("copies"))
    bucket = F.pmod(_draw(F.col("key"), F.lit(0)), F.lit(BUCKETS)).cast("int")
    rows = rows.select("doc_id", "size", "text_crc32", "copies", jump_hash(F.col("key"), shards).alias("to"), bucket.alias("bucket"))
    rows = rows.select("doc_id", "size", "text_crc32", "copies", F.col("to.shard").cast("int").alias("shard"), F.col("to.grown").cast("int").alias("grown_shard"), "bucket")
    counts = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    earlier = W.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("first", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    # At most shards x BUCKETS rows of three numbers, whatever the input.
    rows = rows.join(F.broadcast(starts) if shards * BUCKETS <= 1 << 18 else starts, ["shard", "bucket"])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    slot = F.col("start") + F.col("first") + F.col("copy") - 1
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.cast("long").alias("slot"), "grown_shard")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read_table(spark, sf_dir, "documents"))


#: Each draw is a UDF-free macro here: 32 bits of the MD5 of "<doc_id>:<step>"; CRC-32 is folded over the bytes.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
rows AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(4294967295, list_reduce(
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) AS text_crc32
  FROM documents, crc_table),
keys AS (SELECT DISTINCT key FROM rows),
jumps AS (
  SELECT key, 0 AS step, 0::BIGINT AS j FROM keys
  UNION ALL
  SELECT key, step + 1, floor((j + 1) * 4294967296 / ((('0x' || substr(md5(key || ':' || (step + 1)), 1, 8))::BIGINT + 1)::DOUBLE))::BIGINT
  FROM jumps WHERE j <= {SHARDS}),
shards AS (
  SELECT key, max(j) FILTER (j < {SHARDS}) AS shard, max(j) FILTER (j <= {SHARDS}) AS grown,
         ('0x' || substr(md5(key || ':0'), 1, 8))::BIGINT % {BUCKETS} AS bucket
  FROM jumps GROUP BY key)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot,
       grown::INTEGER AS grown_shard
FROM rows JOIN shards USING (key)
"""
