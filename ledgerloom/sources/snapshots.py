"""Landed JSON snapshots: one folder a run, a manifest that says whether it is complete, numbered files of records."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

_SIDE = T.StructType([T.StructField(n, T.StringType()) for n in ("account_id", "account_name", "sub_account_id", "sub_account_name", "tax_id", "tax_name", "tax_long_name")]
                     + [T.StructField("value", T.LongType()), T.StructField("tax_value", T.LongType())]
                     + [T.StructField(n, T.StringType()) for n in ("department_id", "department_name", "trade_partner_code", "trade_partner_name", "invoice_kind")])
_TEXTS = lambda *names: [T.StructField(n, T.StringType()) for n in names]

JOURNAL = T.StructType(
    [*_TEXTS("id"), T.StructField("number", T.LongType()), *_TEXTS("transaction_date"), T.StructField("term_period", T.LongType()), *_TEXTS("journal_type", "entered_by"),
     T.StructField("is_realized", T.BooleanType()), *_TEXTS("memo"), T.StructField("tags", T.ArrayType(T.StringType())), *_TEXTS("transaction_id"),
     T.StructField("voucher_file_ids", T.ArrayType(T.StringType())), *_TEXTS("create_time", "update_time"),
     T.StructField("branches", T.ArrayType(T.StructType([T.StructField("remark", T.StringType()), T.StructField("debitor", _SIDE), T.StructField("creditor", _SIDE)])))]
)
LINE_ITEM = T.StructType([*_TEXTS("id", "date"), T.StructField("value", T.LongType()), *_TEXTS("side", "content", "memo", "journalizing_status", "connected_account_id", "connected_sub_account_id"), T.StructField("voucher_file_ids", T.ArrayType(T.StringType()))])
TERM = T.StructType([T.StructField("fiscal_year", T.IntegerType()), *_TEXTS("start_date", "end_date", "tax_method", "accounting_method")])
CONNECTED = T.StructType([*_TEXTS("id", "name"), T.StructField("connected_sub_accounts", T.ArrayType(T.StructType(_TEXTS("id", "name", "account_id", "sub_account_id"))))])


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The newest run folder whose manifest can be read and does not say failed; folders without one are no runs."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/*/manifest.json")
    if not fs.globStatus(found):
        return None
    m = spark.read.schema("status string, fetched_at string, _corrupt_record string").option("multiLine", True).json(f"{root}/*/manifest.json")
    m = m.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/manifest\\.json$", 1)).cache()
    best = m.where("_corrupt_record is null and coalesce(status, 'complete') <> 'failed'").agg(F.max("run")).first()[0]
    m.unpersist()
    return f"{root}/{best}" if best else None


def read_records(spark: SparkSession, run: str, key: str, schema: T.StructType) -> DataFrame:
    """All records under `key` of the run's <key>_*.json files; of equal ids the first, by file name and position."""
    files = spark.read.schema(T.StructType([T.StructField(key, T.ArrayType(schema))])).option("multiLine", True).json(f"{run}/{key}_*.json")
    rows = files.select(F.col("_metadata.file_name").alias("_file"), F.posexplode(key).alias("_pos", "_r"))
    first = F.row_number().over(W.partitionBy("_r.id").orderBy("_file", "_pos")) if "id" in schema.names else F.lit(1)
    return rows.withColumn("_n", first).where("_n = 1").select("_r.*")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, key: str | None = None) -> DataFrame:
    """JSON lines; with a key, of equal keys the last line counts. Blank lines are no records."""
    rows = spark.read.schema(schema).json(path)
    if key is None:
        return rows
    at = rows.select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    w = W.partitionBy(key).orderBy(F.desc("_f"), F.desc("_b"), F.desc("_i"))
    return at.withColumn("_n", F.row_number().over(w)).where(f"_n = 1 and {key} is not null").drop("_f", "_b", "_i", "_n")


def as_dates(df: DataFrame, *columns: str) -> DataFrame:
    """ISO texts to dates by their first ten characters; what is no date becomes null."""
    return df.withColumns({c: F.try_to_date(F.substring(c, 1, 10)) for c in columns})


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_run(spark: SparkSession, root: str, sample: bool = False, now: datetime.datetime | None = None) -> str:
    """A new run folder named by the time, which must not be there yet."""
    run = f"{root}/{(now or datetime.datetime.now()):%Y%m%d-%H%M%S}" + "-sample" * sample
    path, fs = _fs(spark, run)
    if fs.exists(path):
        raise FileExistsError(run)
    fs.mkdirs(path)
    return run


def save_json(spark: SparkSession, path: str, data) -> None:
    """A small JSON document, written beside its place and then moved there, so that no reader sees half of it."""
    target, fs = _fs(spark, path)
    part, _ = _fs(spark, path + ".tmp")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(data, ensure_ascii=False, indent=2, default=str).encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot write {path}")


def write_manifest(spark: SparkSession, run: str, now: datetime.datetime | None = None, **fields) -> None:
    """The run's manifest: when it was fetched, and what the caller says of it. Without one a run doesn't count."""
    save_json(spark, f"{run}/manifest.json", {"fetched_at": (now or datetime.datetime.now()).isoformat(timespec="seconds")} | fields)


def load_json(spark: SparkSession, path: str):
    """A small JSON document."""
    return json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def run_or_latest(spark: SparkSession, root: str, run: str | None = None) -> str | None:
    """The named run, else the latest one that counts."""
    return run or latest_run(spark, root)


def term_range(terms: DataFrame, today: str, start: str | None = None, end: str | None = None) -> tuple:
    """(start, end) as dates: both as given, or the newest term begun by today, cut off there."""
    if start or end:
        if not (start and end):
            raise ValueError("both ends of a range must be given")
        return datetime.date.fromisoformat(start), datetime.date.fromisoformat(end)
    day = F.lit(today).cast("date")
    t = terms.select(F.col("start_date").cast("date").alias("s"), F.col("end_date").cast("date").alias("e")).where(F.col("s") <= day)
    row = t.agg(F.max("s").alias("s"), F.max_by(F.least("e", day), "s").alias("e")).first()
    if row.s is None:
        raise ValueError("no term has begun")
    return row.s, row.e


def land(spark: SparkSession, run: str, key: str, name: str, items: list[dict], meta: dict, period: dict) -> None:
    """One file of fetched records, <key>_<name>.json, with its period and metadata."""
    save_json(spark, f"{run}/{key}_{name}.json", {"period": period, "metadata": meta, key: items})
