"""Delimited files in the forms people review and import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = b"\xef\xbb\xbf"


def cell(c, kind: T.DataType):
    """null as empty, booleans as true and false, nested values as JSON."""
    if isinstance(kind, T.ArrayType | T.StructType | T.MapType):
        c = F.to_json(c)
    return F.coalesce(c.cast("string"), F.lit(""))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, bom: bool = False) -> None:
    """Header, minimal quotes, LF, UTF-8, one folder of part files. With bom each part begins with a byte order mark, as the
    first character of its header's first name: spreadsheets then read UTF-8."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = columns or df.columns
    out = df.select(*((cell(F.col(n), kinds[n]) if n in kinds else F.lit("")).alias(("﻿" if bom and i == 0 else "") + n) for i, n in enumerate(names)))
    out.write.option("header", True).option("lineSep", "\n").option("escape", '"').option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; empty cells are '', as the files' writers mean them. A byte order mark is not part of a name."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\x00").option("emptyValue", "").csv(path)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns)).fillna("")


def has_bom(spark: SparkSession, path: str) -> DataFrame:
    """(path, bom) of each file."""
    f = spark.read.format("binaryFile").load(path)
    return f.select("path", (F.substring("content", 1, 3) == F.lit(bytearray(BOM))).alias("bom"))


def append_results(df: DataFrame, path: str, done: str = "transaction_id") -> int:
    """Appends JSON lines for rows whose id the target lacks: a run that broke off is taken up where it ended."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    new = df
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        new = df.join(spark.read.schema(f"{done} string").json(path), done, "left_anti")
    new = new.persist()
    n = new.count()
    if n:
        new.write.mode("append").json(path)
    new.unpersist()
    return n
