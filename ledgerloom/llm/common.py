"""Helpers that the corpus operators share: scratch tables, columns and connected components."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as every word-level operator here defines it.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting (tests) gets a folder of its own; a cluster without it is an error,
    as executors and driver share no local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Rows that go to a Python worker at a time. Spark's own number is meant for rows of numbers: of long texts it makes batches whose
#: buffers, in the executor and in the worker, are many times as large.
TEXT_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lets no batch of the session have more than TEXT_ROWS rows; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= TEXT_ROWS:
        spark.conf.set(name, TEXT_ROWS)


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive any executor."""

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark, self.compact = spark, False
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, compact: bool | None = None) -> DataFrame:
        """df, written once and read back. compact: in partitions of the advisory size, not as many as there are cores, for tables
        that are cheap to make; each file costs a file system several requests, a local one several processes."""
        self.count += 1
        path, name = f"{self.root}/{self.count}", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
        before = self.spark.conf.get(name, "true")
        if self.compact if compact is None else compact:
            self.spark.conf.set(name, "false")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(name, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def part(self, compact: bool = False) -> Scratch:
        """A folder below this one, to be closed on its own; compact: what its writes do if they don't say."""
        out = Scratch.__new__(Scratch)
        out.compact = compact
        self.parts = getattr(self, "parts", 0) + 1
        out.spark, out.root, out.count = self.spark, f"{self.root}/part-{self.parts}", 0
        return out

    def _delete(self, path: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, table: DataFrame) -> None:
        """Remove a table that nothing will read again."""
        self._delete(table._scratch_path)

    def close(self) -> None:
        """Remove all its tables, when nothing will read them again."""
        self._delete(self.root)


#: Rows of a scratch file of connected_components.
FILE_ROWS = 250_000


def settled(spark: SparkSession, name: str, build) -> DataFrame:
    """What build(scratch) gives, written; the scratch tables that it was made of are gone."""
    scratch = Scratch(spark, name)
    work = scratch.part()
    out = scratch.write(build(work))
    work.close()
    return out


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until df has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of edges (a long, b long); root is the smallest node of its component.

    Alternates large-star and small-star steps, each an aggregation and an equi-join, until the edges form stars.
    A node with very many links is pre-aggregated by the partial min. The minima are written before they are joined: beside
    an aggregate of its own key the skew join could not split a hub's links.
    Tables are written in files of about FILE_ROWS rows, so that few edges don't make as many files as there are partitions.
    An edge table without rows gives a table without rows; self-links and repeated links are ignored.
    """

    def star(e: DataFrame, least: DataFrame) -> DataFrame:
        return e.join(least, "a")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = scratch.write(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = mark(current)
    while seen[0]:
        files = math.ceil(seen[0] / FILE_ROWS)
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(files))
        large = star(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.write(large.coalesce(files))
        scratch.drop(least)
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(files))
        small = star(large, least).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        following = scratch.write(small.coalesce(files))
        now = mark(following)
        for done in (least, large, current):
            scratch.drop(done)
        current = following
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


#: Bytes of text that a Python worker handles at a time, but for a single longer text.
SLICE_BYTES = 4 << 20


def _trim() -> None:
    """Hands freed memory back to the system: workers are used again, and would keep the most that any task ever took."""
    import ctypes

    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batches, column: int):
    """Arrow batches cut into runs of rows of about SLICE_BYTES of a column of texts, string or binary."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        n = batch.num_rows
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(lengths) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
        del batch, lengths, part
        _trim()


def whole_group(run):
    """A function of a group's table, for applyInArrow, after which its memory is handed back."""

    def wrapped(table):
        import pyarrow as pa

        pa.set_memory_pool(pa.system_memory_pool())
        try:
            return run(table)
        finally:
            if table.nbytes > SLICE_BYTES // 4:
                _trim()

    return wrapped
