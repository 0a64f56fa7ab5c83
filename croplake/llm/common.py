"""What the operators share: the shared work folder, written tables, size-checked broadcasts, components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when a count shows that it has at most this many rows of a few numbers.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder every executor sees, removed when the session's JVM ends.

    It lies in ``spark.checkpoint.dir``; where that is unset, in the warehouse, which all executors share only
    where ``spark.sql.warehouse.dir`` names a shared store (by default it is a folder of the driver).
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/croplake-work/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps read it, and a lost executor costs no more than a read."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, with a broadcast hint only if a count shows that it is small; else Spark shuffles both sides."""
    return F.broadcast(ids) if ids.limit(rows + 1).count() <= rows else ids


def with_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is (``left_semi``) or isn't (``left_anti``) in ``ids``; null equals null."""
    other = sized(ids.select(F.col(ids.columns[0]).alias("__id")))
    return df.join(other, df[key].eqNullSafe(other["__id"]), how)


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python 1,000 at a time where it is at Spark's default of 10,000.

    Of whole texts ten thousand are tens of megabytes, which an executor holds several times over for every
    running task. Results don't depend on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def over_batches(df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` for a generator of column dicts."""
    small_batches(df.sparkSession)
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in kinds], schema=kinds)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Give freed memory back to the system: a worker that is used again would keep what its largest task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in schema.split(","))])


def as_text(column: pa.Array) -> pa.Array:
    """The text column of a batch, nulls as empty."""
    return column.fill_null("") if column.null_count else column


def parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut to a few rows, so that what is made of one at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def passing(batch: pa.RecordBatch, mask: np.ndarray) -> pa.RecordBatch:
    return batch.filter(pa.array(mask, pa.bool_()))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as (node, root): root is the smallest node of the component.

    Alternating large and small stars: every round sends each node's neighbours to the smallest of them, by a
    minimum per node with a map-side step and an equi-join that Spark can split on a hub. The number of rounds
    is logarithmic; each round is written to the shared folder. Nothing is gathered on the driver but one sum.
    Loops and repeated edges change nothing; no edges give an empty table.
    """
    now = written(_down(edges.where("a <> b")), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(_down(large), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = written(_down(small), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

