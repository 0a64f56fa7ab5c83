"""Session settings the operators count on, and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: narrow rows of one task where tasks are as many as the rows ask for
TASK_ROWS = 2_000_000
#: Adaptive settings. ``forceOptimizeSkewedJoin`` lets Spark split a hot join key even when the
#: split costs one more shuffle for the aggregate that follows the join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # narrow rows shrink so much in a shuffle that Spark's 64 MB are well over 1 GB of a task that sorts and groups them
    ADVISORY: "8m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # longer generated methods are not compiled by the JVM; Spark then does better without fusing
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def builder(app_name: str = "croplake") -> SparkSession.Builder:
    """A session builder with :data:`SETTINGS`; master and memory are left to the caller."""
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, or where that is unset a folder of the warehouse.

    On a cluster set ``spark.checkpoint.dir``: the warehouse is shared by all executors only where
    ``spark.sql.warehouse.dir`` names a shared store, and by default it is a folder of the driver.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(configured)
    return configured


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of an equi-join that is made by a shuffle, so that no side passes the driver.

    Spark takes the size of a table that is worked out of a few stored columns (shapes, exploded rows) from
    those columns; by that it would broadcast what is many times as large.
    """
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` to ``tasks`` (``spark.sql.shuffle.partitions``): for rows of few bytes and much work.

    Adaptive execution would put them together again by their bytes.
    """
    return df.repartition(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def tasks_for(*frames: DataFrame) -> int:
    """Tasks for the rows of ``frames`` together, :data:`TASK_ROWS` each and at least one per slot.

    They grow with the rows, whatever ``spark.sql.shuffle.partitions`` is; the frames are counted here.
    """
    rows = sum(df.count() for df in frames)
    return max(frames[0].sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def small_tasks(spark: SparkSession) -> None:
    """Give ``spark`` the advisory size of :data:`SETTINGS` where its own stands at Spark's default."""
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, SETTINGS[ADVISORY])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and go on from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
