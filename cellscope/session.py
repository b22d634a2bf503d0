"""Spark session and storage helpers shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, app_name: str = "cellscope",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the jobs are tuned for.

    AQE is on so that shuffle partitions coalesce at runtime, skewed join
    partitions are split, and sort-merge joins turn into broadcast joins only
    when the measured side is below the broadcast threshold.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "16g")
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    # on a cluster the number of shuffle partitions is the cluster's to set; AQE coalesces from there
    if shuffle_partitions or (master or "").startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read.
    A scratch folder is chosen only when the setting is absent and Spark runs
    in local mode (tests, laptops).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="cellscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def filter_computed(df: DataFrame, cond) -> DataFrame:
    """Keep rows where ``cond`` holds, evaluating ``cond`` once per row.

    A Filter is pushed below the projections it depends on and every column
    it names is replaced by its defining expression; for costly derived
    columns (hash-derived coordinates, ring geometry) that repeats the work
    per reference. A 0/1-element explode keeps the same semantics but is not
    pushed down.
    """
    cols = df.columns
    flagged = df.withColumn("__keep", cond)
    gate = F.when(F.col("__keep"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return flagged.select(*cols, F.explode(gate).alias("__k")).drop("__k")


#: Most rows of a side that is broadcast on the strength of a count.
BROADCAST_ROWS = 100_000


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when a count shows at most ``limit`` rows; else the join is left to the planner."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: Rows that a task of a counted shuffle gets on average.
TASK_ROWS = 1_000_000


def row_tasks(*frames: DataFrame) -> int:
    """Tasks for a shuffle of the largest of ``frames`` (tables as read: they are counted), one for each TASK_ROWS rows."""
    return max(1, *(-(-f.count() // TASK_ROWS) for f in frames))


def deal(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over ``tasks`` tasks, or over as many as run at once if these are more; with one task it is
    left to the planner.

    The planner's shuffles have a fixed number of partitions and are coalesced down to the cores, so their tasks grow with the input.
    """
    return df if tasks == 1 else df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), *keys)


def deal_join(many: DataFrame, few: DataFrame, tasks: int, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key``, both sides dealt by it over ``tasks`` tasks. ``few`` is hashed and ``many`` streams past it, so
    that a key with very many rows takes time in its task but no memory."""
    if tasks == 1:
        return many.join(few, key, how)
    return deal(many, tasks, key).join(deal(few, tasks, key).hint("shuffle_hash"), key, how)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage with a replicated, shared copy: a lost executor re-reads the
    files instead of recomputing the upstream joins.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
