"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings every job relies on.  Results do not depend on them, only plans do
#: (apart from the time zone, which decides the date of an instant).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs one more exchange further up the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash(sku) also serves a join on (sku, quarter): the fact table is shuffled once for both.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfline") -> SparkSession:
    """Single-machine session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfline-"))
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused sub-folder path of the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Cut the lineage: write the rows to a table in the shared folder and read them back.

    Later readers see the same rows even after executors are lost, read only the columns they need, and the
    planner knows the table's real size."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    pinned = df.sparkSession.read.schema(df.schema).parquet(path)
    pinned._pinned_at = path
    return pinned


def release(*frames: DataFrame | None) -> None:
    """Remove tables that ``pin`` wrote, once everything made of them is stored itself.  Other frames are left alone."""
    for df in frames:
        path = getattr(df, "_pinned_at", None)
        if path is not None:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
