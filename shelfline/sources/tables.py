"""Reading and writing tables of the layered store (Parquet folders ``<root>/<layer>/<table>``)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.dedup import dedup_exact, unseen
from shelfline.operators.runlog import Step


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path.  What cannot be read there is an error for the reader, not absence."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A source table over JDBC, in parallel key ranges when a numeric key is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="10000", **properties)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def read_partitioned(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A folder of Parquet files with partition folders; filters on them prune files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def with_provenance(df: DataFrame, label: str) -> DataFrame:
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source": F.lit(label)})


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The row count of a write comes out of the write job itself."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a table including its schema; returns the rows written."""
    counted, seen = _counted(df)
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def append_table(df: DataFrame, path: str) -> int:
    counted, seen = _counted(df)
    counted.write.mode("append").parquet(path)
    return seen.get["rows"]


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files gained columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


class TypeConflict(ValueError):
    """A column of a batch has another type than the stored one."""


#: Partition folders of tables that streams write batch by batch.
OWNERS = ("run_id", "batch_id")


def evolved(df: DataFrame, path: str) -> DataFrame:
    """Rows brought to the schema that a table will have with them: stored columns first, in their order, missing ones
    null, new ones behind them.  A column whose type differs from the stored one is refused."""
    spark = df.sparkSession
    stored = [f for f in read_evolving(spark, path).schema if f.name not in OWNERS] if exists(spark, path) else []
    types = {f.name: f.dataType for f in stored}
    conflicts = [f"{f.name}: {types[f.name].simpleString()} is stored, {f.dataType.simpleString()} comes" for f in df.schema if types.get(f.name, f.dataType) != f.dataType]
    if conflicts:
        raise TypeConflict("; ".join(conflicts))
    known = [F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored]
    return df.select(*known, *[F.col(f"`{c}`") for c in df.columns if c not in types])


def append_evolving(df: DataFrame, path: str) -> int:
    """Append rows to a table that may gain columns; returns the rows written."""
    return append_table(evolved(df, path), path)


def batch_folder(spark: SparkSession, path: str, batch_id: int) -> str:
    """Folder that a micro-batch owns, by the stream's identity and the batch's number: a retry writes it anew and
    leaves no second copy, a stream under another checkpoint has folders of its own."""
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "no-stream"
    return f"{path}/{OWNERS[0]}={run}/{OWNERS[1]}={batch_id}"


def read_pruned(spark: SparkSession, path: str, partition: str, calendar: DataFrame, day: str) -> DataFrame:
    """The partitions of a table whose value occurs in a (filtered) calendar.  The calendar's values reach the scan as
    a pruning filter, so the files of other partitions are not opened."""
    wanted = calendar.select(F.col(day).alias(partition)).distinct()
    # a calendar has one row per day at most
    return read_partitioned(spark, path).join(F.broadcast(wanted), partition, "left_semi")


def stored_counts(spark: SparkSession, root: str, layers: Sequence[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """Rows of every stored table by layer, from the file footers, with the time of counting."""
    counted = None
    for layer in layers:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{layer}")
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(target):
            continue
        for name in sorted(status.getPath().getName() for status in system.listStatus(target)):
            one = spark.read.parquet(table_path(root, layer, name)).agg(F.count(F.lit(1)).alias("row_count"))
            one = one.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count", F.current_timestamp().alias("counted_at"))
            counted = one if counted is None else counted.unionByName(one)
    return counted


def write_clustered(df: DataFrame, path: str, column: str, partitions: int | None = None) -> int:
    """Range-partition and sort by a column, so that row-group statistics skip data outside a range."""
    parts = (partitions,) if partitions else ()
    counted, seen = _counted(df.repartitionByRange(*parts, F.col(column)).sortWithinPartitions(column))
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def insert_new(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str]) -> int:
    """Append the rows whose key is not there yet; of several copies in the batch the smallest row counts.

    The target is reduced to the batch's keys before it meets the batch, so it is scanned, not shuffled, while
    the batch is small."""
    fresh = dedup_exact(batch, keys)
    if exists(spark, path):
        stored = spark.read.schema(batch.schema).parquet(path).select(*keys)
        fresh = unseen(fresh, stored.join(fresh.select(*keys), list(keys), "left_semi"), keys)
    return append_table(fresh, path)


def updated(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """Keyed update as a rewrite: rows meeting ``where`` take the new values."""
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def build(
    spark: SparkSession, root: str, layer: str, name: str, df: DataFrame, run_id: str, step: str, log_path: str | None = None
) -> DataFrame:
    """Write a table, log the step with its row count, return the written table."""
    doing = Step(run_id, layer, step, f"{layer}.{name}")
    path = table_path(root, layer, name)
    rows = write_table(df, path)
    if log_path:
        append_table(doing.outcome(spark, rows), log_path)
    return spark.read.parquet(path)


def snapshot_all(
    spark: SparkSession,
    readers: Mapping[str, Callable[[], DataFrame]],
    root: str,
    label: str,
    run_id: str,
    log_path: str,
    step: str = "snapshot",
) -> None:
    """Full reload of source tables into bronze.  A table that fails is logged and the rest go on."""
    for name, reader in readers.items():
        doing = Step(run_id, "bronze", step, f"bronze.{name}")
        try:
            rows = write_table(with_provenance(reader(), f"{label}/{name}"), table_path(root, "bronze", name))
            told = doing.outcome(spark, rows)
        except Exception as problem:  # noqa: BLE001 - the log carries the failure
            told = doing.outcome(spark, problem=problem)
        append_table(told, log_path)


def comment_on(spark: SparkSession, table: str, text: str, column: str | None = None) -> None:
    """Describe a catalog table or one of its columns."""
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    if column is None:
        spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")
    else:
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT '{quoted}'")
