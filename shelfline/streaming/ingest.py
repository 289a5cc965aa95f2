"""Incremental file ingestion: each run takes the files that are new and stops."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.files import with_file_lineage
from shelfline.sources.tables import batch_folder, evolved, exists, read_evolving, write_table


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: str,
    glob: str | None = None,
    options: Mapping[str, object] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Stream over the files of a folder and its sub-folders.  ``glob`` matches file names, case-sensitively,
    and tells layouts in one folder apart.  ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true").options(**(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def csv_stream(spark: SparkSession, path: str, schema: str, glob: str, sep: str, max_files: int | None = None) -> DataFrame:
    """Delimited files with a header, every column as text, with file lineage."""
    options = {"header": "true", "sep": sep, "encoding": "UTF-8"}
    return with_file_lineage(file_stream(spark, path, "csv", schema, glob, options, max_files))


def json_records_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    glob: str,
    records: str = "records",
    header: tuple[str, ...] = ("distributor",),
    multi_line: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """Documents with an array of records: one row per record, header fields and lineage kept.

    A multi-line document is read by one task per file; with line-delimited documents files are split."""
    documents = file_stream(spark, path, "json", schema, glob, {"multiLine": multi_line}, max_files)
    flat = with_file_lineage(documents.select(*header, F.explode(records).alias("_record"), "_metadata"))
    lineage = [c for c in flat.columns if c not in (*header, "_record", "_metadata")]
    return flat.select(*header, "_record.*", *lineage)


CORRUPT = "_corrupt"


def documents_stream(spark: SparkSession, path: str, schema: str, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """JSON documents written over several lines, one per file, with lineage.  A document that cannot be read comes as
    one row with its text in ``_corrupt`` and the rest null."""
    options = {"multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return with_file_lineage(file_stream(spark, path, "json", f"{schema}, {CORRUPT} string", glob, options, max_files))


def records_of(documents: DataFrame, records: str = "records", header: tuple[str, ...] = ("distributor",)) -> DataFrame:
    """One row per record of the readable documents, header fields and lineage kept."""
    lineage = [c for c in documents.columns if c.startswith("_") and c != CORRUPT]
    flat = documents.filter(F.col(CORRUPT).isNull()).select(*header, F.explode(records).alias("_record"), *lineage)
    return flat.select(*header, "_record.*", *lineage)


def broken_documents(documents: DataFrame) -> DataFrame:
    """Path, text and time of the documents that could not be read."""
    return documents.filter(F.col(CORRUPT).isNotNull()).select("_source_file", F.col(CORRUPT).alias("document"), "_ingested_at")


def run_documents(stream: DataFrame, good: str, broken: str, checkpoint: str, **shape) -> None:
    """Take the new documents: records to ``good``, broken documents to ``broken``.

    A batch owns a folder in either table and writes it anew when it is retried."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for rows, path in ((records_of(batch, **shape), good), (broken_documents(batch), broken)):
                write_table(rows, batch_folder(batch.sparkSession, path, batch_id))
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    for rows, path in ((records_of(stream, **shape), good), (broken_documents(stream), broken)):
        if not exists(spark, path):  # no document yet: an empty table
            spark.createDataFrame([], rows.schema).write.parquet(path)


def run_evolving(stream: DataFrame, path: str, checkpoint: str) -> list[int]:
    """Append what is new to a table that may gain columns; rows added batch by batch."""
    added: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        added.append(write_table(evolved(batch, path), batch_folder(batch.sparkSession, path, batch_id)))

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return added


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, from the file footers; 0 when it does not exist yet."""
    return spark.read.parquet(path).count() if exists(spark, path) else 0


def run_available_now(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append everything that is new to a Parquet table and return the rows added.

    The file sink commits whole micro-batches through its log, so a retried batch adds nothing twice."""
    spark = stream.sparkSession
    before = row_count(spark, path)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return row_count(spark, path) - before


def layout_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows and distinct source files per layout."""
    counted = None
    for layout, path in paths.items():
        one = read_evolving(spark, path).agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct("_source_file").alias("files")
        )
        one = one.select(F.lit(layout).alias("layout"), "rows", "files")
        counted = one if counted is None else counted.unionByName(one)
    return counted
