"""Batch readers of delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Path and modification time of the file and the time of ingestion."""
    return df.withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_file_modified": F.col("_metadata.file_modification_time"),
            "_ingested_at": F.current_timestamp(),
        }
    )


def load_csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame:
    """A reference file, all columns as text unless a schema says otherwise."""
    reader = spark.read.option("header", "true").option("sep", sep)
    if schema:
        reader = reader.schema(schema)
    return with_file_lineage(reader.csv(path))
