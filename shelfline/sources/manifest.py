"""A manifest of delivered files against what was loaded of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.reconcile import verdict

COUNT = "decimal(38,0)"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(object_name, source_value) of a JSON object that maps names to row counts; several manifest files are merged."""
    entries = F.from_json("value", "map<string,bigint>")
    return spark.read.text(path, wholetext=True).select(F.explode(entries).alias("object_name", "source_value"))


def loaded_counts(df: DataFrame, name: Column | None = None) -> DataFrame:
    """Rows by source file of a batch read from files, from the reader's metadata; ``name`` derives the manifest's name
    of a file from ``_metadata.file_path`` and else it is the file name."""
    name = F.col("_metadata.file_name") if name is None else name
    return df.groupBy(name.alias("object_name")).agg(F.count(F.lit(1)).alias("target_value"))


def manifest_check(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row per file: its count in the manifest and as loaded, PASS or FAIL, and what is wrong: missing, unlisted,
    short or long."""
    both = manifest.join(loaded, "object_name", "full_outer")
    listed, there = F.col("source_value").isNotNull(), F.col("target_value").isNotNull()
    short = F.col("target_value") < F.col("source_value")
    problem = F.when(~there, "missing").when(~listed, "unlisted").when(short, "short").when(F.col("target_value") > F.col("source_value"), "long")
    counts = [F.coalesce(c, F.lit(0)).cast(COUNT).alias(c) for c in ("source_value", "target_value")]
    rows = both.select(F.lit("0_manifest").alias("check_level"), "object_name", F.lit("row_count").alias("check_name"), *counts, problem.alias("problem"))
    judged = verdict(rows)
    # an unlisted file fails even when it is empty
    return judged.withColumn("status", F.when(F.col("problem").isNull(), F.col("status")).otherwise("FAIL"))
