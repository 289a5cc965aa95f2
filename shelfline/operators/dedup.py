"""Duplicates, newest rows, set helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct combination of ``columns``; of several copies the smallest row survives, so a
    rerun keeps the same one.  Copies are dropped before the shuffle already."""
    rest = [c for c in df.columns if c not in columns]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*columns).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*columns, *[F.col(f"_kept.{c}").alias(c) for c in rest]).select(*df.columns)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``: an aggregate with map-side combine, not a window."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def rows_of_newest_run(df: DataFrame, at: str, run: str = "run_id") -> DataFrame:
    """All rows of the run that holds the latest ``at``; the run id is a one-row aggregate."""
    newest = df.agg(F.max_by(run, F.struct(at, run)).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(run) == F.col("_newest"), "left_semi")


def unseen(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` yet."""
    return batch.join(target.select(*keys), list(keys), "left_anti")


def distinct_count(columns: Sequence[str]) -> Column:
    """Exact number of distinct (composite) keys, NULLs included."""
    return F.countDistinct(F.struct(*columns))
