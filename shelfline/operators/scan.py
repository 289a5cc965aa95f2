"""Ordered scans per key that survive heavy keys.

A window partitioned by an entity key puts the whole history of that entity into one task.  When one
entity owns a large part of the log this task never ends.  ``ordered_scan`` first counts rows per key
(one column-pruned aggregate).  With no heavy key it is an ordinary window.  Otherwise the rows of heavy
keys are range-partitioned by (key, order) into slices, scanned slice by slice, and the
slices are linked through one summary row each.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import pin

#: A key with more rows than this is scanned in slices of about this many rows.
HEAVY_ROWS = 2_000_000
#: Slices of the heavy rows for each core, at most.
SLICES_PER_CORE = 8


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of two aliased frames on ``keys``."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


@dataclass(frozen=True)
class HeavyKeys:
    """Keys with more rows than the limit (``frame`` is None when there is none)."""

    keys: tuple[str, ...]
    frame: DataFrame | None = None
    count: int = 0
    rows: int = 0


def heavy_keys(df: DataFrame, keys: Sequence[str], limit: int = HEAVY_ROWS, rows: Column | None = None) -> HeavyKeys:
    """Count rows per key and keep the keys above ``limit``; only two numbers reach the driver."""
    rows = F.count(F.lit(1)) if rows is None else rows
    counted = df.groupBy(*keys).agg(rows.alias("_rows")).filter(F.col("_rows") > limit)
    found = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("total")).first()
    if found["n"] == 0:
        return HeavyKeys(tuple(keys))
    return HeavyKeys(tuple(keys), pin(counted.select(*keys)), found["n"], int(found["total"]))


def split_heavy(df: DataFrame, heavy: HeavyKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of heavy keys, the other rows).  Spark broadcasts the stored key list when its size allows."""
    left, right = df.alias("_l"), heavy.frame.alias("_r")
    condition = same_keys("_l", "_r", heavy.keys)
    return left.join(right, condition, "left_semi"), left.join(right, condition, "left_anti")


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Mapping[str, Column] | None = None,
    upcoming: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    heavy_rows: int = HEAVY_ROWS,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Add scan columns computed per ``keys`` in ascending ``order``.

    ``carry``     last non-null value at or before the row
    ``upcoming``  first non-null value strictly after the row
    ``running``   cumulative sum up to and including the row

    ``order`` must be a total order per key.  Wrap a value in a struct when its own NULL must be kept
    apart from "nothing seen".  ``heavy`` passes a count already made (its keys a prefix of ``keys``).
    """
    carry, upcoming, running = dict(carry or {}), dict(upcoming or {}), dict(running or {})
    heavy = heavy or heavy_keys(df, keys, heavy_rows)
    if heavy.count == 0:
        return _scan(df, keys, order, carry, upcoming, running)
    hot, cold = split_heavy(df, heavy)
    slices = min(math.ceil(heavy.rows / heavy_rows), SLICES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    return _scan(cold, keys, order, carry, upcoming, running).unionByName(
        _sliced_scan(hot, keys, order, carry, upcoming, running, slices)
    )


def _scan(df, keys, order, carry, upcoming, running) -> DataFrame:
    forward = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # A frame that runs to the end of the partition is recomputed for every row; the same frame seen
    # from the other end grows row by row.
    backward = (
        Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    )
    # the backward pass goes first, so the rows leave in ascending order and a following scan needs no sort
    df = df.withColumns({name: F.last(value, ignorenulls=True).over(backward) for name, value in upcoming.items()})
    added = {name: F.last(value, ignorenulls=True).over(forward) for name, value in carry.items()}
    added |= {name: F.sum(value).over(forward) for name, value in running.items()}
    return df.withColumns(added)


def _sliced_scan(df, keys, order, carry, upcoming, running, slices) -> DataFrame:
    placed = df.repartitionByRange(max(2, slices), *keys, *order).withColumn("_slice", F.spark_partition_id())
    placed = pin(placed)
    local = _scan(placed, [*keys, "_slice"], order, carry, upcoming, running)

    position = F.struct(*[F.col(c) for c in order])
    ends = {f"_last_{n}": F.max_by(v, F.when(v.isNotNull(), position)) for n, v in carry.items()}
    ends |= {f"_first_{n}": F.min_by(v, F.when(v.isNotNull(), position)) for n, v in upcoming.items()}
    ends |= {f"_sum_{n}": F.sum(v) for n, v in running.items()}
    summary = placed.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in ends.items()])

    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    links = {f"_in_{n}": F.last(f"_last_{n}", ignorenulls=True).over(before) for n in carry}
    links |= {f"_in_{n}": F.last(f"_first_{n}", ignorenulls=True).over(after) for n in upcoming}
    links |= {f"_in_{n}": F.sum(f"_sum_{n}").over(before) for n in running}
    linked = summary.withColumns(links).select(*keys, "_slice", *links)

    joined = local.alias("_l").join(
        # one row per (heavy key, slice): at most heavy keys + slices rows
        linked.alias("_r"),
        same_keys("_l", "_r", [*keys, "_slice"]),
        "left",
    )
    columns = [F.col(f"_l.{c}") for c in df.columns]
    for name in (*carry, *upcoming):
        columns.append(F.coalesce(F.col(f"_l.{name}"), F.col(f"_r._in_{name}")).alias(name))
    for name in running:
        own, inbound = F.col(f"_l.{name}"), F.col(f"_r._in_{name}")
        columns.append(F.when(inbound.isNull(), own).otherwise(F.coalesce(own, F.lit(0)) + inbound).alias(name))
    return joined.select(*columns)
