"""The stored event table: batch folders as the stream writes them, and segments of many batches.

A batch is a folder ``run_id=.../batch_id=...``.  Compaction rewrites finished batches into a segment of few files under
``_segments`` and then publishes the next manifest, which names the live segments and, for each run, the last batch they
hold.  A reader takes the newest manifest and, besides its segments, only the batches behind them: before the manifest
appears it sees the batches, afterwards the segment, never both.  Folders that no manifest needs are removed by
``vacuum``, later, so a reader that has begun can end."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from shelfline.sources.tables import exists

RUN, BATCH = "run_id", "batch_id"
SEGMENTS, MANIFESTS = "_segments", "_manifests"
#: More segments than this are merged into one with the next batches.
MOST_SEGMENTS = 8


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it is absent."""
    if not exists(spark, path):
        return []
    system, target = _files(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(target))


@dataclass(frozen=True)
class Manifest:
    """Live segments, and by run the last batch that they hold."""

    version: int = 0
    segments: list[str] = field(default_factory=list)
    covered: dict[str, int] = field(default_factory=dict)


def manifest(spark: SparkSession, root: str) -> Manifest:
    names = [n for n in _children(spark, f"{root}/{MANIFESTS}") if n.endswith(".json")]
    if not names:
        return Manifest()
    text = "".join(r.value for r in spark.read.text(f"{root}/{MANIFESTS}/{names[-1]}", wholetext=True).collect())
    return Manifest(**json.loads(text))


def publish(spark: SparkSession, root: str, new: Manifest) -> None:
    """The manifest appears whole or not at all; two writers cannot publish the same version."""
    name = f"{root}/{MANIFESTS}/{new.version:012d}.json"
    system, draft = _files(spark, f"{root}/{MANIFESTS}/.{uuid.uuid4().hex}.draft")
    stream = system.create(draft)
    stream.write(json.dumps(vars(new)).encode())
    stream.close()
    if exists(spark, name) or not system.rename(draft, _files(spark, name)[1]):
        raise RuntimeError(f"another compaction has published version {new.version}")


def batches(spark: SparkSession, root: str, seen: Manifest) -> list[tuple[str, int]]:
    """(run, batch) of the batch folders behind the segments."""
    found = []
    for run in (n.removeprefix(f"{RUN}=") for n in _children(spark, root) if n.startswith(f"{RUN}=")):
        numbers = (n.removeprefix(f"{BATCH}=") for n in _children(spark, f"{root}/{RUN}={run}") if n.startswith(f"{BATCH}="))
        found += [(run, int(n)) for n in numbers if int(n) > seen.covered.get(run, -1)]
    return sorted(found)


def stored(
    spark: SparkSession,
    root: str,
    seen: Manifest | None = None,
    without_run: str | None = None,
    without_batch: tuple[str, int] | None = None,
    columns: str | None = None,
) -> DataFrame | None:
    """The rows of the table, each once, with their run; None when there are none.  ``without_run`` and
    ``without_batch`` leave folders out before anything is read."""
    seen = seen or manifest(spark, root)
    own = [(r, b) for r, b in batches(spark, root, seen) if r != without_run and (r, b) != without_batch]
    places = [(root, [f"{root}/{RUN}={r}/{BATCH}={b}" for r, b in own])]
    for base in (f"{root}/{SEGMENTS}/{s}" for s in seen.segments):
        runs = [n.removeprefix(f"{RUN}=") for n in _children(spark, base) if n.startswith(f"{RUN}=")]
        places.append((base, [f"{base}/{RUN}={r}" for r in runs if r != without_run]))
    reader = spark.read if columns is None else spark.read.schema(f"{columns}, {RUN} string")
    parts = [reader.option("basePath", base).parquet(*paths).drop(BATCH) for base, paths in places if paths]
    rows = None
    for part in parts:
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """Every event once, whether a compaction runs or not."""
    rows = stored(spark, root)
    if rows is None:
        raise FileNotFoundError(f"no events under {root}")
    return rows


def compact(spark: SparkSession, root: str, most_segments: int = MOST_SEGMENTS) -> Manifest | None:
    """Rewrite the finished batches into one segment and publish it; None when there is nothing to do.

    The newest batch of a run may still be retried and is left for the next time.  Beyond ``most_segments`` the older
    segments are merged in, so the table has a bounded number of them."""
    seen = manifest(spark, root)
    behind = batches(spark, root, seen)
    newest = {run: batch for run, batch in behind}
    finished = [(r, b) for r, b in behind if b < newest[r]]
    merging = len(seen.segments) >= most_segments
    if not finished and not (merging and len(seen.segments) > 1):
        return None
    covered = seen.covered | {r: max(b for x, b in finished if x == r) for r, _ in finished}
    rows = _of_batches(spark, root, finished)
    older = stored(spark, root, Manifest(0, seen.segments, seen.covered | newest)) if merging else None
    if older is not None:
        rows = older if rows is None else rows.unionByName(older, allowMissingColumns=True)
    name = uuid.uuid4().hex
    # few files a run, a long one split
    rows.hint("rebalance", RUN).write.partitionBy(RUN).parquet(f"{root}/{SEGMENTS}/{name}")
    new = Manifest(seen.version + 1, [name] if merging else [*seen.segments, name], covered)
    publish(spark, root, new)
    return new


def _of_batches(spark: SparkSession, root: str, chosen: list[tuple[str, int]]) -> DataFrame | None:
    if not chosen:
        return None
    paths = [f"{root}/{RUN}={r}/{BATCH}={b}" for r, b in chosen]
    return spark.read.option("basePath", root).parquet(*paths).drop(BATCH)


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove batch folders, segments and manifests that the newest manifest does not need; returns how many.

    To be called when no reader of an older manifest is left."""
    seen, gone = manifest(spark, root), []
    for run in (n.removeprefix(f"{RUN}=") for n in _children(spark, root) if n.startswith(f"{RUN}=")):
        numbers = [int(n.removeprefix(f"{BATCH}=")) for n in _children(spark, f"{root}/{RUN}={run}") if n.startswith(f"{BATCH}=")]
        gone += [f"{root}/{RUN}={run}/{BATCH}={b}" for b in numbers if b <= seen.covered.get(run, -1)]
    gone += [f"{root}/{SEGMENTS}/{s}" for s in _children(spark, f"{root}/{SEGMENTS}") if s not in seen.segments]
    gone += [f"{root}/{MANIFESTS}/{n}" for n in _children(spark, f"{root}/{MANIFESTS}") if n.endswith(".json") and int(n[:-5]) < seen.version]
    for path in gone:
        system, target = _files(spark, path)
        system.delete(target, True)
    return len(gone)
