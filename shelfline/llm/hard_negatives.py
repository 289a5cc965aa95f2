"""Hard negatives for contrastive training, by a secondary-sort shuffle.

Every pair that can matter becomes one packed key (anchor, descending score, kind, id).  Keys are dealt by anchor and
sorted within partitions (``repartition`` and ``sortWithinPartitions``, the DataFrame form of
repartitionAndSortWithinPartitions), so one pass over a partition meets an anchor's rows from the best score down: a
positive opens a window of allowed negative scores, a negative falls into the windows open at its score and is emitted
at once.  The pass holds the windows of one anchor, never its rows.

What has to be shuffled is cut down exactly before that.  Anchors and rows are dealt to a grid of blocks of bounded
size; a grid cell multiplies its blocks tile by tile and keeps of each anchor only what can be among the first: first
its best positives, then, once the windows are known, the best negatives of each window.  A cell emits at most
``positives`` or ``positives * negatives`` keys an anchor, however many rows its block has.

Scores are inner products of floor(256 * x), exact integers: by floating point while sums stay below 2**53, by 64-bit
integers below 2**62, and by unbounded ones beyond, where scores end at the limits of 64 bits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import pin

#: Rows, and anchors, of a block at most, for vectors of 64 components; longer vectors make smaller blocks.
BLOCK_ROWS, BLOCK_ANCHORS, BLOCK_DIMS = 65_536, 32_768, 64
#: Rows of a block at least, so that a small table still occupies all cores.
LEAST_ROWS = 1_024
#: Anchors and rows multiplied at once.
TILE_ANCHORS, TILE_ROWS = 512, 2_048

SIGN = np.uint64(1 << 63)
TOP = 2**63 - 1
POSITIVE, NEGATIVE = 0, 1
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) of the rows that take part, repeated rows once; labels as text."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    taking = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    return rows.filter(taking).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label")).distinct()


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones are filled up with zeros."""
    column = table.column("embedding").combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.float64)
    sizes = np.diff(np.asarray(column.offsets))
    whole = np.clip(np.floor(values * 256.0), -np.finfo(np.float64).max, np.finfo(np.float64).max)
    if len(sizes) and (sizes == dims).all():
        return whole.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = whole
    return out


def _typed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the narrowest type whose products are exact."""
    most = max(1, a.shape[1]) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most < 2**53:
        return a, b
    if most < 2**62:
        return a.astype(np.int64), b.astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return (whole(a) if a.size else a.astype(object)), (whole(b) if b.size else b.astype(object))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    s = a @ b.T
    return np.clip(s, -TOP, TOP) if s.dtype == object else s


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest negative score n with low * score <= 100 * n <= high * score."""
    whole, rest = np.divmod(score, 100)  # no product passes 64 bits
    return low * whole - (-low * rest) // 100, high * whole + (high * rest) // 100


class _Best:
    """The first ``keep`` (score, id) of every anchor, scores descending and ids ascending, over rows that come in
    ascending id order from tile to tile."""

    def __init__(self, anchors: int, keep: int, above: np.ndarray):
        self.keep, self.above = keep, above  # only scores above count
        self.anchor = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.int64)
        self.id = np.empty(0, dtype=np.int64)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(anchor):
            return
        a, s, i = (np.concatenate(x) for x in ((self.anchor, anchor), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, a))
        a, s, i = a[order], s[order], i[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])
        a, s, i = a[new], s[new], i[new]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        place = np.arange(len(a)) - np.repeat(first, np.diff(first, append=len(a)))
        kept = place < self.keep
        self.anchor, self.score, self.id = a[kept], s[kept], i[kept]
        full = self.anchor[place[kept] == self.keep - 1]
        self.above[full] = self.score[place[kept] == self.keep - 1]  # an equal score further on has a larger id


def _keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.Table:
    packed = np.empty(len(anchor), dtype=KEY)
    packed["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ SIGN
    packed["score"] = ~(score.astype(np.int64).view(np.uint64) ^ SIGN)
    packed["kind"] = kind
    packed["id"] = ids.astype(np.int64).view(np.uint64) ^ SIGN
    flat = pa.py_buffer(packed.tobytes())
    binary = pa.Array.from_buffers(pa.binary(KEY.itemsize), len(packed), [None, flat]).cast(pa.binary())
    return pa.table({"anchor": pa.array(anchor, pa.int64()), "score": pa.array(score, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "key": binary})


KEYS = "anchor long, score long, vec_id long, key binary"


def _cell(anchors: pa.Table, rows: pa.Table) -> tuple:
    """Ids, label codes and matrices of a grid cell, rows in ascending id order."""
    rows = rows.sort_by([("vec_id", "ascending")])
    dims = max([0, *(int(np.diff(np.asarray(t.column("embedding").combine_chunks().offsets)).max(initial=0)) for t in (anchors, rows))])
    a, b = _typed(_matrix(anchors, dims), _matrix(rows, dims))
    labels = pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks], pa.string()).combine_chunks().dictionary_encode()
    codes = np.asarray(labels.indices)
    return np.asarray(anchors.column("vec_id")), codes[: len(a)], a, np.asarray(rows.column("vec_id")), codes[len(a) :], b


def _tiles(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    for i in range(0, len(a), TILE_ANCHORS):
        for j in range(0, len(b), TILE_ROWS):
            yield i, j, _products(a[i : i + TILE_ANCHORS], b[j : j + TILE_ROWS])


def best_positives(keep: int):
    """Of a grid cell, the best ``keep`` other rows of each anchor's label."""

    def of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a_ids, a_codes, a, b_ids, b_codes, b = _cell(anchors, rows)
        parts = []
        for code in np.unique(a_codes):  # only rows of the same label are multiplied
            at, bt = np.flatnonzero(a_codes == code), np.flatnonzero(b_codes == code)
            best = _Best(len(at), keep, np.full(len(at), -TOP - 1, dtype=np.int64))
            for i, j, s in _tiles(a[at], b[bt]):
                other = a_ids[at[i : i + len(s)]][:, None] != b_ids[bt[j : j + s.shape[1]]][None, :]
                above = best.above[i : i + len(s)]
                x, y = np.nonzero((s > above[:, None]) & other)
                best.add(x + i, s[x, y].astype(np.int64), b_ids[bt[y + j]])
            parts.append(_keys(a_ids[at[best.anchor]], best.score, POSITIVE, best.id))
        return pa.concat_tables(parts) if parts else _keys(*[np.empty(0, np.int64)] * 2, POSITIVE, np.empty(0, np.int64))

    return of


def best_negatives(keep: int, low: int, high: int):
    """Of a grid cell, the best ``keep`` rows of other labels in each of an anchor's windows; ``scores`` are its positives'."""

    def of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a_ids, a_codes, a, b_ids, b_codes, b = _cell(anchors, rows)
        lists = anchors.column("scores").to_pylist()
        width = max(map(len, lists), default=0)
        top, best = np.full((len(a), width), -TOP - 1, dtype=np.int64), []
        for w in range(width):
            has = np.array([len(x) > w for x in lists])
            least = np.full(len(a), TOP, dtype=np.int64)  # no window: nothing is above
            least[has], top[has, w] = window_of(np.array([x[w] for x in lists if len(x) > w], dtype=np.int64), low, high)
            best.append(_Best(len(a), keep, np.where(has, least - 1, TOP)))
        for i, j, s in _tiles(a, b):
            n = len(s)
            lowest = np.min([x.above[i : i + n] for x in best], axis=0)
            x, y = np.nonzero((s > lowest[:, None]) & (s <= top[i : i + n].max(axis=1)[:, None]) & (a_codes[i : i + n, None] != b_codes[None, j : j + s.shape[1]]))
            score = s[x, y].astype(np.int64)
            for w, one in enumerate(best):
                inside = (score > one.above[x + i]) & (score <= top[x + i, w])
                one.add(x[inside] + i, score[inside], b_ids[y[inside] + j])
        found = [np.concatenate([np.empty(0, np.int64), *(getattr(x, f) for x in best)]) for f in ("anchor", "score", "id")]
        return _keys(a_ids[found[0]], found[1], NEGATIVE, found[2])

    return of


def _grid(anchors: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Anchors and rows dealt to the cells of a grid of bounded blocks."""
    dims = F.coalesce(F.max(F.size("embedding")), F.lit(1))
    n, widest = rows.agg(F.count(F.lit(1)), dims).first()
    narrow = max(1.0, widest / BLOCK_DIMS)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    down = max(1, math.ceil(n * narrow / BLOCK_ROWS), min(2 * cores, n // LEAST_ROWS))
    across = max(1, math.ceil(anchors.count() * narrow / BLOCK_ANCHORS))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = anchors.withColumn("across", F.pmod(F.xxhash64("vec_id"), F.lit(across)).cast("int")).withColumn("down", every(down))
    spread = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(down)).cast("int")
    return dealt, rows.withColumn("down", spread).withColumn("across", every(across))


def _over_grid(anchors: DataFrame, rows: DataFrame, function) -> DataFrame:
    left, right = _grid(anchors, rows)
    cells = left.groupBy("across", "down").cogroup(right.groupBy("across", "down"))
    return cells.applyInArrow(function, KEYS)


def stream_windows(positives: int, negatives: int, low: int, high: int):
    """Batches of keys in order in, (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) out."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, last, opened = None, None, []
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("key")).to_pylist()
            keys = np.frombuffer(b"".join(column), dtype=KEY)
            anchors, ids = ((keys[f].astype(np.uint64) ^ SIGN).view(np.int64).tolist() for f in ("anchor", "id"))
            scores = (~keys["score"].astype(np.uint64) ^ SIGN).view(np.int64)
            least, most = (x.tolist() for x in window_of(scores, low, high))
            out: list[tuple] = []
            for key, a, s, kind, i, lo, hi in zip(column, anchors, scores.tolist(), keys["kind"].tolist(), ids, least, most, strict=True):
                if key == last:
                    continue
                last = key
                if a != anchor:
                    anchor, opened = a, []
                if kind == POSITIVE:
                    if len(opened) < positives:
                        opened.append([i, s, lo, hi, 0])
                    continue
                for window in opened:
                    if window[2] <= s <= window[3] and window[4] < negatives:
                        window[4] += 1
                        out.append((a, window[0], window[4], i, window[1], s))
            if out:
                columns = zip(*out, strict=True)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

    return over


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of
    another label whose score is ``low`` to ``high`` percent of the positive's (limits included).

    ``rows`` has vec_id, embedding and label; further columns are not read, whatever their names.  Rows with a null
    vec_id, label or vector, or with a null or non-finite component, take no part.  Repeated rows count once, and of
    anchors of one vec_id the one of the smallest label and vector counts; an anchor is never its own positive or
    negative, and candidates equal in vec_id and score count once.  Vectors of unlike length are filled up with zeros.
    Ties go to the smaller vec_id.  A negative positive score has an empty window.  An empty table gives no rows."""
    table = pin(usable(rows).withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))), "vectors")
    others = table.drop("is_anchor")
    copy = F.row_number().over(Window.partitionBy("vec_id").orderBy("label", "embedding"))
    anchors = pin(table.filter("is_anchor").drop("is_anchor").withColumn("copy", copy).filter("copy = 1").drop("copy"), "anchors")

    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id"))
    found = _over_grid(anchors, others, best_positives(positives)).distinct()
    first = pin(found.withColumn("place", place).filter(F.col("place") <= positives).drop("place"), "positives")

    scores = first.groupBy(F.col("anchor").alias("vec_id")).agg(F.collect_set("score").alias("scores"))
    near = _over_grid(anchors.join(scores, "vec_id"), others, best_negatives(negatives, low, high))
    keys = first.unionByName(near).select("anchor", "key").repartition("anchor").sortWithinPartitions("key")
    return keys.select("key").mapInArrow(stream_windows(positives, negatives, low, high), FOUND)
