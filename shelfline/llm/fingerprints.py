"""Document fingerprints: a quartile bucket digest.

Byte triplets are hashed to 256 buckets and counted.  A digest holds the logarithm of the length, how the
quartiles of the counts relate, and for every bucket the quartile its count falls into.  Two digests are
compared by a bounded difference: quartiles apart per bucket (opposite ends weigh double), steps of length and
of the quartile ratios.  The likeness is one minus the difference over its bound.

``compare_with_next`` needs every document's successor in order of id: a range partitioning, one pass with a
look-ahead of one row, and a small join that closes the last row of each partition with the first row of the
next one that has rows."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import chunks as C
from shelfline.session import pin

BUCKETS = 256
#: Odd multipliers of the triplet hash.
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: Weight of quartiles apart: none, one, two, three.
APART = np.array([0, 1, 2, 6])
#: The largest differences that count: of the length's logarithm, and of each quartile ratio.
LENGTH_BOUND, RATIO_BOUND = 64, 15
BOUND = int(APART.max()) * BUCKETS + LENGTH_BOUND + 2 * RATIO_BOUND

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint(text: bytes) -> str:
    """Hex digest: one byte of length, one byte of two quartile ratios, two bits per bucket.  Texts under three
    bytes have no triplet; their counts are all zero."""
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(data) >= 3:
        hashed = (data[:-2] * np.uint32(FACTORS[0])) ^ (data[1:-1] * np.uint32(FACTORS[1])) ^ (data[2:] * np.uint32(FACTORS[2]))
        hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(FACTORS[0])
        counts = np.bincount(hashed >> np.uint32(24), minlength=BUCKETS)
    else:
        counts = np.zeros(BUCKETS, dtype=np.int64)
    low, mid, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > low).astype(np.uint8) + (counts > mid) + (counts > high)
    length = min(255, round(8 * math.log2(len(text) + 1)))
    ratios = [int(16 * low // high) & 15, int(16 * mid // high) & 15] if high else [0, 0]
    four = codes.reshape(-1, 4)
    body = (four[:, 0] << 6) | (four[:, 1] << 4) | (four[:, 2] << 2) | four[:, 3]
    return bytes([length, ratios[0] << 4 | ratios[1]]).hex() + body.astype(np.uint8).tobytes().hex()


def _codes(digest: bytes) -> np.ndarray:
    body = np.frombuffer(digest, dtype=np.uint8, offset=2)
    return np.stack([body >> 6, (body >> 4) & 3, (body >> 2) & 3, body & 3]).astype(np.int8)


def likeness(one: str, other: str) -> float:
    """From 0 (as different as digests get) to 1 (equal digests)."""
    a, b = bytes.fromhex(one), bytes.fromhex(other)
    apart = int(APART[np.abs(_codes(a) - _codes(b))].sum())
    apart += min(LENGTH_BOUND, abs(a[0] - b[0]))
    apart += abs((a[1] >> 4) - (b[1] >> 4)) + abs((a[1] & 15) - (b[1] & 15))
    return 1.0 - apart / BOUND


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many from the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(doc_id: int | None, text: str, digest: str, following: str, next_digest: str) -> tuple:
    new = edited(text, following).encode()
    changed = fingerprint(new)
    return doc_id, len(text), hashlib.sha256(new).hexdigest(), digest, changed, likeness(digest, changed), likeness(digest, next_digest)


_FIELDS = [f.split() for f in RESULT.split(", ")]
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], _ARROW[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields]
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how like the text is to that and to the next text.

    The next document is the one with the next smaller id; after the last comes the first.  Null text is empty;
    two empty texts are equal.  A null id comes last; rows of equal id follow each other in order of text.  A
    lone document is its own successor.  Further columns are not carried.  Empty tables give empty results."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").asc()]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranged = narrow.repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)
    schema = f"{RESULT}, part int, edge string, text string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                digest = fingerprint(text.encode())
                if held is None:
                    rows.append((None, None, None, digest, None, None, None, part, "head", text))
                else:
                    rows.append((*_compared(*held, text, digest), part, None, None))
                held = (doc_id, text, digest)
            if rows:
                yield _batch(rows, schema)
        if held is not None:
            yield _batch([(held[0], None, None, held[2], None, None, None, part, "tail", held[1])], schema)

    walked = pin(ranged.mapInArrow(walk, schema), "fingerprints")
    # one row per partition from here on
    parts = walked.filter("edge = 'head'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    line = Window.orderBy("part")
    follows = walked.filter("edge = 'head'").select(
        F.col("part").alias("tail_part"), F.coalesce(F.lead("part").over(line), F.min("part").over(Window.partitionBy())).alias("part")
    )
    tails = walked.filter("edge = 'tail'").select("doc_id", "text", "fingerprint", F.col("part").alias("tail_part"))
    open_rows = tails.join(follows, "tail_part").join(parts, "part").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")

    def close(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _batch([_compared(*row.values()) for row in batch.to_pylist()], RESULT)

    names = [name for name, _ in _FIELDS]
    open_rows = open_rows.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    return walked.filter("edge IS NULL").select(*names).unionByName(C.map_batches(open_rows, close, RESULT))
