"""Documents dealt to chunks, and questions about the whole corpus answered chunk by chunk.

A chunk is a set of documents of bounded size, chosen by hash, so that a hot source or a group of copies is
spread evenly.  An operator that needs corpus-wide facts (does this n-gram occur elsewhere, how often) reduces
each chunk to its distinct keys, sends these packed to buckets of the key space, and gets one answer per key
back in the same order.  Nothing is broadcast, no key sends more than one entry per chunk, and the driver sees
one number, the size of the input."""

from __future__ import annotations

import ctypes
import math
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import shelfline

#: Rows per Arrow batch; bounds what a Python worker holds of long texts.
BATCH_ROWS = 256
#: Characters of text per chunk.
CHUNK_CHARS = 3_000_000
#: Keys per bucket, about.
BUCKET_KEYS = 1_500_000


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches from here on in this session: a batch of long texts must fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which need not have it installed.  Once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = shelfline.__path__[0]
        name = tempfile.mkdtemp(prefix="shelfline-code-") + "/shelfline"
        context.addPyFile(shutil.make_archive(name, "zip", root_dir=f"{root}/..", base_dir="shelfline"))
        _SHIPPED.add(context.applicationId)


def text_size(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0)


def others(docs: DataFrame, used: Iterable[str] = ("doc_id", "text")) -> list[str]:
    return [c for c in docs.columns if c not in set(used)]


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rest): all further columns in one struct, so that no name can clash with an operator's."""
    rest = others(docs)
    extra = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), extra.alias("rest"))


def packed_schema(narrow: DataFrame, added: str) -> StructType:
    """Schema of packed rows with further columns; fields that are never null stay so."""
    return StructType([*StructType.fromDDL("doc_id long, text string"), StructField("rest", narrow.schema["rest"].dataType), *StructType.fromDDL(added)])


def unpacked(df: DataFrame, docs: DataFrame, added: Iterable[str], text: bool = True) -> DataFrame:
    """The columns of ``docs`` in their order, then the operator's; on a clash the operator's column wins."""
    added = list(added)
    columns = []
    for c in docs.columns:
        if c in added or (c == "text" and not text):
            continue
        columns.append(F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c))
    return df.select(*columns, *added)


def chunked(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> tuple[DataFrame, int]:
    """Adds ``chunk``; returns also the characters of the corpus."""
    chars = text_size(docs)
    n = max(1, math.ceil(chars / chunk_chars))
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")), chars


def buckets_for(keys: int, bucket_keys: int = BUCKET_KEYS) -> int:
    return max(1, math.ceil(keys / bucket_keys))


def column_bytes(table: pa.Table | pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts as UTF-8; null is the empty text."""
    column = table.column(name)
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def by_doc(table: pa.Table) -> pa.Table:
    """Rows in ascending doc_id, null last."""
    return table.sort_by([("doc_id", "ascending")])


def doc_keys(table: pa.Table) -> np.ndarray:
    """Document ids as integers; null counts as larger than every id."""
    return np.array([np.iinfo(np.int64).max if d is None else d for d in table.column("doc_id").to_pylist()], dtype=np.int64)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Upper 32 bits of a hash scaled to the number of buckets; ascending hashes give ascending buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cut_points(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(buckets + 1))


def give_back() -> None:
    """Return freed memory to the system.  A worker lives on for other stages, beside which both allocators would keep
    some 200 MB that nothing uses."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def settled(function: Callable[..., pa.Table], *parts: pa.Table) -> pa.Table:
    """The function's answer for one group; what it worked with is given back."""
    try:
        return function(*parts)
    finally:
        give_back()


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """One output batch per input batch.  A task ends with its worker's freed memory given back."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)
        give_back()

    return df.mapInArrow(over, schema)
