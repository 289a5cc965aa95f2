"""A training corpus from raw documents: quality rules, near-duplicates, repeated passages, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes every stage to the shared folder and reads it back for the next."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.catalog import PIECES, documents, prepared
from shelfline.llm.chunks import text_size
from shelfline.llm.mixing import mix_rows
from shelfline.llm.near_dedup import near_duplicates
from shelfline.llm.pieces import encode_decode
from shelfline.llm.quality import repetition
from shelfline.llm.substring_dedup import remove_repeats
from shelfline.session import pin

#: Characters of an output shard of the mix, about.
SHARD_CHARS = 16_000_000


def beside(docs: DataFrame, *used: str) -> DataFrame:
    """The columns an operator uses, and the whole row in one more, so that no other column can clash with its own."""
    return docs.select(*used, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules.  Null and empty texts fail; repeated rows pass or fail together."""
    prepared(spark)
    return repetition(beside(docs, "doc_id", "text")).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at 80 percent, the one of the smallest id.

    Of rows of equal id one stays, that of the smallest text.  Null ids stay; texts without words are linked with
    nothing and stay."""
    prepared(spark)
    stays = near_duplicates(docs, n=5, percent=80).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = beside(docs, "doc_id", "text")
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    single = rows.filter("doc_id IS NOT NULL").withColumn("copy", copy).filter("copy = 1")
    return single.join(stays, "doc_id", "left_semi").select("row.*").unionByName(docs.filter("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that repeat a 13-word window of an earlier document; n_chars follows.

    Every document stays, with an empty text when all of it is repeats; one that loses nothing keeps its text."""
    prepared(spark)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    found = remove_repeats(beside(docs, "doc_id", "text"), joined=False)
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, shard by shard in shuffled order."""
    prepared(spark)
    levels = max(1, math.ceil(math.log2(max(2, text_size(docs) / SHARD_CHARS))))
    rows = mix_rows(beside(docs, "doc_id", "text", "source"), levels=levels)
    return rows.repartition("shard").sortWithinPartitions("shard", "place").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of ids and of the text they decode to."""
    prepared(spark)
    return encode_decode(docs, PIECES, keep_decoded=False)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL cannot express the encoding; the tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
