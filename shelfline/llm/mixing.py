"""Mixing sources to target weights, with DataFrame functions only.

Every source is cut into blocks by hash.  Its target, in words, is turned into an exact quota of blocks: all
blocks as many times as the target holds the source whole, then blocks in permuted order, the last one in part.
A splitting tree deals the quotas to output shards: at each node, half of the node's blocks go left, and how
many of each source do is a draw of the multivariate hypergeometric distribution, made as on an urn: the units
of the node are put in the order of a hash and the first half goes left.  Each shard then draws its number of
blocks from the source's permuted line, disjoint from the others', and orders its documents by hash.

Blocks are a fixed number per source, so quotas and tree do not grow with the corpus; documents meet them only
through joins on (source, block) and one window over the documents of partly taken blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import pin

WORD = r"[^\x20\x09-\x0D]+"
#: Digits of the hash that name a block: 16**2 blocks per source.
BLOCK_DIGITS = 2


def _sources(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, line (its number, by code point, null last), source_size, target."""
    line = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("line", F.row_number().over(line))
    known = totals.withColumns({"weight": F.element_at(cycle, F.pmod(F.col("line") - 1, F.lit(len(weights))).cast("int") + 1), "cap": most * F.col("source_size")})
    # sources reach their cap in the order of cap by weight; one is capped when its share of what the earlier ones leave reaches it
    order = Window.orderBy(F.col("cap") / F.col("weight"), "line")
    earlier, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("wanted").over(earlier)
    known = known.withColumns({"wanted": F.col("cap"), "all_words": share * F.sum("source_size").over(every)})
    known = known.withColumn("capped", (F.col("all_words") - F.coalesce(left, F.lit(0.0))) * F.col("weight") >= F.col("cap") * F.sum("weight").over(onward))
    spent = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(every)
    free = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap")).otherwise((F.col("all_words") - spent) * F.col("weight") / F.nullif(free, F.lit(0.0)))
    return known.select("source", "line", "source_size", target.alias("target"))


def _draws(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """(line, block, turn, words): blocks in the order of drawing; ``words`` is null for a whole block."""
    blocks = sized.groupBy("line", "block").agg(F.sum("size").alias("block_size"))
    permuted = Window.partitionBy("line").orderBy(F.md5(F.concat_ws(":", F.col("line").cast("string"), "block")), "block")
    blocks = blocks.withColumns({"place": F.row_number().over(permuted), "upto": F.sum("block_size").over(permuted.rowsBetween(Window.unboundedPreceding, 0))})
    known = blocks.join(sources.select("line", "source_size", "target"), "line").filter("source_size > 0")
    rounds = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - rounds * F.col("source_size") - (F.col("upto") - F.col("block_size"))
    partial = F.when(rest >= F.col("block_size"), F.lit(None).cast("double")).otherwise(rest)
    whole = known.select("line", "block", "place", F.explode(F.sequence(F.lit(0), (rounds - 1).cast("int"))).alias("round"), F.lit(None).cast("double").alias("words"), rounds.alias("rounds"))
    whole = whole.filter("rounds > 0 AND round >= 0").drop("rounds")
    last = known.filter(rest > 0).select("line", "block", "place", rounds.cast("int").alias("round"), partial.alias("words"))
    turn = Window.partitionBy("line").orderBy("round", "place")
    return whole.unionByName(last).withColumn("turn", F.row_number().over(turn))


def _dealt(quotas: DataFrame, levels: int, seed: str) -> DataFrame:
    """(line, shard, quota) from (line, quota), by the splitting tree."""
    nodes = quotas.select("line", F.lit(0).alias("node"), "quota")
    for level in range(levels):
        units = nodes.filter("quota > 0").select("line", "node", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("unit"))
        key = F.md5(F.concat_ws(":", F.lit(f"{seed}:{level}"), *[F.col(c).cast("string") for c in ("node", "line", "unit")]))
        urn = Window.partitionBy("node")
        units = units.withColumns({"drawn": F.row_number().over(urn.orderBy(key, "line", "unit")), "n": F.count(F.lit(1)).over(urn)})
        # an odd unit goes left or right in turn
        left = F.col("drawn") <= F.floor((F.col("n") + F.pmod(F.col("node") + level, F.lit(2))) / 2)
        nodes = units.groupBy("line", (2 * F.col("node") + F.when(left, 0).otherwise(1)).alias("node")).agg(F.count(F.lit(1)).alias("quota"))
    return nodes.select("line", F.col("node").alias("shard"), "quota")


def _key(seed: str):
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def with_size(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Adds size (words of the text, null: 0), key (hash that orders documents) and block; they win over equal names."""
    key = _key(seed)
    return docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long"),
            "key": key,
            "block": F.substring(key, 1, BLOCK_DIGITS),
        }
    )


def plan_blocks(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, levels: int = 4, seed: str = "mix"
) -> DataFrame:
    """One row for every block of ``sized`` (source, block, size): source, block, source_size, target, whole (the
    shards that take the block whole, in the order of its turns), words and part (how many words a shard takes of
    it in part, and which; null when none does).  ``levels`` doublings of the number of shards."""
    sources = pin(_sources(sized, weights, share, most), "mix-sources")
    numbered = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("s.line", "d.block", "d.size")
    blocks = pin(numbered.groupBy("line", "block").agg(F.sum("size").alias("size")), "mix-blocks")
    draws = pin(_draws(blocks, sources), "mix-draws")
    shards = _dealt(draws.groupBy("line").agg(F.count(F.lit(1)).alias("quota")), levels, seed)
    units = shards.select("line", "shard", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("unit"))
    units = units.withColumn("turn", F.row_number().over(Window.partitionBy("line").orderBy("shard", "unit"))).drop("unit")
    turns = F.array_sort(F.collect_list(F.when(F.col("words").isNull(), F.struct("round", "shard"))))
    drawn = draws.join(units, ["line", "turn"]).groupBy("line", "block").agg(
        F.transform(turns, lambda t: t["shard"]).alias("whole"),
        F.max("words").alias("words"),
        F.max(F.when(F.col("words").isNotNull(), F.col("shard"))).alias("part"),
    )
    known = blocks.join(drawn, ["line", "block"], "left").join(sources, "line")
    none = F.array().cast("array<int>")
    return pin(known.select("source", "block", "source_size", "target", F.coalesce("whole", none).alias("whole"), "words", "part"), "mix-plan")


def take(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``with_size`` with source_size, target and shards (one entry for each time the row is taken)."""
    found = sized.alias("d").join(
        plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.block") == F.col("p.block"))
    )
    kept = [F.col(f"d.`{c}`") for c in sized.columns if c not in ("source_size", "target", "shards")]
    found = found.select(F.struct(*kept).alias("d"), *[F.col(f"p.{c}") for c in ("source_size", "target", "whole", "words", "part")])
    # documents of a block that is taken in part; there is at most one such block for each source
    within = Window.partitionBy("d.source").orderBy("d.key", "d.doc_id", "d.size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("d.size").over(within)
    parted = found.filter("words IS NOT NULL").withColumn("upto", upto)
    # a document that crosses the border is taken when that comes nearer to the target
    nearer = 2 * F.col("upto") - F.col("d.size") <= 2 * F.col("words")
    parted = parted.withColumn("shards", F.when(nearer, F.concat("whole", F.array("part"))).otherwise(F.col("whole")))
    whole = found.filter("words IS NULL").withColumn("shards", F.col("whole"))
    columns = ["d.*", "source_size", "target", "shards"]
    return whole.select(*columns).unionByName(parted.select(*columns))


def mix_rows(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with shard and place (its order inside the shard).

    Null text has no words; such rows belong to a block and count nothing.  A null source is a source of its own,
    the last.  A null id is one more id.  Repeated rows are taken or left as separate rows.  Everything follows
    from ids, texts and ``seed``, so reruns agree.  Further columns are kept; size, key, block, source_size,
    target, shard and place win over equal names.  Empty tables give empty results."""
    sized = with_size(docs, seed)
    narrow = pin(sized.select(F.col("source").cast("string").alias("source"), "block", "size"), "mix-sizes")
    rows = take(sized, plan_blocks(narrow, seed=seed, **how))
    kept = [c for c in rows.columns if c not in ("shards", "shard", "place", "round")]
    rows = rows.select(*kept, F.posexplode("shards").alias("round", "shard"))
    return rows.withColumn("place", F.md5(F.concat_ws(":", F.lit(seed), "key", F.col("round").cast("string")))).drop("round")


def taken_words(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the row) and shards (where they go, as numbers
    with commas, in the order of drawing), for every row of ``docs``."""
    sized = with_size(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"), seed)
    sized = pin(sized.select("doc_id", "source", "size", "key", "block"), "mix-sizes")
    rows = take(sized, plan_blocks(sized, seed=seed, **how))
    taken, places = (F.col("size") * F.size("shards")).cast("long"), F.array_join(F.col("shards").cast("array<string>"), ",")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), places.alias("shards"))
