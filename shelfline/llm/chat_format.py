"""Chat formatting of reply trees.

Messages form trees: each names its parent.  Iterative self-joins by doubling give every message its ancestor at
distance 1, 2, 4 ... together with the number of messages and the score on the way, so a tree of any depth takes as
many joins as the depth has binary digits.  The leaves of a tree are ranked by the score of their branch; from the
chosen ones the same tables, longest jumps first, enumerate every message of the path from the root exactly once.
Each path becomes one text, streamed from rows sorted by path and place.

The template puts ``<|im_start|>role`` and a line feed before a text, ``<|im_end|>`` and a line feed behind it.  A control
string inside a text or role gets one backslash more behind its ``<`` than it has, so no text holds a bare one and
taking one away restores it; line feeds and backslashes of a role are written as two characters."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.scan import ordered_scan, same_keys
from shelfline.session import pin

START, END = "<|im_start|>", "<|im_end|>"
BARE = re.compile(r"<(\\*)\|(im_(?:start|end)\|>)")
MARKED = re.compile(r"<\\(\\*)\|(im_(?:start|end)\|>)")
KEYS = ("tree", "node")


def escape(text: str) -> str:
    return BARE.sub(r"<\\\1|\2", text)


def unescape(text: str) -> str:
    return MARKED.sub(r"<\1|\2", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


# ------------------------------------------------------------------ trees


def _levels(links: DataFrame) -> list[DataFrame]:
    """Tables (tree, node, up, hops, total): ``up`` is the ancestor at distance 1, 2, 4 ...; the last has no ancestors
    left but those on cycles."""
    parents = links.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    known = links.alias("_l").join(parents.alias("_r"), same_keys("_l", "_r", ("tree", "parent")), "left")
    up = F.when(F.col("_r.known"), F.col("_l.parent"))
    level = known.select("_l.tree", "_l.node", up.alias("up"), F.lit(1).cast("long").alias("hops"), F.col("_l.score").alias("total"))
    levels = [pin(level, "ancestors")]
    n = levels[0].count()
    while 1 << (len(levels) - 1) <= n and not levels[-1].filter("up IS NOT NULL").isEmpty():
        now = levels[-1]
        far = now.select("tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("hops").alias("more"), F.col("total").alias("gain"))
        going = now.filter("up IS NOT NULL").alias("_l").join(far.alias("_r"), same_keys("_l", "_r", ("tree", "up")))
        going = going.select("_l.tree", "_l.node", F.col("_r.far").alias("up"), (F.col("hops") + F.col("more")).alias("hops"), (F.col("total") + F.col("gain")).alias("total"))
        levels.append(pin(now.filter("up IS NULL").unionByName(going), "ancestors"))
    return levels


def reply_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """(tree, path, rank, position, node): the messages of the ``top`` best branches of every tree (None: of all).

    ``messages`` has tree, node, parent and score; ``path`` is the leaf's node.  A branch's score is the sum of its
    messages' (null: 0); ties go to the smaller leaf.  A message whose parent is null or absent is a root.  Of several
    rows of one node the one of the smallest (parent, score) gives its place.  Messages on a cycle or below one are on
    no path from a root and do not appear, nor do rows without a node."""
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    least = F.min(F.struct("parent", score.alias("score")))
    links = messages.filter("node IS NOT NULL").groupBy("tree", "node").agg(least.alias("at")).select("tree", "node", "at.parent", "at.score")
    levels = _levels(pin(links, "links"))

    inner = levels[0].filter("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    rooted = levels[-1].filter("up IS NULL")
    leaves = rooted.alias("_l").join(inner.alias("_r"), same_keys("_l", "_r", KEYS), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    ranked = leaves.withColumn("rank", rank)
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    on_path = pin(ranked.select("tree", F.col("node").alias("path"), "rank", "hops", "node", F.lit(0).cast("long").alias("back")), "paths")
    for k in reversed(range(len(levels) - 1)):
        jumps = levels[k].filter("up IS NOT NULL").select("tree", "node", "up")
        further = on_path.alias("_l").join(jumps.alias("_r"), same_keys("_l", "_r", KEYS))
        further = further.select("_l.tree", "_l.path", "_l.rank", "_l.hops", F.col("_r.up").alias("node"), (F.col("_l.back") + (1 << k)).alias("back"))
        on_path = pin(on_path.unionByName(further), "paths")
    return on_path.select("tree", "path", "rank", (F.col("hops") - 1 - F.col("back")).alias("position"), "node")


# ------------------------------------------------------------------ template

FORMATTED = "tree long, path long, rank int, text string, loss array<struct<start:long,end:long>>"
SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _writer(loss_roles: frozenset[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, at, parts, spans = None, None, 0, [], []

        def done() -> pa.RecordBatch:
            columns = [pa.array([v], t) for v, t in zip(current, (pa.int64(), pa.int64(), pa.int32()), strict=True)]
            return pa.record_batch([*columns, pa.array(["".join(parts)]), pa.array([spans], SPAN)], names=["tree", "path", "rank", "text", "loss"])

        for batch in batches:
            for *key, position, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != current:
                    if current is not None:
                        yield done()
                    current, place, at, parts, spans = key, None, 0, [], []
                if position == place:
                    continue  # another row of the same message
                place, head, body = position, f"{START}{escape_role(role)}\n", escape(text)
                if role in loss_roles:
                    spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
                parts += (head, body, END, "\n")
                at += len(head) + len(body) + len(END) + 1
        if current is not None:
            yield done()

    return over


def format_paths(messages: DataFrame, top: int | None = 1, loss_roles: Iterable[str] = ("assistant",)) -> DataFrame:
    """(tree, path, rank, text, loss): one formatted conversation for each chosen branch, with the spans of characters
    that training predicts: the escaped texts of ``loss_roles``, nothing around them.

    ``messages`` has tree, node, parent (long), score, role and text; further columns are not read, whatever their names.
    A null role or text is empty.  Of several rows of one node the smallest (role, text) is written.  Trees of a null
    ``tree`` are one tree.  An empty table gives no rows."""
    said = messages.select("tree", "node", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    placed = reply_paths(messages, top).alias("_l").join(said.alias("_r"), same_keys("_l", "_r", KEYS))
    rows = placed.select("_l.tree", "_l.path", "_l.rank", "_l.position", "_r.role", "_r.text")
    rows = rows.repartition("tree", "path").sortWithinPartitions("tree", "path", "position", "role", "text")
    return rows.mapInArrow(_writer(frozenset(loss_roles)), FORMATTED)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    out = []
    for turn in text.split(START)[1:]:
        head, _, body = turn.partition("\n")
        out.append((unescape_role(head), unescape(body.removesuffix(f"{END}\n"))))
    return out


READ = "tree long, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for tree, path, text, loss in zip(*(batch.column(c).to_pylist() for c in ("tree", "path", "text", "loss")), strict=True):
            turns, learned = read_turns(text), "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{r}\n{t}\n" for r, t in turns), learned)]
            out.append((tree, path, len(turns), digests[0], len(learned), digests[1], len(text)))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [f.split(" ")[0] for f in READ.split(", ")]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader finds in formatted conversations: turns, digests over them and over the text under the loss spans."""
    return formatted.mapInArrow(_read, READ)


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees of one branch: rows by turn, null first, ties by role and text."""
    plain = conversations.select(F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    placed = ordered_scan(plain, ["tree"], ["turn", "role", "text"], running={"node": F.lit(1).cast("long")})
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return pin(placed.select("tree", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text"), "messages")
