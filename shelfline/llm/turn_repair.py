"""Repair of conversation structure at the least cost, by a square-root checkpointed dynamic programme.

A conversation should read ``(s?(ua)+)?`` in role initials: a system turn or none, then user and assistant in turn.
Four states tell what may come next.  Edits are, as letters of the audit: Delete a row (4), Insert an empty turn (3),
Keep a row (0), Rerole it (3); from every state exactly one role can be inserted or reroled to, so the letters alone
determine the result.  A cost vector gives, for each state, what the rest of the conversation costs at least.

Going backward, cost vectors are stored at checkpoints only, the square root of the rows apart; going forward, the
vectors between two checkpoints are computed again and the ASCII-least letter is taken among those that keep the cost
tight.  A conversation of more rows than a block is treated alike one level up: its blocks are transition matrices
of min-plus products, the vectors at block ends come from the products, each block is walked from all four states
at once, and the walks are linked.  So no task holds more of a conversation than the codes of one block, one byte a
row, and a few numbers for each further block; the texts are streamed past the letters in the order of rows.  What one
row of the result needs by itself (the audit's letters, the digest over the repaired text) is made in one task."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.scan import ordered_scan, same_keys
from shelfline.session import pin

#: Rows of a conversation in one block.
BLOCK = 4_096
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 40
#: What a row adds: states are start, after system, after user, after assistant; the one role each may add, and the state then.
ADDS = ("user", "user", "assistant", "user")
THEN = (2, 2, 3, 2)
#: State after keeping a row of this initial, by state.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
STATES = range(4)
END = (0, NEVER, NEVER, 0)
#: Characters that are no content.
WHITE = r"\x20\x09-\x0D"
#: Codes of rows: four initials (o: any other), each sound, truncated, duplicate, blank.
CODES = {initial + fault: "abcdefghijklmnop"[4 * i + j] for i, initial in enumerate("suao") for j, fault in enumerate(("", "t", "d", "b"))}
DECODED = {code: (name[0], name[1:]) for name, code in CODES.items()}


def _closed(v: list[int]) -> tuple[int, ...]:
    """Costs when turns may be inserted first."""
    user, assistant = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + user), min(v[1], INSERT + user), user, assistant


CLOSED_END = _closed(list(END))


@lru_cache(maxsize=len(CODES))
def _edits(code: str) -> list[list[tuple[str, int, int]]]:
    """By state: letters that use up a row of this code, their costs and the states after them; D, K, R in order."""
    initial, fault = DECODED[code]
    left = TRUNCATED if fault == "t" else 0
    out = []
    for state in STATES:
        ways = [("D", DELETE, state)]
        if fault not in ("d", "b"):
            if KEPT[initial][state] is not None:
                ways.append(("K", left, KEPT[initial][state]))
            ways.append(("R", REROLE + left, THEN[state]))
        out.append(ways)
    return out


def _before(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost vector before a row, given the one after it."""
    return _closed([min(cost + after[to] for _, cost, to in ways) for ways in _edits(code)])


def checkpoints(codes: str, after: tuple[int, ...]) -> tuple[int, dict[int, tuple[int, ...]]]:
    """Distance of checkpoints and their cost vectors by row; the last one is the vector behind all rows."""
    step = max(1, math.isqrt(len(codes)))
    stored, v = {len(codes): after}, after
    for i in range(len(codes) - 1, -1, -1):
        v = _before(codes[i], v)
        if i % step == 0:
            stored[i] = v
    return step, stored


def _forward(codes: str, step: int, stored: dict, state: int, last: bool) -> tuple[str, int, int]:
    """ASCII-least tight letters from ``state``, the state behind them, and their cost with all that follows."""
    cost, letters = stored[0][state], []
    for start in range(0, len(codes), step):
        end = min(start + step, len(codes))
        between = [stored[end]]
        for code in reversed(codes[start:end]):  # the vectors between two checkpoints, once more
            between.append(_before(code, between[-1]))
        between.reverse()
        for code, v, after in zip(codes[start:end], between, between[1:], strict=False):
            while True:
                ways = [(letter, to) for letter, price, to in _edits(code)[state] if price + after[to] == v[state]]
                if not (ways and ways[0][0] == "D") and INSERT + v[THEN[state]] == v[state]:
                    letters.append("I")
                    state = THEN[state]
                    continue
                letters.append(ways[0][0])
                state = ways[0][1]
                break
    while last and END[state]:  # turns still owed at the end
        letters.append("I")
        state = THEN[state]
    return "".join(letters), state, cost


def transitions(codes: str) -> list[tuple[int, ...]]:
    """Min-plus matrix of a block: least cost from each state before it to each state right behind its last row."""
    columns = []
    for target in STATES:
        v = tuple(0 if s == target else NEVER for s in STATES)
        for code in reversed(codes):
            v = _before(code, v)
        columns.append(v)
    return [tuple(min(columns[t][s], NEVER) for t in STATES) for s in STATES]


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, pos): rows by turn, null first, ties by role and text; null role or text is one space."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *filled)
    # rows that tie in all of this are equal, so it does not matter which of them comes first
    placed = ordered_scan(plain, ["conv_id"], ["turn", "role", "text"], running={"pos": F.lit(1).cast("long")})
    return placed.select("conv_id", "turn", "role", "text", (F.col("pos") - 1).alias("pos"))


def codes(placed: DataFrame) -> DataFrame:
    """(conv_id, pos, code) of every row: its initial and its first fault."""
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    cut = ~F.col("text").rlike(rf"[.!?][{WHITE}]*\z")
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(" "), "role", "text"), 256)
    facts = placed.select("conv_id", "pos", initial.alias("initial"), blank.alias("blank"), cut.alias("cut"), same.alias("same"))
    firsts = facts.groupBy("conv_id", "same").agg(F.min("pos").alias("pos")).select("conv_id", "pos", F.lit(True).alias("first"))
    joined = facts.alias("_l").join(firsts.alias("_r"), same_keys("_l", "_r", ("conv_id", "pos")), "left").select("_l.*", "_r.first")
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("")
    table = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return joined.select("conv_id", "pos", table[F.concat("initial", fault)].alias("code"))


def blocks(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, codes, last): codes of up to ``block`` rows as one string."""
    number = F.floor(F.col("pos") / block).cast("long")
    listed = F.sort_array(F.collect_list(F.struct("pos", "code")))
    text = F.array_join(F.transform(listed, lambda x: x["code"]), "")
    whole = coded.groupBy("conv_id", number.alias("block")).agg(text.alias("codes"))
    ends = coded.groupBy("conv_id").agg(F.floor(F.max("pos") / block).cast("long").alias("end"))
    return whole.alias("_l").join(ends.alias("_r"), same_keys("_l", "_r", ("conv_id",))).select("_l.*", (F.col("block") == F.col("end")).alias("last"), "end")


TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split(" ") for field in schema.split(", ")]
    return pa.record_batch([pa.array(c, TYPES[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def _mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of each row's values; it yields rows of ``schema``."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if out := [new for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for new in function(*row)]:
                yield _batch(out, schema)

    return df.mapInArrow(over, schema)


def _linked_costs(conv_id, listed):
    """Vectors behind each block of one conversation, from the last block back."""
    after, out = list(CLOSED_END), []
    for item in reversed(listed):
        out.append((conv_id, item["block"], list(after)))
        after = [min(row[t] + after[t] for t in STATES) for row in (item["matrix"][4 * s : 4 * s + 4] for s in STATES)]
    return out


def _linked_states(conv_id, listed):
    """State before each block of one conversation, from the first block on."""
    state, out = 0, []
    for item in listed:
        out.append((conv_id, item["block"], state))
        state = item["ends"][state]
    return out


def _all_walks(conv_id, block, codes, last, after):
    after = tuple(after or CLOSED_END)
    step, stored = checkpoints(codes, after)
    return [(conv_id, block, codes, s, *_forward(codes, step, stored, s, last)) for s in ((0,) if block == 0 else STATES)]


def edits(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, codes, letters, cost): the chosen letters block by block; ``cost`` is that from the block on."""
    parts = pin(blocks(codes(placed), block), "codes")
    several = parts.filter("end > 0")
    matrices = _mapped(several.select("conv_id", "block", "codes"), lambda c, b, t: [(c, b, [x for row in transitions(t) for x in row])], "conv_id long, block long, matrix array<long>")
    by_conversation = lambda df, item: df.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", item))).alias("listed"))
    vectors = _mapped(by_conversation(matrices, "matrix"), _linked_costs, "conv_id long, block long, after array<long>")
    keyed = parts.alias("_l").join(vectors.alias("_r"), same_keys("_l", "_r", ("conv_id", "block")), "left")
    schema = "conv_id long, block long, codes string, start int, letters string, end int, cost long"
    walks = pin(_mapped(keyed.select("_l.conv_id", "_l.block", "_l.codes", "_l.last", "_r.after"), _all_walks, schema), "walks")
    ends = F.transform(F.sort_array(F.collect_list(F.struct("start", "end"))), lambda x: x["end"])
    steps = walks.alias("w").join(several.select("conv_id", "block").alias("s"), same_keys("w", "s", ("conv_id", "block")), "left_semi")
    steps = steps.groupBy("conv_id", "block").agg(ends.alias("ends"))
    starts = _mapped(by_conversation(steps, "ends"), _linked_states, "conv_id long, block long, start int")
    chosen = walks.alias("_l").join(starts.alias("_r"), same_keys("_l", "_r", ("conv_id", "block")), "left")
    return chosen.filter(F.col("_l.start") == F.coalesce("_r.start", F.lit(0))).select("_l.conv_id", "_l.block", "_l.codes", "_l.letters", "_l.cost")


def _stream(placed: DataFrame, chosen: DataFrame, block: int) -> DataFrame:
    """Rows in order, each block's letters before its rows."""
    rows = placed.select("conv_id", F.floor(F.col("pos") / block).cast("long").alias("block"), "pos", "turn", "role", "text", *[F.lit(None).cast(t).alias(c) for c, t in (("codes", "string"), ("letters", "string"), ("cost", "long"))])
    heads = chosen.select("conv_id", "block", F.lit(-1).cast("long").alias("pos"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))], "codes", "letters", "cost")
    return rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos")


class _Reader:
    """Walks through the sorted rows: for every row its code, and the turns that the letters make of it."""

    def __init__(self):
        self.state, self.letters, self.at, self.codes, self.row = 0, "", 0, "", 0

    def block(self, codes: str, letters: str) -> None:
        self.codes, self.letters, self.at, self.row = codes, letters, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            yield ADDS[self.state], ""
            self.state = THEN[self.state]

    def turn(self, role: str, text: str) -> tuple[str, list[tuple[str, str]]]:
        out = list(self.inserted())
        letter, code = self.letters[self.at], self.codes[self.row]
        self.at, self.row = self.at + 1, self.row + 1
        if letter == "K":
            out.append((role, text))
            self.state = KEPT[DECODED[code][0]][self.state]
        elif letter == "R":
            out.append((ADDS[self.state], text))
            self.state = THEN[self.state]
        if self.row == len(self.codes):
            out += self.inserted()
        return code, out


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = "conv_id long, turn long, role string, text string"
SUMMARY = "conv_id long, " + ", ".join(f"{c} long" for c in NUMBERS) + ", audit string, repaired_sha256 string"


class _Summary:
    """Figures of one conversation while its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id, self.reader, self.digest, self.audit, self.cost = conv_id, _Reader(), hashlib.sha256(), [], None
        self.least = self.most = self.initial = None
        self.turns = self.illegal = 0
        self.faults, self.empty = {"b": 0, "d": 0, "t": 0, "": 0}, True

    def head(self, codes, letters, cost):
        self.reader.block(codes, letters)
        self.audit.append(letters)
        self.cost = cost if self.cost is None else self.cost

    def row(self, turn, role, text):
        code, made = self.reader.turn(role, text)
        initial, fault = DECODED[code]
        self.faults[fault] += 1
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None and turn != self.most:
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        for r, t in made:
            self.digest.update(f"{'' if self.empty else chr(10)}{r}:{t}".encode("utf-8", "surrogatepass"))
            self.empty = False

    def result(self):
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return self.conv_id, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, done = None, []
    for batch in batches:
        for conv_id, _, pos, turn, role, text, codes_, letters, cost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.result())
                current = _Summary(conv_id)
            if pos < 0:
                current.head(codes_, letters, cost)
            else:
                current.row(turn, role, text)
        if done:
            yield _batch(done, SUMMARY)
            done = []
    if current is not None:
        yield _batch([current.result()], SUMMARY)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, number, reader = None, 0, _Reader()
    for batch in batches:
        out = []
        for conv_id, block, pos, _, role, text, codes_, letters, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if pos < 0:
                if current is None or block == 0:
                    current, number, reader = (conv_id,), 0, _Reader()
                reader.block(codes_, letters)
                continue
            for r, t in reader.turn(role, text)[1]:
                out.append((conv_id, number, r, t))
                number += 1
        if out:
            yield _batch(out, TURNS)


def repaired_turns(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), role, text.  Conversations of which nothing stays are absent."""
    placed = pin(ordered(rows), "ordered")
    return _stream(placed, edits(placed, block), block).mapInArrow(_turns, TURNS)


def repair(rows: DataFrame, every: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role and text; further columns are not read, whatever their names.  ``every`` names
    conversations to report even when they have no rows (zeros, empty audit, digest of the empty text).  Rows are taken
    by turn, null first, ties by role and text; a null role or text is one space, rows of a null conv_id are one
    conversation.  A repeated row is a duplicate.  An initial is the first character of the role; any but s, u and a
    fits nowhere.  An empty table gives no rows."""
    placed = pin(ordered(rows), "ordered")
    found = _stream(placed, edits(placed, block), block).mapInArrow(_summaries, SUMMARY)
    if every is None:
        return found
    ids = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.alias("_l").join(found.alias("_r"), same_keys("_l", "_r", ("conv_id",)), "left")
    nothing: dict[str, Column] = {c: F.lit(0).cast("long") for c in NUMBERS} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return joined.select("_l.conv_id", *[F.coalesce(F.col(f"_r.{c}"), v).alias(c) for c, v in nothing.items()])


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text,
    2 removes sentence ends, 3 repeats it, 4 makes it a user's.  Nulls count as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    kinds = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return kinds.select("conv_id", "turn", role.alias("role"), said.alias("text"), times.alias("time")).drop("time")
