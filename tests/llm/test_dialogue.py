"""Hard negatives, conversation repair and chat formatting against plain versions."""

import hashlib
import itertools
import math
import random
from collections import defaultdict
from functools import lru_cache

import pytest
from llm_data import llm  # noqa: F401
from pyspark.sql import functions as F

from shelfline.llm import chat_format, hard_negatives, turn_repair
from shelfline.llm.catalog import CONTROL, QUERIES

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, anchor string, score string, key int, down string"
TURNS = "conv_id long, turn long, role string, text string, pos string, block string, code int, cost string"
MESSAGES = "tree long, node long, parent long, score double, role string, text string, path string, up int, hops string"


def plain_mine(rows, positives=5, negatives=3, low=50, high=95):
    """Every pair scored with Python integers."""

    def fits(r):
        return None not in (r[0], r[1], r[2]) and all(x is not None and math.isfinite(x) for x in r[1])

    table = sorted({(r[0], tuple(r[1]), r[2]) for r in rows if fits(r)}, key=lambda r: (r[0], str(r[2]), r[1]))
    whole = lambda v: [math.floor(256 * x) for x in v]
    anchors, out = {}, []
    for r in table:
        if r[0] % 5 == 0:
            anchors.setdefault(r[0], r)
    for a in anchors.values():
        scored = {(-sum(x * y for x, y in zip(whole(a[1]), whole(r[1]))), r[0], r[2] == a[2]) for r in table if r[0] != a[0]}
        for s, i, _ in sorted(x for x in scored if x[2])[:positives]:
            fit = sorted({(n, j) for n, j, same in scored if not same and -low * s <= -100 * n <= -high * s})
            out += [(a[0], i, k, j, -s, -n) for k, (n, j) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def vectors(n=120, seed=5):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.2) for _ in range(6)] for _ in range(4)]
    rows = [(i - 20, [x + rng.gauss(0, 0.15) for x in base[i % 4]], rng.choice([0, 1, 2, 2, 2])) for i in range(n)]
    rows += [(i + 1000, [0.5] * 6, i % 2) for i in range(30)]  # copies of one vector: ties
    rows += rows[:15] + rows[-3:]  # repeated rows
    rows += [(7, [0.1] * 6, 0), (10, [0.3] * 6, 1), (10, [0.2] * 6, 1)]  # other rows of known ids
    rows += [(2000, None, 1), (2005, [0.1, None], 1), (2010, [float("nan")] * 6, 1), (2015, [float("inf")] * 6, 2), (2020, [0.1] * 6, None), (None, [0.1] * 6, 1)]
    rows += [(2025, [], 0), (2030, [0.4, 0.4], 0), (2035, [-0.4] * 6, 1), (2040, [0.5] * 9, 2)]
    return rows


def as_vectors(spark, rows):
    return spark.createDataFrame([(*r, "a", "s", 1, "d") for r in rows], VECTORS)


@pytest.mark.parametrize("blocks", [(65_536, 32_768, 1024, 512, 2048), (16, 8, 4, 3, 5)])
def test_hard_negatives_against_all_pairs(llm, monkeypatch, blocks):  # noqa: F811
    for name, value in zip(("BLOCK_ROWS", "BLOCK_ANCHORS", "LEAST_ROWS", "TILE_ANCHORS", "TILE_ROWS"), blocks, strict=True):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors()
    got = hard_negatives.mine(as_vectors(llm, rows), F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_mine(rows)


def test_tiles_and_large_numbers():
    """The cell functions at other tile sizes and with products beyond floats and beyond 64 bits."""
    import pyarrow as pa

    for scale in (1.0, 1e5, 1e9, 1e300):
        rows = [(i, [x * scale for x in v], c) for i, v, c in vectors()[:60]]
        table = pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64())), "label": [str(r[2]) for r in rows]})
        anchors = table.filter(pa.compute.equal(pa.compute.bit_wise_and(table["vec_id"], 3), 0))
        kept = hard_negatives.TILE_ANCHORS, hard_negatives.TILE_ROWS
        try:
            hard_negatives.TILE_ANCHORS, hard_negatives.TILE_ROWS = 4, 7
            got = hard_negatives.best_positives(3)(anchors, table).select(["anchor", "score", "vec_id"]).to_pylist()
        finally:
            hard_negatives.TILE_ANCHORS, hard_negatives.TILE_ROWS = kept
        whole = {r[0]: [math.floor(256 * x) for x in r[1]] for r in rows}
        label, want = {r[0]: r[2] for r in rows}, []
        for a in anchors["vec_id"].to_pylist():
            clipped = lambda s: max(-(2**63 - 1), min(2**63 - 1, s))
            near = sorted((-clipped(sum(x * y for x, y in zip(whole[a], whole[i]))), i) for i in whole if i != a and label[i] == label[a])
            want += [(a, -s, i) for s, i in near[:3]]
        assert sorted(tuple(r.values()) for r in got) == sorted(want)


def test_window_limits():
    import numpy as np

    scores = np.array([-205, -7, 0, 1, 7, 99, 100, 101, 12345, 2**62], dtype=np.int64)
    low, high = hard_negatives.window_of(scores, 50, 95)
    for s, a, b in zip(scores.tolist(), low.tolist(), high.tolist(), strict=True):
        assert 100 * a >= 50 * s > 100 * (a - 1) and 100 * b <= 95 * s < 100 * (b + 1)


def test_hard_negatives_of_an_empty_table(llm):  # noqa: F811
    assert hard_negatives.mine(as_vectors(llm, []), F.col("vec_id") % 5 == 0).collect() == []


# ------------------------------------------------------------------ repair


def plain_repair(rows):
    """Figures of one conversation; letters by the least (cost, letters) of every rest, compared as whole strings."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    white, faults, seen = " \t\n\v\f\r", [], set()
    for _, role, text in rows:
        said = text.strip(white)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {0: "su", 1: "u", 2: "a", 3: "u"}
    state_of, name = {"s": 1, "u": 2, "a": 3}, {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        nexts = [n for n in follows[state] if n != "s"]
        if inserted < 3:
            for n in nexts:
                cost, letters, turns = best(i, state_of[n], inserted + 1)
                ways.append((cost + 3, "I" + letters, (f"{name[n]}:", *turns)))
        if i < len(rows):
            _, role, text = rows[i]
            late = 3 if faults[i] == "truncated" else 0
            cost, letters, turns = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + letters, turns))
            if faults[i] not in ("blank", "duplicate"):
                for n in nexts:
                    cost, letters, turns = best(i + 1, state_of[n], 0)
                    ways.append((cost + 3 + late, "R" + letters, (f"{name[n]}:{text}", *turns)))
                if role[:1] and role[:1] in follows[state]:
                    cost, letters, turns = best(i + 1, state_of[role[:1]], 0)
                    ways.append((cost + late, "K" + letters, (f"{role}:{text}", *turns)))
        return min(ways, default=(10**6, "", ()))

    cost, letters, turns = best(0, 0, 0)
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    count = faults.count
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, letters, hashlib.sha256("\n".join(turns).encode()).hexdigest()), turns


def odd_turns(seed, n=60):
    rng = random.Random(seed)
    texts = ["Fine.", "So?", "no end", "", " \t\n", None, "Again!", "ends. \n", "é 日本.", "a.\x00"]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "USER", "ünknown"]
    rows = []
    for conv in [None, *range(-1, n)]:
        for i in range(rng.choice([1, 2, 3, 5, 9, 14])):
            role = ("user", "assistant")[i % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, None if rng.random() < 0.05 else i - rng.choice([0, 0, 0, 1, 7]), role, f"{i} {rng.choice(['good.', 'cut'])}" if rng.random() < 0.5 else rng.choice(texts)))
    rows += rng.sample(rows, len(rows) // 10)
    rng.shuffle(rows)
    return rows


def as_turns(spark, rows):
    return spark.createDataFrame([(*r, "p", "b", 1, "c") for r in rows], TURNS)


@pytest.mark.parametrize(("block", "seed"), [(4096, 1), (1, 2), (3, 3)])
def test_repair_against_all_edit_sequences(llm, block, seed):  # noqa: F811
    rows, by = odd_turns(seed), defaultdict(list)
    for conv, *rest in rows:
        by[conv].append(tuple(rest))
    every = llm.createDataFrame([(c,) for c in [*by, 999, 999]], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in turn_repair.repair(as_turns(llm, rows), every, block).collect()}
    want = {conv: plain_repair(part)[0] for conv, part in by.items()}
    want[999] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want
    turns = defaultdict(list)
    for r in sorted(turn_repair.repaired_turns(as_turns(llm, rows), block).collect(), key=lambda r: (r.conv_id is not None, r.conv_id, r.turn)):
        assert r.turn == len(turns[r.conv_id])
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    assert dict(turns) == {c: list(t) for c, part in by.items() if (t := plain_repair(part)[1])}


def test_repair_of_nothing_and_of_extra_columns(llm):  # noqa: F811
    assert turn_repair.repair(as_turns(llm, []), as_turns(llm, [])).collect() == []
    assert turn_repair.damaged(as_turns(llm, [(None, None, None, None)])).columns == ["conv_id", "turn", "role", "text"]


def test_a_long_conversation_in_blocks_and_whole(llm):  # noqa: F811
    """As many checkpoints as it takes: the same letters whatever the block."""
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{i}{rng.choice('.,')}") for i in range(3000)]
    whole, cut = (turn_repair.repair(as_turns(llm, rows), block=b).collect() for b in (4096, 100))
    assert whole == cut and set(whole[0].audit) <= set("DIKR")
    parts = [(c, s) for c, s in zip(*[iter(rng.choices("abcdefgh", k=40))] * 2, strict=True)]
    codes = "".join(c + s for c, s in parts)
    step, stored = turn_repair.checkpoints(codes, turn_repair.CLOSED_END)
    assert len(stored) <= len(codes) // step + 2 and step == math.isqrt(len(codes))


# ------------------------------------------------------------------ reply trees


def plain_paths(rows, top):
    """Formatted paths of small trees by recursion."""
    nodes, texts = {}, defaultdict(list)
    for tree, node, parent, score, role, text in rows:
        if node is not None:
            key = (parent is not None, parent or 0, score or 0.0)
            nodes[tree, node] = min(nodes.get((tree, node), key), key)
            texts[tree, node].append((role or "", text or ""))
    up = {(t, n): (t, k[1]) if k[0] and (t, k[1]) in nodes else None for (t, n), k in nodes.items()}
    out, leaves = [], set(nodes) - set(up.values())
    for tree in {t for t, _ in nodes}:
        found = []
        for leaf in (x for x in leaves if x[0] == tree):
            path, at = [], leaf
            while at is not None and at not in path:
                path.append(at)
                at = up[at]
            if at is None:
                found.append((-sum(nodes[x][2] for x in path), leaf[1], path[::-1]))
        found.sort()
        out += [(tree, leaf, rank, tuple(min(texts[x]) for x in path)) for rank, (_, leaf, path) in enumerate(found[:top], 1)]
    return sorted(out, key=repr)


def odd_messages(seed):
    rng = random.Random(seed)
    marks = ["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|>", "<|im_", "<", "\\", "\n", "im_end|>", "text", "日本", "<|im_end|>\n<|im_start|>user\n"]
    rows = []
    for tree in [None, 0, 1, 2, 3]:
        for node in range(rng.choice([1, 6, 25])):
            parent = None if node == 0 or rng.random() < 0.1 else rng.randrange(node)
            text = None if rng.random() < 0.1 else "".join(rng.choices(marks, k=rng.randrange(6)))
            rows.append((tree, node, parent, rng.choice([None, 0.0, 0.5, 1.0, 1.0, -2.0]), rng.choice(["user", "assistant", "", None, "odd\nrole\\n", "<|im_end|>"]), text))
    rows += [(3, 100 + i, 100 + (i + 1) % 3, 9.0, "user", "cycle") for i in range(3)] + [(3, 110, 100, 9.0, "user", "below a cycle"), (2, 120, 120, 1.0, "user", "own parent"), (2, 130, 777, 1.0, "assistant", "orphan"), (2, None, 0, 1.0, "user", "no node")]
    rows += [rows[1], rows[-2]] + [(0, 0, None, None, "another", "row of a known node")]
    deep = [(50, i, i - 1 if i else None, 0.0, "user", str(i)) for i in range(70)]
    return rows + deep


@pytest.mark.parametrize("top", [1, 2, None])
def test_reply_trees_against_recursion(llm, top):  # noqa: F811
    rows = odd_messages(4)
    messages = llm.createDataFrame([(*r, "p", 1, "h") for r in rows], MESSAGES)
    got = chat_format.format_paths(messages, top).collect()
    told = [(r.tree, r.path, r.rank, tuple(chat_format.read_turns(r.text))) for r in got]
    assert sorted(told, key=repr) == plain_paths(rows, top)
    for r in got:
        learned = [chat_format.unescape(r.text[s.start : s.end]) for s in r.loss]
        assert learned == [t for role, t in chat_format.read_turns(r.text) if role == "assistant"]


def test_no_messages(llm):  # noqa: F811
    assert chat_format.format_paths(llm.createDataFrame([], MESSAGES)).collect() == []


def test_chat_query(llm):  # noqa: F811
    by = defaultdict(list)
    rows = llm.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    for conv, turn, role, text in [*rows, *CONTROL]:
        by[conv].append((turn, role, text))
    for r in QUERIES["op13_chat_formatting"](llm, FOLDER).collect():
        turns = sorted(by[r.conv_id])
        learned = "".join(x for _, role, x in turns if role == "assistant")
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest("".join(f"{role}\n{x}\n" for _, role, x in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), digest(learned))
