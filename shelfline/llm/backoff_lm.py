"""Language-model scoring with a weighted backoff automaton.

Smoothed n-grams are states and arcs.  The state after a token is that token's context, if training saw it,
else the root.  A state has one arc for each pair seen in training, weighted with its smoothed log-probability,
and a failure arc to the root, weighted with the mass left to unseen continuations; at the root every token has
its unigram arc.  A text is read once from left to right: each token follows an arc, or fails to the root and
goes on from there, and the weights are added up.

    p(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | h) = (c(h w) + k p(w)) / (c(h) + k)

so an arc weighs log10 p(w | h) and a failure log10 (k / (c(h) + k)); the probabilities after h add up to one.

Counts come from the whole training part.  Each chunk of documents sends its distinct tokens and pairs with
their counts to buckets of the key space, gets the corpus-wide counts of just these back, and builds the part of
the automaton that its own texts can reach.  No vocabulary is broadcast, whatever its size.  Tokens go by
64-bit hashes, pairs by 48 bits beyond the bucket number."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import chunks as C
from shelfline.llm.hashing import mix, number, numbers, word_hashes, words_of

#: Added to each count in the unigram estimate.
ADDED = 0.1
#: Weight of the unigram estimate in a state, in observations.
STRENGTH = 300.0
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
ASK = "bucket int, chunk int, kind int, keys binary, counts binary"
ANSWER = "chunk int, bucket int, kind int, counts binary, total long, distinct long"


def _packed(keys: np.ndarray, kind: int) -> bytes:
    """Keys of a bucket.  Of pairs, 48 bits beyond the bucket number do: there are many, and each counts little."""
    return keys.tobytes() if kind == 1 else keys.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(blob: bytes, kind: int) -> np.ndarray:
    if kind == 1:
        return np.frombuffer(blob, dtype="<u8")
    wide = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


class _Tokens:
    """Tokens and pairs of a chunk: distinct keys, the slot of each position, and counts in training texts."""

    def __init__(self, table: pa.Table):
        words = words_of([t.lower() for t in C.column_bytes(table)])
        n_docs = len(words.first) - 1
        self.first = words.first[:-1] + np.arange(n_docs)
        size = len(words.starts) + n_docs
        token = np.full(size, END, dtype=np.uint64)
        token[np.arange(len(words.starts)) + words.owner()] = word_hashes(words)
        self.sizes = words.counts + 1
        before = np.empty(size, dtype=np.uint64)
        before[1:], before[self.first] = token[:-1], START
        train = np.repeat(~np.array(table.column("held_out").to_pylist(), dtype=bool), self.sizes)
        self.keys, self.slots, self.counts = {}, {}, {}
        for kind, values in ((1, token), (2, mix(mix(before) ^ token))):
            key, slot = np.unique(values, return_inverse=True)
            self.keys[kind], self.slots[kind] = key, slot
            self.counts[kind] = np.bincount(slot, weights=train, minlength=len(key)).astype(np.int64)


class Automaton:
    """The part of the automaton reachable for the given positions: token counts and pair counts at each of them,
    counts of the states they start from, training tokens and vocabulary."""

    def __init__(self, total: int, distinct: int, strength: float):
        self.floor = total + ADDED * (distinct + 1)
        self.strength = strength

    def root_arcs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / self.floor)

    def walk(self, counts: np.ndarray, pairs: np.ndarray, states: np.ndarray) -> np.ndarray:
        """Weight of every step.  ``states`` holds the training count of the state before each token, 0 at the root."""
        at_root = self.root_arcs(counts)
        if self.strength <= 0:
            raise ValueError("strength must be positive")
        arcs = np.log10((pairs + self.strength * 10**at_root) / (states + self.strength))
        failures = np.log10(self.strength / (states + self.strength))
        return np.where(states == 0, at_root, np.where(pairs > 0, arcs, failures + at_root))


def score_texts(docs: DataFrame, held_out, strength: float = STRENGTH, chunk_chars: int = C.CHUNK_CHARS, bucket_keys: int = C.BUCKET_KEYS) -> DataFrame:
    """Scores every document; training uses those where ``held_out`` (a boolean column) is not true.

    Tokens are words with A-Z lowered, then one end.  Null text is empty and has the end only.  A null in
    ``held_out`` counts as false.  Rows of equal id are separate texts.  Without training texts N and V are 0 and
    every text has its root weights.  Further columns are not carried.  Empty tables give empty results."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    parts, chars = C.chunked(narrow, chunk_chars)
    buckets = C.buckets_for(chars // 6, bucket_keys)

    def ask(table: pa.Table) -> pa.Table:
        tokens, chunk = _Tokens(table), table.column("chunk")[0].as_py()
        rows = []
        for kind, key in tokens.keys.items():
            cuts = C.cut_points(C.bucket_of(key, buckets), buckets)
            for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a or kind == 1:  # every bucket of tokens is asked, as each tells its share of N and V
                    rows.append((bucket, chunk, kind, _packed(key[a:b], kind), number(tokens.counts[kind][a:b])))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "chunk", "kind", "keys", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        out = []
        kinds = np.array(table.column("kind").to_pylist())
        for kind in np.unique(kinds).tolist():
            own = table.filter(pa.array(kinds == kind))
            keys = [_unpacked(k, kind) for k in own.column("keys").to_pylist()]
            counts = np.concatenate([numbers(c) for c in own.column("counts").to_pylist()]).astype(np.int64)
            unique, slot = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(slot, weights=counts, minlength=len(unique)).astype(np.int64)
            ends = np.cumsum([0, *map(len, keys)])
            replies = [number(sums[slot[a:b]]) for a, b in zip(ends[:-1], ends[1:])]
            out.append(
                pa.table(
                    {
                        "chunk": own.column("chunk"),
                        "bucket": own.column("bucket"),
                        "kind": own.column("kind"),
                        "counts": pa.array(replies, pa.binary()),
                        "total": pa.array([int(sums.sum())] * own.num_rows, pa.int64()),
                        "distinct": pa.array([int(np.count_nonzero(sums))] * own.num_rows, pa.int64()),
                    }
                )
            )
        return pa.concat_tables(out)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = _Tokens(table)
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "counts", "total", "distinct"))))
        total, distinct = (sum(r[i] for r in rows if r[0] == 1) for i in (3, 4))
        found = {k: np.concatenate([numbers(r[2]) for r in rows if r[0] == k]).astype(np.int64) for k in (1, 2)}
        counts, pairs = found[1][tokens.slots[1]], found[2][tokens.slots[2]]
        states = np.empty_like(counts)
        states[1:] = counts[:-1]
        # a text begins in the start state, which training entered once per text, as often as it met the end
        states[tokens.first] = counts[np.cumsum(tokens.sizes) - 1]
        automaton = Automaton(total, distinct, strength)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, tokens.first)

        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": table.column("held_out"),
                "n_tokens": pa.array(tokens.sizes, pa.int64()),
                "n_known": pa.array(per_text((counts > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array([total] * table.num_rows, pa.int64()),
                "base_score": pa.array(per_text(automaton.root_arcs(counts)), pa.float64()),
                "score": pa.array(per_text(automaton.walk(counts, pairs, states)), pa.float64()),
            }
        )

    by_chunk = parts.groupBy("chunk")
    answers = by_chunk.applyInArrow(ask, ASK).groupBy("bucket").applyInArrow(answer, ANSWER)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(score, RESULT)
