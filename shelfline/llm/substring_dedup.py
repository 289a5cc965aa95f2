"""Removal of long word sequences that an earlier document already has.

Fixed-block anchors: every document lays down non-overlapping blocks of ``block`` words; every rolling window
of the same length probes them.  With ``2 * block - 1 <= window``, a repeat of ``window`` words contains a whole
block of either document, so windows without a hit need no further look.  Hits are extended to the windows of
``window`` words that contain them; these are compared corpus-wide, and overlapping matches merge into maximal
repeats.

Both questions (is this block probed by anything else; which is the smallest document with this window) are
asked chunk by chunk and answered in buckets of the key space, see ``chunks``.  A passage with any number of
copies sends one key per chunk; no pair of documents is ever formed.

Block keys are 32 bits beyond the bucket number and only select candidates.  Window keys are 64 bits beyond the
bucket number, which comes from a second, independent hash, so that the key grows with the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfline.llm import chunks as C
from shelfline.llm.hashing import SECOND_BASE, Words, covered, ngram_hashes, number, numbers, word_hashes, words_of

ANSWER = "chunk int, stage int, bucket int, bits binary, size int"
#: Added columns.
ADDED = "n_words long, n_removed long, spans array<int>"
U32, U64 = np.uint64(32), np.uint64


class _Blocks:
    """Distinct block keys of a chunk, ascending by (bucket, key)."""

    def __init__(self, words: Words, hashes: np.ndarray, block: int, buckets: int):
        grams = ngram_hashes(hashes, block)
        at = np.arange(len(grams))
        self.inside = at + block <= words.text_end()[: len(grams)]
        key = (C.bucket_of(grams, buckets) << U32) | (grams & U64(0xFFFFFFFF))
        self.key, self.slot, self.count = np.unique(key[self.inside], return_inverse=True, return_counts=True)
        begin = np.repeat(words.first[:-1], words.counts)[: len(grams)]
        anchor = ((at - begin) % block == 0)[self.inside]
        self.anchor = np.bincount(self.slot, weights=anchor, minlength=len(self.key)) > 0
        self.cuts = C.cut_points(self.key >> U32, buckets)


class _Windows:
    """Distinct keys of the candidate windows of a chunk, with the smallest document of each."""

    def __init__(self, words: Words, hashes: np.ndarray, docs: np.ndarray, hit: np.ndarray, block: int, window: int, buckets: int):
        grams = ngram_hashes(hashes, window)
        at = np.arange(len(grams))
        hits = np.concatenate(([0], np.cumsum(hit)))
        inner = window - block + 1
        candidate = (at + window <= words.text_end()[: len(grams)]) & (hits[at + inner] > hits[at])
        self.at = np.flatnonzero(candidate)
        key, index, slot = np.unique(grams[self.at], return_index=True, return_inverse=True)
        where = C.bucket_of(ngram_hashes(hashes, window, SECOND_BASE)[self.at[index]], buckets)
        order = np.argsort(where, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.key, self.slot = key[order], rank[slot]
        self.doc = docs[words.owner()[self.at]]
        self.low = self.doc[index][order]  # documents ascend, so the first occurrence has the smallest
        self.cuts = C.cut_points(where[order], buckets)


def _read(table: pa.Table) -> tuple[pa.Table, Words, np.ndarray, np.ndarray]:
    table = C.by_doc(table)
    words = words_of(C.column_bytes(table))
    return table, words, word_hashes(words), C.doc_keys(table)


def _bits(answers: pa.Table, stage: int) -> np.ndarray:
    rows = sorted((b, blob, n) for s, b, blob, n in zip(*(answers.column(c).to_pylist() for c in ("stage", "bucket", "bits", "size"))) if s == stage)
    parts = [np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=n) for _, blob, n in rows]
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, dtype=bool)


def _slices(cuts: np.ndarray) -> Iterator[tuple[int, slice]]:
    for bucket in np.flatnonzero(np.diff(cuts)):
        yield int(bucket), slice(cuts[bucket], cuts[bucket + 1])


def _answer(table: pa.Table, stage: int, sizes: list[int], flags: np.ndarray) -> pa.Table:
    ends = np.cumsum([0, *sizes])
    bits = [np.packbits(flags[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "stage": pa.array([stage] * len(sizes), pa.int32()),
            "bucket": table.column("bucket"),
            "bits": pa.array(bits, pa.binary()),
            "size": pa.array(sizes, pa.int32()),
        }
    )


def _hits(words: Words, hashes: np.ndarray, answers: pa.Table, block: int, buckets: int) -> np.ndarray:
    """Positions whose block-long window was found elsewhere."""
    blocks = _Blocks(words, hashes, block, buckets)
    hit = np.zeros(len(hashes), dtype=bool)
    hit[np.flatnonzero(blocks.inside)] = _bits(answers, 1)[blocks.slot]
    return hit


def remove_repeats(
    docs: DataFrame, window: int = 13, joined: bool = True, chunk_chars: int = C.CHUNK_CHARS, bucket_keys: int = C.BUCKET_KEYS
) -> DataFrame:
    """Cuts every word covered by a window of ``window`` words that also starts in a document of a smaller id.

    Windows are judged on the input.  ``text`` is replaced by the kept words, joined by one space; with
    ``joined=False`` a document that loses nothing keeps its text as it is.  Added: n_words, n_removed and
    spans, the removed maximal word ranges as begin, end, begin, end ... (end excluded).

    Null or empty text: no words, empty text.  Texts under ``window`` words lose nothing.  Repeats inside one
    document, and between rows of equal id, are no reason to remove.  A null id counts as larger than any.
    Empty tables give empty results; further columns are kept, and added columns win over equal names."""
    block = (window + 1) // 2
    parts, chars = C.chunked(C.packed(docs), chunk_chars)
    buckets = C.buckets_for(chars // 6, bucket_keys)  # a word takes about six characters

    def ask_blocks(table: pa.Table) -> pa.Table:
        table, words, hashes, _ = _read(table)
        blocks = _Blocks(words, hashes, block, buckets)
        low, many = (blocks.key & U64(0xFFFFFFFF)).astype("<u4"), blocks.count > 1
        found = list(_slices(blocks.cuts))
        return pa.table(
            {
                "chunk": pa.array([table.column("chunk")[0].as_py()] * len(found), pa.int32()),
                "bucket": pa.array([b for b, _ in found], pa.int32()),
                "keys": pa.array([low[s].tobytes() for _, s in found], pa.binary()),
                "flags": pa.array([np.packbits(np.stack([blocks.anchor[s], many[s]])).tobytes() for _, s in found], pa.binary()),
            }
        )

    def answer_blocks(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, dtype="<u4") for k in table.column("keys").to_pylist()]
        flags = [np.unpackbits(np.frombuffer(f, dtype=np.uint8), count=2 * len(k)).reshape(2, -1) for f, k in zip(table.column("flags").to_pylist(), keys)]
        anchor, many = np.concatenate(flags, axis=1)
        unique, slot = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(slot) + np.bincount(slot, weights=many)
        wanted = (np.bincount(slot, weights=anchor) > 0) & (times > 1)
        return _answer(table, 1, [len(k) for k in keys], wanted[slot])

    def ask_windows(docs_part: pa.Table, answers: pa.Table) -> pa.Table:
        table, words, hashes, ids = _read(docs_part)
        hit = _hits(words, hashes, answers, block, buckets)
        windows = _Windows(words, hashes, ids, hit, block, window, buckets)
        found = list(_slices(windows.cuts))
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        bases = [int(windows.low[s].min()) for _, s in found]
        return pa.table(
            {
                "chunk": pa.array([chunk] * len(found), pa.int32()),
                "bucket": pa.array([b for b, _ in found], pa.int32()),
                "keys": pa.array([windows.key[s].tobytes() for _, s in found], pa.binary()),
                "base": pa.array(bases, pa.int64()),
                "docs": pa.array([number((windows.low[s] - b).view(np.uint64)) for (_, s), b in zip(found, bases)], pa.binary()),
            }
        )

    def answer_windows(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, dtype="<u8") for k in table.column("keys").to_pylist()]
        low = [numbers(d).astype(np.int64) + b for d, b in zip(table.column("docs").to_pylist(), table.column("base").to_pylist())]
        key, doc = np.concatenate(keys), np.concatenate(low)
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.diff(key[order], prepend=~key[order[0]]) != 0)
        smallest = np.minimum.reduceat(doc[order], begins)
        least = np.empty(len(key), dtype=np.int64)
        least[order] = np.repeat(smallest, np.diff(np.append(begins, len(key))))
        return _answer(table, 2, [len(k) for k in keys], least < doc)

    def cut(docs_part: pa.Table, answers: pa.Table) -> pa.Table:
        table, words, hashes, ids = _read(docs_part)
        hit = _hits(words, hashes, answers, block, buckets)
        windows = _Windows(words, hashes, ids, hit, block, window, buckets)
        earlier = _bits(answers, 2)[windows.slot] | (windows.doc > windows.low[windows.slot])
        starts = np.zeros(len(hashes), dtype=bool)
        starts[windows.at[earlier]] = True
        gone = covered(starts, window, len(hashes))
        texts, removed, spans = [], [], []
        for text, a, b in zip(C.column_bytes(table), words.first[:-1], words.first[1:]):
            lost = gone[a:b]
            n = int(lost.sum())
            removed.append(n)
            spans.append(np.flatnonzero(np.diff(lost.view(np.int8), prepend=np.int8(0), append=np.int8(0))).tolist() if n else [])
            if n:
                texts.append(b" ".join([w for w, gone_word in zip(text.split(), lost.tolist()) if not gone_word]))
            else:
                texts.append(b" ".join(text.split()) if joined else text)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
                "rest": table.column("rest"),
                "n_words": pa.array(words.counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int32())),
            }
        )

    by_chunk = parts.groupBy("chunk")
    asked = by_chunk.applyInArrow(lambda part: C.settled(ask_blocks, part), "chunk int, bucket int, keys binary, flags binary")
    first = asked.groupBy("bucket").applyInArrow(lambda asks: C.settled(answer_blocks, asks), ANSWER)
    asked = by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(
        lambda part, answers: C.settled(ask_windows, part, answers), "chunk int, bucket int, keys binary, base long, docs binary"
    )
    second = asked.groupBy("bucket").applyInArrow(lambda asks: C.settled(answer_windows, asks), ANSWER)
    answered = first.unionByName(second).groupBy("chunk")
    result = by_chunk.cogroup(answered).applyInArrow(lambda part, answers: C.settled(cut, part, answers), C.packed_schema(parts, ADDED))
    return C.unpacked(result, docs, ["n_words", "n_removed", "spans"])

