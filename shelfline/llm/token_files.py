"""Token ids as flat binary files.

A shard holds the documents of one range of ids, ascending: ``<shard>.ids`` is a flat file of little-endian
unsigned integers (16 bits when the vocabulary allows, else 32), ``<shard>.offsets`` the 64-bit positions where
documents begin (one more than documents), ``<shard>.docs`` their 64-bit ids.  A shard's place in the whole is
the prefix sum of the shards before it.  Shards are written by the tasks that own the range, under a name of
the attempt, then renamed, so a repeated task leaves one whole file.  Readers map local files into memory."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as stores
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from shelfline.llm import chunks as C
from shelfline.session import pin, scratch

#: Words, and parts of words, that a worker remembers; about 60 MB each.
REMEMBERED = 400_000
#: Stands for a null document id in ``.docs``.
NO_ID = np.iinfo(np.int64).min
MANIFEST = "shard int, path string, width int, n_docs long, n_ids long"


#: Latin letters, each one code point.
LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: Marks cut off behind words, of tokenizers whose way with Latin words is known and of others.
MARKS, FEW_MARKS = ",.;:!?&$#*%\"')]}", ",.;:!?"
#: Words that are encoded as one text.
TOGETHER = 1000
#: Bytes of text that a task encodes at a time.
HELD_BYTES = 4_000_000


class WordEncoder:
    """Ids of a text word by word.  For tokenizers whose pre-tokens never span white space, nor a letter and the
    closing punctuation behind it; each distinct word without its punctuation is encoded by the library once per
    worker.  Latin words go many at a time to the library's model where the tokenizer does no more to them than
    lower their letters (`plain`)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.plain = self._plain(path)

    def _plain(self, path: str) -> Tokenizer | None:
        """The same model without normalizer and with nothing but white space between pre-tokens; None when it and
        the tokenizer disagree on any two Latin letters, in either case, or on a mark behind one."""
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        letters = [chr(c) for c in range(256) if re.fullmatch(LATIN, chr(c))]
        pairs = [x + y for x in letters for y in letters]
        if self._by_one(pairs) != self._by_many([p.lower() for p in pairs]):
            return None
        marked = [x + y for x in ("a", "É") for y in MARKS]
        if self._by_one(marked) != [x + y for x, y in zip(self._by_one([m[0] for m in marked]), self._by_one([m[1] for m in marked]))]:
            return None
        return self.plain

    def _by_one(self, words: list[str]) -> list[bytes]:
        return [array(self.kind.char, e.ids).tobytes() for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _by_many(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case Latin words."""
        out = []
        for at in range(0, len(words), TOGETHER):
            few = words[at : at + TOGETHER]
            encoding = self.plain.encode(" ".join(few), add_special_tokens=False)
            cut = (np.searchsorted(np.array(encoding.word_ids, dtype=np.int64), np.arange(len(few) + 1)) * self.kind.itemsize).tolist()
            ids = np.array(encoding.ids, dtype=self.kind).tobytes()
            out += [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        return out

    def learn(self, words: list[str]) -> None:
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > REMEMBERED:
            self.words = {w: self.words[w] for w in words if w in self.words}
        listed = pa.array(new, pa.large_string())
        cores = pc.utf8_rtrim(listed, MARKS if self.plain else FEW_MARKS)
        latin = pc.match_substring_regex(cores, f"^{LATIN}$") if self.plain else pa.array([False] * len(new), pa.bool_())
        # a mark behind anything but a letter may belong to a longer run of marks
        whole = pc.invert(pc.or_(latin, pc.match_substring_regex(cores, "[A-Za-z]$")))
        cores = pc.if_else(whole, listed, pc.if_else(latin, pc.utf8_lower(cores), cores)).to_pylist()
        marks = [w[len(core) :] for w, core in zip(new, cores)]
        kinds = latin.to_pylist()
        many = {core for core, kind in zip(cores, kinds) if kind}
        one = {core for core, kind in zip(cores, kinds) if not kind}
        one.update(marks)
        many, one = many.difference(self.parts), one.difference(self.parts)
        if len(self.parts) + len(many) + len(one) > REMEMBERED:
            self.parts = {p: self.parts[p] for some in (cores, marks) for p in some if p in self.parts}
        one -= many
        for some, found in ((many, self._by_many), (one, self._by_one)):
            parts = list(some)
            self.parts.update(zip(parts, found(parts)))
        part = self.parts
        self.words.update(zip(new, [part[core] + part[mark] if mark else part[core] for core, mark in zip(cores, marks)]))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        known = list(map(self.words.__getitem__, words))
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        pool = np.frombuffer(b"".join(known), dtype=self.kind)
        # the ids of all words in a row: for each word its stretch of the pool
        word = coded.indices.to_numpy()
        sizes = size[word]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = pool[np.arange(ends[-1]) + np.repeat((np.cumsum(size) - size)[word] - ends[:-1], sizes)].tobytes()
        offsets = split.offsets.to_numpy()
        cut = (ends[offsets - offsets[0]] * self.kind.itemsize).tolist()
        found = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        # one whole text of a batch, the shortest of several words: a tokenizer that looks across words is refused
        counts = np.diff(offsets)
        for at in range(0, len(texts), C.BATCH_ROWS):
            some = [i for i in range(at, min(at + C.BATCH_ROWS, len(texts))) if counts[i] > 1 and len(texts[i].split()) > 1]
            if some:
                tried = min(some, key=lambda i: len(texts[i]))
                whole = self.library.encode(texts[tried].decode(), add_special_tokens=False).ids
                if array(self.kind.char, whole).tobytes() != found[tried]:
                    raise ValueError("a text encoded word by word differs from the library")
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[int | None]]]:
    """Texts and ids of batches together, up to the batch that makes them HELD_BYTES."""
    texts, docs, held = [], [], 0
    for batch in batches:
        some = C.column_bytes(batch)
        texts += some
        docs += batch.column("doc_id").to_pylist()
        held += sum(map(len, some))
        if held >= HELD_BYTES:
            yield texts, docs
            texts, docs, held = [], [], 0
    if texts:
        yield texts, docs


def _store(path: str) -> tuple[stores.FileSystem, str]:
    return stores.FileSystem.from_uri(path)


def _publish(store: stores.FileSystem, part: str, final: str) -> None:
    """Rename a finished file; a copy left by an earlier attempt holds the same bytes."""
    if not isinstance(store, stores.LocalFileSystem) and store.get_file_info(final).type != stores.FileType.NotFound:
        store.delete_file(final)
    store.move(part, final)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode and write all documents; returns the manifest: shard, path, width, n_docs, n_ids.

    Null text is the empty text: only the end id is written.  Null ids come first.  Rows of equal id follow each
    other in order of text.  Further columns are not written.  An empty table gives no shard."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = narrow.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task = encoder(tokenizer), TaskContext.get()
        shard, end = task.partitionId(), np.array([end_id], dtype=tool.kind).tobytes()
        path, suffix = f"{folder}/shard-{shard:08d}", f".attempt-{task.taskAttemptId()}"
        store, local = _store(path)
        ends, ids, sink = array("q", [0]), array("q"), None
        for texts, docs in _gathered(batches):
            if sink is None:
                sink = store.open_output_stream(local + ".ids" + suffix)
            for encoded in tool.encode(texts):
                sink.write(encoded + end)
                ends.append(ends[-1] + len(encoded) // tool.kind.itemsize + 1)
            ids.extend(NO_ID if d is None else d for d in docs)
        if sink is None:
            return
        sink.close()
        for kind, values in ((".offsets", ends), (".docs", ids)):
            with store.open_output_stream(local + kind + suffix) as out:
                out.write(np.array(values, dtype="<i8").tobytes())
        for kind in (".docs", ".offsets", ".ids"):
            _publish(store, local + kind + suffix, local + kind)
        row = {"shard": [shard], "path": [path], "width": [tool.kind.itemsize], "n_docs": [len(ids)], "n_ids": [ends[-1]]}
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], list(row))

    store, local = _store(folder)
    store.create_dir(local, recursive=True)
    return pin(ranged.mapInArrow(write, MANIFEST), "token-manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """Adds ``base``, the ids in all shards before.  The manifest has one row per shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class Flat:
    """A flat file of integers: mapped into memory where it is a local file, else read range by range."""

    def __init__(self, path: str, kind: np.dtype):
        self.store, self.path = _store(path)
        self.kind = kind
        self.size = self.store.get_file_info(self.path).size // kind.itemsize
        self.mapped = np.memmap(self.path, dtype=kind, mode="r") if self.local and self.size else None
        self.file = self.store.open_input_file(self.path) if self.mapped is None else None

    @property
    def local(self) -> bool:
        return isinstance(self.store, stores.LocalFileSystem)

    def part(self, begin: int, end: int) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[begin:end]
        wide = self.kind.itemsize
        return np.frombuffer(self.file.read_at((end - begin) * wide, begin * wide), dtype=self.kind)


def read_shards(manifest: DataFrame, rows: int = 4096) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), read from the files: as many tasks as shards, each holding the ids of one document."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = Flat(shard["path"] + ".ids", np.dtype(f"<u{shard['width']}"))
                offsets, docs = (Flat(shard["path"] + k, np.dtype("<i8")) for k in (".offsets", ".docs"))
                for at in range(0, docs.size, rows):
                    own, cut = docs.part(at, min(at + rows, docs.size)), offsets.part(at, min(at + rows, docs.size) + 1)
                    sums = [zlib.crc32(ids.part(a, b).astype("<u4").tobytes()) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own, pa.int64(), mask=own == NO_ID),
                            pa.array(cut[:-1] + shard["base"], pa.int64()),
                            pa.array(np.diff(cut), pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # without a number, adaptive execution would put the few rows of the manifest, and so all files, into one task
    return with_bases(manifest).repartition(max(1, manifest.count()), "shard").mapInArrow(read, schema)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write to a new folder of the shared store, then read back."""
    return read_shards(write_shards(docs, scratch(spark, "tokens"), tokenizer, end_id))
