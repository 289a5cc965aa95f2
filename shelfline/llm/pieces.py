"""SentencePiece encoding and decoding for merge-type vocabularies.

A score-ordered agenda of adjacent symbol pairs: the pair whose merged piece has the highest score is merged
first, the leftmost on ties, and its new neighbours enter the agenda.  A merge never joins two segments when no
piece of the vocabulary spans their border, so a text is cut at such borders (before the first of a run of
spaces; around characters that no longer piece contains; before a punctuation mark that no piece has behind the
character at hand) and every distinct segment is merged once per worker.
Segments new to a worker, and one whole text of every Arrow batch, are checked against the sentencepiece library; any
difference stops the job.  The library decodes the ids of whole texts.

Only vocabularies with an identity normalizer and byte fallback or unknown ids are handled; others are refused
when the vocabulary is read."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from shelfline.llm import chunks as C

SPACE = "▁"
#: Segments, and words, that a worker remembers in either of two generations; about 30 MB each.
REMEMBERED = 150_000
#: Segments of up to this many characters, all of them pieces, are merged side by side, others one by one.
TOGETHER = 40
NEVER = np.inf
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Remembered:
    """Ids by key in two generations.  A key that is met again moves to the young one; when that is full it becomes the
    old one, and what was not met since is forgotten."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """Keys that have to be learned; all others are in the young generation afterwards."""
        if len(self.young) + len(keys) > REMEMBERED:
            self.old, self.young = self.young, {}
        absent = keys - self.young.keys()
        met = absent & self.old.keys()
        old = self.old
        self.young.update((k, old[k]) for k in met)
        return list(absent - met) if met else list(absent)


class Vocabulary:
    """Pieces, scores and cutting rule of a model file."""

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        normal, trained = proto.normalizer_spec, proto.trainer_spec
        if trained.model_type != model_pb2.TrainerSpec.BPE or normal.precompiled_charsmap or normal.remove_extra_whitespaces:
            raise ValueError("a merge-type vocabulary with an identity normalizer is needed")
        if not normal.escape_whitespaces or trained.treat_whitespace_as_suffix or any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError("user-defined or unused pieces and space suffixes are not handled")
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        # the agenda takes the highest score first
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        bytes_at = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.bytes = [bytes_at[f"<0x{b:02X}>"] for b in range(256)] if trained.byte_fallback else None
        longer = [p for p in self.id if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("pieces must not hold a space after another character")
        # for merging side by side: symbols are ids, and one number more stands for no piece
        self.order = np.full(len(proto.pieces) + 1, NEVER)
        self.order[list(self.id.values())] = [-proto.pieces[i].score for i in self.id.values()]
        pairs = [(self.id[p[:i]], self.id[p[i:]], self.id[p]) for p in longer for i in range(1, len(p)) if p[:i] in self.id and p[i:] in self.id]
        left, right, piece = np.array(sorted(pairs), dtype=np.int64).T
        self.pair_keys, self.pair_piece = left * len(self.order) + right, piece.astype(np.int32)
        letters = [p for p in self.id if len(p) == 1]
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[[ord(c) for c in letters]] = [self.id[c] for c in letters]
        self.foreign = re.compile(f"[^{re.escape(''.join(letters))}]").search
        used = set("".join(longer))
        self.alone = alone = "".join(c for c in "\n\t\r" if c not in used)
        # punctuation, and the characters it may follow inside a piece: behind any other one a segment ends
        marks = ",.;:!?"
        joined = {p[i - 1] for p in longer for i in range(1, len(p)) if p[i] in marks} | {SPACE}
        self.by_words = bool(self.prefix) and "\n" in alone
        inner = f"(?:[^{SPACE}{alone}{marks}]|(?<=[{re.escape(''.join(sorted(joined)))}])[{marks}])"
        self.segment = re.compile(f"{SPACE}+{inner}*|[{marks}]{inner}*|{inner}+" + (f"|[{alone}]" if alone else ""))
        self.decimal = list(map(str, range(len(proto.pieces))))
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        # ids as 32-bit integers, the most compact form of a remembered segment
        self.known, self.words = Remembered(), Remembered()

    def merged(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment, by its agenda."""
        out: list[bytes] = [b""] * len(segments)
        short = []
        for i, segment in enumerate(segments):
            if len(segment) <= TOGETHER and self.foreign(segment) is None:
                short.append(i)
            else:
                out[i] = array("i", self._merged_alone(segment)).tobytes()
        for i, ids in zip(short, self._merged_together([segments[i] for i in short])):
            out[i] = ids
        return out

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair of symbols makes, the last number (never merged) when it makes none."""
        wanted = left.astype(np.int64) * len(self.order) + right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == wanted, self.pair_piece[at], len(self.order) - 1)

    def _merged_together(self, segments: list[str]) -> list[bytes]:
        """Agendas of many short segments side by side: an entry for each adjacent pair, all in one array.  In each
        round every segment merges its best pair, the leftmost of equals."""
        if not segments:
            return []
        symbol = self.letter[np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)]
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        none = len(self.order) - 1
        piece = np.full(len(symbol), none, dtype=np.int32)
        inner = owner[:-1] == owner[1:]
        piece[:-1][inner] = self._pairs(symbol[:-1][inner], symbol[1:][inner])
        rank = self.order[piece]
        done_owner, done_symbol = [], []
        while len(symbol):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(owner))))
            live = best < NEVER
            if not live.all():
                done_owner.append(owner[~live])
                done_symbol.append(symbol[~live])
                owner, symbol, piece, rank, best = owner[live], symbol[live], piece[live], rank[live], best[live]
                if not len(owner):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.diff(owner[at], prepend=-1) != 0]
            symbol[at] = piece[at]
            kept = np.ones(len(symbol), dtype=bool)
            kept[at + 1] = False
            owner, symbol, piece, rank = owner[kept], symbol[kept], piece[kept], rank[kept]
            at = at - np.arange(len(at))
            # the merged symbol has new pairs with the one before and the one behind
            changed = np.concatenate((at, at[at > 0] - 1))
            piece[changed] = none
            inner = changed[changed + 1 < len(owner)]
            inner = inner[owner[inner] == owner[inner + 1]]
            piece[inner] = self._pairs(symbol[inner], symbol[inner + 1])
            rank[changed] = self.order[piece[changed]]
        owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
        sort = np.argsort(owner, kind="stable")
        ids, ends = symbol[sort].astype(np.int32).tobytes(), (4 * np.cumsum(np.bincount(owner, minlength=len(segments)))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _merged_alone(self, segment: str) -> list[int]:
        out: list[int] = []
        for symbol in self._agenda(segment):
            found = self.id.get(symbol)
            if found is not None:
                out.append(found)
            elif self.bytes is not None:
                out.extend([self.bytes[b] for b in symbol.encode()])
            else:
                out.append(self.unknown)
        return out

    def _agenda(self, segment: str) -> list[str]:
        """Symbols of a segment of any length and content.  The agenda is a heap; entries whose symbols have been
        merged since are passed over."""
        rank = self.rank
        symbols = list(segment)
        last = len(symbols)
        before, after = list(range(-1, last)), list(range(1, last + 1))
        agenda = []
        for i in range(last - 1):
            piece = symbols[i] + symbols[i + 1]
            if piece in rank:
                agenda.append((rank[piece], i, piece))
        heapify(agenda)
        while agenda:
            _, left, piece = heappop(agenda)
            right = after[left]
            if right < last and symbols[left] and symbols[left] + symbols[right] == piece:
                symbols[left], symbols[right] = piece, ""
                after[left] = beyond = after[right]
                if beyond < last:
                    before[beyond] = left
                    longer = piece + symbols[beyond]
                    if longer in rank:
                        heappush(agenda, (rank[longer], left, longer))
                ahead = before[left]
                if ahead >= 0:
                    longer = symbols[ahead] + piece
                    if longer in rank:
                        heappush(agenda, (rank[longer], ahead, longer))
        return [symbol for symbol in symbols if symbol]

    def segments(self, text: str) -> list[str]:
        return self.segment.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def learn(self, segments: set[str]) -> None:
        """Merge segments that are new and compare them with the library's ids."""
        new = self.known.missing(segments)
        ids = self.merged(new)
        # A segment that starts with a space is offered without it, as the library puts one in front; any other
        # one is offered behind a line break, which stands alone.
        spaced = [i for i, s in enumerate(new) if s[0] == SPACE and s != self.prefix]
        behind = [i for i, s in enumerate(new) if s[0] != SPACE] if "\n" in self.alone else []
        skip = len(self.library.encode("\n"))
        for chosen, offered, own in (
            (spaced, [new[i][len(self.prefix) :].replace(SPACE, " ") for i in spaced], 0),
            (behind, ["\n" + new[i] for i in behind], skip),
        ):
            for i, found in zip(chosen, self.library.encode(offered, num_threads=1) if offered else []):
                if array("i", found[own:]).tobytes() != ids[i]:
                    raise ValueError(f"differs from the library: {new[i]!r}")
        self.known.young.update(zip(new, ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text.  Where single spaces and line breaks part its words, whole words are looked up,
        and only new ones are cut to segments."""
        cut: list[tuple[bool, list[str]]] = []
        for text in texts:
            units = text.replace("\n", " \n").split(" ")
            plain = self.by_words and "" not in units and SPACE not in text
            cut.append((plain, units if plain else self.segments(text)))
        words = set().union(*(units for plain, units in cut if plain))
        new = self.words.missing(words)
        # a word at the start of a line has the line break in front, any other one a space; a word of letters is one segment
        parts = [[SPACE + w] if w.isalpha() else self.segment.findall(w if w[0] == "\n" else SPACE + w) for w in new]
        self.learn(set().union(*parts, *(units for plain, units in cut if not plain)))
        known = self.known.young.__getitem__
        self.words.young.update((w, known(p[0]) if len(p) == 1 else b"".join(map(known, p))) for w, p in zip(new, parts))
        word = self.words.young.__getitem__
        return [b"".join(map(word if plain else known, units)) for plain, units in cut]

    def check(self, text: str, ids: list[int]) -> None:
        """One whole text against the library: the rule that cuts texts must hold for this vocabulary."""
        if self.library.encode(text, num_threads=1) != ids:
            raise ValueError("a text cut to segments differs from the library")

    def decoded(self, ids: list[list[int]]) -> list[str]:
        """What the library makes of the ids."""
        return self.library.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_decode(docs: DataFrame, path: str, keep_ids: bool = True, keep_decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (array, unless ``keep_ids`` is false) and decoded, the
    text the library makes of the ids (unless ``keep_decoded`` is false).  ``path`` is the model file, present on
    every executor.

    Null text is the empty text, with no ids.  Long texts are encoded whole.  Rows are independent; a repeated
    row gets an equal result, a null doc_id stays null, further columns are not carried."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = vocabulary(path)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        packed = known.encode(texts)
        ids = [np.frombuffer(p, dtype=np.int32).tolist() for p in packed]
        # the shortest text that was cut at all is checked whole
        tried = min((i for i in range(len(texts)) if texts[i]), key=lambda i: len(texts[i]), default=None)
        if tried is not None:
            known.check(texts[tried], ids[tried])
        decoded, decimal = known.decoded(ids), known.decimal
        columns = {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array(list(map(len, ids)), pa.int64()),
            "ids_sha256": pa.array([_sha256(",".join([decimal[i] for i in own])) for own in ids], pa.string()),
            "decoded_sha256": pa.array(list(map(_sha256, decoded)), pa.string()),
        }
        if keep_ids:
            flat = np.frombuffer(b"".join(packed), dtype=np.int32)
            bounds = np.concatenate(([0], np.cumsum(list(map(len, ids))))).astype(np.int32)
            columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
        if keep_decoded:
            columns["decoded"] = pa.array(decoded, pa.string())
        return pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return C.map_batches(narrow, run, schema + ", ids array<int>" * keep_ids + ", decoded string" * keep_decoded)
