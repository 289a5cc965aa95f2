"""Token counts of texts of any length, as the sentencepiece library gives them.

A huge text is encoded in overlapping chunks with offsets.  Two neighbours are spliced at a common boundary
inside their overlap that is proven stable: both end a token there, and no piece of the vocabulary can span it
(a space after another character, when no piece holds a space behind one).  When an overlap has none, it is
widened, in the limit to the whole text so far, so the count is always that of the whole text."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from shelfline.llm import chunks as C

SPACE = "▁".encode()
#: Texts up to this many bytes are encoded in one go.
WHOLE, CHUNK, OVERLAP = 24_000, 16_000, 200


class Counter:
    def __init__(self, path: str, whole: int = WHOLE, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.whole, self.chunk, self.overlap = whole, chunk, overlap
        pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
        self.splittable = not any("▁" in p.lstrip("▁") for p in pieces)

    def offsets(self, data: bytes, begin: int, end: int) -> list[int]:
        """Where the tokens of a stretch begin, in bytes of the whole text, and the stretch's end.  The library
        puts a space in front; inside a text it stands for the stretch's own first space, if it has one, and
        otherwise spoils the first word, which is never spliced at."""
        own = 1 if begin and data[begin] == 0x20 else 0
        found = self.library.encode(data[begin + own : end].decode(), return_type="proto").pieces
        return [begin if i == 0 else begin + own + p.begin for i, p in enumerate(found)] + [end]

    @staticmethod
    def whole_character(data: bytes, at: int) -> int:
        """The nearest start of a character at or before a position."""
        while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return at

    @staticmethod
    def stable(data: bytes, at: int) -> bool:
        """A space behind anything but a space (which the library also writes as U+2581)."""
        return data[at] == 0x20 and data[at - 1] != 0x20 and data[at - 3 : at] != SPACE

    def count(self, text: str) -> int:
        data = text.encode()
        if len(data) <= self.whole or not self.splittable:
            return len(self.library.encode(text))
        total, begin, overlap = 0, 0, self.overlap
        end = self.whole_character(data, self.chunk)
        left = self.offsets(data, begin, end)
        while True:
            start = self.whole_character(data, max(begin, end - overlap))
            stop = self.whole_character(data, min(len(data), start + self.chunk + 2 * overlap))
            right = self.offsets(data, start, stop)
            # the first token of the right stretch carries the added space, so its own start is no boundary
            common = set(left) & set(right)
            splice = max((p for p in common if start < p < end and self.stable(data, p)), default=None)
            if splice is not None:
                total += sum(p < splice for p in left[:-1])
                left, begin, end = [p for p in right if p >= splice], splice, stop
            elif start > begin:
                overlap *= 2
                continue
            else:  # the overlap is the whole left stretch: the right one, which begins with it, takes its place
                left, end = right, stop
            overlap = self.overlap
            if end == len(data):
                return total + len(left) - 1


@lru_cache(maxsize=2)
def counter(path: str, whole: int, chunk: int, overlap: int) -> Counter:
    return Counter(path, whole, chunk, overlap)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, whole: int = WHOLE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Null text is the empty text, with no tokens.  Rows are independent; repeated rows get equal results, a
    null doc_id stays null, further columns are not carried.  ``path`` is the model file on every executor."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = counter(path, whole, chunk, overlap)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts = [tool.count(t) for t in texts]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "over_limit": pa.array([n > limit for n in counts], pa.bool_()),
            }
        )

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return C.map_batches(narrow, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
