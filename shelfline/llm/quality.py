"""Quality rules on repetition.

Rolling hashes of several n-gram lengths find, inside each text, the characters that belong to word sequences
seen before in the same text, and the lines that equal an earlier line.  A text made mostly of its own copies
is rejected.  Every figure is a whole number; shares are compared by multiplication, so that a verdict never
depends on rounding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfline.llm import chunks as C
from shelfline.llm.hashing import PLAIN, covered, mix, ngram_hashes, word_hashes, words_of

#: Base: fewer words fail; so does a higher percentage of words in repeated windows of this many words.
LEAST_WORDS, BASE_WINDOW, BASE_PERCENT = 20, 8, 30
#: Highest percentage of the characters of words in n-grams seen earlier in the text, by n.  The figures of
#: the published rules for web text (duplicate 5- to 10-grams).
NGRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Highest percentage of characters in lines that equal an earlier line (published rule).
LINE_PERCENT = 20
#: Highest number of symbols for each hundred words (published rule).
SYMBOL_PERCENT = 10
SYMBOLS = b"#*$%&|<>"

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *[f"dup{n}_chars" for n in NGRAM_PERCENT]]
VERDICTS = ["base_failed", "kept"]

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[np.frombuffer(SYMBOLS, dtype=np.uint8)] = True


def _letters(text: bytes) -> int:
    """Code points in words."""
    data = np.frombuffer(text, dtype=np.uint8)
    return int(np.count_nonzero(PLAIN[data] & ((data & 0xC0) != 0x80)))


def _repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the code points of their words."""
    seen: set[bytes] = set()
    n = chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            if line.strip():
                n += 1
                chars += _letters(line)
        else:
            seen.add(line)
    return n, chars


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The figures of each text.  Null and empty texts have zero everywhere."""
    words = words_of(texts)
    size = len(words.starts)
    hashes, owner, ends = word_hashes(words), words.owner(), words.text_end()
    lead = np.concatenate(([0], np.cumsum(PLAIN[words.data] & ((words.data & 0xC0) != 0x80))))
    chars = lead[words.ends] - lead[words.starts]

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return (total[words.first[1:]] - total[words.first[:-1]]).astype(np.int64)

    symbols = np.concatenate(([0], np.cumsum(_IS_SYMBOL[words.data])))
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    lines = np.array([_repeated_lines(t) for t in texts], dtype=np.int64).reshape(-1, 2)
    found = {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_text(chars),
        "n_symbols": symbols[bounds[1:]] - symbols[bounds[:-1]],
        "n_dup_lines": lines[:, 0],
        "dup_line_chars": lines[:, 1],
    }
    for n in NGRAM_PERCENT:
        grams = ngram_hashes(hashes, n)
        whole = np.flatnonzero(np.arange(len(grams)) + n <= ends[: len(grams)])
        # the text's number goes into the key: only repeats within a text count
        keys = mix(grams[whole] ^ mix(owner[whole].astype(np.uint64)))
        _, index, slot, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        later, every = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        many = whole[times[slot] > 1]
        every[many] = True
        later[many] = True
        later[whole[index]] = False
        found[f"dup{n}_chars"] = per_text(np.where(covered(later, n, size), chars, 0))
        if n == BASE_WINDOW:
            found["n_repeat_words"] = per_text(covered(every, n, size))
    return found


def judge(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    words, chars = found["n_words"], found["word_chars"]
    failed = (words < LEAST_WORDS) | (100 * found["n_repeat_words"] > BASE_PERCENT * words)
    kept = ~failed & (100 * found["dup_line_chars"] <= LINE_PERCENT * chars) & (100 * found["n_symbols"] <= SYMBOL_PERCENT * words)
    for n, percent in NGRAM_PERCENT.items():
        kept &= 100 * found[f"dup{n}_chars"] <= percent * chars
    return failed, kept


def repetition(docs: DataFrame) -> DataFrame:
    """Adds the figures and verdicts to each document.

    Null text counts as empty: all figures are zero, the base rule fails and the document is not kept.  Long
    texts are measured whole.  Rows are independent, so repeated rows get equal results; further columns are
    kept, and a figure wins over a column of its name.  Empty tables give empty results."""
    packed = C.packed(docs)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(C.column_bytes(batch))
        failed, kept = judge(found)
        arrays = [batch.column(c) for c in ("doc_id", "text", "rest")]
        arrays += [pa.array(found[c], pa.int64()) for c in FIGURES] + [pa.array(failed), pa.array(kept)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "rest", *FIGURES, *VERDICTS])

    schema = C.packed_schema(packed, ", ".join([f"{c} long" for c in FIGURES] + [f"{c} boolean" for c in VERDICTS]))
    return C.unpacked(C.map_batches(packed, add, schema), docs, [*FIGURES, *VERDICTS])
