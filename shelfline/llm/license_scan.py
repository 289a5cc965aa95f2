"""License scans: exact phrases and fuzzy short notices.

Exact phrases are looked up word by word.  For notices with up to k errors, the notice is cut into k + 1 seeds:
k errors cannot touch all of them, so every match holds at least one seed unchanged (pigeonhole).  All seeds
are found in one pass of an Aho-Corasick automaton; around each, the regex library's bounded-error matching
verifies the notice and reports where it stands."""

from __future__ import annotations

from bisect import bisect
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfline.llm import chunks as C
from shelfline.llm.hashing import ALNUM

#: Exact phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Openings and short forms of well-known license notices, as lower-case words, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "licensed under the bsd license": "bsd",
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the apache license version 2 0": "apache-2.0",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "this program and the accompanying materials are made available under the terms of the eclipse public license": "epl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "boost software license version 1 0": "bsl-1.0",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu library general public license": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license": "agpl",
    "under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu library general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license": "gfdl",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "licensed under a creative commons attribution noderivatives 4 0 international license": "cc-by-nd",
    "licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under a creative commons attribution noncommercial sharealike 4 0 international license": "cc-by-nc-sa",
    "licensed under a creative commons attribution noncommercial noderivatives 4 0 international license": "cc-by-nc-nd",
    "this work is licensed under a creative commons attribution": "cc-by",
    "this work is licensed under a creative commons attribution sharealike": "cc-by-sa",
    "this work is licensed under a creative commons attribution noderivatives": "cc-by-nd",
    "this work is licensed under a creative commons attribution noncommercial": "cc-by-nc",
    "this work is licensed under a creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "this work is licensed under a creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide": "cc0",
    "spdx license identifier mit": "mit",
    "spdx license identifier isc": "isc",
    "spdx license identifier apache 2 0": "apache-2.0",
    "spdx license identifier bsd 2 clause": "bsd",
    "spdx license identifier bsd 3 clause": "bsd",
    "spdx license identifier mpl 2 0": "mpl-2.0",
    "spdx license identifier unlicense": "unlicense",
    "spdx license identifier gpl 2 0": "gpl",
    "spdx license identifier gpl 3 0": "gpl",
    "spdx license identifier lgpl 2 1": "lgpl",
    "spdx license identifier lgpl 3 0": "lgpl",
    "spdx license identifier agpl 3 0": "agpl",
    "spdx license identifier cc0 1 0": "cc0",
    "spdx license identifier cc by 4 0": "cc-by",
    "spdx license identifier cc by sa 4 0": "cc-by-sa",
}
#: Fixed value: a notice that begins so ends in a name of few letters, in which an error names another license.
SHORT_FORM = "spdx license identifier "
#: One error is allowed for this many characters of a notice.
CHARS_PER_ERROR = 12

_TO_WORDS = bytes(b if ALNUM[b] else 32 for b in range(256))


def words_line(text: bytes) -> bytes:
    """Lower-case words, each with one space before and after."""
    words = text.lower().translate(_TO_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def letters_of(notice: str) -> dict[str, int]:
    """For each character, the places where the notice has it, as bits."""
    places: dict[str, int] = {}
    for i, c in enumerate(notice):
        places[c] = places.get(c, 0) | 1 << i
    return places


def ends_within(line: str, low: int, high: int, size: int, letters: dict[str, int], k: int) -> list[int]:
    """Ends of stretches of ``line[low:high]`` at most ``k`` edits from a notice: the bit-parallel edit distance, one
    step a character, so a text full of seeds costs no more than its length times the notices."""
    whole, top = (1 << size) - 1, 1 << size - 1
    up, down, distance, ends = whole, 0, size, []
    for at in range(low, high):
        equal = letters.get(line[at], 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        more, less = down | (whole & ~(horizontal | up)), up & horizontal
        if more & top:
            distance += 1
        elif less & top:
            distance -= 1
        more, less = more << 1 & whole, less << 1 & whole
        up, down = less | (whole & ~(vertical | more)), more & vertical
        if distance <= k:
            ends.append(at + 1)
    return ends


class Scanner:
    def __init__(self, notices: tuple[tuple[str, str], ...], chars_per_error: int):
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, label) in enumerate(notices):
            k = 0 if notice.startswith(SHORT_FORM) else len(notice) // chars_per_error
            body = rf"\b(?:{regex.escape(notice)}){{e<={k}}}\b" if k else rf"\b{regex.escape(notice)}\b"
            self.notices.append((notice, label, k, regex.compile(f"(?b){body}"), letters_of(notice)))
            for i in range(k + 1):
                begin, end = len(notice) * i // (k + 1), len(notice) * (i + 1) // (k + 1)
                seeds.setdefault(notice[begin:end], []).append((number, begin))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()

    def exact(self, line: bytes) -> list[tuple[int, str]]:
        """(character, label) of every place of a phrase, overlaps included."""
        found = []
        for phrase, label in PHRASES.items():
            needle = b" " + phrase.encode() + b" "
            at = line.find(needle)
            while at >= 0:
                found.append((at, label))
                at = line.find(needle, at + 1)
        return found

    def fuzzy(self, line: str) -> list[tuple[int, int, str, float]]:
        """(begin, end, label, likeness) of the notices.  Of matches that overlap the most alike stands, of equals the
        longest, so a notice is not told as a relative of fewer or other words; what does not overlap all stands."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(line):
            for number, offset in places:
                notice, _, k, *_ = self.notices[number]
                begin = last + 1 - size - offset
                low, high = max(0, begin - k), min(len(line), begin + len(notice) + k)
                own = windows.setdefault(number, [])
                own.append([low, high])
        found = []
        for number, spans in windows.items():
            notice, label, k, pattern, letters = self.notices[number]
            merged: list[list[int]] = []
            for low, high in sorted(spans):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                # where a match can end, by edit distance; the regex library finds the best one that ends about there
                done = low
                for end in ends_within(line, low, high, len(notice), letters, k):
                    if end <= done:
                        continue
                    # one more character on either side shows whether a word ends there
                    match = pattern.search(line, max(done, end - len(notice) - k - 1), min(len(line), end + k + 1))
                    if match:
                        found.append((match.start(), match.end(), label, 1 - sum(match.fuzzy_counts or (0,)) / len(notice)))
                        done = match.end()
        return standing(found)


def standing(found: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Matches that no better one overlaps, by place."""
    kept: list[tuple[int, int, str, float]] = []
    begins: list[int] = []
    for match in sorted(set(found), key=lambda m: (-m[3], m[0] - m[1], m[0], m[2])):
        at = bisect(begins, match[0])
        if (at == 0 or kept[at - 1][1] <= match[0]) and (at == len(kept) or match[1] <= kept[at][0]):
            kept.insert(at, match)
            begins.insert(at, match[0])
    return kept


@lru_cache(maxsize=4)
def scanner(notices: tuple[tuple[str, str], ...], chars_per_error: int) -> Scanner:
    return Scanner(notices, chars_per_error)


SPAN = pa.struct([("begin_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("likeness", pa.float64())])


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """doc_id, n_words, n_base (places of the exact phrases), first_word, last_word (smallest and largest start
    of those, words from 0, else null), base_labels, labels (with those of the fuzzy notices; both distinct,
    sorted, comma-joined, empty without any), score (1 with an exact phrase, else the likeness of the best
    notice, else 0) and spans of the notices in words (end excluded).

    Null text is empty.  Rows are independent; repeated rows get equal results, a null doc_id stays null,
    further columns are not carried.  Long texts are scanned whole."""
    listed = tuple(notices.items())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = scanner(listed, chars_per_error)
        rows = []
        for text in C.column_bytes(batch):
            line = words_line(text)
            base = tool.exact(line)
            starts = [line.count(b" ", 0, at) for at, _ in base]
            shown = line.decode()
            fuzzy = tool.fuzzy(shown)
            spans = sorted(
                (shown.count(" ", 0, begin + 1) - (shown[begin] != " "), shown.count(" ", 0, end - 1), label, like) for begin, end, label, like in fuzzy
            )
            rows.append(
                {
                    "n_words": line.count(b" ") - 1,
                    "n_base": len(base),
                    "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted({label for _, label in base})),
                    "labels": ",".join(sorted({label for _, label in base} | {s[2] for s in spans})),
                    "score": 1.0 if base else max((s[3] for s in spans), default=0.0),
                    "spans": [dict(zip(("begin_word", "end_word", "label", "likeness"), s)) for s in spans],
                }
            )
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(SPAN)}
        columns = {"doc_id": batch.column("doc_id")} | {name: pa.array([r[name] for r in rows], kind) for name, kind in kinds.items()}
        return pa.RecordBatch.from_pydict(columns)

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<begin_word: long, end_word: long, label: string, likeness: double>>"
    )
    return C.map_batches(narrow, run, schema)
