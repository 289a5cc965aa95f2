"""Operators on single texts and on words shared between texts, against plain versions."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
import sentencepiece
from llm_data import frame, llm, odd, small, small_rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import license_scan, pieces, token_counts, token_files
from shelfline.llm.backoff_lm import STRENGTH, score_texts
from shelfline.llm.catalog import PIECES, QUERIES, WORDS
from shelfline.llm.fingerprints import compare_with_next, edited, fingerprint, likeness
from shelfline.llm.quality import FIGURES, repetition
from shelfline.llm.substring_dedup import remove_repeats
from shelfline.session import scratch

FOLDER = "/root/testdata/sf0.001"


def told(rows):
    return sorted(rows, key=repr)


def test_substring_dedup_query(llm, small_rows):
    got = [tuple(r) for r in QUERIES["op1_substring_dedup"](llm, FOLDER).collect()]
    want = [(i, len(w), n, brute.sha(" ".join(kept))) for i, w, kept, n in brute.without_repeats(small_rows)]
    assert told(got) == told(want)


@pytest.mark.parametrize("window, chars, keys", [(13, 3_000_000, 1_000_000), (13, 700, 50), (4, 5000, 300)])
def test_substring_dedup_odd(llm, odd, window, chars, keys):
    found = remove_repeats(frame(llm, odd), window, chunk_chars=chars, bucket_keys=keys)
    assert found.columns == "doc_id text lang source n_chars chunk rest size kept block shard n_words n_removed spans".split()
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in found.collect()]
    want = [(i, len(w), n, " ".join(kept)) for i, w, kept, n in brute.without_repeats(odd, window)]
    assert told(got) == told(want)
    for r in found.collect():
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed


def test_substring_dedup_keeps_untouched_text(llm, odd):
    for r in remove_repeats(frame(llm, odd), joined=False).filter("n_removed = 0").collect():
        assert r.text in [d["text"] or "" for d in odd if d["doc_id"] == r.doc_id]


@pytest.mark.parametrize("source", ["small", "odd"])
def test_quality(llm, small, small_rows, odd, source):
    table, docs = (small, small_rows) if source == "small" else (frame(llm, odd), odd)
    names = [*FIGURES, "base_failed", "kept"]
    got = [(r.doc_id, *(r[n] for n in names)) for r in repetition(table).collect()]
    want = [(d["doc_id"], *(q[n] for n in names)) for d, q in ((d, brute.quality(d["text"])) for d in docs)]
    assert told(got) == told(want)


def test_fingerprints_follow_the_next_document(llm, small, small_rows, odd):
    for table, docs in ((small.repartition(7), small_rows), (frame(llm, odd), odd), (frame(llm, odd[:1]), odd[:1])):
        line = sorted(docs, key=lambda d: (d["doc_id"] is None, -(d["doc_id"] or 0), (d["text"] or "").encode()))
        want = []
        for i, d in enumerate(line):
            text, following = d["text"] or "", line[(i + 1) % len(line)]["text"] or ""
            half = len(text) // 2
            new = text[: len(text) - half] + following[:half]
            prints = [fingerprint(t.encode()) for t in (text, new, following)]
            want.append((d["doc_id"], len(text), brute.sha(new), *prints[:2], likeness(prints[0], prints[1]), likeness(prints[0], prints[2])))
        assert told([tuple(r) for r in compare_with_next(table).collect()]) == told(want)


def test_fingerprint_rules():
    assert fingerprint(b"") == fingerprint(b"") and likeness(fingerprint(b""), fingerprint(b"")) == 1.0
    one, other = fingerprint(b"some text that goes on for a while" * 9), fingerprint(bytes(range(256)) * 3)
    assert 0 <= likeness(one, other) == likeness(other, one) < 1
    assert edited("abcde", "xyz") == "abcxy" and edited("abcd", "z") == "abz" and edited("", "z") == ""
    # counts by hand: each triplet once
    slow = {}
    text = b"hello triplets"
    for a, b, c in zip(text, text[1:], text[2:]):
        h = ((a * 0x9E3779B1) ^ (b * 0x85EBCA77) ^ (c * 0xC2B2AE3D)) % 2**32
        h = ((h ^ (h >> 15)) * 0x9E3779B1) % 2**32
        slow[h >> 24] = slow.get(h >> 24, 0) + 1
    counts = [slow.get(i, 0) for i in range(256)]
    low, mid, high = (sorted(counts)[i] for i in (63, 127, 191))
    codes = [(c > low) + (c > mid) + (c > high) for c in counts]
    body = bytes(codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3] for i in range(0, 256, 4))
    assert fingerprint(text)[4:] == body.hex()


def test_pieces_as_the_library(llm, small, small_rows, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for table, docs in ((small, small_rows), (frame(llm, odd), odd)):
        want = []
        for d in docs:
            ids = library.encode(d["text"] or "")
            want.append((d["doc_id"], len(ids), ids, library.decode(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
        got = [(r.doc_id, r.n_tokens, r.ids, r.decoded, r.ids_sha256) for r in pieces.encode_decode(table, PIECES).collect()]
        assert told(got) == told(want)
        assert all(r.decoded_sha256 == brute.sha(r.decoded) for r in pieces.encode_decode(table, PIECES).collect())


@pytest.mark.parametrize("together", [0, 10**9])
def test_both_forms_of_the_agenda(monkeypatch, small_rows, together):
    monkeypatch.setattr(pieces, "TOGETHER", together)
    known = pieces.Vocabulary(PIECES)
    texts = [d["text"][:3000] for d in small_rows[:60]] + ["a" * 500, "日本" * 200, "hello" * 99, "zqzq" * 120]
    assert [np.frombuffer(e, np.int32).tolist() for e in known.encode(texts)] == known.library.encode(texts)


def test_pieces_forget_and_refuse(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    known = pieces.Vocabulary(PIECES)
    texts = ["a b c d e f g", "  spaces   inside ", "line\nbreak\ttab", "日本語 😀", ""]
    for _ in range(2):
        found = [np.frombuffer(e, np.int32).tolist() for e in known.encode(texts)]
        assert found == known.library.encode(texts)
        assert known.decoded(found) == known.library.decode(known.library.encode(texts))
        assert len(known.words.young) + len(known.words.old) <= 22  # a batch has 11
    known.check("a b", known.library.encode("a b"))
    with pytest.raises(ValueError, match="differs"):
        known.check("a b", known.library.encode("ab"))
    monkeypatch.setattr(known, "merged", lambda segments: [b"1234" for _ in segments])
    with pytest.raises(ValueError, match="differs"):
        list(known.encode(["quite new words"]))


def test_token_counts_as_the_library(llm, small, small_rows, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for table, docs in ((small, small_rows), (frame(llm, odd), odd)):
        want = [(d["doc_id"], len((d["text"] or "").encode()), n, n > 100) for d in docs for n in [len(library.encode(d["text"] or ""))]]
        for how in ({}, {"whole": 200, "chunk": 150, "overlap": 10}):
            assert told([tuple(r) for r in token_counts.count_tokens(table, PIECES, 100, **how).collect()]) == told(want)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000, "日" * 900, "a b" * 999, ("ab" * 300 + " ") * 9, "▁ a" * 500, "\n \n" * 700, "é  x" * 400])
def test_token_counts_where_overlaps_fail(text):
    tool = token_counts.Counter(PIECES, whole=100, chunk=60, overlap=4)
    assert tool.count(text) == len(tool.library.encode(text))


def test_lm_scores(llm, small, small_rows, odd):
    docs = [d for d in odd if d["doc_id"] is not None]
    for table, docs, how in ((small, small_rows, {}), (frame(llm, docs), docs, {"chunk_chars": 900, "bucket_keys": 100})):
        held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
        got = told(tuple(r) for r in score_texts(table, held_out, **how).collect())
        want = told(brute.lm(docs, STRENGTH))
        assert [g[:5] for g in got] == [w[:5] for w in want]
        for g, w in zip(got, want):
            assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_lm_beats_unigrams_on_held_out_texts(small, llm):
    rows = QUERIES["op5_lm_scoring"](llm, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_without_training_texts(llm):
    docs = frame(llm, [{"doc_id": 1, "text": "a b"}, {"doc_id": None, "text": None}])
    rows = score_texts(docs, F.lit(True)).collect()
    assert {r.n_known for r in rows} == {0} and all(r.score == r.base_score == 0 for r in rows)


def naive_scan(text):
    line = brute.lower(text)
    words = "".join(c if c.isdigit() and c < "\x80" or "a" <= c <= "z" or c >= "\x80" else " " for c in line).split(" ")
    words = [w for w in words if w]
    found = []
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


def test_license_base(llm, small, small_rows, odd):
    for table, docs in ((small, small_rows), (frame(llm, odd), odd)):
        got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scan(table).collect()]
        assert told(got) == told((d["doc_id"], *naive_scan(d["text"])) for d in docs)


def distance(a, b):
    """Fewest edits between ``a`` and any stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return min(row)


def scanned(llm, texts):
    rows = license_scan.scan(frame(llm, [{"doc_id": i, "text": t} for i, t in enumerate(texts)])).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in rows)]


def test_license_notices_within_the_error_bound(llm):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    wrong = mit.replace("hereby", "herby").replace("person", "pers0n")
    rows = scanned(
        llm,
        [
            f"start {mit} of this",
            f"start {wrong} end",
            "permission to do things is sometimes granted free of doubt to a person",
            "Redistribuiton and use in source and binary form, with or without modification, are",
            f"{mit}. {mit}",
            "cc by and all rights reserved",
            f"{wrong} {mit} and {wrong}",
        ],
    )
    assert rows[0].labels == "mit" and rows[0].score == 1.0 and rows[0].spans[0][:2] == (1, 14)
    assert rows[1].labels == "mit" and 0.9 < rows[1].score < 1
    assert rows[2].labels == "" and rows[2].score == 0 and rows[3].labels == "bsd"
    assert [s[:2] for s in rows[4].spans] == [(0, 13), (13, 26)]
    assert rows[5].labels == rows[5].base_labels == "cc-by,reserved" and rows[5].spans == []
    assert [s[:2] for s in rows[6].spans] == [(0, 13), (13, 26), (27, 40)]


def test_every_notice_is_told_apart_from_its_relatives(llm):
    """Clean, and between other words: its own label and no other; an unknown short form has none."""
    notices = list(license_scan.NOTICES.items())
    rows = scanned(llm, [f"some words before {n} and some behind" for n, _ in notices] + ["spdx license identifier zlib", "SPDX-License-Identifier: MITx"])
    for (notice, label), r in zip(notices, rows):
        assert {s.label for s in r.spans} == {label}, notice
        assert r.spans[0].likeness == 1.0
    assert [r.labels for r in rows[-2:]] == ["", ""]


def test_random_edits_against_edit_distance(llm):
    """Recall and precision over texts with known edits: what is within the bound is found with its label."""
    rng = random.Random(8)
    notices = [(n, x) for n, x in license_scan.NOTICES.items() if not n.startswith(license_scan.SHORT_FORM)]
    texts, want = [], []
    for notice, label in notices * 4:
        chars = list(notice)
        for _ in range(rng.randrange(len(notice) // license_scan.CHARS_PER_ERROR + 4)):
            at = rng.randrange(1, len(chars) - 1)
            chars[at : at + 1] = rng.choice([[], [rng.choice("abcdefgh")], [chars[at], rng.choice("abcdefgh")]])
        texts.append(f"xyzzy {''.join(chars)} plugh")
        line = license_scan.words_line(texts[-1].encode()).decode()
        near = {n: distance(n, line) / len(n) for n, _ in notices}
        within = {n for n, d in near.items() if d * len(n) <= len(n) // license_scan.CHARS_PER_ERROR}
        want.append((label, {license_scan.NOTICES[n] for n in within}, {license_scan.NOTICES[n] for n in within if near[n] == min(near.values())}))
    right = 0
    for r, (label, allowed, best) in zip(scanned(llm, texts), want):
        found = {s.label for s in r.spans}
        # nothing beyond the bound; word ends may cost the last error, so what is well within it is always found
        assert found <= allowed
        right += (label in found) if label in best else (not best or bool(found))
    assert right >= 0.97 * len(texts)


def test_one_read_task_a_shard_and_ranged_reads(llm, tmp_path, small, monkeypatch):
    """Adaptive execution must not gather the shards in one task; a store without files reads the same by ranges."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    llm.conf.set(key, "false")
    manifest = token_files.write_shards(small, scratch(llm, "shards"), WORDS, 2)
    llm.conf.set(key, "true")
    read = token_files.read_shards(manifest)
    want = told(tuple(r) for r in read.collect())
    assert read.rdd.getNumPartitions() == manifest.count() > 1
    row = manifest.first()
    whole = token_files.Flat(row.path + ".docs", np.dtype("<i8"))
    monkeypatch.setattr(token_files.Flat, "local", property(lambda self: False))
    ranged = token_files.Flat(row.path + ".docs", np.dtype("<i8"))
    assert ranged.mapped is None and (ranged.size, ranged.part(1, 3).tolist()) == (whole.size, whole.part(1, 3).tolist())
    assert want


def test_unfit_tokenizers_are_refused(monkeypatch):
    """Texts are encoded word by word: a tokenizer to which the space before a word matters must not pass."""
    import public_tokenizers

    unfit = token_files.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    with pytest.raises(ValueError, match="differs"):
        unfit.encode([b"some words in a row", b"some longer text than the first one"])


def test_token_files_round_trip(llm, small, small_rows, odd):
    library = Tokenizer.from_file(WORDS)
    for table, docs in ((small.repartition(5), small_rows), (frame(llm, odd), odd)):
        folder = scratch(llm, "shards")
        got = [tuple(r) for r in token_files.read_shards(token_files.write_shards(table, folder, WORDS, 2)).collect()]
        start, want = 0, []
        for d in sorted(docs, key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, d["text"] is not None, (d["text"] or "").encode())):
            ids = library.encode(d["text"] or "", add_special_tokens=False).ids + [2]
            want.append((d["doc_id"], start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            start += len(ids)
        assert told(got) == told(want)


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_empty_table(llm, tmp_path, small, name):
    for table in ("documents", "embeddings", "conversations"):
        rows = llm.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        rows.limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    found = QUERIES[name](llm, str(tmp_path))
    if name == "op13_chat_formatting":
        assert [r.conv_id for r in found.collect()] == [-1]  # the conversation that the query adds
    else:
        assert found.columns[0] in ("doc_id", "anchor_id", "conv_id") and found.collect() == []


class Counted:
    """A tokenizer that counts the texts handed to it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode(self, text, **options):
        self.texts += 1
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_latin_words_reach_the_library_together():
    rng, tool = random.Random(4), token_files.WordEncoder(WORDS)
    words = ["".join(rng.choice("abcdefghijÀéñßÿ") for _ in range(9)) for _ in range(3000)]
    texts = [" ".join(words[i : i + 100]).encode() for i in range(0, 3000, 100)]
    want = [np.array(tool.library.encode(t.decode(), add_special_tokens=False).ids, dtype=tool.kind).tobytes() for t in texts]
    counted = [Counted(t) for t in (tool.library, getattr(tool, "plain", None)) if t is not None]
    tool.library, tool.plain = (*counted, None)[:2]
    assert tool.encode(texts) == want
    assert sum(c.texts for c in counted) < 30


def test_words_by_themselves_are_the_whole_text(monkeypatch):
    """Random texts of letters in both cases, combining marks, marks, digits, odd spaces and special strings, with a
    worker that forgets often, against the library on whole texts."""
    monkeypatch.setattr(token_files, "REMEMBERED", 60)
    rng, tool = random.Random(6), token_files.WordEncoder(WORDS)
    assert tool.plain is not None
    bits = ["a", "J", "k", "É", "ÿ", "ß", "İ", "ẞ", "K", "Å", "\u030c", "\u0301", "µ", "ª", "×", "÷", "日", "😀", "'s", "'RE", "'", ")", "]}", "&&", "#$", ".", ",", "|", "<|endoftext|>", "<|ENDOFTEXT|>"]
    bits += ["7", "٣", "\x00", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u200b", " ", " ", "\n", "\t\x0b", "\x0c\r", "the", "Word"]
    for _ in range(20):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))).encode() for _ in range(40)] + [b"", b" ", b"one"]
        want = [np.array(tool.library.encode(t.decode(), add_special_tokens=False).ids, dtype=tool.kind).tobytes() for t in texts]
        assert tool.encode(texts) == want
