"""Operators on the corpus as a whole, and the pipeline, against plain versions."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm_data import frame, llm, odd, small, small_rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import chunks, hashing, near_dedup
from shelfline.llm.catalog import PIECES, QUERIES
from shelfline.llm.components import components
from shelfline.llm.mixing import mix_rows, taken_words
from shelfline.llm.near_dedup import _after, band_hashes, near_duplicates, shingle_sets, signature

FOLDER = "/root/testdata/sf0.001"


def told(rows):
    return sorted(rows, key=repr)


def test_near_dedup_query(llm, small_rows):
    want = brute.near_components(small_rows, 2)
    got = [tuple(r) for r in QUERIES["op10_minhash_near_dedup"](llm, FOLDER).collect()]
    assert told(got) == told((i, n, c, i == c) for i, (n, c) in want.items())


@pytest.mark.parametrize("n", [1, 2, 5])
def test_near_dedup_odd(llm, odd, n):
    docs = [d for d in odd if d["doc_id"] not in (18, None)]
    want = brute.near_components(docs, n)
    rows = near_duplicates(frame(llm, odd).filter("doc_id <> 18 OR doc_id IS NULL"), n).collect()
    assert told(tuple(r) for r in rows if r.doc_id is not None) == told((i, m, c, i == c) for i, (m, c) in want.items())
    assert [tuple(r)[2:] for r in rows if r.doc_id is None] == [(None, True)]


def test_near_dedup_chains_and_large_groups(llm):
    """Chains whose ends are unlike, and one centre that is unlike most of its bucket."""
    docs, words = [], [f"w{i}" for i in range(400)]
    for i in range(40):  # each shares four fifths and a little with the one before
        docs.append({"doc_id": 1000 - i, "text": " ".join(words[i * 4 : i * 4 + 50])})
    docs += [{"doc_id": i, "text": " ".join(["common"] + [f"u{i}-{k}" for k in range(3)])} for i in range(30)]
    docs += [{"doc_id": 2000 + i, "text": " ".join(f"v{k}" for k in range(60) if k != i)} for i in range(60)]
    want = brute.near_components(docs, 1)
    got = [tuple(r) for r in near_duplicates(frame(llm, docs), 1).collect()]
    assert told(got) == told((i, n, c, i == c) for i, (n, c) in want.items())


def test_near_dedup_compares_few_near_copies(llm, monkeypatch):
    """Near copies of one text whose edits come from few words: many are unlike the centre and share edits with each
    other, yet hardly any are linked; what is compared on full sets stays near the number of documents."""
    rng = random.Random(8)
    edits, base, docs = [f"e{k}" for k in range(12)], [f"b{k}" for k in range(150)], []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(150), rng.choice((2, 5, 8, 12, 14))):
            words[at] = rng.choice(edits)
        docs.append({"doc_id": i, "text": " ".join(words)})
    compared, pin = [], near_dedup.pin

    def counted(df, label):
        pinned = pin(df, label)
        if label == "pairs":
            compared.append(pinned.count())
        return pinned

    monkeypatch.setattr(near_dedup, "pin", counted)
    got = [tuple(r) for r in near_duplicates(frame(llm, docs), 2).collect()]
    want = brute.near_components(docs, 2)
    assert told(got) == told((i, n, c, i == c) for i, (n, c) in want.items())
    assert sum(compared) < 5 * len(docs)


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_bounds_of_open_pairs_lose_no_link(llm, percent):
    """Members of one centre: every link between different components is among the pairs that are left to compare."""
    rng = np.random.default_rng(percent)
    centre, pool = np.arange(1, 101, dtype=np.uint64) * np.uint64(2**32 + 977), rng.integers(0, 2**64, 60, dtype=np.uint64)
    members = [np.unique(np.concatenate((rng.choice(centre, 100 - int(rng.integers(0, 30)), replace=False), rng.choice(pool, int(rng.integers(0, 45)), replace=False)))) for _ in range(70)]
    seen = np.zeros(near_dedup.SLOTS, dtype=np.int32)
    after = [_after(centre, m, percent, seen) for m in members]
    schema = "a long, b long, label long, size long, apart long, own array<long>, more array<long>, parities array<long>"
    rows = [
        (-1, i, -1 if linked else i, len(m), n, own.view(np.int64).tolist(), more.view(np.int64).tolist(), near_dedup._parities(m).tolist())
        for i, (m, (linked, n, own, more)) in enumerate(zip(members, after))
    ]
    named = llm.createDataFrame(rows, schema)
    found = near_dedup._differences(named).join(named.select(F.col("b").alias("id"), "parities"), "id")
    left = {tuple(sorted(r)) for r in near_dedup._open_pairs(found, percent).collect()}
    links = set()
    for i, x in enumerate(members):
        for j in range(i):
            shared = len(np.intersect1d(x, members[j]))
            if 100 * shared >= percent * (len(x) + len(members[j]) - shared) and not (after[i][0] and after[j][0]):
                links.add((j, i))
    assert links <= left


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    for size, shared in ((400, 300), (12, 9), (2, 1)):
        hits = []
        for _ in range(300):
            pool = rng.integers(0, 2**64, 2 * size - shared, dtype=np.uint64)
            a, b = np.sort(pool[:size]), np.sort(pool[-size:])
            hits.append(np.mean(signature(a) == signature(b)))
        assert np.mean(hits) == pytest.approx(shared / (2 * size - shared), abs=0.04)
    assert len(set(band_hashes(signature(shingle_sets([b"one"], 2)[0])).tolist())) == 32


def test_components(llm):
    rng = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(300, 340)] + [(int(a), int(b)) for a, b in rng.integers(600, 900, (200, 2))] + [(7, 7)]
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    alone = {a for a in label if not any(a in p and p[0] != p[1] for p in pairs)}
    got = {r.id: r.label for r in components(llm.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {a: x for a, x in label.items() if a not in alone}


@pytest.mark.parametrize("source", ["small", "odd"])
def test_mixing(llm, small, small_rows, odd, source):
    table, docs = (small, small_rows) if source == "small" else (frame(llm, odd), odd)
    want = [(d["doc_id"], n, total, pytest.approx(t), n * times) for d, n, total, t, times in brute.mixed(docs)]
    rows = told(tuple(r) for r in taken_words(table).collect())
    got = told(r[:5] for r in rows)
    assert got == told(want)
    assert rows == told(tuple(r) for r in taken_words(table.repartition(3)).collect())
    assert all(r[4] <= 2 * r[1] for r in got)


def test_mix_follows_its_tree(llm, small):
    """The shards change with the tree, what is taken does not; the draws stay near the hypergeometric mean."""
    runs = {levels: {r.doc_id: r for r in taken_words(small, levels=levels).collect()} for levels in (0, 2, 4)}
    assert {r.shards for r in runs[0].values()} <= {"", "0", "0,0"}
    for levels in (2, 4):
        assert all((r.taken, r.size * len(r.shards.split(",")) * bool(r.shards)) == (runs[0][i].taken, r.taken) for i, r in runs[levels].items())
        words = Counter()
        for r in runs[levels].values():
            for shard in r.shards.split(",") if r.shards else ():
                words[shard] += r.size
        assert len(words) == 2**levels and max(words.values()) < 2.5 * sum(words.values()) / len(words)
    assert {i: r.shards for i, r in runs[2].items()} != {i: r.shards for i, r in runs[4].items()}


def test_mix_rows_deal_every_block_once(llm, small, small_rows):
    rows = mix_rows(small, levels=3).collect()
    times = {}
    for r in rows:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {d["doc_id"]: t for d, _, _, _, t in brute.mixed(small_rows) if t}
    assert {r.shard for r in rows} == set(range(8))
    # shards hold nearly the same number of blocks
    held = {k: len({(r.source, r.block) for r in rows if r.shard == k}) for k in range(8)}
    assert max(held.values()) <= 1.5 * min(held.values())
    again = {(r.doc_id, r.shard, r.place) for r in mix_rows(small.repartition(4), levels=3).collect()}
    assert again == {(r.doc_id, r.shard, r.place) for r in rows}


def brute_pipeline(docs):
    docs = [d for d in docs if brute.quality(d["text"])["kept"]]
    single = {}
    for d in sorted(docs, key=lambda d: (d["text"] or "").encode()):
        single.setdefault(d["doc_id"], d)
    groups = brute.near_components(list(single.values()), 5)
    docs = [single[i] for i, (_, c) in groups.items() if i == c]
    kept = {i: (" ".join(words), n) for i, _, words, n in brute.without_repeats(docs)}
    docs = [d | {"text": kept[d["doc_id"]][0] if kept[d["doc_id"]][1] else d["text"]} for d in docs]
    docs = [d for d, _, _, _, times in brute.mixed(docs) for _ in range(times)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return [(d["doc_id"], library.encode(d["text"] or "")) for d in docs]


def test_pipeline(llm, small_rows):
    got = [(r.doc_id, r.ids) for r in corpus_pipeline.run(llm, FOLDER).collect()]
    assert told(got) == told(brute_pipeline(small_rows))


def test_pipeline_stages_on_odd_rows(llm, odd, tmp_path):
    docs = [d for d in odd if d["doc_id"] is not None]
    clashing = {c: F.lit("own") for c in ("kept", "size", "target", "shards", "round", "row", "copy", "key", "place", "spans")}
    table = frame(llm, docs).withColumns(clashing)
    columns = table.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        table = stage(llm, table, FOLDER)
        if i < 4:
            assert table.columns == columns
            assert table.filter(" OR ".join(f"{c} IS DISTINCT FROM 'own'" for c in clashing)).isEmpty()
            table.write.parquet(str(tmp_path / str(i)))
            table = llm.read.parquet(str(tmp_path / str(i)))
    assert told((r.doc_id, r.ids) for r in table.collect()) == told(brute_pipeline(docs))


def test_pipeline_stages_on_nothing(llm, small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, small.filter("doc_id < 0"), FOLDER).collect() == []


@pytest.mark.parametrize("percent", [50, 80])
def test_differences_lead_linked_members_to_each_other(percent):
    """For any centre, two members that are linked, but not both to it, share a key to look by."""
    rng = np.random.default_rng(4)
    linked = lambda x, y: 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
    seen = rng.integers(0, 5, 1 << 20)
    met = 0
    for _ in range(4000):
        pool = rng.permutation(400).astype(np.uint64)
        size = rng.integers(2, 40)
        base = pool[:size]

        def edited(text, edits):
            kept = text[rng.random(len(text)) > edits]
            return np.unique(np.concatenate((kept, rng.choice(pool, rng.integers(0, 1 + int(size * edits) + 1)))))

        centre, first = edited(base, 0.2), edited(base, 0.3)
        second = edited(first, 0.15)
        if not (len(centre) and len(first) and len(second)) or not linked(first, second):
            continue
        (one, n1, own1, more1), (two, n2, own2, more2) = (_after(centre, m, percent, seen) for m in (first, second))
        assert (one, two) == (linked(centre, first), linked(centre, second))
        if one and two or np.array_equal(first, second):
            continue
        met += 1
        assert abs(n1 - n2) * (100 + percent) <= (len(first) + len(second)) * (100 - percent)
        leads = (set(own1.tolist()), set(own2.tolist()))
        every = (leads[0] | set(more1.tolist()), leads[1] | set(more2.tolist()))
        assert leads[0] & every[1] or leads[1] & every[0]
    assert met > 200


def held_mb() -> float:
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096 / 1e6


class Stages:
    """Hands out what a worker runs."""

    def mapInArrow(self, function, schema):
        return function


def small_parts():
    """About 200 MB in each allocator, in parts too small to go back to the system by themselves."""
    arrays, texts = [np.ones(12_000) for _ in range(2_000)], [pa.array([b"x" * 500] * 200) for _ in range(2_000)]
    return len(arrays), len(texts)


def test_workers_give_memory_back():
    """What a task or group has worked with does not stay with its worker, which idles beside later stages."""
    behind = []

    def work(batch):
        small_parts()
        behind.append(np.ones(12_000))  # lies above what was freed
        return batch

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64())})
    before = held_mb()
    assert sum(b.num_rows for b in chunks.map_batches(Stages(), work, "doc_id long")(iter([batch, batch]))) == 2
    assert held_mb() - before < 60
    assert chunks.settled(work, batch) is batch
    assert held_mb() - before < 60


def test_long_tables_of_powers_are_not_kept():
    up, down = hashing.powers(hashing.BYTE_BASE, 3_000_000)
    assert len(up) == 3_000_000 and np.all(up * down == 1)
    assert all(len(a) <= 1 << 20 for pair in hashing._POWERS.values() for a in pair)
