"""Near duplicates by one-permutation MinHash.

A document's set of word shingles is hashed once; the top bits of a hash name one of 128 bins and each bin keeps
its smallest hash.  Empty bins borrow from a bin found by a fixed sequence of hashed probes (optimal
densification).  Four bins make a band; documents that agree on one of 32 bands are candidates.  At a similarity
of 0.8 a pair misses every band with a chance of 5e-8.

Documents with equal sets are one class from the start, so exact copies cost nothing further.  The classes
of a bucket are compared, on full sets, with one centre only, the one in the most crowded buckets around: a star,
linear in the bucket, and a group of near copies has the same centre in all its buckets.

No link is lost to the star shape.  Two members that are linked, but not both to the centre, must both differ from
the centre by much the same shingles: of the differences of either, the two share more than a known number.  So
each member of a star goes on to buckets named by (centre, shingle) for the first of its differences, in an order
common to the star, as many as that number allows (a prefix filter); members that can be linked meet in one of
them.  Of the members that meet there and are not of one component yet, those are compared on full sets that pass
three exact bounds: the numbers of their differences, the places of the shared shingle in the two orders (what
follows must still hold the shared differences that a link asks for), and the parities of both sets in 1024 slots
(the slots that disagree are at most the shingles by which the sets differ).  Near copies of one text with edits of
their own fail these bounds and part at once, however many they are."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import chunks as C
from shelfline.llm.components import components
from shelfline.llm.hashing import mix, ngram_hashes, word_hashes, words_of
from shelfline.session import pin, release

BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
PROBES = 512


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending.  A text of fewer words has its whole sequence as one."""
    words = words_of([t.lower() for t in texts])
    hashes = word_hashes(words)
    grams = ngram_hashes(hashes, n)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        else:
            sets.append(ngram_hashes(hashes[a:b], b - a, salt=1000) if b > a else np.empty(0, dtype=np.uint64))
    return sets


@lru_cache(maxsize=1)
def _probes() -> np.ndarray:
    """For each bin, the bins it borrows from, in order."""
    cells = np.arange(BINS * PROBES, dtype=np.uint64).reshape(BINS, PROBES)
    return (mix(cells, 7) >> np.uint64(57)).astype(np.int64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Smallest hash of each of 128 bins, empty bins densified.  ``hashes`` ascend and are not empty."""
    owner = (hashes >> np.uint64(57)).astype(np.int64)
    filled, index = np.unique(owner, return_index=True)
    out = np.zeros(BINS, dtype=np.uint64)
    out[filled] = hashes[index]
    have = np.zeros(BINS, dtype=bool)
    have[filled] = True
    empty = np.flatnonzero(~have)
    if len(empty):
        tries = _probes()[empty]
        good = have[tries]
        source = tries[np.arange(len(empty)), good.argmax(axis=1)]
        source = np.where(good.any(axis=1), source, filled[0])
        out[empty] = out[source]
    return out


def band_hashes(bins: np.ndarray) -> np.ndarray:
    """One key for each band; bands do not meet."""
    return mix(ngram_hashes(mix(bins), ROWS)[::ROWS] ^ mix(np.arange(BANDS, dtype=np.uint64)), 11).view(np.int64)


def _sketches(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, same (128-bit digest of the set, null when empty), bands."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(C.column_bytes(batch), n)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "same": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                "bands": pa.array([band_hashes(signature(s)) if len(s) else None for s in sets], pa.list_(pa.int64())),
            }
        )

    return C.map_batches(docs, sketch, "doc_id long, n_shingles long, same binary, bands array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def full(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(C.column_bytes(batch), n)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    return C.map_batches(docs, full, "doc_id long, shingles binary")


#: The order of differences goes by counts from about this many documents, kept in so many slots by hash.  Any order
#: gives the same links; one that has common shingles last gives few candidates.
SAMPLED, SLOTS = 2000, 1 << 20


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(SLOTS - 1)).astype(np.int64)


def _rare_first(shingles: np.ndarray, seen: np.ndarray) -> np.ndarray:
    return shingles[np.lexsort((shingles, seen[_slot(shingles)]))]


def _seen(sets: DataFrame) -> np.ndarray:
    """How many documents of a sample have a shingle of each slot: an array of fixed size."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = [_slot(np.frombuffer(blob, dtype=np.uint64)) for blob in batch.column("shingles").to_pylist()]
        slot, n = np.unique(np.concatenate(every), return_counts=True)
        return pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int64()), "n": pa.array(n, pa.int64())})

    step = max(1, sets.count() // SAMPLED)
    sample = sets.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    found = C.map_batches(sample, count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(SLOTS, dtype=np.int32)
    seen[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return seen


def _after(x: np.ndarray, y: np.ndarray, percent: int, seen: np.ndarray) -> tuple[bool, int, np.ndarray, np.ndarray]:
    """Is member y linked to centre x; by how many shingles do they differ; by which of these must it look for members linked to itself, and by
    which more for members that are linked to the centre (only when it is not).

    With q = (100 - percent) / (100 + percent), sets of sizes a and b are linked when they differ by at most
    q (a + b) shingles.  For members with differences D1 and D2 from a centre of size c, the first of them not
    linked to it, |D1| > q (c + a1), so they share more than (|D2| + q (c - a2)) / 2 differences."""
    c, size, q = len(x), len(y), (100 - percent, 100 + percent)
    where = np.searchsorted(x, y)
    inside = x[np.minimum(where, c - 1)] == y
    shared = int(np.count_nonzero(inside))
    linked = 100 * shared >= percent * (c + size - shared)
    gone = np.ones(c, dtype=bool)
    gone[where[inside]] = False
    # rare ones first: shingles that the centre lacks, then in the order of how often a sample of documents has them
    apart = np.concatenate((_rare_first(y[~inside], seen), _rare_first(x[gone], seen)))
    n = len(apart)
    least = (n * q[1] + q[0] * (c - size)) // (2 * q[1]) + 1
    own = max(0, n - least + 1)
    more = own
    if not linked:
        # a member linked to the centre has a size of at most 100 c / percent
        largest = 100 * c // percent + 1
        if n * q[1] <= q[0] * (c + size + 2 * largest):
            least = max(1, -(-(n * q[1] - q[0] * (size + largest)) // q[1]))
            more = max(own, n - least + 1)
    return linked, n, apart[:own], apart[own:more]


#: Slots of the parities of a set.
PARITIES = 1024


def _parities(shingles: np.ndarray) -> np.ndarray:
    """For each slot, whether it has an odd number of the set's shingles, 64 slots an integer."""
    slot = ((shingles >> np.uint64(20)) & np.uint64(PARITIES - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=PARITIES) & 1).astype(bool)).view(np.int64)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(b, "b").join(a, "a").select(*pairs.columns, "set_a", "set_b")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, seen: Broadcast[np.ndarray]) -> DataFrame:
    """(a, b, linked, size, apart, own, more, parities) for pairs (centre a, member b, goes_on)."""

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for one, other, goes_on in zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b", "goes_on"))):
            member = np.frombuffer(other, dtype=np.uint64)
            linked, apart, own, more = _after(np.frombuffer(one, dtype=np.uint64), member, percent, seen.value)
            rows.append((linked, len(member), apart, *((own.view(np.int64), more.view(np.int64), _parities(member)) if goes_on else (None, None, None))))
        kinds = [pa.bool_(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *arrays], ["a", "b", "linked", "size", "apart", "own", "more", "parities"])

    schema = "a long, b long, linked boolean, size long, apart long, own array<long>, more array<long>, parities array<long>"
    return C.map_batches(_with_sets(pairs, sets), compare, schema)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked on full sets."""

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for one, other in zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b"))):
            x, y = np.frombuffer(one, dtype=np.uint64), np.frombuffer(other, dtype=np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return C.map_batches(_with_sets(pairs, sets), compare, "a long, b long")


def _hubs(rows: DataFrame) -> DataFrame:
    """(bucket, a): the centre of each bucket, which need not be in it.  Of the ids that share a bucket with one of
    the bucket's members it is the one in the most crowded buckets, so that the many buckets of a group of near
    copies choose the same centre."""
    weight = rows.groupBy("id").agg(F.sum("members").alias("weight"))
    weighed = rows.join(weight, "id").select("bucket", "id", F.struct("weight", (-F.col("id")).alias("minus")).alias("own"))
    best = weighed.groupBy("bucket").agg(F.max("own").alias("best"))
    reached = rows.select("bucket", "id").join(best, "bucket").groupBy("id").agg(F.max("best").alias("hub"))
    hubs = rows.select("bucket", "id").join(reached, "id").groupBy("bucket").agg(F.max("hub").alias("hub"))
    return hubs.select("bucket", (-F.col("hub.minus")).alias("a"))


def _stars(rows: DataFrame) -> DataFrame:
    """(a, b, goes_on): centre and member, for the hub of every bucket of rows (bucket, id).  A star of one member
    has nothing further to compare and does not go on."""
    crowded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    rows = pin(rows.join(crowded, "bucket"), "buckets")
    met = pin(rows.join(_hubs(rows), "bucket").filter("id <> a").select("a", F.col("id").alias("b")).distinct(), "stars")
    release(rows)
    several = met.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    pairs = pin(met.join(several, "a").select("a", "b", (F.col("n") > 1).alias("goes_on")), "pairs")
    release(met)
    return pairs


def _differences(named: DataFrame) -> DataFrame:
    """(bucket, id, label, size, apart, place, lead) of members that go on; ``place`` is the shingle's in their order."""
    kept = ("a", F.col("b").alias("id"), "label", "size", "apart")
    own = named.select(F.posexplode("own").alias("place", "shingle"), F.lit(True).alias("lead"), *kept)
    more = named.select(F.posexplode("more").alias("behind", "shingle"), F.lit(False).alias("lead"), *kept, F.size("own").alias("before"))
    more = more.withColumn("place", F.col("before") + F.col("behind")).drop("before", "behind")
    return own.unionByName(more).select(F.xxhash64("a", "shingle").alias("bucket"), "id", "label", "size", "apart", "place", "lead")


def _open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of one bucket, at least one of them a lead, that are of different components and can be linked:
    sets of sizes s and t are linked when they differ by at most (100 - percent) / (100 + percent) (s + t) shingles."""
    other = rows.filter("lead").select(*[F.col(c).alias(f"c_{c}") for c in ("bucket", "label", "size", "apart", "place", "parities")], F.col("id").alias("a"))
    limit = (F.col("size") + F.col("c_size")) * (100 - percent)
    # a pair of two leads comes up once, with the smaller one first
    once = ~F.col("lead") | (F.col("id") > F.col("a"))
    gap = F.abs(F.col("apart") - F.col("c_apart")) * (100 + percent) <= limit
    # the first shingle that two linked members share has all the others they share behind it, in both orders
    left = F.least(F.col("apart") - F.col("place"), F.col("c_apart") - F.col("c_place"))
    placed = (F.col("apart") + F.col("c_apart") - 2 * left) * (100 + percent) <= limit
    odd = sum((F.bit_count(F.col("parities")[i].bitwiseXOR(F.col("c_parities")[i])) for i in range(PARITIES // 64)), F.lit(0))
    close = odd * (100 + percent) <= limit
    met = (F.col("bucket") == F.col("c_bucket")) & (F.col("id") != F.col("a")) & (F.col("label") != F.col("c_label")) & once & gap & placed & close
    return rows.join(other, met).select("a", F.col("id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links of at least ``percent`` percent of
    intersection over union of word ``n``-shingles, A-Z lowered) and kept (doc_id = component_id).

    Null text and texts without words have an empty set and are linked with nothing.  Rows of equal id are one
    vertex with the sets of all of them, so they share a component and are kept or not together.  A null id is
    linked with nothing: its component is null and it is kept.  Further columns are not
    carried.  Empty tables give empty results."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = pin(_sketches(narrow, n), "sketches")
    usable = sketches.filter("doc_id IS NOT NULL AND same IS NOT NULL")
    heads = usable.groupBy("same").agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands"))
    heads = pin(heads, "classes")
    pairs = _stars(heads.select(F.explode("bands").alias("bucket"), "id"))
    involved = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    # the ids of all candidates grow with the corpus: texts are sorted to them, whatever their number
    sets = pin(_sets(narrow.join(involved.hint("merge"), "doc_id", "left_semi"), n), "shingles")
    seen = docs.sparkSession.sparkContext.broadcast(_seen(sets))
    found = pin(_compared(pairs, sets, percent, seen), "compared")
    release(pairs)
    links = pin(found.filter("linked").select("a", "b"), "links")
    labels = components(links)
    named = found.join(labels.select(F.col("id").alias("b"), "label"), "b", "left").withColumn("label", F.coalesce("label", "b"))
    apart = pin(_differences(named), "differences")
    mixed = apart.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max("lead").alias("led"))
    mixed = mixed.filter("led AND least <> most").select("bucket")
    # an id of several sets has the parities of all of them at each of its differences
    parities = found.filter("parities IS NOT NULL").select(F.col("b").alias("id"), "parities").distinct()
    rows = pin(apart.join(mixed, "bucket", "left_semi").join(parities, "id"), "open")
    release(found, apart)
    pairs = pin(_open_pairs(rows, percent), "pairs")
    release(rows)
    more = pin(_links(pairs, sets, percent), "links")
    if not more.isEmpty():
        before, labels = labels, components(links.unionByName(more))
        release(before)
    release(pairs, sets, links, more)
    reach = heads.select("same", "id").join(labels, "id", "left").select("same", F.coalesce("label", "id").alias("reach"))
    placed = sketches.join(reach, "same", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("reach", "doc_id")).alias("component_id"))
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
