"""Plain, slow versions of the operators, on lists of dicts."""

import hashlib
import math
import zlib
from collections import Counter


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(docs, window=13):
    """[(doc_id, words, kept words, removed count)]"""
    starts = {}
    for d in docs:
        w = words(d["text"])
        for i in range(len(w) - window + 1):
            starts.setdefault(tuple(w[i : i + window]), []).append(math.inf if d["doc_id"] is None else d["doc_id"])
    out = []
    for d in docs:
        w, own = words(d["text"]), math.inf if d["doc_id"] is None else d["doc_id"]
        gone = set()
        for i in range(len(w) - window + 1):
            if min(starts[tuple(w[i : i + window])]) < own:
                gone.update(range(i, i + window))
        out.append((d["doc_id"], w, [x for i, x in enumerate(w) if i not in gone], len(gone)))
    return out


def quality(text):
    text = text or ""
    w = words(text)
    found = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    seen, lines, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if line in seen and words(line):
            lines += 1
            line_chars += sum(map(len, words(line)))
        seen.add(line)
    found |= {"n_dup_lines": lines, "dup_line_chars": line_chars}
    for n in range(5, 11):
        grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        times, seen, later, every = Counter(grams), set(), set(), set()
        for i, g in enumerate(grams):
            if times[g] > 1:
                every.update(range(i, i + n))
            if g in seen:
                later.update(range(i, i + n))
            seen.add(g)
        found[f"dup{n}_chars"] = sum(len(w[i]) for i in later)
        if n == 8:
            found["n_repeat_words"] = len(every)
    failed = len(w) < 20 or 100 * found["n_repeat_words"] > 30 * len(w)
    chars = found["word_chars"]
    kept = not failed and 100 * line_chars <= 20 * chars and 100 * found["n_symbols"] <= 10 * len(w)
    limits = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
    kept = kept and all(100 * found[f"dup{n}_chars"] <= p * chars for n, p in limits.items())
    return found | {"base_failed": failed, "kept": kept}


def shingles(text, n):
    w = words(lower(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def near_components(docs, n, percent=80):
    """{doc_id: (shingles, smallest reachable id)} for distinct ids."""
    sets = {d["doc_id"]: shingles(d["text"], n) for d in docs}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def lm(docs, strength):
    def tokens(d):
        return [*words(lower(d["text"])), None]

    def out(d):
        return zlib.crc32(str(d["doc_id"]).encode()) % 10 == 0

    one, two = Counter(), Counter()
    for d in docs:
        if not out(d):
            t = tokens(d)
            one.update(t)
            two.update(zip(["<start>", *t], t))
    total, distinct = sum(one.values()), len(one)
    result = []
    for d in docs:
        t, before, base, score = tokens(d), "<start>", 0.0, 0.0
        for w in t:
            p = (one[w] + 0.1) / (total + 0.1 * (distinct + 1))
            base += math.log10(p)
            state = one[None] if before == "<start>" else one[before]
            score += math.log10((two[before, w] + strength * p) / (state + strength))
            before = w
        result.append((d["doc_id"], out(d), len(t), sum(one[w] > 0 for w in t), total, base, score))
    return result


def targets(sizes, share=1.5, most=2.0, cycle=(3.0, 1.0, 2.0)):
    """{source: target} by resharing what is above the caps, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        capped |= over


def mixed(docs, seed="mix"):
    """[(doc, size, source_size, target, times taken)]"""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    size = [len(words(d["text"])) for d in docs]
    key = [md5(f"{seed}:{'null' if d['doc_id'] is None else d['doc_id']}") for d in docs]
    sizes = {}
    for d, n in zip(docs, size):
        sizes[d["source"]] = sizes.get(d["source"], 0) + n
    target = targets(sizes)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    times = [0] * len(docs)
    for line, s in enumerate(names, 1):
        if not sizes[s]:
            continue
        own = [i for i, d in enumerate(docs) if d["source"] == s]
        rounds = math.floor(target[s] / sizes[s])
        left = target[s] - rounds * sizes[s]
        blocks = sorted({key[i][:2] for i in own}, key=lambda b: (md5(f"{line}:{b}"), b))
        done = 0
        for b in blocks:
            members = sorted((i for i in own if key[i][:2] == b), key=lambda i: (key[i], docs[i]["doc_id"] is not None, docs[i]["doc_id"] or 0, size[i]))
            whole, upto = sum(size[i] for i in members), 0
            for i in members:
                upto += size[i]
                times[i] += rounds
                rest = left - done
                if rest > 0 and (rest >= whole or 2 * upto - size[i] <= 2 * rest):
                    times[i] += 1
            done += whole
    return [(d, n, sizes[d["source"]], target[d["source"]], t) for d, n, t in zip(docs, size, times)]
