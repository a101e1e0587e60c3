"""Plain versions of the contracts, for small tables: one row after the other, no Spark."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fold(doc_id, m):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text):
    w = words(lower_ascii(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(n, linked, ids):
    """For each of n items the least id of the items that it reaches."""
    group = list(range(n))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                group[root(i)] = root(j)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least.get(root(i)) for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def removed_windows(rows, window=50):
    """(doc_id, n_words, n_removed, kept_sha256) for rows (doc_id, text); a NULL id is before all others."""
    key = lambda d: (d is not None, d or 0)
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            s = tuple(w[i:i + window])
            first[s] = min(first.get(s, key(d)), key(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = {k for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < key(d) for k in range(i, i + window)}
        out.append((d, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def targets(sizes, weights, repeats=3):
    """Shares of the whole by weight, capped, the excess reshared."""
    budget, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        weight = sum(weights[s] for s in free)
        level = (budget - sum(repeats * sizes[s] for s in capped)) / weight if weight else 0
        over = {s for s in free if level * weights[s] > repeats * sizes[s]}
        if not over:
            return {s: float(repeats * sizes[s]) if s in capped else level * weights[s] for s in sizes}
        capped |= over


def suffix_tree(train, least=2, discount=0.75):
    """Contexts of up to two words kept by divergence; returns log10 P(token | the two before it)."""
    counts = Counter(t for doc in train for t in doc)
    n, v = sum(counts.values()), len(counts)

    def root(w):
        return (counts[w] + 1) / (n + v + 1)

    pairs, triples = Counter(), Counter()
    for doc in train:
        seq = ["<s>", *doc]
        pairs.update(zip(seq, seq[1:]))
        triples.update(zip(seq, seq[1:], seq[2:]))

    def keep(context, total, listed, parent):
        if not listed:
            return None
        share = {w: c / total for w, c in listed.items()}
        rest = max(1 - sum(share.values()), 0.0)
        rest_parent = max(1 - sum(parent(w) for w in listed), 1e-12)
        divergence = sum(p * np.log(p / parent(w)) for w, p in share.items())
        if rest > 0:
            divergence += rest * np.log(rest / rest_parent)
        if total * divergence <= 0.5 * np.log(max(total, 1)) * len(listed):
            return None
        left = 1 - sum((c - discount) / total for c in listed.values())
        return left, {w: (c - discount) / total + left * parent(w) for w, c in listed.items()}

    def gather(grams, size):
        out = {}
        for g, c in grams.items():
            if c >= least:
                out.setdefault(g[:size], {})[g[size]] = c
        return out

    one = {}
    for (a,), listed in gather(pairs, 1).items():
        if (kept := keep(a, len(train) if a == "<s>" else counts[a], listed, root)):
            one[a] = kept

    def p1(a, w):
        if a not in one:
            return root(w)
        left, listed = one[a]
        return listed.get(w, left * root(w))

    two = {}
    for (a, b), listed in gather(triples, 2).items():
        if pairs[(a, b)] < least or b not in one:
            continue
        listed = {w: c for w, c in listed.items() if w in one[b][1]}
        if (kept := keep((a, b), pairs[(a, b)], listed, lambda w, b=b: p1(b, w))):
            two[(a, b)] = kept

    def p(a, b, w):
        if (a, b) in two:
            left, listed = two[(a, b)]
            return listed.get(w, left * p1(b, w))
        return p1(b, w)

    return counts, n, v, root, p, one, two


def mix_times(rows):
    """How often rows (doc_id, source, size) are taken: cyclic weights, all words as budget, finish times in order."""
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    target = targets(sizes, {s: k % 3 + 1 for k, s in enumerate(order)})
    copies = []
    for s in order:
        through = 0
        for key, doc_id, n in sorted((hashlib.md5(f"42:{d}".encode()).hexdigest(), d, n) for d, x, n in rows if x == s):
            through += n
            for epoch in range(1, int(np.ceil(target[s] / sizes[s])) + 1 if target[s] else 1):
                copies.append((((epoch - 1) * sizes[s] + through) / target[s], order.index(s), epoch, key, doc_id, n))
    taken, total = Counter(), 0
    for *_, doc_id, n in sorted(copies):
        total += n
        if total > sum(sizes.values()):
            break
        taken[doc_id] += 1
    return taken
