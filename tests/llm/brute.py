"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re
from fractions import Fraction
from math import log10

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def repeats(rows, length, keep_first=False):
    """rows: [(doc_id, text)] -> {index: (kept, n_removed, n_spans)}"""
    places = collections.defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    for r, t in enumerate(data):
        for i in range(len(t) - length + 1):
            places[t[i:i + length]].append((rows[r][0], r, i))
    out = {}
    for r, t in enumerate(data):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            p = places[t[i:i + length]]
            if (len(p) > 1) if not keep_first else (min((d, x) for d, _, x in p) < (rows[r][0], i)):
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[r] = (bytes(b for b, g in zip(t, gone) if not g), sum(gone), runs)
    return out


def linked(rows, k=5, threshold=75):
    """rows: [(doc_id, text)] -> [(n_shingles, component_id)]"""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= threshold * len(sets[i] | sets[j]):
                    root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest.setdefault(find(i), []).append(d)
    return [(len(sets[i]), min(smallest[find(i)])) for i in range(len(rows))]


def kneser_ney(train, texts, order=2):
    """Interpolated modified Kneser-Ney: [(n_tokens, n_known, base, score)] of ``texts``."""
    def stream(t):
        return ["<s>", *words(t), "</s>"]

    adjusted = {k: collections.Counter() for k in range(1, order + 1)}
    raw = collections.Counter()
    seen = {k: set() for k in range(1, order + 1)}
    for t in train:
        s = stream(t)
        raw.update(s[1:])
        for k in range(1, order + 1):
            for i in range(max(k - 1, 1), len(s)):
                g = tuple(s[i - k + 1:i + 1])
                seen[k].add(g)
                if k == order or i == k - 1:
                    adjusted[k][g] += 1
    for k in range(1, order):
        for g in seen[k + 1]:
            adjusted[k][g[1:]] += 1
    total, vocabulary = sum(raw.values()), len(raw)

    def discounts(k):
        n = collections.Counter(adjusted[k].values())
        if not (n[1] and n[2] and n[3]):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return [0, *(min(max(x, 0.05), c) for x, c in zip(d, (1, 2, 3)))]

    contexts = {k: collections.defaultdict(list) for k in adjusted}
    for k, a in adjusted.items():
        for g, c in a.items():
            if c:
                contexts[k][g[:-1]].append(c)
    ds = {k: discounts(k) for k in adjusted}

    def prob(g):
        k = len(g)
        if not k:
            return 1 / (vocabulary + 1)
        c = contexts[k].get(g[:-1])
        if not c:
            return prob(g[1:])
        d = ds[k]
        a = adjusted[k].get(g, 0)
        return (max(a - d[min(a, 3)], 0) + sum(d[min(x, 3)] for x in c) * prob(g[1:])) / sum(c)

    out = []
    for t in texts:
        s = stream(t)
        score = sum(log10(prob(tuple(s[max(0, i - order + 1):i + 1]))) for i in range(1, len(s)))
        base = sum(log10((raw[w] + 1) / (total + vocabulary + 1)) for w in s[1:])
        out.append((len(s) - 1, sum(raw[w] > 0 for w in s[1:]), base, score))
    return out, total


def water_fill(sources, cap=3, weights=(5, 2, 1)):
    """{name: words} -> {name: exact target}"""
    names = sorted((n for n in sources if n is not None), key=lambda n: n.encode()) + [None] * (None in sources)
    weight = {n: Fraction(weights[i % len(weights)]) for i, n in enumerate(names)}
    target, total, free = {}, Fraction(sum(sources.values())), set(names)
    while free:
        level = total / sum(weight[n] for n in free)
        over = {n for n in free if weight[n] * level > cap * sources[n]}
        if not over:
            target |= {n: weight[n] * level for n in free}
            break
        for n in over:
            target[n] = Fraction(cap * sources[n])
            total -= target[n]
        free -= over
    return target
