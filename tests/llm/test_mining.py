"""Hard negatives and collocations against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle_harness as H
from ledgerweave.llm import collocations as co
from ledgerweave.llm import hard_negatives as hn

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- hard negatives

def mined(rows, is_anchor, n_pos=5, n_neg=5, lower=80):
    """rows: [(vec_id, label, ints)] -> sorted result rows, one selection per window."""
    out = []
    for i, (a, label, z) in enumerate(rows):
        if not is_anchor(a):
            continue
        score = [(-int(np.dot(z, y)), v, j) for j, (v, _, y) in enumerate(rows) if j != i and len(y) == len(z)]
        same = sorted(s for s in score if rows[s[2]][1] == label)[:n_pos]
        other = sorted(s for s in score if rows[s[2]][1] != label)
        for p, v, _ in same:
            inside = [(s, w) for s, w, _ in other if lower * -p <= 100 * -s <= 100 * -p][:n_neg]
            out += [(a, v, r, w, -p, -s) for r, (s, w) in enumerate(inside, 1)]
    return sorted(out)


def vectors(n, d, labels, seed, spread=20):
    rng = np.random.default_rng(seed)
    return [(int(v), int(c), [int(x) for x in z]) for v, c, z in zip(rng.integers(0, n, n), rng.integers(0, labels, n), rng.integers(-spread, spread + 5, (n, d)))]


def frame(spark, rows):
    return spark.createDataFrame([(v, c, [float(x) for x in z] if z is not None else None, 7, 1.5) for v, c, z in rows],
                                 "vec_id long, label int, embedding array<double>, rank int, slot double").repartition(3)


def run(spark, rows, **settings):
    got = hn.mine(hn.taking_part(frame(spark, rows), F.col("label"), scale=1), F.col("vec_id") % 10 == 0, **settings)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("labels,spread", [(3, 20), (1, 20), (40, 20), (2, 1)])
def test_windows_are_answered_from_slots(spark, monkeypatch, labels, spread):
    monkeypatch.setattr(hn, "ROWS", 60)
    monkeypatch.setattr(hn, "ANCHORS", 9)
    rows = vectors(200, 5, labels, labels, spread)
    assert run(spark, rows) == mined(rows, lambda v: v % 10 == 0)


def test_wide_windows_and_copies(spark):
    rows = vectors(60, 4, 2, 5) + [(10, 0, [3, 3, 3, 3])] * 4 + [(11, 1, [3, 3, 3, 3])] * 9
    assert run(spark, rows, n_positives=7, n_negatives=3, lower_percent=10) == mined(rows, lambda v: v % 10 == 0, 7, 3, 10)


def test_odd_rows_take_no_part(spark):
    rows = [(0, 1, [1, 2]), (1, 1, [2, 2]), (2, 0, [2, 1]), (3, 0, [0, 0]), (10, 0, [0, 0]), (20, 0, []), (21, 0, []), (22, 1, []), (30, 2, [5, 5, 5])]
    odd = [(40, None, [1, 2]), (None, 0, [1, 2]), (50, 0, None), (60, 0, [1, None]), (70, 0, [float("nan"), 1]), (80, 1, [float("inf"), 1])]
    whole = spark.createDataFrame([(v, c, None if z is None else [None if x is None else float(x) for x in z]) for v, c, z in rows + odd], "vec_id long, label int, embedding array<double>")
    got = hn.mine(hn.taking_part(whole, F.col("label"), scale=1), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, lambda v: v % 10 == 0)
    assert run(spark, []) == []


def test_large_values_are_exact(spark):
    rows = [(v, c, [x * (1 << 25) + 1 for x in z]) for v, c, z in vectors(80, 4, 3, 8, 9)]
    assert run(spark, rows) == mined(rows, lambda v: v % 10 == 0)


def test_leading():
    group = np.array([2, 0, 2, 2, 0, 1])
    order = np.lexsort((np.arange(6), group))
    assert hn.leading(order, group, 2).tolist() == [1, 4, 5, 0, 2]


def test_op12_oracle(spark, duck001):
    assert H.compare(spark, "/root/testdata/sf0.01", hn.op12_hard_negatives, hn.OP12_SQL, duck001)["ok"]


# ---------------------------------------------------------------- collocations

def phrases(rows, longest=4):
    """rows: [(lang, text)] -> {lang: Counter of word tuples}"""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return counts


def plain_collocations(rows, threshold, top=2000, contained=80):
    out = []
    for lang, f in phrases(rows).items():
        words = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= threshold}
        scored = []
        for p, a in cand.items():
            if any(100 * b >= contained * a for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, l_, r_ = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l_, r_))
        out += [(lang, i, p.decode(), -a, l_, r_, words, -s) for i, (s, a, p, l_, r_) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def texts(n, seed=3):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "state", "the", "THE", "of", "é", "Éa", "日本", "a.b", "x", "don't", "…", "a\x0bb", "\x1c"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            words[3:3] = ["San", "Francisco", "bay", "area"]
        rows.append((rng.choice(["en", "fr", None, "und"]), rng.choice([" ", "  ", "\t", " "]).join(words).replace("x", rng.choice([",", "x", "!\n", " "]))))
    return rows + [("en", None), ("de", ""), ("fr", " \t "), ("en", "New york " * 200)] + rows[:20]


def collocated(spark, rows, **settings):
    docs = spark.createDataFrame([(la, t, "p", 1) for la, t in rows], "lang string, text string, phrase string, rank int").repartition(3)
    return sorted(tuple(r) for r in co.collocations(docs, **settings).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("threshold,top", [(2, 2000), (9, 2000), (9, 4)])
def test_collocations(spark, threshold, top):
    rows = texts(120)
    assert collocated(spark, rows, threshold=threshold, top=top) == plain_collocations(rows, threshold, top)


def test_many_partitions_and_small_summaries(spark, monkeypatch):
    """Partitions beyond a task's fan-out, summaries put together often, and a filter that lets much through."""
    rows = texts(150, 4)
    monkeypatch.setattr(co, "MASS", 64)
    monkeypatch.setattr(co, "MOST_BITS", 1 << 15)
    docs = spark.createDataFrame([(la or "und", t) for la, t in rows], "lang string, text string").repartition(3)
    entries = co.summaries(docs, 7, fan=8).collect()
    assert {r.p for r in entries if r.p >= 0} <= set(range(128)) and sum(r.mass for r in entries if r.p >= 0) == sum(sum(c.values()) for c in phrases(rows).values())
    assert collocated(spark, rows, threshold=5) == plain_collocations(rows, 5)


def test_summary_keeps_what_is_frequent():
    rng = np.random.default_rng(2)
    keys = np.concatenate((rng.integers(0, 3000, 20000), np.repeat([5000, 5001], 400))).astype(np.uint64)
    rng.shuffle(keys)
    true = Counter(keys.tolist())
    capacity = len(keys) // 100 + 1
    summary = co.Summary(capacity, held=500)
    for part in np.array_split(keys, 60):
        summary.add(*np.unique(part, return_counts=True))
    k, c = summary.compact()
    assert len(k) <= capacity and summary.off < 100
    assert all(true[x] - summary.off <= n <= true[x] for x, n in zip(k.tolist(), c.tolist()))
    assert {x for x, n in true.items() if n >= 100} <= set(summary.frequent(100).tolist())


def test_planes():
    x = np.array([1, 5, 70000, 2**31 + 9], np.uint32)
    assert (co.from_planes(co.planes(x), np.uint32) == x).all()
    assert (co.keys_of(co.planes(np.diff(x, prepend=np.uint32(0))), np.uint32) == x).all()


def test_no_documents(spark):
    assert collocated(spark, []) == []


def test_op13_oracle(spark, duck001):
    assert H.compare(spark, "/root/testdata/sf0.01", co.op13_collocations, co.OP13_SQL, duck001)["ok"]
