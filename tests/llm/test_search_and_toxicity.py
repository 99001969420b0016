"""The two searches, toxicity and the pipeline against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from ledgerweave.llm import exact_topk, learned_partitions, toxicity, vectors


def vector_rows(n, d, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, d))).astype(np.float32)
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]


ODD = [(9001, None), (9002, []), (9003, [0.1] * 7 + [None]), (9004, [float("nan")] * 8), (9005, [float("inf")] + [0.0] * 7), (9006, [0.0] * 8), (9007, [0.5] * 3), (None, [0.1] * 8)]


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 3, 0.5) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double").repartition(3)


def test_exact_topk(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "VECTORS", 150)
    monkeypatch.setattr(exact_topk, "QUERIES", 4)
    rows = vector_rows(800, 8) + [(2000 + i, [0.25] * 8) for i in range(60)]
    rows += rows[:5] + [(300, rows[7][1]), (3000, [0.1] * 3), (3001, [0.2] * 3)]  # repeated rows and ids, another length
    got = exact_topk.exact_top(exact_topk.integers(table_of(spark, rows + ODD)), F.col("vec_id") % 100 == 0).collect()
    z = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows + [(9006, [0.0] * 8), (9007, [0.5] * 3)]]
    want = []
    for n, (q, x) in enumerate(z):
        if q % 100 == 0:
            s = sorted((-int(x @ y), c) for m, (c, y) in enumerate(z) if m != n and len(y) == len(x))[:10]
            want += [(q, r, c, -s_) for r, (s_, c) in enumerate(s, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("scale", [1, 1 << 21])
@pytest.mark.parametrize("n", [1, 3, 15, 40, 700])
def test_lists_are_read_in_steps(n, scale):
    rng = np.random.default_rng(n)
    x = rng.integers(-9, 10, (n, 6)) * scale
    x[::3] *= 40  # few objects lead: the lists need not be read to the end
    lists, depths = exact_topk.SortedLists(x), []
    for q in x[:30]:
        at, score, depth = lists.search(q, 4)
        want = x @ q
        assert (score == want[at]).all() and len(set(at)) == len(at)
        assert set(np.flatnonzero(want >= np.sort(want)[-4:].min())) <= set(at)
        depths.append(depth)
    assert max(depths) <= n and (n < 700 or np.mean(depths) < 0.8 * n)


def test_exact_topk_few(spark):
    rows = [(100, [1.0, 2.0]), (1, [1.0, 0.0])]
    got = exact_topk.exact_top(exact_topk.integers(table_of(spark, rows)), F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 1024 * 1024)]
    assert exact_topk.exact_top(exact_topk.integers(table_of(spark, [])), F.col("vec_id") % 100 == 0).count() == 0


def test_exact_topk_oracle(spark, duck001):
    got = sorted(tuple(r) for r in exact_topk.op7_exact_topk(spark, "/root/testdata/sf0.01").collect())
    assert got == sorted(duck001.execute(exact_topk.OP7_SQL).fetchall())


def test_repeated_ids_are_rows(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [2.0, 0.0]), (1, [0.0, 3.0]), (1, [0.0, 3.0])]
    z = {("a", 100): (1, 0), ("b", 100): (0, 1), ("a", 1): (2, 0), ("b", 1): (0, 3), ("c", 1): (0, 3)}
    table = table_of(spark, rows)
    got = exact_topk.exact_top(exact_topk.integers(table), F.col("vec_id") % 100 == 0).collect()
    near = learned_partitions.nearest(vectors.usable(table, zero=False), F.col("vec_id") % 100 == 0).collect()
    want, close = [], []
    for q in (("a", 100), ("b", 100)):
        others = [c for c in z if c != q]
        top = sorted((-1024 * 1024 * int(np.dot(z[q], z[c])), c[1]) for c in others)
        want += [(100, r, c, -s) for r, (s, c) in enumerate(top, 1)]
        close += [(100, r, c, s) for r, (s, c) in enumerate(sorted((float(np.hypot(*np.subtract(z[q], z[c]))), c[1]) for c in others), 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert sorted(tuple(r) for r in near) == [(*c[:3], pytest.approx(c[3])) for c in sorted(close)]


def nearest_by_force(z, q, k=10):
    return sorted((float(np.sqrt(((z[c] - z[q]) ** 2).sum())), c) for c in z if c != q)[:k]


def test_one_part_is_exact(spark):
    rows = vector_rows(300, 8) + [(2000 + i, [0.25] * 8) for i in range(30)]
    got = learned_partitions.nearest(vectors.usable(table_of(spark, rows + ODD), zero=False), F.col("vec_id") % 100 == 0).collect()
    z = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q in (i for i in z if i % 100 == 0):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [(c, s) for _, c, s in own] == [(c, pytest.approx(s, rel=1e-12)) for s, c in nearest_by_force(z, q)]


def test_other_lengths_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "SMALL", 100)
    rows = vector_rows(1500, 8) + [(5000 + i, v) for i, v in vector_rows(150, 5, seed=2)] + [(100, [0.0, 1.0])]
    got = learned_partitions.nearest(vectors.usable(table_of(spark, rows), zero=False), F.col("vec_id") % 100 == 0).collect()
    z = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    by = {i: len(v) for i, v in z[:-1]}
    assert all(by[r.query_id] == by[r.vec_id] for r in got) and {r.query_id for r in got} == {i for i in by if i % 100 == 0}
    for q in (5000, 5100):  # rows of another length are searched whole
        own = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [c for _, c in own] == [c for _, c in nearest_by_force({i: v for i, v in z if len(v) == 5}, q)]


def test_learned_partitions_recall(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "GROUP", 700)
    rows = vector_rows(6000, 16, seed=3)
    rows += [(10_000 + i, rows[5][1]) for i in range(2500)]  # one very common vector
    got = {}
    for r in learned_partitions.nearest(vectors.usable(table_of(spark, rows), zero=False), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        d[ids == q] = np.inf
        o = np.lexsort((ids, d))[:10]
        hit += len(set(ids[o].tolist()) & set(got[q]))
        total += 10
        assert all(got[q][c] == pytest.approx(d[np.flatnonzero(ids == c)[0]], rel=1e-12, abs=1e-12) for c in got[q])
    assert hit >= 0.9 * total


@pytest.mark.parametrize("explicit", [None, 0.9])
def test_cover_is_of_distinct_vectors(explicit):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2400, 12))
    x[rng.random(2400) < 0.5] = x[0]  # half of the sample is one vector
    router, probes = learned_partitions.learn(x) if explicit is None else learned_partitions.learn(x, cover=explicit)
    asked, x = np.unique(x[:600], axis=0), x[600:]
    near = np.argsort((x * x).sum(1)[None, :] - 2 * asked @ x.T, axis=1, kind="stable")[:, :10]
    found = (router.order(asked)[:, :probes, None] == router.order(x)[:, 0][near][:, None, :]).any(1).mean()
    assert found >= (explicit or 0.98), (found, probes)


def test_balanced_parts():
    x = np.array([v for _, v in vector_rows(1024, 8)])
    graph = learned_partitions.neighbour_graph(x, 8)
    part = learned_partitions.balanced_parts(graph, 8, np.random.default_rng(0))
    assert set(np.bincount(part, minlength=8)) == {128}
    assert (part[graph] == part[:, None]).mean() > 0.5


@pytest.fixture(scope="module")
def decoder():
    text = ("the stupid idiot was a loser and a moron said the clown this is worthless trash you are so pathetic and disgusting "
            "please see the book at all letters good moon off will need keep three " * 20)
    table = toxicity.symbol_table()
    s = np.array([table[ord(c)] for c in "  " + text + "  "], int)
    counts = np.bincount((s[:-2] * toxicity.SYMBOLS + s[1:-1]) * toxicity.SYMBOLS + s[2:], minlength=toxicity.SYMBOLS ** 3)
    return toxicity.Decoder(toxicity.character_model(counts))


@pytest.mark.parametrize("shown,meant", [("1d10t", "idiot"), ("stup1d", "stupid"), ("$tup!d", "stupid"), ("m0r0n", "moron"), ("l000ser", "loser"), ("iiidiooot", "idiot"), ("s t u p i d", "stupid"),
                                         ("i d i o t", "idiot"), ("cl0wn", "clown"), ("tr@sh", "trash"), ("goood", "good"), ("b00k", "book")])
def test_deobfuscation(decoder, shown, meant):
    assert decoder.restore(shown) == meant


@pytest.mark.parametrize("shown", ["1 d 1 0 t", "$ t u p 1 d", "! d ! o t", "i.d.i.o.t", "i-d-i-o-t", "i_d_i_o_t", "1.d-1_0 t", "i. d. i. o. t.", "iddiot", "stuppid", "I D D I O T",
                                   "$-t-u-u-p-!-d", "d é b i l e", "d.é.b.i.l.e", "1dd1oott", "m.0.r.0.n"])
def test_combined_obfuscation_is_found(decoder, shown):
    meant = ["idiot", "stupid", "moron", "débile"]
    _prints_of = lambda t: toxicity.features(*one_text(t), decoder)[0]
    keys = np.unique(np.concatenate([_prints_of(w) for w in meant]))
    row, found = toxicity._hits(*one_text(f"said the {shown} again"), decoder, keys)
    assert any(keys[f] in whole_print(w) for f in found for w in meant), shown


def one_text(t):
    data = np.frombuffer(t.encode(), np.uint8)
    return data, np.array([0, len(data)])


def whole_print(w):
    data, offs = one_text(w)
    return toxicity.Prints(toxicity.LOWER[data]).spans(offs[:1], offs[1:])


def test_plain_words_stay(decoder):
    keys = np.unique(toxicity.features(*one_text("idiot stupid"), decoder)[0])
    assert not len(toxicity._hits(*one_text("all good books will need 1 2 3 letters e.g. a-b U.S. moon"), decoder, keys)[0])


def labelled(seed, n=900):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeiounrstlm") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    bad = ["idiot", "stupid", "moron", "worthless", "clown"]
    looks = {"i": "1", "o": "0", "e": "3", "s": "$", "a": "@"}
    rows = []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                b = rng.choice(bad)
                how = rng.random()
                if how < 0.2:
                    b = "".join(looks.get(c, c) for c in b)
                elif how < 0.3:
                    b = " ".join(b)
                elif how < 0.4:
                    b = "".join(c * rng.choice((1, 1, 3)) for c in b)
                w.insert(rng.randint(0, len(w)), b)
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxicity_held_out(spark, tmp_path):
    rows = labelled(1)
    odd = [(5000, None), (5001, ""), (5002, "..."), (5003, "w " * 30000), (5004, "idiot " + "plain " * 20000 + "stupid moron clown idiot")]
    docs = spark.createDataFrame([(i, t, 0.1, 5) for i, t, _ in rows] + [(i, t, 0.1, 5) for i, t in odd] + [(3, rows[3][1], 0.1, 5)], "doc_id long, text string, score double, label int").repartition(4)
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(6000, 1, 1), (5001, None, 1), (3, rows[3][2], 1)], "doc_id long, toxic int, quality int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = toxicity.op4_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by = {r.doc_id: r for r in got}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    right = np.mean([by[i].predicted == y for i, y in held])
    assert right > 0.97, right
    assert by[5004].predicted == 1 and by[5003].predicted == 0 and by[5000].score == by[5001].score < 0.5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.5, 0.5]
    model = toxicity.fit(docs.limit(0), none)
    assert toxicity.score(docs.limit(0), model).count() == 0 and toxicity.accepted(docs, model, 0.6).count() == 2


def test_near_duplicates_by_row(spark):
    import corpus_pipeline

    text = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    docs = [(1, text("a")), (2, text("a") + " more"), (2, text("b")), (3, text("b") + " more"), (4, text("c")), (4, text("d")), (4, text("d")), (4, text("c").upper()),
            (5, None), (5, None), (5, " "), (None, text("a")), (None, text("a")), (6, text("b", 39)), (7, text("e"))]
    df = spark.createDataFrame([(d, "s", t) for d, t in docs], "doc_id long, source string, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert got.columns == df.columns
    want = [(1, text("a")), (2, text("b")), (4, text("c").upper()), (4, text("d")), (5, None), (5, " "), (None, text("a")), (None, text("a")), (7, text("e"))]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    rows = labelled(2, 400)
    passage = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    docs = [(i, t + (" " + passage if i % 9 == 0 else ""), "en", f"s{i % 4}", 0, 1) for i, t, _ in rows]
    docs += [(1000 + i, docs[i][1], "en", "s1", 0, 1) for i in range(0, 40)] + [(1100 + i, docs[i][1] + " more", "en", "s2", 0, 1) for i in range(0, 40)]
    docs += [(2000, None, None, None, None, 1), (2001, "", "en", "s0", 0, 1), (1, docs[1][1], "en", "s1", 0, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int, kept int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, str(tmp_path))
        d.write.parquet(str(tmp_path / f"out-{name}"))
        d = spark.read.parquet(str(tmp_path / f"out-{name}"))
        seen.append(sorted((tuple(r) for r in d.collect()), key=repr))
    assert all(len(s[0]) == 6 for s in seen[:4])
    toxic = {i for i, _, y in rows if y}
    first = [r[0] for r in seen[0]]
    clean = [x[0] for x in docs if x[0] % 1000 not in toxic and (x[0] < 1100 or x[0] - 1100 not in toxic)]
    assert len(set(clean) - set(first)) <= 2 and len({x for x in first if x in toxic}) <= 5
    by_id = {x[0]: x[1] for x in docs}
    links = brute.linked([(r[0], r[1]) for r in seen[0]])
    assert sorted(r[0] for r in seen[1]) == sorted({c for _, c in links})
    cut = brute.repeats([(r[0], r[1]) for r in seen[1]], 200, keep_first=True)
    want = {r[0]: cut[i][0].decode() for i, r in enumerate(seen[1])}  # plain ASCII: spans are whole characters
    assert {r[0]: r[1] for r in seen[2]} == want and all(r[4] == len(r[1]) for r in seen[2])
    assert sum(len(by_id[i] or "") - len(t) for i, t in want.items()) > 5000
    n = {i: sum(r[0] == i for r in seen[3]) for i in want}
    assert set(n.values()) <= {0, 1, 2, 3} and sum(n.values()) > 50
    assert len(seen[4]) == len(seen[3])
    for doc_id, count, ids, digest in seen[4]:
        assert len(ids) == count and digest == brute.sha(want[doc_id])
