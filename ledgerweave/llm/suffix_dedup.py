"""Suffix-array dedup: remove repeated byte strings by longest-previous-factor arrays.

A start of a text is *repeated* when the ``length`` bytes from it also start elsewhere in the corpus (the same
text included), and *later* when an earlier text or place (smaller doc_id, then smaller offset) has them.  Every byte
that such a start covers goes; with ``keep_first`` only later starts count, so the first copy stays.

One suffix array of 100 TB cannot sit in one place, so suffixes are dealt to tasks by content:

1. Every ``length``-byte string owns an anchor: of its ``GRAM``-byte grams the one with the least fingerprint.  The anchor
   depends on the string's bytes alone, so equal strings have equal anchors and meet.  Neighbouring starts mostly
   share an anchor; such a run travels as one row holding the bytes its starts read.
2. A first pass counts anchors; a fixed-size bit filter of those seen twice lets a second pass drop all other runs.
   Equal runs of a task are folded into their first one before the shuffle, so a passage that half of all documents hold
   sends one row per task and not one per document.  Anchors with very many different runs are dealt
   start by start, under the fingerprint of the whole string.
3. A task sorts the suffixes of its runs to depth ``length`` (block by block), which brings matching starts together;
   in that suffix order the previous and next smaller positions give, for each start, an earlier match of at least
   ``length`` bytes (its previous factor), and any neighbour a match at all.
4. Starts become spans per text; only texts that may have spans (a bit filter again) are shuffled to be cut.

Whole texts that occur more than once need no suffixes: they are found by one aggregation.
Blocks are compared by 64-bit fingerprints.

Null texts are empty and nothing is cut from texts below ``length`` bytes; rows equal in doc_id and text count as copies of each
other, but as one document under ``keep_first``; a null doc_id sorts first; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ledgerweave.llm.arrays import CHUNK, Prints, text_chunks
from ledgerweave.llm.base import freed, key_filter, saved, table

LENGTH = 200
GRAM = 32
BLOCK = 40
#: Bits of the filter of repeated anchors: so many each, up to 16 MB in all; and runs of one anchor from which it is dealt start by start.
BITS_EACH, ANCHOR_BITS = 256, 1 << 27
HOT_RUNS = 20_000
#: Bytes of runs that a task folds, or sorts, at once (whole anchors).
FOLD_BYTES, SORT_BYTES = 2 << 20, 1 << 19
POS = np.uint64(0xFFFFFFFF)
SEEN, HOT = 1, 2


def anchor_runs(data: np.ndarray, offs: np.ndarray, length: int):
    """Runs of starts with one anchor: (first start, starts, anchor fingerprint, row), and the fingerprints used."""
    grams = length - GRAM + 1
    prints = Prints(data)
    g = prints.windows(GRAM)
    n_starts = np.maximum(0, np.diff(offs) - length + 1)
    if not n_starts.sum():
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z, prints
    v = (g & ~POS) | np.arange(len(g), dtype=np.uint64)
    step = 1
    while step * 2 <= grams:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    if grams > step:
        v = np.minimum(v[:len(v) - (grams - step)], v[grams - step:])
    ok = np.zeros(len(data) + 1, np.int8)
    has = n_starts > 0
    ok[offs[:-1][has]] += 1
    ok[(offs[:-1] + n_starts)[has]] -= 1
    starts = np.flatnonzero(np.cumsum(ok[:-1], dtype=np.int8))
    a = (v[starts] & POS).astype(np.int64)
    cut = np.flatnonzero((a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first = np.concatenate(([0], cut))
    count = np.diff(np.concatenate((first, [len(starts)])))
    lo = starts[first]
    return lo, count, g[a[first]], np.searchsorted(offs, lo, "right") - 1, prints


def anchor_counts(docs: DataFrame, length: int) -> DataFrame:
    def count(batches):
        held, size = [], 0

        def flush():
            x, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(c)], names=["g", "c"])

        for b in batches:
            for _, _, data, offs in text_chunks(b.column(0), CHUNK // 4):
                held.append(anchor_runs(data, offs, length)[2])
                size += len(held[-1])
                if size > 500_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return docs.select("text").mapInArrow(freed(count), "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).where("c > 1")


def anchor_bits(anchors: int) -> int:
    """Size of the filter of so many repeated anchors, a power of two; a task's Python worker holds it whole."""
    return min(ANCHOR_BITS, 1 << max(20, (anchors * BITS_EACH - 1).bit_length()))


RUNS = "g long, id long, key long, pos int, m int, flags int, ctx binary, s int, e int"


def repeated_runs(docs: DataFrame, length: int, keep_first: bool, twice, hot) -> DataFrame:
    """Runs whose anchor may repeat, folded per task; spans (s, e) already certain have no ctx."""

    def read(batches):
        held, size, known = [], 0, set()

        def flush():
            key, ident, pos, m, g, ctx, print_ = (np.concatenate([h[i] for h in held]) if i != 5 else [c for h in held for c in h[i]] for i in range(7))
            _, same = np.unique(print_, return_inverse=True)
            order = np.lexsort((pos, key, ident, same))
            head = np.concatenate(([True], same[order][1:] != same[order][:-1]))
            sizes = np.diff(np.concatenate((np.flatnonzero(head), [len(order)])))
            lead = order[head]
            rest = order[~head]
            if keep_first:  # rows equal to their leader in document and place are the same document
                owner = np.repeat(lead, sizes)[~head]
                rest = rest[(key[rest] != key[owner]) | (pos[rest] != pos[owner])]
            spans = rest if keep_first else np.concatenate((rest, lead[sizes > 1]))
            yield _rows(np.zeros(len(spans), np.int64) + key[spans], ident[spans], key[spans], pos[spans], m[spans], np.zeros(len(spans), np.int64), None, pos[spans], pos[spans] + m[spans] - 1 + length)
            is_hot = hot.value.has(g[lead].view(np.int64))
            flags = np.where(sizes > 1, SEEN, 0)
            cold = lead[~is_hot]
            yield _rows(g[cold].view(np.int64), ident[cold], key[cold], pos[cold], m[cold], flags[~is_hot], [ctx[i] for i in cold])
            at = np.flatnonzero(is_hot)
            for part in np.array_split(at, max(1, len(at) // 2000)):
                if len(part):
                    i = lead[part]
                    text = np.frombuffer(b"".join(ctx[j] for j in i), np.uint8)
                    off = np.concatenate(([0], np.cumsum(m[i] + length - 1)))[:-1]
                    within = np.arange(m[i].sum()) - np.repeat(np.cumsum(m[i]) - m[i], m[i])
                    st = np.repeat(off, m[i]) + within
                    h = Prints(text).spans(st, st + length).view(np.int64)
                    yield _rows(h, np.repeat(ident[i], m[i]), np.repeat(key[i], m[i]), np.repeat(pos[i], m[i]) + within, np.ones(len(st), np.int64), np.repeat(flags[part], m[i]) | HOT, None)

        for b in batches:
            ids, keys, texts = b.column(0).fill_null(-(1 << 63)).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()
            for lo, hi, data, offs in text_chunks(b.column(3), CHUNK // 4):
                start, m, g, row, prints = anchor_runs(data, offs, length)
                take = twice.value.has(g.view(np.int64))
                if not keep_first:  # a whole copy of a text this task has read adds nothing
                    fresh = np.ones(hi - lo, bool)
                    for r in range(hi - lo):
                        f = texts[lo + r]
                        fresh[r] = f not in known
                        known.add(f)
                    take &= fresh[row]
                start, m, g, row = start[take], m[take], g[take], row[take]
                if not len(start):
                    continue
                end = start + m - 1 + length
                raw = data.tobytes()
                ctx = [raw[x:y] for x, y in zip(start, end)]
                held.append((keys[lo + row], ids[lo + row], start - offs[row], m, g, ctx, prints.spans(start, end)))
                size += int((end - start).sum())
                if size > FOLD_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long"), "key", "f", "text").mapInArrow(freed(read), RUNS)


def _rows(g, ident, key, pos, m, flags, ctx, s=None, e=None):
    n = len(g)
    i32 = lambda x: pa.nulls(n, pa.int32()) if x is None else pa.array(np.asarray(x).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(g), pa.array(ident), pa.array(key), i32(pos), i32(m), i32(flags), pa.nulls(n, pa.binary()) if ctx is None else pa.array(ctx, pa.binary()), i32(s), i32(e)],
        names=["g", "id", "key", "pos", "m", "flags", "ctx", "s", "e"])


def smaller_neighbours(pos: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous and next index holding a smaller position within the same run of the suffix order, -1 where none."""
    out = []
    for x, r in ((pos, run), (pos[::-1], run[::-1])):
        i = np.arange(len(x))
        p = i - 1
        p[(p < 0) | (r[np.maximum(p, 0)] != r)] = -1
        while True:
            bad = np.flatnonzero((p >= 0) & (x[np.maximum(p, 0)] >= x))
            if not len(bad):
                break
            p[bad] = p[p[bad]]
        out.append(p)
    nxt = out[1][::-1]
    return out[0], np.where(nxt < 0, -1, len(pos) - 1 - nxt)


def suffix_order(prints: Prints, start: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts with a match of ``length`` bytes, in suffix order (by block fingerprints), and the run of each: runs hold equal prefixes."""
    idx, cls = np.arange(len(start)), group
    cuts = list(range(0, length - BLOCK + 1, BLOCK))
    if cuts[-1] + BLOCK < length:
        cuts.append(length - BLOCK)
    for c in cuts:
        w = prints.spans(start[idx] + c, start[idx] + c + BLOCK)
        o = np.lexsort((w, cls))
        idx, w, k = idx[o], w[o], cls[o]
        new = np.concatenate(([True], (w[1:] != w[:-1]) | (k[1:] != k[:-1])))[:len(idx)]
        cls = np.cumsum(new)
        shared = np.bincount(cls)[cls] > 1
        idx, cls = idx[shared], cls[shared]
    return idx, cls


def matched(group, ident, key, pos, m, seen, ctx, length: int, keep_first: bool):
    """Of runs, per start: index of its run, its offset in the text, and whether it goes."""
    text = np.frombuffer(b"".join(ctx), np.uint8)
    off = np.concatenate(([0], np.cumsum(m + length - 1)))[:-1]
    owner = np.repeat(np.arange(len(m)), m)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(m) - m, m)
    idx, run = suffix_order(Prints(text), off[owner] + within, group[owner], length)
    goes = np.zeros(len(owner), bool)
    goes[idx] = flagged(ident[owner[idx]], key[owner[idx]], pos[owner[idx]] + within[idx], run, keep_first)
    if not keep_first:
        goes |= seen[owner]
    return owner, pos[owner] + within, goes


def flagged(ident, key, pos, run, keep_first: bool) -> np.ndarray:
    """Which starts of runs of equal strings go: all, or those with a smaller position before or after them in suffix order."""
    if not keep_first:
        return np.ones(len(run), bool)
    o = np.lexsort((pos, key, ident))
    rank = np.empty(len(o), np.int64)  # of the place in the corpus
    same = (ident[o][1:] == ident[o][:-1]) & (key[o][1:] == key[o][:-1]) & (pos[o][1:] == pos[o][:-1])
    rank[o] = np.concatenate(([0], np.cumsum(~same)))[:len(o)]
    before, after = smaller_neighbours(rank, run)
    return (before >= 0) | (after >= 0)


def spans_of(runs: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(key, s, e): spans of starts that go."""

    def out(key, pos, goes):
        key, pos = key[goes], pos[goes]
        o = np.lexsort((pos, key))
        key, pos = key[o], pos[o]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (pos[1:] > pos[:-1] + 1)))[:len(key)]
        last = np.concatenate((new[1:], [True]))[:len(key)]
        return pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(pos[new].astype(np.int32)), pa.array((pos[last] + length).astype(np.int32))], names=["key", "s", "e"])

    def decide(t: pa.Table):
        col = lambda n: t.column(n).to_numpy()
        flags, g = col("flags"), col("g")
        done = t.column("s").is_valid().to_numpy()
        if done.any():
            sub = t.filter(pa.array(done))
            yield sub.select(["key", "s", "e"]).combine_chunks().to_batches()[0]
        hot = (flags & HOT > 0) & ~done
        if hot.any():
            i = np.flatnonzero(hot)
            i = i[np.argsort(g[i], kind="stable")]
            n = np.unique(g[i], return_counts=True)[1]
            many = np.repeat(n, n) > 1
            goes = np.zeros(len(i), bool)
            goes[many] = flagged(col("id")[i[many]], col("key")[i[many]], col("pos")[i[many]], g[i[many]], keep_first)
            if not keep_first:
                goes |= flags[i] & SEEN > 0
            yield out(col("key")[i], col("pos")[i], goes)
        cold = np.flatnonzero((flags & HOT == 0) & ~done)
        if len(cold):
            c = t.take(pa.array(cold))
            owner, pos, goes = matched(np.unique(g[cold], return_inverse=True)[1], col("id")[cold], col("key")[cold], col("pos")[cold].astype(np.int64),
                                       col("m")[cold].astype(np.int64), flags[cold] & SEEN > 0, c.column("ctx").to_pylist(), length, keep_first)
            yield out(col("key")[cold][owner], pos, goes)

    def work(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size > SORT_BYTES:
                t = pa.Table.from_batches(held).combine_chunks()
                g = t.column("g").to_numpy()
                cut = int(np.searchsorted(g, g[-1]))  # the last anchor may go on
                if cut:
                    yield from decide(t.slice(0, cut))
                held = t.slice(cut).to_batches()
                size = sum(x.nbytes for x in held)
        if held:
            yield from decide(pa.Table.from_batches(held).combine_chunks())

    return runs.repartition("g").sortWithinPartitions("g").mapInArrow(freed(work), "key long, s int, e int")


def repeat_spans(docs: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """(key, spans): per text (key as ``keyed`` gives it) the spans of bytes that go, unmerged."""
    spark = docs.sparkSession
    docs = docs.where(F.octet_length("text") >= length)
    meta = saved(docs.select("doc_id", "key", "f", F.octet_length("text").alias("bytes")), "texts")
    same = meta.groupBy("f", "bytes").agg(F.count(F.lit(1)).alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("first")).where("copies > 1")
    whole = meta.join(same, ["f", "bytes"])
    if keep_first:
        whole = whole.where(F.coalesce("doc_id", F.lit(-(1 << 63))) > F.col("first"))
    whole = whole.select("key", F.lit(0).alias("s"), F.col("bytes").cast("int").alias("e")).distinct()
    counts = saved(anchor_counts(docs, length), "anchors")
    twice = spark.sparkContext.broadcast(key_filter(counts, "g", anchor_bits(counts.count())))
    hot = spark.sparkContext.broadcast(key_filter(counts.where(F.col("c") > HOT_RUNS), "g", 1 << 20))
    spans = spans_of(repeated_runs(docs, length, keep_first, twice, hot), length, keep_first)
    return saved(spans.unionByName(whole).groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("spans")), "spans")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, more) with f, a fingerprint of the text, and key, one of doc_id and text; a null text is empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("text", text).withColumn("f", F.xxhash64("text")).withColumn("key", F.xxhash64("doc_id", "text"))


def cut_texts(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, whole_chars: bool = False, carry: list[str] = ()) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, ``kept`` (the bytes left) and, in the struct ``more``, the columns to ``carry``.

    ``whole_chars`` shrinks each span to whole UTF-8 characters, so that ``kept`` stays valid text.
    """
    spark = docs.sparkSession
    docs = keyed(docs.select("doc_id", "text", F.struct(*(carry or [F.lit(None).cast("int").alias("none")])).alias("more")))
    spans = repeat_spans(docs, length, keep_first)
    own = spark.sparkContext.broadcast(key_filter(spans, "key"))

    @F.arrow_udf("boolean")
    def may(key: pa.Array) -> pa.Array:
        return pa.array(own.value.has(key.to_numpy()))

    docs = docs.withColumn("may", may("key"))

    def cut(batches):
        for b in (whole.slice(i, 200) for whole in batches for i in range(0, whole.num_rows, 200)):
            ids, texts, spans_ = b.column(0), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()
            sizes, removed, runs, kept = [], [], [], []
            for t, sp in zip(texts, spans_):
                parts, at, gone, k = [], 0, 0, 0
                for s, e in _merged(sp or ()):
                    if whole_chars:
                        while s < e and t[s] & 0xC0 == 0x80:
                            s += 1
                        while s < e < len(t) and t[e] & 0xC0 == 0x80:
                            e -= 1
                    if s < e:
                        parts.append(t[at:s])
                        at, gone, k = e, gone + e - s, k + 1
                sizes.append(len(t))
                removed.append(gone)
                runs.append(k)
                kept.append(b"".join(parts) + t[at:])
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()), b.column(3)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "more"])

    touched = docs.where("may").join(spans, "key", "left").select("doc_id", "text", "spans", "more")
    schema = StructType([docs.schema["doc_id"], *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")), StructField("kept", BinaryType()), docs.schema["more"]])
    touched = touched.mapInArrow(freed(cut), schema)
    return (docs.where("not may").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                         F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"), "more")
            .unionByName(touched))


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
