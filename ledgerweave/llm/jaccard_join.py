"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when ``100 * |A & B| >= threshold * |A | B|`` over their sets of distinct
k-word shingles.  The plan:

1. One pass turns each text into its set: a 64-bit id of the set, its size, a bit sketch and its *prefix*
   (the ``n - ceil(t n) + 1`` shingles that come first in one global order).  Linked sets share a prefix
   shingle.  The order puts the corpus's most frequent shingles last; which shingles count as frequent (a
   bounded table) changes only the cost, never the answer.  Documents with equal sets meet in their set id.
2. Prefix rows meet by shingle, in lists ordered by size; rows without a neighbour of a fitting size go.  Each list
   first pairs every set with the one before it and with the first of fitting size (linear in the list); the
   verified links make classes.  Only then lists that still hold several classes propose all their pairs
   *between* classes, so a group of thousands of near copies never spells out its pairs.
3. A proposed pair is dropped when its sketches already prove too many differences (the number of differing
   sketch bits never exceeds the size of the symmetric difference).
4. The rest are decided exactly by T-occurrence search: sets are grouped under the proposing set in blocks, the
   block's inverted lists are split as DivideSkip does (the longest lists aside), short lists are
   merged by counting, long ones probed by binary search, and sets reaching the required overlap are kept.
5. Links make components by spreading minimum labels.

Null or blank texts have an empty set and link with nothing; equal texts, ties and repeated rows share a set and so a
component; an empty table gives no rows; other columns of the input are ignored.  64-bit fingerprints stand for
words and shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.llm.arrays import CHUNK, U, mix, shingle_sets, text_chunks
from ledgerweave.llm.base import components, freed, key_filter, saved, table

WORDS = 5
THRESHOLD = 75
#: Entries of the table of frequent shingles (8 bytes each are broadcast) and the least count in one task to be considered.
FREQUENT = 1 << 17
FREQUENT_LEAST = 4
#: Sets that one block of a search holds, and parts that the sets proposed by one set are dealt to.
BLOCK, SALTS = 256, 16
#: Lists longer than this are compared in blocks of so many rows, by sketch, and give only the pairs that pass.
LONG_LIST, LIST_BLOCK = 64, 1024


def frequent_shingles(texts: DataFrame, k: int = WORDS, most: int = FREQUENT) -> np.ndarray:
    """At most ``most`` shingles that many documents hold, rarest first, as fingerprints."""

    def count(batches):
        held, size = [], 0

        def flush():
            x, c = np.unique(np.concatenate(held), return_counts=True)
            keep = c >= FREQUENT_LEAST
            return pa.RecordBatch.from_arrays([pa.array(x[keep].view(np.int64)), pa.array(c[keep])], names=["h", "c"])

        for b in batches:
            for _, _, data, offs in text_chunks(b.column(0)):
                held.append(shingle_sets(data, offs, k)[0])
                size += len(held[-1])
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counts = saved(texts.select("text").mapInArrow(freed(count), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "frequent")
    steps = counts.groupBy(F.floor(F.log2("c") * 8).alias("step")).count().orderBy(F.desc("step")).collect()  # at most 8 * 63 rows
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, U)
    rows = counts.where(F.floor(F.log2("c") * 8) >= least).collect()  # at most ``most`` rows
    rows.sort(key=lambda r: (r.c, r.h))
    return np.array([r.h for r in rows], np.int64).view(U)


def prefix_size(n: np.ndarray, threshold: int) -> np.ndarray:
    """Shingles of a set of n of which one at least is shared with any linked set."""
    return np.where(n > 0, n - -(-threshold * n // 100) + 1, 0)


def sketch(x: np.ndarray) -> bytes:
    """Parity bits of a set, about two an element: differing bits of two sketches are at most the differing elements of the sets."""
    bits = 1 << max(9, int(2 * len(x) - 1).bit_length())
    return np.packbits((np.bincount((x & U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Differing bits of two sketches, the longer one folded to the length of the other."""
    x, y = np.frombuffer(x, U), np.frombuffer(y, U)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def set_id(x: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set: the mixed sum of its mixed elements."""
    return mix(x * U(0x9FB21C651E98DF25) ^ U(0xA24BAED4963EE407))


def set_ids(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    last = np.cumsum(counts)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(set_id(x))))
    return mix(sums[last] - sums[last - counts] + counts.astype(U)).view(np.int64)


def document_sets(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, f set id (null: empty), n, sketch) per row of ``docs``."""

    def sets(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b.column(1)):
                x, counts = shingle_sets(data, offs, k)
                sk = [sketch(own) for own in np.split(x, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(set_ids(x, counts), mask=counts == 0), pa.array(counts), pa.array(sk, pa.binary())],
                                                 names=["doc_id", "f", "n", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(freed(sets), "doc_id long, f long, n long, sketch binary")


def set_ids_of(wanted, k: int = WORDS):
    """A function of (doc_id, text) columns -> struct(may, f): whether doc_id is in ``wanted`` (a broadcast ``KeyFilter``), and then the text's set id (null: empty).

    Rows stay in the JVM, and one Python function gives both.
    """
    @F.arrow_udf("struct<may: boolean, f: bigint>")
    def of(doc_id: pa.Array, text: pa.Array) -> pa.Array:
        may = wanted.value.has(doc_id.fill_null(0).to_numpy()) & doc_id.is_valid().to_numpy(zero_copy_only=False)
        f, known = np.zeros(len(doc_id), np.int64), np.zeros(len(doc_id), bool)
        for first in range(0, len(doc_id), 500):
            at = first + np.flatnonzero(may[first:first + 500])
            for lo, hi, data, offs in text_chunks(text.take(pa.array(at)), CHUNK // 4):
                x, counts = shingle_sets(data, offs, k)
                f[at[lo:hi]], known[at[lo:hi]] = set_ids(x, counts), counts > 0
        return pa.StructArray.from_arrays([pa.array(may), pa.array(f, mask=~known)], names=["may", "f"])

    # else a filter on ``may`` would be pushed below and the function run twice
    return of.asNondeterministic()


def prefix_rows(docs: DataFrame, frequent: np.ndarray, k: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(f, n, h): the prefix shingles of each set, once per set and task."""
    order = np.argsort(frequent)
    late = docs.sparkSession.sparkContext.broadcast((frequent[order], order.astype(np.int64) + 1))

    def prefixes(batches):
        keys, rank = late.value
        seen = set()
        for b in batches:
            for _, _, data, offs in text_chunks(b.column(0)):
                x, counts = shingle_sets(data, offs, k)
                last = np.cumsum(counts)
                rare = np.zeros(len(x), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
                    rare = np.where(keys[at] == x, rank[at], 0)
                f = set_ids(x, counts)
                p = prefix_size(counts, threshold)
                rows = []
                for r in np.flatnonzero(counts):
                    if f[r] in seen:
                        continue
                    seen.add(f[r])
                    own, late_own = x[last[r] - counts[r]:last[r]], rare[last[r] - counts[r]:last[r]]
                    early = own[late_own == 0]  # in fingerprint order, before all frequent ones
                    if len(early) < p[r]:
                        y = late_own > 0
                        early = np.concatenate((early, own[y][np.argsort(late_own[y], kind="stable")]))
                    rows.append((r, early[:p[r]]))
                if not rows:
                    continue
                r = np.array([i for i, _ in rows])
                cuts = np.concatenate(([0], np.cumsum([len(y) for _, y in rows])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[r]), pa.array(counts[r]), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(np.concatenate([y for _, y in rows]).view(np.int64)))], names=["f", "n", "prefix"])

    return docs.select("text").mapInArrow(freed(prefixes), "f long, n long, prefix array<long>").select("f", "n", F.explode("prefix").alias("h"))


def sketch_passes(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of set ids whose sizes and sketches allow the threshold."""
    p = (pairs.join(sets.select(F.col("f").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
         .join(sets.select(F.col("f").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
         .where(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
         .select("a", "b", "na", "nb", "sa", "sb"))

    def keep(batches):
        for b in batches:
            n = b.column(2).to_numpy() + b.column(3).to_numpy()
            differ = np.array([differing(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())], np.int64)
            # |A ^ B| = |A| + |B| - 2 |A & B| and 100 |A & B| >= t (|A| + |B| - |A & B|)
            ok = differ <= n - 2 * -(-threshold * n // (100 + threshold))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return p.mapInArrow(freed(keep), "a long, b long")


def divide_skip(query: np.ndarray, members: list[np.ndarray], threshold: int = THRESHOLD) -> np.ndarray:
    """Indices of ``members`` (sorted sets) whose Jaccard similarity with the sorted set ``query`` reaches the threshold.

    Inverted lists of the query's elements over the members; the longest lists are set aside, the others merged by
    counting, members with enough counts are looked up in the long lists by binary search.
    """
    sizes = np.array([len(m) for m in members], np.int64)
    need = -(-threshold * (len(query) + sizes) // (100 + threshold))
    x, who = np.concatenate(members), np.repeat(np.arange(len(members)), sizes)
    at = np.minimum(np.searchsorted(query, x), len(query) - 1)
    hit = query[at] == x
    at, who = at[hit], who[hit]
    order = np.lexsort((who, at))
    at, who = at[order], who[order]
    lengths = np.bincount(at, minlength=len(query))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    t = int(need.min())
    longest = int(lengths.max(initial=0))
    aside = min(max(0, t - 1), int(t / (0.0085 * np.log2(longest + 2) + 1))) if longest > 1 else 0
    long_lists = np.argsort(-lengths, kind="stable")[:aside]
    is_long = np.zeros(len(query), bool)
    is_long[long_lists] = True
    count = np.bincount(who[~is_long[at]], minlength=len(members))
    alive = np.flatnonzero(count >= need - aside)
    for n_left, lst in zip(range(aside, 0, -1), long_lists):
        alive = alive[count[alive] >= need[alive] - n_left]
        own = who[starts[lst]:starts[lst + 1]]
        if not len(own) or not len(alive):
            continue
        p = np.minimum(np.searchsorted(own, alive), len(own) - 1)
        count[alive] += own[p] == alive
    return alive[count[alive] >= need[alive]]


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs (a, b) that link, decided on whole sets read again from the texts that hold them."""
    pairs = saved(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("f")).unionByName(pairs.select(F.col("b").alias("f"))).distinct()
    # a set is read from its smallest document
    holders = saved(sets.select("f", "doc_id").join(wanted, "f").select("f", "doc_id"), "holders")
    sc = docs.sparkSession.sparkContext
    by_id, by_f = sc.broadcast(key_filter(holders.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id")), "doc_id")), sc.broadcast(key_filter(holders, "f"))

    def read(batches):
        for b in batches:
            b = b.filter(pa.array(by_id.value.has(b.column(0).fill_null(0).to_numpy())))
            for lo, hi, data, offs in text_chunks(b.column(1)):
                x, counts = shingle_sets(data, offs, k)
                f = set_ids(x, counts)
                blobs = pa.array([own.tobytes() for own in np.split(x, np.cumsum(counts)[:-1])], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(f), blobs], names=["doc_id", "f", "x"]).filter(pa.array((counts > 0) & by_f.value.has(f)))

    full = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(freed(read), "doc_id long, f long, x binary")
    part = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")
    roles = pairs.select(F.col("b").alias("f"), "a", part.alias("part"), "b")
    roles = roles.unionByName(roles.select(F.col("a").alias("f"), "a", "part", F.lit(None).cast("long").alias("b")).distinct())
    roles = roles.join(holders.select("f", "doc_id"), "f")
    # null-safe, as the smallest document of a set may have a null id
    rows = (roles.join(full.withColumnRenamed("f", "g").withColumnRenamed("doc_id", "d"), (F.col("f") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d")))
            .select("a", "part", "b", "x").repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()))

    def search(batches):
        at, query, ids_, members = None, None, [], []

        def flush():
            if not members:
                return None
            found = divide_skip(query, members, threshold)
            return pa.RecordBatch.from_arrays([pa.array([at[0]] * len(found), pa.int64()), pa.array([ids_[i] for i in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for a, part, b, x in zip(*(c.to_pylist() for c in batch.columns)):
                if b is None or len(members) >= BLOCK:
                    out = flush()
                    if out is not None:
                        yield out
                    ids_, members = [], []
                if b is None:
                    at, query = (a, part), np.frombuffer(x, U)
                else:
                    ids_.append(b)
                    members.append(np.frombuffer(x, U))
        out = flush()
        if out is not None:
            yield out

    return saved(rows.mapInArrow(freed(search), "a long, b long"), "links")


def candidate_lists(docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """(h, f, n, start, before): prefix rows that meet another of a fitting size, in lists ordered by size.

    ``start`` is the first set of the run of fitting sizes, ``before`` the set just before, where it fits.
    """
    w = Window.partitionBy("h").orderBy("n", "f")
    rows = prefix_rows(docs, frequent_shingles(docs, k), k, threshold)
    low = F.coalesce(100 * F.lag("n").over(w) >= threshold * F.col("n"), F.lit(False))
    high = F.coalesce(100 * F.col("n") >= threshold * F.lead("n").over(w), F.lit(False))
    rows = rows.withColumn("low", low).withColumn("high", high).withColumn("last", F.lag("f").over(w))
    rows = rows.withColumn("start", F.last(F.when(~F.col("low"), F.col("f")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("low or high").select("h", "f", "n", "start", F.when(F.col("low"), F.col("last")).alias("before"))


def long_list_pairs(lists: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) between classes of long lists (h, f, n, label, size) whose sizes and sketches allow the threshold.

    The rows of a list are dealt to blocks, and each pair of blocks is compared in one place, so no list has to fit
    in a task and pairs that the sketches rule out are never written.
    """
    blocks = F.ceil(F.col("size") / LIST_BLOCK).cast("int")
    # of each set its first long lists: a pair is written only where the first list common to these is compared
    firsts = lists.groupBy("f").agg(F.slice(F.sort_array(F.collect_set("h")), 1, 8).alias("firsts"))
    rows = lists.join(sets.select("f", "sketch"), "f").join(firsts, "f").withColumn("own", F.pmod(F.xxhash64("f"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("h", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "f", "n", "label", "sketch", "firsts")

    def compare(t: pa.Table):
        col = lambda c: t.column(c).to_numpy()
        own, f, n, label = col("own"), col("f"), col("n"), col("label")
        sk = [np.frombuffer(x, U) for x in t.column("sketch").to_pylist()]
        here, firsts = t.column("h")[0].as_py(), [set(x) for x in t.column("firsts").to_pylist()]
        left, right = own == t.column("lo")[0].as_py(), own == t.column("hi")[0].as_py()
        for i in np.flatnonzero(left):
            fits = right & (label > label[i] if t.column("lo")[0].as_py() == t.column("hi")[0].as_py() else label != label[i])
            fits &= 100 * np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i])
            at = np.flatnonzero(fits)
            for size in {len(sk[j]) for j in at}:
                same = at[[len(sk[j]) == size for j in at]]
                one, many = sk[i], np.stack([sk[j] for j in same])
                while len(one) != many.shape[1]:
                    if len(one) > many.shape[1]:
                        one = one[:len(one) // 2] ^ one[len(one) // 2:]
                    else:
                        many = many[:, :many.shape[1] // 2] ^ many[:, many.shape[1] // 2:]
                total = n[i] + n[same]
                ok = np.bitwise_count(one ^ many).sum(axis=1).astype(np.int64) <= total - 2 * -(-threshold * total // (100 + threshold))
                passed = [j for j in same[ok] if min(firsts[i] & firsts[j], default=here) == here]
                if passed:
                    yield np.full(len(passed), f[i]), f[passed]

    def work(batches):
        held, seen = None, set()
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key = np.stack([held.column(c).to_numpy() for c in ("h", "lo", "hi")], 1) if held.num_rows else np.zeros((0, 3), np.int64)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for x, y in zip([0, *cuts[:-1]], cuts):
                yield from found(held.slice(x, y - x), seen)
            if len(cuts):  # the last group may go on
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from found(held, seen)

    def found(t, seen):
        for a, b in compare(t):
            fresh = [i for i, pair in enumerate(zip(a.tolist(), b.tolist())) if pair not in seen]
            if len(seen) < 1_000_000:  # only spares repeats
                seen.update(zip(a.tolist(), b.tolist()))
            if fresh:
                yield pa.RecordBatch.from_arrays([pa.array(a[fresh]), pa.array(b[fresh])], names=["a", "b"])

    rows = rows.repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi")
    return rows.mapInArrow(freed(work), "a long, b long")


def jaccard_components(docs: DataFrame, k: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text); component_id is the smallest doc_id reachable."""
    return set_components(docs, k, threshold).select("doc_id", "n_shingles", "component_id")


def set_components(docs: DataFrame, k: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``jaccard_components`` with f, the row's set id (null: empty), and first_f, the set id of the component's first row by doc_id and f."""
    own = saved(document_sets(docs, k), "docsets")
    sets = saved(own.where("f is not null").groupBy("f").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "sigs")
    lists = saved(candidate_lists(docs, k, threshold), "lists")

    def proposals(x: DataFrame) -> DataFrame:
        return x.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    stars = saved(proposals(lists.select(F.col("start").alias("a"), F.col("f").alias("b")).unionByName(lists.select(F.col("before").alias("a"), F.col("f").alias("b")))), "stars")
    links = verified(sketch_passes(stars, sets, threshold), docs, sets, k, threshold)
    classes = components(links)
    w = Window.partitionBy("h")
    open_ = lists.select("h", "f", "n").join(classes.select(F.col("node").alias("f"), "label"), "f", "left").withColumn("label", F.coalesce("label", "f"))
    open_ = saved(open_.withColumn("low", F.min("label").over(w)).withColumn("high", F.max("label").over(w)).where("low <> high")
                  .select("h", "f", "n", "label", F.count(F.lit(1)).over(w).alias("size")), "open")
    short = open_.where(F.col("size") <= LONG_LIST)
    x, y = short.alias("x"), short.alias("y")
    across = proposals(x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.label") < F.col("y.label"))
                              & (100 * F.least("x.n", "y.n") >= threshold * F.greatest("x.n", "y.n")))
                       .select(F.col("x.f").alias("a"), F.col("y.f").alias("b")))
    across = sketch_passes(across.join(stars, ["a", "b"], "left_anti"), sets, threshold)
    across = across.unionByName(proposals(long_list_pairs(open_.where(F.col("size") > LONG_LIST), sets, threshold))).distinct()
    more = verified(across, docs, sets, k, threshold)
    label = components(links.unionByName(more))
    of = sets.select("f", "doc_id").join(label.select(F.col("node").alias("f"), "label"), "f", "left").withColumn("label", F.coalesce("label", "f"))
    small = of.groupBy("label").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "f"))).alias("first"))
    of = of.join(small, "label").select("f", F.col("first.doc_id").alias("component_id"), F.col("first.f").alias("first_f"))
    return (own.select("doc_id", "n", "f").join(of, "f", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "f", "first_f"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
