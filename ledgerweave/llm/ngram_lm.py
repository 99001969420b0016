"""Interpolated modified Kneser-Ney n-gram model, counted and looked up in Spark.

Texts are tokenised once into *blocks*: token streams over a local word list, with the fingerprints of the words.  From the
highest order down, each block sends its distinct n-grams (sorted 64-bit fingerprints with what it knows of
them) to shards by fingerprint; a shard adds up all blocks' figures and answers each block in its own order.  One
asking block of each n-gram is named its owner, and the owner hands the n-gram's share on to the next lower order: one
more left neighbour for the shorter n-gram, one more continuation for the context.  So each count is exact, all traffic is distinct
n-grams per block (never occurrences), fingerprints spread evenly whatever the words' frequencies, and no
model ever has to fit in one place.  A block's answers are its slice of the model: sorted hash arrays with their
values, spooled to an unlinked file that the scoring worker maps into memory and searches.

Probabilities: raw counts at the highest order, numbers of distinct left neighbours below (raw counts for n-grams that
begin a text), three discounts an order from the counts of counts, interpolation down to uniform over the vocabulary
and one unknown word.  Every text is its words, lower-cased A-Z, then one end token.

Null and blank texts are an end token alone; a null doc_id is trained on and scored; repeated rows count and score as often as they stand;
an empty table gives no rows; other columns are ignored.  64-bit fingerprints stand for words and n-grams.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.arrays import U, mix, text_chunks, word_prints
from ledgerweave.llm.base import freed, session_with, table, written

ORDER = 3
#: Text of a block, and the fingerprints of the marks before and after a text.
BLOCK_BYTES = 8 << 20
#: Tokens of all blocks a shard is made for: no shard gets many more requests of one order, whatever the corpus.
SHARD_TOKENS = 2 << 20
START, STOP = U(0x243F6A8885A308D3), U(0x13198A2E03707344)
BLOCKS = "p long, tokens long, ids array<long>, held array<boolean>, lens binary, words binary, idx binary"
ANSWERS = "p long, level int, shard int, body binary"


def packed(x: np.ndarray) -> bytes:
    """An integer array by byte planes, compressed."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unpacked(b: bytes, dtype) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def blocks_of(docs: DataFrame, held) -> DataFrame:
    """Token blocks of ``docs`` (doc_id, text); ``held`` is a column: true for texts not learned from."""

    def work(batches):
        seq, rows, size = 0, [], 0

        def flush():
            nonlocal seq
            wh = np.concatenate([r[2] for r in rows])
            lens = np.concatenate([r[3] for r in rows])
            words, idx, n = np.unique(wh, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words get small numbers, which compress
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            p = (TaskContext.get().partitionId() << 24) + seq
            seq += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([p]), pa.array([int(lens.sum()) + 2 * len(lens)]), pa.array([[i for r in rows for i in r[0]]], pa.list_(pa.int64())), pa.array([[h for r in rows for h in r[1]]], pa.list_(pa.bool_())),
                 pa.array([packed(lens)], pa.binary()), pa.array([words[order].tobytes()], pa.binary()), pa.array([packed(place[idx])], pa.binary())],
                names=["p", "tokens", "ids", "held", "lens", "words", "idx"])

        for b in batches:
            for lo, hi, data, offs in text_chunks(b.column(2)):
                wh, row = word_prints(data, offs)
                rows.append((b.column(0).slice(lo, hi - lo).to_pylist(), b.column(1).slice(lo, hi - lo).to_pylist(), wh, np.bincount(row, minlength=hi - lo)))
                size += len(data) + 64 * (hi - lo)
                if size > BLOCK_BYTES:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(held, F.lit(False)), "text").mapInArrow(freed(work), BLOCKS)


class Block:
    """The token stream of a block: every text as start mark, words, end mark."""

    def __init__(self, ids, held, lens: bytes, words: bytes, idx: bytes):
        self.ids, self.held = ids, np.array(held, bool)
        n = unpacked(lens, np.int64) + 2
        self.first = np.cumsum(n) - n
        self.size = n
        words = np.frombuffer(words, U)
        self.words = np.append(words, [START, STOP])
        self.code = np.empty(int(n.sum()), np.int64)  # of each token: its place among the words
        inner = np.ones(len(self.code), bool)
        inner[self.first] = inner[self.first + n - 1] = False
        self.code[inner] = unpacked(idx, np.uint32)
        self.code[self.first], self.code[self.first + n - 1] = len(words), len(words) + 1
        self.place = np.arange(len(self.code)) - np.repeat(self.first, n)  # within the text
        self.train = np.repeat(~self.held, n)
        self._grams = {}

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions where a k-gram ends, sorted fingerprints of the distinct ones, which one stands where, a position of each."""
        if k not in self._grams:
            factor = lambda j: U(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64))
            at = np.flatnonzero(self.place >= k - 1)
            if k == 1:  # the words are distinct already
                h = mix(self.words * factor(0) + U(1))
                order = np.argsort(h)
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                self._grams[k] = at, h[order], rank[self.code], None
            else:
                h = np.zeros(len(at), U)
                for j in range(k):
                    h += self.words[self.code[at - j]] * factor(j)
                keys, one, back = np.unique(mix(h + U(k)), return_index=True, return_inverse=True)
                self._grams[k] = at, keys, back, at[one]
        return self._grams[k]


def bounds(shards: int) -> np.ndarray:
    return np.array([(i << 64) // shards for i in range(1, shards)], U)


FIELDS = 6  # of an n-gram: raw count, adjusted count, and as a context: total, continuations seen once, twice, more


def sent(k: int, order: int) -> list[int]:
    """The figures of k-grams that are read again: raw counts of words only; nothing of contexts at the highest order, where none is one."""
    return [*([0] if k == 1 else []), 1, *(range(2, FIELDS) if k < order else [])]


def requests(block: Block, k: int, order: int, above) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-grams of the block and its share of their figures; ``above``: the answers of order k + 1."""
    at, keys, back, _ = block.grams(k)
    f = np.zeros((FIELDS, len(keys)), np.int64)
    counts = block.train[at] & (block.place[at] > 0)  # the start mark alone is no event
    f[0] = np.bincount(back[counts], minlength=len(keys))
    if k == order:
        f[1] = f[0]
    else:
        begins = counts & (block.place[at] == k - 1)
        f[1] = np.bincount(back[begins], minlength=len(keys))
        owned = above.owned()
        one = block.grams(k + 1)[3][owned]  # an occurrence of each of the owned
        adjusted = above.figure(1)[owned]
        where = np.full(len(block.code), -1, np.int64)
        where[at] = back
        f[1] += np.bincount(where[one], minlength=len(keys))
        ctx = where[one - 1]
        f[2] = np.bincount(ctx, weights=adjusted, minlength=len(keys)).astype(np.int64)
        for j, hit in ((3, adjusted == 1), (4, adjusted == 2), (5, adjusted > 2)):
            f[j] = np.bincount(ctx[hit], minlength=len(keys))
    return keys, f


def joined(parts: list[bytes]) -> bytes:
    return np.array([len(x) for x in parts], np.int64).tobytes() + b"".join(parts)


def body_of(*arrays: np.ndarray) -> bytes:
    return joined([packed(a) for a in arrays])


def of_body(b: bytes, i: int, dtypes) -> np.ndarray:
    """The i-th array of a body."""
    size = np.frombuffer(b[:8 * len(dtypes)], np.int64)
    start = 8 * len(dtypes) + int(size[:i].sum())
    return unpacked(b[start:start + int(size[i])], dtypes[i])


KEY = [np.uint64] + [np.uint32, np.uint32, np.uint64, np.uint32, np.uint32, np.uint32]
ANSWER = KEY[1:] + [np.uint8]


def shards_for(tokens: int, least: int) -> int:
    """Shards of an order: a block asks for at most as many n-grams as it has tokens."""
    return max(8, least, -(-tokens // SHARD_TOKENS))


def requests_of(rows: DataFrame, k: int, order: int, shards: int) -> DataFrame:
    """Blocks (with their answers of order k + 1) -> requests of order k by shard."""
    cuts = bounds(shards)

    def work(batches):
        for block, above, p in _blocks(batches, [k + 1] if k < order else []):
            keys, f = requests(block, k, order, above.get(k + 1))
            edge = np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)]))
            figures = [v.astype(d) if i in sent(k, order) else np.zeros(0, d) for i, (v, d) in enumerate(zip(f, KEY[1:]))]
            out = [(p, k, s, body_of(np.diff(keys[x:y], prepend=U(0)), *(v[x:y] for v in figures))) for s, (x, y) in enumerate(zip(edge[:-1], edge[1:])) if y > x]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["p", "level", "shard", "body"])

    return rows.mapInArrow(freed(work), ANSWERS)


class Answers:
    """What the shards answered a block for one order; figures are unpacked when they are asked for."""

    def __init__(self, bodies):
        self.bodies = [b for _, b in sorted(bodies, key=lambda x: x[0])]

    def figure(self, i: int) -> np.ndarray:
        return np.concatenate([of_body(b, i, ANSWER) for b in self.bodies]).astype(np.int64)

    def owned(self) -> np.ndarray:
        return self.figure(FIELDS).astype(bool)


def _blocks(batches, levels):
    """Blocks in rows sorted by p, each followed by its answers: yields (block, {level: answers}, p)."""
    now = None

    def finish():
        block, bodies, p = now
        return block, {k: Answers(bodies.get(k, [])) for k in levels}, p

    for b in batches:
        for r in b.to_pylist():
            if r.get("body") is None:
                if now:
                    yield finish()
                now = (Block(r["ids"], r["held"], r["lens"], r["words"], r["idx"]), {}, r["p"])
            else:
                now[1].setdefault(r["level"], []).append((r["shard"], r["body"]))
    if now:
        yield finish()


def answers_of(asked: DataFrame, order: int) -> DataFrame:
    """Add up each shard's requests; a row per asking block, and one with p = -1 holding the shard's counts of counts."""

    def work(t: pa.Table) -> pa.Table:
        ps, level, shard, bodies = (t.column(c).to_pylist() for c in ("p", "level", "shard", "body"))
        asked_for = [np.cumsum(of_body(b, 0, KEY)) for b in bodies]
        edge = np.cumsum([0, *(len(x) for x in asked_for)])
        keys, back = np.unique(np.concatenate(asked_for), return_inverse=True)
        del asked_for
        parts, words = [[] for _ in bodies], [0, 0]
        for i in range(FIELDS):  # one figure at a time; sums stay far below 2^53
            if i not in sent(level[0], order):
                for part in parts:
                    part.append(packed(np.zeros(0, ANSWER[i])))
                continue
            v = np.concatenate([of_body(b, i + 1, KEY) for b in bodies])
            total = np.bincount(back, weights=v, minlength=len(keys)).astype(np.int64)
            if i == 0:
                words = [total.sum(), (total > 0).sum()]
            elif i == 1:
                stat = [*((total == c).sum() for c in (1, 2, 3, 4)), total.sum(), (total > 2).sum(), *words]
                counted = total > 0
            for part, x, y in zip(parts, edge[:-1], edge[1:]):
                part.append(packed(total[back[x:y]].astype(ANSWER[i])))
        first = np.full(len(keys), len(back), np.int64)
        np.minimum.at(first, back, np.arange(len(back)))
        owner = np.zeros(len(back), np.uint8)
        owner[first[counted]] = 1
        for part, x, y in zip(parts, edge[:-1], edge[1:]):
            part.append(packed(owner[x:y]))
        out = [joined(part) for part in parts] + [np.array(stat, np.int64).tobytes()]
        return pa.table({"p": pa.array([*ps, -1]), "level": pa.array([*level, level[0]], pa.int32()), "shard": pa.array([*shard, shard[0]], pa.int32()), "body": pa.array(out, pa.binary())})

    return asked.groupBy("shard").applyInArrow(work, ANSWERS)


def figures(answers: DataFrame) -> np.ndarray:
    """The counts of counts of one order: one short row per shard comes back."""
    rows = answers.where("p = -1").select("body").collect()
    return np.sum([np.frombuffer(bytes(r.body), np.int64) for r in rows], axis=0) if rows else np.zeros(8, np.int64)


def discounts(stat: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more; where counts of counts are too thin, half, one and one and a half."""
    n1, n2, n3, n4 = (float(x) for x in stat[:4])
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(x, 0.05), c) for x, c in zip(d, (1.0, 2.0, 3.0)))])


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays in a file that has no name any more, mapped into memory; counts in 4 bytes where they fit."""
    arrays = [a.astype(np.uint32) if a.dtype == np.int64 and a.max(initial=0) < 1 << 32 else np.ascontiguousarray(a) for a in arrays]
    if not len(arrays[0]):
        return arrays
    with tempfile.TemporaryFile() as f:
        for a in arrays:
            f.write(a.tobytes())
        f.flush()
        ends = np.cumsum([a.nbytes for a in arrays])
        return [np.memmap(f, a.dtype, "r", int(e) - a.nbytes, a.shape) for a, e in zip(arrays, ends)]


def scores(block: Block, slices: dict, order: int, stats: dict[int, np.ndarray]):
    """Per text: tokens, known tokens, base score, score (log10)."""
    n_train, vocabulary = int(stats[1][6]), int(stats[1][7])
    event = np.flatnonzero(block.place > 0)
    prob = np.full(len(block.code), 1.0 / (vocabulary + 1))
    raw, context = None, None
    for k in range(1, order + 1):
        at, own, back, _ = block.grams(k)
        # the slice of the model: sorted fingerprints, and of the highest order only the counts
        keys, *values = mapped([own, *(slices[k].figure(i) for i in sent(k, order))])
        values = dict(zip(sent(k, order), values))
        found = np.searchsorted(keys, own)
        figure = lambda v: v[found].astype(np.int64)
        d = discounts(stats[k])
        a = figure(values[1])
        left = np.maximum(a - d[np.minimum(a, 3)], 0)[back]
        if k == 1:
            raw = figure(values[0])[back]
            total = float(stats[1][4])
            if total:
                rest = float(d[1] * stats[1][0] + d[2] * stats[1][1] + d[3] * stats[1][5])
                prob = left / total + rest / total * prob
        else:
            s, share = (v[at - 1] for v in context(d))
            prob[at] = np.where(s > 0, (left + share * prob[at]) / np.maximum(s, 1), prob[at])
        if k < order:
            def context(d, at=at, back=back, n=[figure(values[i]) for i in range(2, FIELDS)]):
                """Of the k-gram ending at a position, as a context: its total and what discounting leaves for the order below."""
                total, share = np.zeros(len(block.code)), np.zeros(len(block.code))
                total[at], share[at] = n[0][back], (d[1] * n[1] + d[2] * n[2] + d[3] * n[3])[back]
                return total, share
    base = np.zeros(len(block.code))
    base[event] = np.log10((raw[event] + 1.0) / (n_train + vocabulary + 1.0))
    full = np.zeros(len(block.code))
    full[event] = np.log10(prob[event])
    known = np.zeros(len(block.code), np.int64)
    known[event] = raw[event] > 0
    return block.size - 1, *(np.add.reduceat(x, block.first) for x in (known, base, full))


#: Shuffle files of a write go when it is done: the table is in the shared folder then, and no later job reads them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def score_texts(docs: DataFrame, held, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    blocks = blocks_of(docs, held)
    blocks_path = written(blocks, "blocks")
    blocks = spark.read.schema(blocks.schema).parquet(blocks_path)
    shards = shards_for(blocks.agg(F.sum("tokens").alias("n")).first().n or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the orders are written in a session of their own, so that its setting meets no other job
    writer = session_with(spark, {CLEANUP: "true"})
    paths, stats = {}, {}

    def with_answers(of: SparkSession, levels):
        read = lambda path, schema: of.read.schema(schema).parquet(path)
        rows = read(blocks_path, blocks.schema).selectExpr("*", "cast(null as int) level", "cast(null as int) shard", "cast(null as binary) body")
        for k in levels:
            rows = rows.unionByName(read(paths[k], ANSWERS).where("p >= 0"), allowMissingColumns=True)
        return rows.repartition("p").sortWithinPartitions("p", F.col("shard").asc_nulls_first()) if levels else rows

    for k in range(order, 0, -1):
        paths[k] = written(answers_of(requests_of(with_answers(writer, [k + 1] if k < order else []), k, order, shards), order), f"order{k}")
        stats[k] = figures(spark.read.schema(ANSWERS).parquet(paths[k]))

    def work(batches):
        for block, slices, _ in _blocks(batches, range(1, order + 1)):
            n, known, base, full = scores(block, slices, order, stats)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), pa.array(block.held), pa.array(n), pa.array(known), pa.array(np.full(len(n), int(stats[1][6]))), pa.array(base), pa.array(full)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return with_answers(spark, range(1, order + 1)).mapInArrow(freed(work), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score_texts(table(spark, sf_dir, "documents"), held)
