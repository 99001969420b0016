"""Phrase collocation mining with mergeable Misra-Gries summaries.

Phrases are the runs of 1 to 4 words inside a piece of text (pieces end at punctuation and line ends), counted per lang.

1. Every task sums the phrases of its texts by fingerprint and hands the sums, dealt by the fingerprint's leading bits to hash
   partitions, on as rows.  Partitions are as many as keep the occurrences of one (its mass) near ``MASS``.
2. Per partition the summaries are merged into one of ``mass // threshold + 1`` counters: where there are more, the count of the first
   one too many is taken off all, and what is not above it goes.  All that is taken off a phrase stays below the threshold, so each
   phrase that occurs ``threshold`` times or more is left; those whose upper bound is lower go.
3. A second pass over all texts counts exactly, as strings, the phrases whose fingerprint is left (a bit filter of bounded size;
   what passes it wrongly only costs work), and the exact threshold applies.

Scores, cuts and the drop of phrases inside longer ones are joins of the exact table.  Of two adjacent words the parts of a phrase that
occurs often enough do so too, so every part is in that table.

Null and empty texts have no words; a null lang is ``und``; repeated rows count as often as they stand; ties are ordered by
phrase; an empty table gives no rows; other columns are ignored.  A text must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.llm.arrays import LOWER, Prints, mix, text_chunks
from ledgerweave.llm.base import freed, key_filter, saved, table
from ledgerweave.llm.pieces import ragged

LONGEST = 4
THRESHOLD = 30
CONTAINED_PERCENT = 80
TOP = 2000
UNKNOWN = "und"
#: Phrase occurrences of a hash partition (about), and phrase occurrences a byte of text gives at most, nearly.
MASS, PER_BYTE = 1 << 22, 0.75
#: Partitions a task deals its sums to; more are reached in a second step.
FAN = 4096
#: Sums a task or a merge holds at least before they are put together.
HELD = 1 << 19
#: Bytes of text handled at once.
SLICE = 1 << 20
#: Bits of the filter of the second pass, for each phrase left and at most.
BITS_EACH, MOST_BITS = 128, 1 << 28

U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
FACTORS = mix(np.arange(1, LONGEST + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


class Words:
    """The words of some texts in order: ``ids`` (equal for equal words of one lang), ``run`` (words left in the piece, itself included)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lang_of_row: np.ndarray):
        data = LOWER[data]
        inside = ~(SEPARATOR | BREAK)[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offs] = True
        start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
        end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        self.n = n = len(start)
        if not n:
            return
        row = np.searchsorted(offs, start, "right") - 1
        breaks = np.concatenate(([0], np.cumsum(BREAK[data])))
        joined = (row[1:] == row[:-1]) & (breaks[start[1:]] == breaks[end[:-1]])
        last = np.flatnonzero(np.append(~joined, True))
        self.run = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1
        size = end - start
        cuts = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
        packed = np.ascontiguousarray(data[inside])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(packed)]).dictionary_encode()
        self.words = words.dictionary
        word, lang = words.indices.to_numpy(), lang_of_row[row]
        pair, self.ids = np.unique(lang * len(self.words) + word, return_inverse=True)
        self.word_of, self.lang_of = pair % len(self.words), pair // len(self.words)
        self.packed, self.cuts = packed, cuts

    def starts(self, n: int) -> np.ndarray:
        """Places at which a phrase of n words starts."""
        return np.flatnonzero(self.run >= n)

    def prints(self, lang_prints: np.ndarray) -> np.ndarray:
        """A fingerprint of each id."""
        _, offs, data = self.words.buffers()
        offs = np.frombuffer(offs, np.int64)[self.words.offset:self.words.offset + len(self.words) + 1]
        h = Prints(np.frombuffer(data, np.uint8)[:offs[-1]]).spans(offs[:-1], offs[1:])
        return mix(h[self.word_of] ^ lang_prints[self.lang_of])


def phrase_prints(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the phrases of n words at ``at``, from those of the words."""
    out = np.full(len(at), U(n), U)
    for j in range(n):
        out += h[at + j] * FACTORS[j]
    return mix(out)


def _slices(batch: pa.RecordBatch, limit: int):
    """(langs as indices, lang values, their fingerprints, words) of slices of a batch (lang, text)."""
    langs = batch.column(0).dictionary_encode()
    values = [v.as_py() for v in langs.dictionary]
    raw = [v.encode() for v in values]
    cuts = np.cumsum([0, *map(len, raw)]).astype(np.int64)
    prints = Prints(np.frombuffer(b"".join(raw), np.uint8)).spans(cuts[:-1], cuts[1:])
    index = langs.indices.to_numpy().astype(np.int64)
    for lo, hi, data, offs in text_chunks(batch.column(1), limit):
        words = Words(data, offs, index[lo:hi])
        if words.n:
            yield values, prints, words


def summed(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts (each one if not given)."""
    k = np.concatenate(keys)
    if counts is None:
        k.sort()
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))[:len(k)]
        return k[first], np.diff(np.append(first, len(k)))
    c = np.concatenate(counts)
    o = np.argsort(k, kind="stable")
    k, c = k[o], c[o]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))[:len(k)]
    return k[first], np.add.reduceat(c, first) if len(first) else c


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters (None: no limit), merged from others."""

    def __init__(self, capacity: int | None = None, held: int | None = None):
        self.capacity, self.held = capacity, max(held or HELD, 2 * (capacity or 0))
        self.keys, self.counts, self.size, self.off = [], [], 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.capacity is not None and self.size > self.held:
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, U), np.zeros(0, np.int64)
        k, c = summed(self.keys, self.counts)
        if self.capacity is not None and len(k) > self.capacity:
            less = np.partition(c, len(c) - self.capacity - 1)[len(c) - self.capacity - 1]  # the first one too many, from above
            left = c > less
            k, c, self.off = k[left], c[left] - less, self.off + int(less)
        self.keys, self.counts, self.size = [k], [c], len(k)
        return k, c

    def frequent(self, threshold: int) -> np.ndarray:
        """Keys that may have ``threshold`` occurrences."""
        k, c = self.compact()
        return k[c + self.off >= threshold]


def planes(x: np.ndarray) -> bytes:
    """Whole numbers byte by byte of equal weight, so that bytes that are mostly equal stand together and compress."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def keys_of(raw: bytes, kind) -> np.ndarray:
    """Sorted keys from the planes of their differences."""
    return np.cumsum(from_planes(raw, kind), dtype=U)


ENTRIES = "p long, mass long, lang string, words long, keys binary, counts binary"


def _entry_rows(k: np.ndarray, c: np.ndarray, low: int, totals: dict | None = None) -> pa.RecordBatch:
    """Rows of sorted keys dealt by the bits above ``low``, each with its mass; ``totals``: words by lang, as rows of their own."""
    part = k >> U(low)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))[:len(k)]
    cuts = [*first.tolist(), len(k)]
    inner = (k & U((1 << low) - 1)).astype(np.uint32 if low <= 32 else np.uint64)
    c32 = c.astype(np.uint32)  # a task's sums are handed on long before they pass 32 bits
    spans = list(zip(cuts[:-1], cuts[1:]))
    totals = totals or {}
    z = len(totals)
    return pa.RecordBatch.from_arrays([
        pa.array([int(part[a]) for a, _ in spans] + [-1] * z, pa.int64()),
        pa.array([int(c[a:b].sum()) for a, b in spans] + [0] * z, pa.int64()),
        pa.array([None] * len(spans) + list(totals), pa.string()),
        pa.array([None] * len(spans) + list(totals.values()), pa.int64()),
        pa.array([planes(np.diff(inner[a:b], prepend=inner.dtype.type(0))) for a, b in spans] + [None] * z, pa.binary()),
        pa.array([planes(c32[a:b]) for a, b in spans] + [None] * z, pa.binary()),
    ], names=["p", "mass", "lang", "words", "keys", "counts"])


def summaries(docs: DataFrame, bits: int, longest: int = LONGEST, fan: int = FAN) -> DataFrame:
    """Rows of ENTRIES of ``docs`` (lang, text): summed fingerprints of ``bits`` + 32 bits dealt to 2^bits partitions."""
    first = min(bits, fan.bit_length() - 1)
    second = bits - first

    def count(batches):
        held, totals = Summary(), {}
        for b in batches:
            for values, prints, words in _slices(b, SLICE):
                h = words.prints(prints)[words.ids]
                keys = [phrase_prints(h, words.starts(n), n) >> U(32 - bits) for n in range(1, longest + 1)]
                held.add(*summed(keys))
                for i, m in enumerate(np.bincount(words.lang_of[words.ids], minlength=len(values)).tolist()):
                    totals[values[i]] = totals.get(values[i], 0) + m
                if held.size > HELD:
                    k, c = held.compact()
                    if 2 * len(k) > HELD:
                        yield _entry_rows(k, c, 32 + second)
                        held = Summary()
        yield _entry_rows(*held.compact(), 32 + second, totals)

    out = docs.mapInArrow(freed(count), ENTRIES)
    if not second:
        return out

    def deal(batches):
        held = Summary()
        for b in batches:
            yield b.filter(pc.less(b.column(0), 0))
            for part, keys, counts in zip(*(b.column(c).to_pylist() for c in ("p", "keys", "counts"))):
                if part >= 0:
                    held.add(keys_of(keys, np.uint64) | U(part << (32 + second)), from_planes(counts, np.uint32).astype(np.int64))
                if held.size > HELD:
                    yield _entry_rows(*held.compact(), 32)
                    held = Summary()
        yield _entry_rows(*held.compact(), 32)

    # rows of a leading part come together, so that each hands on long runs of its inner partitions
    return out.repartition("p").mapInArrow(freed(deal), ENTRIES)


def survivors(entries: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(key long): fingerprints, partition bits first, of all phrases that may occur ``threshold`` times."""
    entries = entries.where("p >= 0")
    mass = entries.groupBy("p").agg(F.sum("mass").alias("total"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = p = None
        for b in batches:
            for part, total, keys, counts in zip(*(b.column(c).to_pylist() for c in ("p", "total", "keys", "counts"))):
                p, summary = part, summary or Summary(total // threshold + 1)
                summary.add(keys_of(keys, np.uint32), from_planes(counts, np.uint32).astype(np.int64))
        if summary:
            k = summary.frequent(threshold) | U(p << 32)
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64))], names=["key"])

    return entries.join(mass, "p").select("p", "total", "keys", "counts").groupBy("p").applyInArrow(merge, "key long")


def exact_counts(docs: DataFrame, keys: DataFrame, bits: int, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """(lang, words, phrase, f): exact counts of the phrases of ``docs`` (lang, text) with f >= threshold, all of whose fingerprints are in ``keys``."""
    wanted = max(1, keys.count())
    size = min(MOST_BITS, max(1 << 20, 1 << (BITS_EACH * wanted - 1).bit_length()))
    sent = docs.sparkSession.sparkContext.broadcast(key_filter(keys, "key", size))

    def count(batches):
        for b in batches:
            for values, prints, words in _slices(b, SLICE):
                h = words.prints(prints)[words.ids]
                gram, width = words.ids, len(words.word_of)
                grams = {1: gram}
                for n in range(1, longest + 1):
                    at = words.starts(n)
                    if n == 2:  # equal pairs of ids get one number, so that longer phrases are pairs of numbers too
                        pair = np.zeros(words.n, np.int64)
                        _, pair[at] = np.unique(gram[at] * width + gram[at + 1], return_inverse=True)
                        grams[2] = pair
                    at = at[sent.value.has(phrase_prints(h, at, n) >> U(32 - bits))]
                    if not len(at):
                        continue
                    left = grams[min(n, 2)]
                    key = left[at] if n < 3 else left[at] * words.n + (gram[at + 2] if n == 3 else left[at + 2])
                    _, one, c = np.unique(key, return_index=True, return_counts=True)
                    yield _phrases(words, at[one], n, c, values)

    schema = "lang string, words int, phrase string, f long"
    found = docs.mapInArrow(freed(count), schema)
    return found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= threshold)


def _phrases(words: Words, at: np.ndarray, n: int, counts: np.ndarray, langs: list[str]) -> pa.RecordBatch:
    """The phrases of n words at ``at``, words joined by one space, with their counts."""
    cuts, size = words.cuts, words.cuts[at + n] - words.cuts[at] + n - 1
    offs = np.concatenate(([0], np.cumsum(size)))
    text = np.full(int(offs[-1]), 0x20, np.uint8)
    to = offs[:-1].copy()
    for j in range(n):
        m = cuts[at + j + 1] - cuts[at + j]
        first = np.cumsum(m) - m
        text[np.repeat(to - first, m) + np.arange(int(m.sum()))] = ragged(words.packed, cuts[at + j], m)
        to += m + 1
    phrase = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())
    lang = pa.array(langs, pa.string()).take(pa.array(words.lang_of[words.ids[at]]))
    return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(at), n, np.int32)), phrase, pa.array(counts.astype(np.int64))], names=["lang", "words", "phrase", "f"])


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of every phrase of 1 to ``longest`` (4 at most) words with f >= threshold, and (lang, n): words by lang."""
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"phrases have 1 to {LONGEST} words")
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    bits = max(0, int(size * PER_BYTE / MASS).bit_length())
    entries = saved(summaries(docs, bits, longest), "summaries")
    keys = saved(survivors(entries, threshold), "survivors")
    counts = saved(exact_counts(docs, keys, bits, threshold, longest), "phrases")
    return counts, entries.where("p < 0").groupBy("lang").agg(F.sum("words").alias("n"))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, contained_percent: int = CONTAINED_PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's ``top`` phrases of ``docs`` (lang, text)."""
    counts, totals = frequent_phrases(docs, threshold, longest)
    whole = lambda c: f"cast({c} as decimal(20, 0))"
    part = counts.select("lang", "phrase", "f")
    parted = counts.where("words >= 2").withColumn("w", F.split("phrase", " ")).withColumnRenamed("f", "a")
    joined = lambda start, size: f"array_join(slice(w, {start}, {size}), ' ')"
    cuts = parted.withColumn("k", F.expr("explode(sequence(1, words - 1))")).select("lang", "phrase", "a", "k", F.expr(joined("1", "k")).alias("head"), F.expr(joined("k + 1", "words - k")).alias("tail"))
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    # in decimals, as the products may pass 64 bits
    cuts = cuts.withColumn("score", F.expr(f"{whole('2000000')} * {whole('a')} div ({whole('l')} + {whole('r')})"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # every run of words of a longer candidate, with the most frequent such candidate
    runs = parted.where("words >= 3").withColumn("m", F.expr("explode(sequence(2, words - 1))")).withColumn("at", F.expr("explode(sequence(1, words - m + 1))"))
    inside = runs.select("lang", F.expr(joined("at", "m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * {whole('longer')} < {int(contained_percent)} * {whole('a')}"))
    w = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
runs AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM starts, (VALUES (1), (2), (3), (4)) s(m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 30),
halves AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
cut AS (SELECT h.lang, h.phrase, h.a, k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * h.a // (x.f + y.f) AS score
        FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.head JOIN f y ON y.lang = h.lang AND y.phrase = h.tail),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT DISTINCT c.lang, c.a, array_to_string(c.w[i:i + s.m - 1], ' ') AS phrase
          FROM c, (VALUES (2), (3)) s(m), (VALUES (1), (2), (3)) t(i) WHERE s.m < c.m AND i + s.m - 1 <= c.m),
kept AS (SELECT low.* FROM low WHERE NOT EXISTS (SELECT 1 FROM parts WHERE parts.lang = low.lang AND parts.phrase = low.phrase
         AND CAST(100 AS HUGEINT) * parts.a >= CAST(80 AS HUGEINT) * low.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
