"""Toxicity by noisy-channel deobfuscation.

A character model (trigrams of all documents, counted in Spark into a table of fixed size) is the language side; the channel
side says how a letter may have been written: as itself, as a look-alike sign, repeated, or letter by letter with gaps.  Every
suspicious token (signs among letters, three equal letters in a row, two where the word is no known feature, runs of single letters
and signs between spaces or . - _) spans a lattice of sources,
and Viterbi decoding picks the likeliest one.  A classifier then scores the *restored* text: whether words and word
beginnings occur, weighted by a logistic regression.

Learning reads labelled rows of the training fold only, at most ``TRAIN_ROWS`` of them in hash order of doc_id (a
documented bound, so the model's cost does not grow); character counts and scoring cover all documents and whole texts.

Null and empty texts have no words and get the score of the intercept; labels that are null or doubled count once (the
larger); without labels of both kinds the score is the share of label 1 (0.5 without any); repeated rows are scored alike; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.arrays import LOWER, U, Prints, mix, text_chunks, word_spans
from ledgerweave.llm.base import freed, release, saved, table

#: Labelled rows learned from, features kept, and the lengths (bytes) of word beginnings used as features.
TRAIN_ROWS, FEATURES, STEMS = 12_000, 4096, (4, 5, 6, 7, 8)
#: Symbols of the character model: end of a word, letters, anything else.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüÿßœ"
EDGE, OTHER = 0, len(LETTERS) + 1
SYMBOLS = 64
#: Signs and the letters they are written for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "*": "aeiou", "(": "c", "€": "e"}
#: Log probabilities of the channel: a letter as itself, as a look-alike, a letter repeated, a sign meant as itself.
PLAIN, LOOK, REPEAT, SIGN = np.log(0.9), np.log(0.04), np.log(0.02), np.log(0.9)
#: Least letters that are joined when they stand apart, and tokens remembered by a task.
APART, REMEMBERED = 3, 20_000
#: Bytes of text looked at at once.
SLICE = 1 << 18

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = _LETTER[0x80:] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKS if ord(c) < 0x80]] = True
_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in ".-_"]] = True
_CORE = _LETTER.copy()
_CORE[[ord(c) for c in "0123456789@$"]] = True


def symbol_table() -> np.ndarray:
    t = np.full(0x180, OTHER, np.uint8)
    t[[0x20, *range(9, 14)]] = EDGE
    for i, c in enumerate(LETTERS, 1):
        t[ord(c)] = i
        if len(c.upper()) == 1 and ord(c.upper()) < len(t):
            t[ord(c.upper())] = i
    return t


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of symbols over all texts: SYMBOLS^3 numbers, whatever the input."""

    def count(batches):
        known, total = symbol_table(), np.zeros(SYMBOLS ** 3, np.int64)
        for b in batches:
            texts = b.column(0)
            for lo in range(0, b.num_rows, 200):
                joined = "  ".join(t or "" for t in texts.slice(lo, 200).to_pylist()) + "  "
                code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
                s = np.where(code < len(known), known[np.minimum(code, len(known) - 1)], OTHER).astype(np.int32)
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "c"])

    out = np.zeros(SYMBOLS ** 3, np.int64)
    for r in docs.select("text").mapInArrow(freed(count), "i long, c long").groupBy("i").agg(F.sum("c").alias("c")).collect():
        out[r.i] = r.c
    return out


def character_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the third symbol given two, smoothed with those given one and none."""
    c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    one = (c.sum((0, 1)) + 1) / (c.sum() + SYMBOLS)
    two = (c.sum(0) + 5 * one) / (c.sum((0, 2))[:, None] + 5)
    return np.log((c + 5 * two) / (c.sum(2)[:, :, None] + 5)).astype(np.float32)


def sources(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each run of equal characters the strings it may stand for, with channel scores."""
    out = []
    for ch, run in groupby(token.lower()):
        n = len(list(run))
        ways = [(ch * min(n, 2), (PLAIN if ch.isalpha() else SIGN) * min(n, 2))]
        if n > 1 and ch.isalpha():
            ways = [(ch, PLAIN + REPEAT * (n - 1) / 2), (ch * 2, 2 * PLAIN + (REPEAT * (n - 2) / 2))]
        for letter in LOOKS.get(ch, ""):
            ways.append((letter, LOOK + REPEAT * (n - 1) / 2))
            if n > 1:
                ways.append((letter * 2, 2 * LOOK + REPEAT * (n - 2) / 2))
        out.append(ways)
    return out


class Decoder:
    """Viterbi decoding of tokens under the character model; remembers a bounded number of tokens."""

    def __init__(self, model: np.ndarray):
        self.model, self.known, self.memory = model, symbol_table(), {}

    def symbols(self, s: str) -> list[int]:
        return [int(self.known[ord(c)]) if ord(c) < len(self.known) else OTHER for c in s]

    def decode(self, token: str) -> tuple[str, float]:
        """Likeliest source of a token and its score, the word's end included."""
        states = {(EDGE, EDGE): (0.0, None)}  # last two symbols -> score, chain of choices
        for ways in sources(token):
            new = {}
            for text, cost in ways:
                symbols = self.symbols(text)
                for (a, b), (score, chain) in states.items():
                    s = score + cost
                    for c in symbols:
                        s += self.model[a, b, c]
                        a, b = b, c
                    old = new.get((a, b))
                    if old is None or s > old[0]:
                        new[a, b] = (s, (text, chain))
            states = new
        score, chain = max(((v + self.model[a, b, EDGE], chain) for (a, b), (v, chain) in states.items()), key=lambda x: x[0])
        out = []
        while chain:
            text, chain = chain
            out.append(text)
        return "".join(reversed(out)), float(score)

    def restore(self, token: str) -> str:
        """A token restored; of letters with gaps, one word if it is likelier than the letters alone."""
        got = self.memory.get(token)
        if got is None:
            if " " in token:
                joined, together = self.decode(token.replace(" ", ""))
                apart = sum(self.decode(t)[1] for t in token.split(" "))
                got = joined if together + LOOK * 1.5 > apart else token
            else:
                got = self.decode(token)[0]
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[token] = got
        return got


def _cores(data: np.ndarray, offs: np.ndarray):
    """Words without the punctuation around them: start, end, row."""
    s, e, row = word_spans(data, offs)
    if not len(s):
        return s, e, row
    at = np.arange(len(data))
    core = _CORE[data]
    after = np.minimum.accumulate(np.where(core, at, len(data))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(core, at, -1))
    s, e = after[s], before[e - 1] + 1
    ok = s < e
    return s[ok], e[ok], row[ok]


def _prints(data: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature fingerprints of words and their beginnings, with their rows."""
    prints = Prints(LOWER[data])
    h, r = [prints.spans(s, e)], [row]
    for n in STEMS:
        long = e - s > n
        h.append(mix(prints.spans(s[long], s[long] + n) + U(n)))
        r.append(row[long])
    return np.concatenate(h), np.concatenate(r)


def _apart(data: np.ndarray, offs: np.ndarray):
    """Runs of APART or more single characters (letters and signs, a letter among them) between spaces or . - _: their strings, their rows."""
    s, e, row = word_spans(np.where(_GAP[data], np.uint8(0x20), data), offs)
    if not len(s):
        return [], []
    whole = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    single = (whole[e] - whole[s] == 1) & (_LETTER[data[s]] | _SIGN[data[s]])
    cut = np.flatnonzero(np.concatenate(([True], (single[1:] != single[:-1]) | (row[1:] != row[:-1]))))
    size = np.diff(np.concatenate((cut, [len(s)])))
    letters = np.concatenate(([0], np.cumsum(_LETTER[data[s]])))
    raw, words, rows = data.tobytes(), [], []
    run = single[cut] & (size >= APART) & (letters[cut + size] > letters[cut])
    for a, n in zip(cut[run], size[run]):
        words.append(" ".join(raw[x:y].decode("utf-8", "ignore").lower() for x, y in zip(s[a:a + n], e[a:a + n])))
        rows.append(row[a])
    return words, rows


def features(data: np.ndarray, offs: np.ndarray, decoder: Decoder, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(feature fingerprints, rows, restored tokens) of the restored texts; features may repeat.

    With the known features ``keys``, words with doubled letters that are none of them count as written and as restored.
    """
    s, e, row = _cores(data, offs)
    if not len(s):
        return np.zeros(0, U), np.zeros(0, np.int64), 0
    low = LOWER[data]
    total = lambda x: np.concatenate(([0], np.cumsum(x)))
    letters, signs = total(_LETTER[data]), total(_SIGN[data])
    triple = np.zeros(len(data), bool)
    triple[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & (low[2:] < 0x80) & _LETTER[low[2:]]
    triples = total(triple)
    odd = ((signs[e] > signs[s]) & (letters[e] > letters[s])) | ((e - s > 2) & (triples[e] > triples[np.minimum(s + 2, e)]))
    raw = data.tobytes()
    words, rows = [], []
    for i in np.flatnonzero(odd):
        words.append(decoder.restore(raw[s[i]:e[i]].decode("utf-8", "ignore")))
        rows.append(row[i])
    for w, r in zip(*_apart(data, offs)):
        words.append(decoder.restore(w))
        rows.append(r)
    if keys is not None and len(keys):
        double = np.zeros(len(data), bool)
        double[1:] = (low[1:] == low[:-1]) & (low[1:] < 0x80) & _LETTER[low[1:]]
        doubles = total(double)
        at = np.flatnonzero(~odd & (doubles[e] > doubles[np.minimum(s + 1, e)]))
        own = Prints(low).spans(s[at], e[at]) if len(at) else np.zeros(0, U)
        unknown = keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] != own
        at, (_, one, back) = at[unknown], np.unique(own[unknown], return_index=True, return_inverse=True)
        order = np.argsort(back, kind="stable")
        for i, same in zip(one, np.split(order, np.cumsum(np.bincount(back, minlength=len(one)))[:-1])):
            shown = raw[s[at[i]]:e[at[i]]].decode("utf-8", "ignore").lower()
            meant = decoder.restore(shown)
            if meant != shown:
                words.extend([meant] * len(same))
                rows.extend(row[at[same]])
    h, r = _prints(data, s[~odd], e[~odd], row[~odd])
    if words:
        again = [w.encode() for w in words]
        d = np.frombuffer(b"".join(again), np.uint8)
        o = np.concatenate(([0], np.cumsum([len(w) for w in again])))
        s2, e2, which = _cores(d, o)
        if len(s2):
            h2, r2 = _prints(d, s2, e2, np.array(rows)[which])
            h, r = np.concatenate((h, h2)), np.concatenate((r, r2))
    return h, r, len(words)


@dataclass
class Model:
    characters: np.ndarray  # log probabilities
    keys: np.ndarray  # sorted feature fingerprints
    weights: np.ndarray
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model of ``docs`` (doc_id, text; all texts are counted) and ``labels`` (doc_id, label 0/1) to learn from."""
    sc = docs.sparkSession.sparkContext
    characters = character_model(character_counts(docs))
    own = sc.broadcast(characters)
    chosen = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` rows are broadcast; a repeated document is learned from as often as it stands
    sample = saved(docs.select("doc_id", "text").join(F.broadcast(saved(chosen, "chosen")), "doc_id").select("text", "label"), "labelled")
    n = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        p = min(max(n1 / (n1 + n0), 1e-6), 1 - 1e-6) if n1 + n0 else 0.5
        return Model(characters, np.zeros(0, U), np.zeros(0), float(np.log(p / (1 - p))))

    def count(batches):
        decoder, held = Decoder(own.value), []
        for b in batches:
            y = b.column(1).to_numpy()
            for lo, hi, data, offs in text_chunks(b.column(0), SLICE):
                h, r, _ = features(data, offs, decoder)
                o = np.lexsort((h, r))
                h, r = h[o], r[o]
                first = np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])))[:len(h)]
                held.append((h[first], y[lo + r[first]]))
        if held:
            h, y = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            u, at = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.bincount(at[y == 1], minlength=len(u))), pa.array(np.bincount(at[y == 0], minlength=len(u)))], names=["h", "n1", "n0"])

    # the features that tell most: G^2 of presence against the label
    counts = sample.mapInArrow(freed(count), "h long, n1 long, n0 long").groupBy("h").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 + n0 >= 3")
    share = (F.col("n1") + F.col("n0")) / float(n1 + n0)
    part = lambda x, m: F.when(x > 0, x * F.log(x / m)).otherwise(0.0)
    gain = sum(part(F.col(c), n_ * share) + part(n_ - F.col(c), n_ * (1 - share)) for c, n_ in (("n1", float(n1)), ("n0", float(n0))))
    best = counts.withColumn("gain", gain).where("gain > 5").orderBy(F.desc("gain"), "h").limit(FEATURES).select("h").collect()
    keys = np.sort(np.array([r.h for r in best], np.int64).view(U))

    def rows_of(batches):
        decoder = Decoder(own.value)
        for b in batches:
            for lo, hi, data, offs in text_chunks(b.column(0), SLICE):
                found = [[] for _ in range(hi - lo)]
                for r, f in zip(*_hits(data, offs, decoder, keys)):
                    found[r].append(int(f))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), b.column(1).slice(lo, hi - lo)], names=["found", "label"])

    got = sample.mapInArrow(freed(rows_of), "found array<int>, label int").collect()
    weights, intercept = logistic([r.found for r in got], np.array([r.label for r in got], float), len(keys))
    return Model(characters, keys, weights, intercept)


def _hits(data, offs, decoder, keys) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once, of known features."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, r, _ = features(data, offs, decoder, keys)
    p = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    hit = keys[p] == h
    both = np.unique(r[hit] * len(keys) + p[hit])
    return both // len(keys), both % len(keys)


def logistic(rows: list[list[int]], y: np.ndarray, n: int, penalty: float = 0.1, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on present features, by accelerated gradient steps."""
    if not len(y):
        return np.zeros(n), 0.0
    col = np.array([f for r in rows for f in r], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = np.zeros(n), float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, weights=w[col], minlength=len(y))
        d = 1 / (1 + np.exp(-z)) - y
        g = np.append(np.bincount(col, weights=d[row], minlength=n) + penalty * w, d.sum()) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def score(docs: DataFrame, model: Model, keep: str = "doc_id") -> DataFrame:
    """(``keep``, score) of each row of ``docs`` (``keep``, text)."""
    own = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[keep].dataType.simpleString()

    def work(batches):
        m = own.value
        decoder = Decoder(m.characters)
        for b in batches:
            for lo, hi, data, offs in text_chunks(b.column(1), SLICE):
                r, f = _hits(data, offs, decoder, m.keys)
                z = m.intercept + np.bincount(r, weights=m.weights[f] if len(f) else None, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-z)))], names=[keep, "score"])

    return docs.select(keep, "text").mapInArrow(freed(work), f"{keep} {kind}, score double")


def accepted(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (text, more columns) that score below ``limit``; only texts go to Python, and one boolean comes back for each."""
    own = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def below(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = own.value
        decoder = Decoder(m.characters)
        try:
            for col in texts:
                z = np.full(len(col), m.intercept)
                for lo, hi, data, offs in text_chunks(col, SLICE):
                    r, f = _hits(data, offs, decoder, m.keys)
                    if len(f):
                        z[lo:hi] += np.bincount(r, weights=m.weights[f], minlength=hi - lo)
                yield pa.array(1 / (1 + np.exp(-z)) < limit)
        finally:
            decoder.memory.clear()
            release()

    return docs.where(below("text"))


def fold(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(1))


def toxic_model(docs: DataFrame, sf_labels: DataFrame) -> Model:
    """Model learned from the training fold of ``labels``."""
    return fit(docs, sf_labels.where(fold() != 0).select("doc_id", F.col("toxic").alias("label")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = score(docs, toxic_model(docs, table(spark, sf_dir, "labels")))
    return s.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
