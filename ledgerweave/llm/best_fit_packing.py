"""Bulk-synchronous best-fit packing of documents into token sequences.

Texts are tokenized once into pieces of at most ``capacity`` tokens.  Pieces of full length are sequences of their own.  The others are
range-sorted: each has its length and a rank among the pieces of that length.  Open sequences are a table of gaps, sorted the same way:
gap, and rank among the sequences of that gap.  A round then does this for all of them at once:

1. successor sweep: from the longest lengths down, the pieces of a length go to the smallest gap that holds them, as many of them as the
   gap holds, then to the next gap.  A sequence takes pieces of one length a round.  The sweep goes over lengths and gaps, not over
   pieces, so it takes at most ``capacity`` steps a side whatever the number of documents, and its result is a table of as few rows:
   these ranks of a length go to those ranks of a gap;
2. conflicts (many pieces with one successor) are settled by rank: that table, broadcast, gives each piece the rank of its gap, and a
   join with the gap table the sequence and the offset in it;
3. the gaps that took pieces shrink and get new ranks, and as many sequences are opened as the tokens left need beyond the gaps
   that can still hold one (never more than any packing of the rest into these gaps would need).

Rounds end when every piece is placed.  Pieces and gaps are written tables, so a lost executor costs a task.

Tokens: where the tokenizer is a plain byte-level BPE, texts are cut at places where its pre-tokenizer always starts a new token, equal
chunks (compared byte by byte) are encoded once per Python worker, while its bounded table holds them, and joined back by position; a text that holds an added token's string, and
every text under another tokenizer, is encoded as it is.

Null and empty texts are one piece that holds the end id only; ties are ordered by rank, which follows row order; repeated rows are
pieces of their own, also with a null or repeated doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.llm.arrays import SPACE, text_chunks
from ledgerweave.llm.base import freed, saved, table
from ledgerweave.llm.pieces import ragged

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END = 2
#: Bytes of text tokenized at once, and distinct chunks remembered by a worker.
SLICE, REMEMBERED = 4 << 20, 600_000
#: Parts that the pieces of one length are ranked in: at least, and one for so many pieces.
PARTS, PART_ROWS = 64, 1 << 14

GRAPHIC = np.zeros(256, bool)
GRAPHIC[0x21:0x7F] = True
#: First bytes of characters that are no white space: none of U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
SOLID = GRAPHIC.copy()
SOLID[0xC3:0xE0] = True
SOLID[0xE4:0xF5] = True

WORD_HEADS = pa.array([bytes([0x20, b]) for b in np.flatnonzero(SOLID).tolist()], pa.large_binary())

# ---------------------------------------------------------------- tokens

def splittable(tokenizer_json: str) -> bool:
    """Whether a text may be cut at ``chunk_starts`` without changing its ids."""
    t = json.loads(tokenizer_json)
    pre = t.get("pre_tokenizer") or {}
    plain = not any(a.get(k) for a in t.get("added_tokens") or () for k in ("lstrip", "rstrip", "normalized", "single_word"))
    return (plain and t.get("normalizer") is None and t.get("truncation") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and t["model"]["type"] == "BPE")


def chunk_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places where a token of the byte-level pre-tokenizer starts in any case, the starts of the non-empty texts included.

    A run of white space starts one after a graphic ASCII character.  So does a space before a character that is no white space: the
    pre-tokenizer gives it to that character, and the white space before it is a token of its own.
    """
    first = offs[:-1][np.diff(offs) > 0]
    start = np.zeros(len(data), bool)
    if len(data) > 1:
        start[1:] = SPACE[data[1:]] & GRAPHIC[data[:-1]]
        start[:-1] |= (data[:-1] == 0x20) & SOLID[data[1:]]
        last = offs[1:][np.diff(offs) > 0] - 1
        start[last] &= SPACE[data[last]] & GRAPHIC[data[np.maximum(last - 1, 0)]]  # what follows is another text
    start[first] = True
    return np.flatnonzero(start)


class ChunkIds:
    """Ids of texts; those of the distinct chunks met are kept, up to a limit.  Place 0 holds the end id."""

    def __init__(self, tokenizer_json: str, end: int):
        from tokenizers import Tokenizer
        self.tokenizer, self.end = Tokenizer.from_str(tokenizer_json), end
        self.added = [a["content"] for a in json.loads(tokenizer_json).get("added_tokens") or ()]
        # an added token between two chunks keeps them apart as the ends of a text would
        self.between = self.added[0] if self.added and splittable(tokenizer_json) else None
        self.between_id = self.tokenizer.token_to_id(self.between) if self.between else None
        # a character of a byte-level token stands for a byte
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False) if self.between else {}
        self.token_bytes = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        self.token_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.chunks, self.met = pa.array([], pa.large_binary()), np.zeros(0, bool)
        self.flat, self.start, self.count = np.array([self.end], np.int32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def thin(self) -> None:
        """Keep the chunks that were met again since they came in."""
        at = np.concatenate(([0], np.flatnonzero(self.met) + 1))
        self.chunks, self.met = self.chunks.filter(pa.array(self.met)), np.zeros(len(at) - 1, bool)
        self.flat, self.count = ragged(self.flat, self.start[at], self.count[at]), self.count[at]
        self.start = np.cumsum(self.count) - self.count

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined_ids(self, chunks: pa.Array, between: str) -> np.ndarray:
        """Ids of chunks joined to one text."""
        one = pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks.cast(pa.binary()))
        return np.array(self.encode([str(pc.binary_join(one, between.encode())[0].as_buffer(), "utf-8")])[0], np.int32)

    def places(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Places in ``start`` and ``count`` of the chunks that begin at ``start``."""
        if len(self.chunks) > REMEMBERED:
            self.thin()
        cuts = np.append(start, len(data))
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        known = pc.index_in(chunks.dictionary, value_set=self.chunks)
        new = pc.is_null(known).to_numpy(zero_copy_only=False)
        place = known.fill_null(0).to_numpy().astype(np.int64) + 1
        self.met[place[~new] - 1] = True
        if new.any():
            # which of them begin with a space and a character that is none: their first two bytes
            head = pc.binary_slice(chunks.dictionary, 0, 2)
            word = new & pc.is_in(head, value_set=WORD_HEADS).to_numpy(zero_copy_only=False)
            for which, between in ((word, ""), (new & ~word, self.between)):
                if not which.any():
                    continue
                fresh = chunks.dictionary.filter(pa.array(which))
                ids = self.joined_ids(fresh, between)
                if between:
                    border = np.flatnonzero(np.append(ids, self.between_id) == self.between_id)
                    count, ids = np.diff(border, prepend=-1) - 1, ids[ids != self.between_id]
                else:  # a token starts with each chunk: the bytes of the tokens tell which are whose
                    upto = np.cumsum(self.token_bytes[ids])
                    count = np.diff(np.searchsorted(upto, np.cumsum(pc.binary_length(fresh).to_numpy()), "right"), prepend=0)
                place[which] = len(self.chunks) + 1 + np.arange(len(fresh))
                self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(count) - count))
                self.count = np.concatenate((self.count, count))
                self.flat = np.concatenate((self.flat, ids))
                self.chunks, self.met = pa.concat_arrays([self.chunks, fresh]), np.append(self.met, np.zeros(len(fresh), bool))
        return place[chunks.indices.to_numpy()]

    def cut_ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other with the end id behind each, their offsets), by chunks."""
        start = chunk_starts(data, offs)
        at = self.places(data, start) if len(start) else start
        chunks = np.bincount(np.searchsorted(offs, start, "right") - 1, minlength=len(offs) - 1)
        at = np.insert(at, np.cumsum(chunks), 0)
        count = self.count[at]
        return ragged(self.flat, self.start[at], count), np.concatenate(([0], np.cumsum(count)[np.cumsum(chunks + 1) - 1]))

    def whole_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same, each text encoded as it is."""
        ids = [[*i, self.end] for i in self.encode([t or "" for t in texts.to_pylist()])]
        return np.concatenate([np.array(i, np.int32) for i in ids]), np.cumsum([0, *map(len, ids)])


#: The table of this Python worker; its tasks, one after the other, share it.
_OWN: dict[tuple[int, int], ChunkIds] = {}


def own_chunk_ids(tokenizer_json: str, end: int) -> ChunkIds:
    key = hash(tokenizer_json), end
    if key not in _OWN:
        _OWN.clear()
        _OWN[key] = ChunkIds(tokenizer_json, end)
    return _OWN[key]


def id_slices(texts: pa.Array, chunks: ChunkIds):
    """(first row, end row, ids, their offsets) of slices of a text column."""
    whole = np.full(len(texts), chunks.between is None)
    for a in chunks.added if chunks.between else ():
        whole |= pc.fill_null(pc.match_substring(texts, a), False).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(whole[1:] != whole[:-1]) + 1).tolist(), len(texts)] if len(texts) else [0]
    for lo, hi in zip(edges[:-1], edges[1:]):
        col = texts.slice(lo, hi - lo)
        for a, b, data, offs in text_chunks(col, SLICE):
            yield lo + a, lo + b, *(chunks.whole_ids(col.slice(a, b - a)) if whole[lo] else chunks.cut_ids(data, offs))


def piece_cuts(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece, start, length) of the pieces of texts: of a longer one, all but the first are full."""
    pieces = -(-lengths // capacity)
    row = np.repeat(np.arange(len(lengths)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = lengths - (pieces - 1) * capacity
    start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
    return row, piece, start, np.where(piece > 0, capacity, head[row])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], row) of every piece of ``docs`` (doc_id, text); ``row`` is its own."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a few MB
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def work(batches):
        chunks = own_chunk_ids(sent.value, end)
        for b in batches:
            for lo, hi, ids, offs in id_slices(b.column(1), chunks):
                row, piece, start, length = piece_cuts(np.diff(offs), capacity)
                at = offs[row] + start
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = np.fromiter((zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(at.tolist(), (at + length).tolist())), np.int64, len(at))
                cols = [b.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                if with_ids:  # pieces follow each other without gaps
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(freed(work), schema).withColumn("row", F.monotonically_increasing_id())


# ---------------------------------------------------------------- packing

def sweep(left: dict[int, int], gaps: dict[int, int]) -> tuple[list[tuple], list[tuple]]:
    """One successor sweep over ``left`` (length -> pieces) and ``gaps`` (gap -> sequences).

    Returns moves (length, rank from, rank to, gap, gap's rank from, pieces a sequence) and shrinks (gap, rank from, rank to, new gap);
    ranks of pieces count from the first one not placed.
    """
    open_, used = sorted(g for g, n in gaps.items() if n), dict.fromkeys(gaps, 0)
    moves, shrinks = [], []
    for length in sorted(left, reverse=True):
        placed = 0
        while placed < left[length]:
            i = bisect.bisect_left(open_, length)
            if i == len(open_):
                break
            gap, first = open_[i], used[open_[i]]
            each = gap // length
            taken = min(gaps[gap] - first, -(-(left[length] - placed) // each))
            pieces = min(left[length] - placed, taken * each)
            moves.append((length, placed, placed + pieces, gap, first, each))
            whole, rest = divmod(pieces, each)
            if whole:
                shrinks.append((gap, first, first + whole, gap - each * length))
            if rest:
                shrinks.append((gap, first + whole, first + taken, gap - rest * length))
            used[gap], placed = first + taken, placed + pieces
            if used[gap] == gaps[gap]:
                open_.pop(i)
    shrinks += [(g, used[g], n, g) for g, n in gaps.items() if used[g] < n]
    return moves, shrinks


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with their rank (from 0) among those of their length, which is cut into parts so that no length is ranked in one task."""
    parts = max(PARTS, -(-pieces.count() // PART_ROWS))
    cut = pieces.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (cut.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
             .select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first")))
    local = cut.withColumn("_local", F.row_number().over(Window.partitionBy("length", "_part").orderBy("row")) - 1)
    return local.join(first, ["length", "_part"]).withColumn("rank", (F.col("_first") + F.col("_local")).cast("long")).drop("_part", "_first", "_local")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length 1 to ``capacity``, row unique, more columns) with sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = saved(pieces, "pieces").select(F.struct("*").alias("piece_"), "length", "row")  # columns of the pieces clash with none here
    # full pieces have odd sequence ids, the others even ones
    full = pieces.where(F.col("length") == capacity).select("piece_", (2 * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = saved(ranked(pieces.where(F.col("length") < capacity)), "ranked")
    left = {int(r.length): r.n for r in rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a length
    done = dict.fromkeys(left, 0)
    opened = max(-(-sum(length * n for length, n in left.items()) // capacity), sum(n for length, n in left.items() if 2 * length > capacity))
    gaps, placed = {capacity: opened}, []
    bins = spark.range(opened).select(F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("gap"), F.col("id").alias("gap_rank"))
    while left:
        moves, shrinks = sweep(left, gaps)
        m = F.broadcast(spark.createDataFrame([(n, done[n] + a, done[n] + b, g, f, e) for n, a, b, g, f, e in moves],
                                              "_length long, _from long, _to long, gap long, _gap_from long, _each long"))
        fits = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to"))
        place = F.col("rank") - F.col("_from")
        asked = (rest.join(m, fits).withColumn("gap_rank", F.col("_gap_from") + F.expr("(rank - _from) div _each"))
                 .withColumn("offset", F.lit(capacity) - F.col("gap") + place % F.col("_each") * F.col("length")))
        found = asked.join(bins, ["gap", "gap_rank"]).select("piece_", (2 * F.col("bin")).alias("sequence_id"), "offset")
        placed.append(saved(found, "placed"))
        moved: dict[int, int] = {}
        for length, a, b, *_ in moves:
            moved[length] = moved.get(length, 0) + b - a
        for length, n in moved.items():
            done[length] += n
            left[length] -= n
        left = {length: n for length, n in left.items() if n}
        if not left:
            break
        new, turns = {}, []
        for g, a, b, to in shrinks:
            if to:
                turns.append((g, a, b, to, new.get(to, 0)))
                new[to] = new.get(to, 0) + b - a
        tokens, least = sum(length * n for length, n in left.items()), min(left)
        more = max(0, -(-(tokens - sum(g * n for g, n in new.items() if g >= least)) // capacity))
        t = F.broadcast(spark.createDataFrame(turns, "_gap long, _from long, _to long, _new long, _new_from long"))
        same = (F.col("gap") == F.col("_gap")) & (F.col("gap_rank") >= F.col("_from")) & (F.col("gap_rank") < F.col("_to"))
        kept = bins.join(t, same).select("bin", F.col("_new").alias("gap"), (F.col("_new_from") + F.col("gap_rank") - F.col("_from")).alias("gap_rank"))
        added = spark.range(more).select((F.col("id") + opened).alias("bin"), F.lit(capacity).cast("long").alias("gap"), (F.col("id") + new.get(capacity, 0)).alias("gap_rank"))
        bins = saved(kept.unionByName(added), "gaps")
        new[capacity], opened, gaps = new.get(capacity, 0) + more, opened + more, new
    out = full
    for p in placed:
        out = out.unionByName(p)
    return out.select("piece_.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts) of ``packed`` pieces with ids: the token sequences themselves, and where their pieces start."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    s = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return s.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
                    F.transform("parts", lambda p: p["offset"]).alias("starts"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
