"""Piece models: marked words of texts and the checks that allow segmenting them one by one (helpers of two operators)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerweave.llm.arrays import text_chunks

MARK = "▁"
#: Limits of a task's table of distinct marked words: words, and values held for them.
TABLE_WORDS, TABLE_VALUES = 500_000, 4_000_000


def model_bytes(path: str) -> bytes:
    """The model file: about half a megabyte, sent with the task, so executors need no file."""
    with open(path, "rb") as f:
        return f.read()


def processor(model: bytes):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def separable(model: bytes) -> bool:
    """Whether no piece can cross a whitespace marker and the text is used as it is but for markers.

    Then every merge stays inside one marked word (markers, then the other characters up to the next marker).
    """
    from sentencepiece import sentencepiece_model_pb2
    m = sentencepiece_model_pb2.ModelProto()
    m.ParseFromString(model)
    n, t = m.normalizer_spec, m.trainer_spec
    plain = (not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces
             and not t.treat_whitespace_as_suffix and t.model_type == t.BPE)
    return plain and not any(MARK in p.piece.lstrip(MARK) for p in m.pieces)


def marked(col: pa.Array) -> pa.Array:
    """Texts with each marker as one space and the leading marker set; empty texts and nulls stay empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    out = pc.replace_substring(col, MARK, " ")
    return pc.if_else(pc.equal(pc.binary_length(out), 0), out, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), out, pa.scalar("", pa.large_string())))


def marked_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each marked word of texts in ``marked`` form."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    sp = data == 0x20
    first = sp.copy()
    first[1:] &= ~sp[:-1]
    row = offs[:-1][np.diff(offs) > 0]
    first[row] = True
    start = np.flatnonzero(first)
    return start, np.append(start[1:], n)


class WordTable:
    """Values (ragged int32) of the distinct marked words a task has met, compared byte by byte; emptied when it reaches its limits."""

    def __init__(self, value):
        self.value = value  # list of marked words -> list of int lists
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_binary())
        self.start, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, words: pa.Array) -> None:
        got = self.value(words.to_pylist())
        count = np.fromiter(map(len, got), np.int64, len(got))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(count) - count))
        self.count = np.concatenate((self.count, count))
        self.flat = np.concatenate([self.flat, *(np.asarray(g, np.int32) for g in got)])
        self.words = pa.concat_arrays([self.words, words])

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``flat`` and length of the values of each word."""
        if len(self.words) > TABLE_WORDS or len(self.flat) > TABLE_VALUES:
            self.clear()
        if not len(start):
            return start, start
        size = end - start
        if (start[1:] == end[:-1]).all():
            raw = data[start[0]:end[-1]]
        else:
            raw = ragged(data, start, size)
        cuts = np.concatenate(([0], np.cumsum(size)))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        known = pc.index_in(words.dictionary, value_set=self.words)
        new = pc.is_null(known).to_numpy(zero_copy_only=False)
        place = known.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            place[new] = len(self.words) + np.arange(int(new.sum()))
            self.add(words.dictionary.filter(pa.array(new)))
        place = place[words.indices.to_numpy()]
        return self.start[place], self.count[place]


def ragged(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[start:start + count] of each, one after the other."""
    first = np.cumsum(count) - count
    return flat[np.repeat(start - first, count) + np.arange(int(count.sum()))]


def encoder(sp, split: bool):
    """Words in ``marked`` form -> ids, as the library gives them for the text they come from."""
    mark = sp.piece_to_id(MARK)

    def value(words: list[bytes]) -> list[list[int]]:
        # the library puts the leading marker back; a lone marker is what follows a text's last word
        out = sp.encode([w[1:].decode() for w in words], num_threads=1)
        return [i if w != b" " else [mark] for w, i in zip(words, out)]

    return value


def word_slices(col: pa.Array, split: bool):
    """(first row, end row, bytes, offsets, word starts, word ends) of slices of a text column."""
    for k in range(0, len(col), 500):
        for lo, hi, data, offs in text_chunks(marked(col.slice(k, 500))):
            if split:
                start, end = marked_words(data, offs)
            else:  # pieces may cross markers: a whole text is one word
                full = np.diff(offs) > 0
                start, end = offs[:-1][full], offs[1:][full]
            yield k + lo, k + hi, data, offs, start, end
