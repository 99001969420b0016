"""SentencePiece encoding and decoding by a distinct-chunk table.

Where no piece of a model crosses a whitespace marker (checked on the model), segmentation never looks past a
marked word.  Each task keeps a bounded table of the distinct marked words it has met, segments each once with the
library, and joins the ids back by position with array takes.  Decoding looks pieces up by id and
concatenates their bytes.  Models whose pieces may cross markers are encoded text by text.

Null and empty texts have no ids and decode to an empty text.  Rows keep their order and number, ties and repeated rows are
encoded alike, an empty table gives no rows, and other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.base import freed, table
from ledgerweave.llm.pieces import MARK, WordTable, encoder, model_bytes, processor, ragged, separable, word_slices

MODEL = "piece_bpe_32k.model"


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>) of each row of ``docs`` (doc_id, text), without begin or end ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(freed(encoding(model_bytes(model_path))), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the text the library's decode(ids) gives; null ids decode to an empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(freed(decoding(model_bytes(model_path))), f"doc_id {kind}, ids array<int>, decoded string")


def encode_and_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """``decode`` of ``encode``, one after the other in one Python worker."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    model = model_bytes(model_path)
    first, second = encoding(model), decoding(model)
    return docs.select("doc_id", "text").mapInArrow(freed(lambda batches: second(first(batches))), f"doc_id {kind}, ids array<int>, decoded string")


def encoding(model: bytes):
    split = separable(model)

    def work(batches):
        sp = processor(model)
        words = WordTable(encoder(sp, split))
        for b in batches:
            for lo, hi, data, offs, start, end in word_slices(b.column(1), split):
                at, n = words.lookup(data, start, end)
                cuts = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(start, offs)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ragged(words.flat, at, n)))], names=["doc_id", "ids"])

    return work


def decoding(model: bytes):
    def work(batches):
        sp = processor(model)
        n = sp.get_piece_size()
        raw = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        pieces = pa.array(raw, pa.large_binary())
        # what needs more than its bytes: unknown ids, and bytes (a text may hold half a character)
        odd = np.array([sp.is_byte(i) and raw[i][0] >= 0x80 or sp.is_unknown(i) or sp.is_control(i) for i in range(n)])
        leads = np.array([sp.id_to_piece(i).startswith(MARK) for i in range(n)])  # whose first marker is dropped at the start of a text
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                ids, lens = part.column(1).flatten().to_numpy(), part.column(1).value_lengths().fill_null(0).to_numpy()
                cuts = np.concatenate(([0], np.cumsum(lens)))
                got = pieces.take(pa.array(ids))
                _, offs, data = got.buffers()
                offs = np.frombuffer(offs, np.int64)[:len(ids) + 1]
                raw_data = data.to_pybytes() if data is not None else b""
                strange = np.concatenate(([0], np.cumsum(odd[ids])))[cuts]
                out = []
                for r in range(len(lens)):
                    if strange[r + 1] > strange[r]:
                        out.append(sp.decode(ids[cuts[r]:cuts[r + 1]].tolist()))
                    else:
                        t = raw_data[offs[cuts[r]]:offs[cuts[r + 1]]].decode()
                        out.append(t[1:] if cuts[r + 1] > cuts[r] and leads[ids[cuts[r]]] else t)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string())], names=["doc_id", "ids", "decoded"])

    return work


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path(MODEL)
    both = encode_and_decode(table(spark, sf_dir, "documents"), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
