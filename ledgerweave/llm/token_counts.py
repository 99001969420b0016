"""Token counts with a whole-token shortcut.

Before any text is read, every piece that is a whole marked word is put through the library once: those that come back as
exactly themselves are *proved* to be one token wherever they stand as a marked word.  Counting then is a lookup of each
marked word's fingerprint among the proved ones (one token each); only the rest is merged by the library, each
distinct word once per task (a bounded table).  Byte-level and character-level vocabularies need
a pre-tokenizer split of their own; this operator handles piece models whose pieces do not cross whitespace markers
(checked on the model), and counts text by text otherwise.

Null and empty texts have 0 tokens; repeated rows and ties are counted alike; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.arrays import Prints
from ledgerweave.llm.base import table
from ledgerweave.llm.pieces import MARK, WordTable, encoder, model_bytes, processor, separable, word_slices

MODEL = "piece_bpe_32k.model"
LIMIT = 4096


def proved_words(model: bytes) -> list[bytes]:
    """Vocabulary strings that are a marked word and encode alone as one token, in the form texts are read in."""
    sp = processor(model)
    words = []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or not p.startswith(MARK):
            continue
        words.append((p.replace(MARK, " ").encode(), i))
    alone = encoder(sp, True)([w for w, _ in words])
    return [w for (w, i), ids in zip(words, alone) if ids == [i]]


def prints_of(words: list[bytes]) -> np.ndarray:
    cuts = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    return np.sort(Prints(np.frombuffer(b"".join(words), np.uint8)).spans(cuts[:-1], cuts[1:]))


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens long) of each row of ``docs`` (doc_id, text), without begin or end ids."""
    model = model_bytes(model_path)
    split = separable(model)
    proved = prints_of(proved_words(model)) if split else np.zeros(0, np.uint64)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        value = encoder(processor(model), split)
        rest = WordTable(lambda words: [[len(i)] for i in value(words)])
        for b in batches:
            for lo, hi, data, offs, start, end in word_slices(b.column(1), split):
                n = np.ones(len(start), np.int64)
                other = np.ones(len(start), bool)
                if len(proved) and len(start):
                    h = Prints(data).spans(start, end)
                    other = proved[np.minimum(np.searchsorted(proved, h), len(proved) - 1)] != h
                at, _ = rest.lookup(data, start[other], end[other])
                n[other] = rest.flat[at]
                total = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(start, offs)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(total))], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    sized = count_sized(docs, public_tokenizers.path(MODEL))
    return sized.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


def count_sized(docs: DataFrame, model_path: str) -> DataFrame:
    """``count_tokens`` with n_bytes, the UTF-8 length of the text, carried along in the row's own id field."""
    row = F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = count_tokens(docs.select(row.alias("doc_id"), "text"), model_path)
    return out.select("doc_id.doc_id", "doc_id.n_bytes", "n_tokens")
