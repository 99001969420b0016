"""Chat formatting, piece codec, token counts, source mixing and the n-gram model against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from ledgerweave.llm import chat_format, ngram_lm, piece_codec, source_mix, token_counts

P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "   ", "a", " a", "a ", "a  b", "a   b  ", "▁", "a▁b", "▁▁", "\n", "a\n b", "\t\tx", "</s> <s> <unk>", "a\0b", "　x", "日本語 テキスト", "é é ﬁ",
       "<0x41> <0xE6>", "� �", "😀 😀😀", "x" * 5000, "ab " * 3000, " " * 300 + "end", "the the the", "​‎ ok", "ẞtraße", "\r\n\r\n", "1234567890 3.14", "𐍈 𐍈"]


def frame(spark, texts, extra="score double, n_tokens int"):
    return spark.createDataFrame([(i, t, 0.5, 7) for i, t in enumerate(texts)], f"doc_id long, text string, {extra}").repartition(2)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    signs = "abcdefgh ABC  ▁é日\n\t😀.,-0123"
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 80))) for _ in range(300)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_codec_is_the_library(spark, texts, library):
    got = {r.doc_id: (r.ids, r.decoded) for r in piece_codec.decode(piece_codec.encode(frame(spark, texts), MODEL), MODEL).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert got[i] == (ids, library.decode(ids)), repr(t)


def test_decode_of_any_ids(spark, library):
    rng = random.Random(6)
    ids = [[rng.randrange(0, 400 if k % 2 else 32000) for _ in range(rng.randint(0, 12))] for k in range(300)]
    df = spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>")
    for r in piece_codec.decode(df, MODEL).collect():
        assert r.decoded == library.decode(ids[r.doc_id])


def test_token_counts_are_the_library(spark, texts, library):
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, texts), MODEL).collect()}
    assert got == {i: len(library.encode(t or "")) for i, t in enumerate(texts)}
    assert len(token_counts.proved_words(token_counts.model_bytes(MODEL))) > 10_000


def test_pieces_empty(spark):
    assert token_counts.count_tokens(frame(spark, []), MODEL).count() == 0
    assert piece_codec.decode(piece_codec.encode(frame(spark, []), MODEL), MODEL).count() == 0


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|body|>hi", "<\\|end|> <\\\\|end|>", "[\\INST] [[INST]] <<SYS>>", "", None, "plain\nlines", "é😀" * 10, "<|image|>", "\\", "x" * 20000]
    rows = [(c, t, role, nasty[(c * 7 + t) % len(nasty)], "z") for c in range(1, 12) for t, role in enumerate(["system", "user", "assistant", "assistant", None, "<|turn|>"])]
    rows += [(50, 0, "user", "a", "z"), (50, 0, "user", "a", "z"), (50, None, "assistant", "b", "z"), (None, 1, "user", "c", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    chat = chat_format.format_chat(df.select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("content")))
    got = {r.conv_id: r for r in chat.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                                            chat_format.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    for c in {r[0] for r in rows}:
        own = sorted([(r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c])
        assert [(t.role, t.text) for t in got[c].turns] == [(role, text) for _, role, text in own]
        assert got[c].loss == "".join(text for _, role, text in own if role == "assistant")
        assert got[c].formatted.count("<|turn|>") == len(own) == got[c].formatted.count("<|end|>")


def test_chat_parts(spark):
    part = "struct<kind:string,text:string,ref:string,units:double>"
    rows = [(1, 0, "user", [("text", "see </s>", None, None), ("image", None, "s3://a.png", 4.0), ("text", "and", None, None), ("audio", None, "b.wav", 1.5), ("document", None, "c.pdf", None)]),
            (1, 1, "assistant", [("text", "fine", None, None), ("film", None, "d", 3.0)]), (2, 0, "user", None)]
    got = {r.conv_id: r for r in chat_format.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{part}>")).collect()}
    assert got[1].formatted == ("<|turn|>user<|body|>see <\\/s><|image|>and<|audio|><|document|><|end|><|turn|>assistant<|body|>fine<|attachment|><|end|>")
    assert [(a.kind, a.ref, a.tokens) for a in got[1].attachments] == [("image", "s3://a.png", 1024), ("audio", "b.wav", 38), ("document", "c.pdf", 800), ("film", "d", 3)]
    assert got[1].attachment_tokens == 1865
    (m,) = got[1].mask
    assert got[1].formatted[m.start:m.start + m.length] == "fine<|attachment|>"
    assert got[2].formatted == "<|turn|>user<|body|><|end|>" and got[2].attachments == []


def test_chat_oracle(spark, duck001):
    got = sorted(tuple(r) for r in chat_format.op2_chat_format(spark, "/root/testdata/sf0.01").collect())
    want = duck001.execute(chat_format.OP2_SQL).fetchall()
    assert got == sorted(want)


def mix_rows(seed):
    rng = random.Random(seed)
    names = [None, "b", "a", "é", "zz", "", "hot", "c", "tiny"]
    rows = [(i, rng.choice(names[:-1] + ["hot"] * 5), "w " * rng.randint(0, 60)) for i in range(1500)]
    return rows + [(2000, "tiny", "one"), (2001, "a", None), (2002, "a", ""), (2003, "empty", " "), (3, "b", "x y"), (3, "b", "x y")]


def test_mix_targets(spark, tmp_path):
    rows = mix_rows(1)
    spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, text string, size int").write.parquet(str(tmp_path / "documents.parquet"))
    got = source_mix.op6_source_mix(spark, str(tmp_path)).collect()
    again = source_mix.op6_source_mix(spark, str(tmp_path)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    words = {}
    for _, s, t in rows:
        words[s] = words.get(s, 0) + len(brute.words(t))
    target = brute.water_fill(words)
    size = {(d, len(brute.words(t))): s for d, s, t in rows}
    taken = {}
    for r in got:
        s = size[r.doc_id, r.size]
        assert r.source_size == words[s] and abs(r.target - float(target[s])) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= 1, s


def test_mix_many_sources_join(spark, monkeypatch, tmp_path):
    rows = mix_rows(2)
    spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, text string, size int").write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(map(repr, source_mix.op6_source_mix(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(source_mix, "BROADCAST_ROWS", 1)
    assert sorted(map(repr, source_mix.op6_source_mix(spark, str(tmp_path)).collect())) == want


def test_mix_repeats_rows(spark):
    docs = spark.createDataFrame([(i, "w " * 30, s, 1) for i in range(300) for s in [["a", "b", "c", "d"][i % 4]]], "doc_id long, text string, source string, size int")
    got = source_mix.repeated(docs)
    assert got.columns == docs.columns
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    # weights 5, 2, 1, 5 of 13 over 4 equal sources; none is above three times its size
    assert all(abs(n[s] - 300 * w / 13) <= 1 for s, w in zip("abcd", (5, 2, 1, 5)))
    assert source_mix.repeated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(spark, order):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [None, "", "  ", "One one ONE", "é É"] + [" ".join(vocabulary[min(39, int(rng.expovariate(0.15)))] for _ in range(rng.randint(1, 60))) for _ in range(150)] + ["only here " * 3]
    texts += texts[20:23]
    held = [i % 5 == 2 for i in range(len(texts))]
    df = spark.createDataFrame([(i if i != 9 else None, t, h, 1) for i, (t, h) in enumerate(zip(texts, held))], "doc_id long, text string, h boolean, score int").repartition(3)
    got = {r.doc_id if r.doc_id is not None else 9: r for r in ngram_lm.score_texts(df, F.col("h"), order).collect()}
    want, total = brute.kneser_ney([t for t, h in zip(texts, held) if not h], texts, order)
    assert len(got) == len(texts)
    for i, (n, known, base, score) in enumerate(want):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, held[i])
        assert abs(r.base_score - base) < 1e-9 * max(1, -base) and abs(r.score - score) < 1e-9 * max(1, -score), (i, r.score, score)


def test_language_model_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, "a b c d " * (i % 7 + 1)) for i in range(60)], "doc_id long, text string")
    want = sorted(map(tuple, ngram_lm.score_texts(df.coalesce(1), F.lit(False)).collect()))
    assert want == sorted(map(tuple, ngram_lm.score_texts(df.repartition(7), F.lit(False)).collect()))
    assert ngram_lm.score_texts(df.limit(0), F.lit(False)).count() == 0


def test_language_model_registered_order(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(3, 30))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in ngram_lm.op5_ngram_lm(spark, str(tmp_path)).collect()}
    assert {r.held_out for r in got.values()} == {True, False}
    want, _ = brute.kneser_ney([t for i, t in enumerate(texts) if not got[i].held_out], texts, 3)
    assert all(abs(got[i].score - w[3]) < 1e-9 * max(1, -w[3]) for i, w in enumerate(want))


def test_language_model_shards_follow_the_input(spark, monkeypatch):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, " ".join(str(rng.randrange(500)) for _ in range(80))) for i in range(100)], "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, ngram_lm.score_texts(df, F.lit(False)).collect()))
    n_shards = lambda n: ngram_lm.shards_for(n << 21, 12)
    assert [n_shards(n) for n in (0, 1, 12, 13, 720)] == [12, 12, 12, 13, 720]
    used = []
    real = ngram_lm.figures
    monkeypatch.setattr(ngram_lm, "figures", lambda answers: used.append(answers.where("p = -1").count()) or real(answers))
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 100)
    assert sorted(map(tuple, ngram_lm.score_texts(df, F.lit(False)).collect())) == want
    assert used[0] >= 80  # 8200 tokens, so 82 shards of the highest order, whatever the shuffle partitions
