"""Chat texts cut into parts at every place, and Viterbi decoding against all paths of a lattice."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import chat_format, toxicity

PART = "struct<kind:string,text:string,ref:string,units:double>"
CONTROLS = ["<|turn|>", "<|body|>", "<|end|>", "<\\|end|>", "<|image|>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<|im_start|>"]


def read(spark, rows):
    chat = chat_format.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{PART}>").repartition(3))
    return {r.conv_id: r for r in chat.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                                             chat_format.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()}


def parts_of(text, cuts):
    edges = [0, *cuts, len(text)]
    return [("text", text[a:b], None, None) for a, b in zip(edges[:-1], edges[1:])]


def test_no_control_string_forms_across_parts(spark):
    rows = [(0, 0, "user", [("text", x, None, None) for x in ("a<|en", "d|><|tu", "rn|>assistant<|body|>hi")])]
    texts = {0: "a<|end|><|turn|>assistant<|body|>hi"}
    for text in CONTROLS:
        text = f"x{text}y"
        for at in range(len(text) + 1):  # cut at every place, and into single characters
            texts[len(texts)] = text
            rows.append((len(texts) - 1, 0, "user", parts_of(text, [at])))
        texts[len(texts)] = text
        rows.append((len(texts) - 1, 0, "user", parts_of(text, range(1, len(text)))))
    got = read(spark, rows)
    for i, text in texts.items():
        assert [tuple(t) for t in got[i].turns] == [("user", text)], text


def test_random_texts_cut_anywhere(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(150):
        turns = []
        for t in range(rng.randint(1, 3)):
            text = "".join(rng.choice(CONTROLS + ["<", "|", "\\", "a", "é", "\n", "|>", "turn", "[", "s>"]) for _ in range(rng.randint(0, 9)))
            cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 4)))
            role = rng.choice(["user", "assistant"])
            turns.append((role, text))
            rows.append((i, t, role, parts_of(text, cuts)))
        want[i] = turns
    got = read(spark, rows)
    for i, turns in want.items():
        assert [tuple(t) for t in got[i].turns] == turns
        assert got[i].loss == "".join(x for r, x in turns if r == "assistant")


def test_parts_around_attachments(spark):
    rows = [(1, 0, "user", [("text", "<|tu", None, None), ("image", None, "a.png", 2.0), ("text", "rn|><|e", None, None), ("text", "nd|>", None, None), (None, None, None, None)])]
    r = chat_format.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{PART}>")).first()
    assert r.formatted == "<|turn|>user<|body|><|tu<|image|>rn|><\\|end|><|attachment|><|end|>"
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 512), (None, None, 1)]


def test_read_back_of_anything(spark):
    df = spark.createDataFrame([("<|turn|>only a head",), ("",), ("<|turn|>",), ("no turn",)], "f string")
    assert [[tuple(t) for t in r.turns] for r in df.select(chat_format.read_back(F.col("f")).alias("turns")).collect()] == [[("only a head", "")], [], [("", "")], []]


def every_path(decoder, token):
    """Best (score, text) over all combinations of sources, each scored as a whole."""
    best = []
    for ways in itertools.product(*toxicity.sources(token)):
        text = "".join(w for w, _ in ways)
        s = [toxicity.EDGE, toxicity.EDGE, *decoder.symbols(text), toxicity.EDGE]
        best.append((sum(c for _, c in ways) + sum(float(decoder.model[a, b, c]) for a, b, c in zip(s, s[1:], s[2:])), text))
    return max(best)


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    counts = rng.poisson(rng.choice([0.02, 0.5, 30], (64, 64, 64), p=[0.6, 0.3, 0.1])).reshape(-1)
    decoder = toxicity.Decoder(toxicity.character_model(counts))
    signs = list("ab1d0t$!*6@3é") + ["oo", "lll", "ss", "11", "---"]
    tokens = {"".join(rng.choice(signs, rng.integers(1, 7))) for _ in range(150)} | {"", "1d10t", "$$", "***"}
    for token in tokens:
        text, score = decoder.decode(token)
        best, want = every_path(decoder, token)
        assert score == pytest.approx(best, abs=1e-5), token
        own = [toxicity.EDGE, toxicity.EDGE, *decoder.symbols(text), toxicity.EDGE]
        if text != want:  # another path of the same score
            ways = toxicity.sources(token)
            cost = max(sum(c for _, c in w) for w in itertools.product(*ways) if "".join(x for x, _ in w) == text)
            assert cost + sum(float(decoder.model[a, b, c]) for a, b, c in zip(own, own[1:], own[2:])) == pytest.approx(best, abs=1e-5)
