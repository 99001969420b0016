"""Chat formatting with typed content parts.

A message's content is an array of parts (kind, text, ref, units).  A visitor over the array flattens it into one body:
text is escaped, an image, audio or document becomes a placeholder in its place, and is recorded as an attachment with its
reference and the tokens the placeholder expands to.  A conversation becomes one string of marked turns plus
a loss mask (spans of the assistant's bodies, in code points).  Control strings inside texts get a backslash
after their first character (and one more if they had some), also where they stand across text parts, so no text can end a turn, and reading back removes it:
the escape is a bijection, checked by the round trip of ``read_back``.

All of it is DataFrame expressions.  A conversation is one row of the result and so is built in one place; the largest must fit
in a task's memory.  Null roles and texts are empty, a null conv_id is one conversation, null turns come first, rows equal in turn
are ordered by role and text, repeated rows are turns of their own, null content or units count as no parts and one unit, unknown kinds
become plain attachments of ``units`` tokens; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.llm.base import table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Tokens that one unit (image tile, second of audio, document page) expands to.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 800}
PART = "struct<kind:string,text:string,ref:string,units:double>"
# control strings: this template's own and those of common ones, without their first character
CONTROLS = r"\|(?:turn|body|end|image|audio|document|attachment|im_start|im_end|endoftext)\|>|/?s>|<SYS>>|</SYS>>|/?INST\]"
ESCAPE = rf"([<\[])(\\*)({CONTROLS})"
UNESCAPE = rf"([<\[])\\(\\*)({CONTROLS})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def text_parts(text: Column) -> Column:
    """Content of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units"))).cast(f"array<{PART}>")


def _placeholder(kind: Column) -> Column:
    return F.when(kind.isin(*TOKENS_PER_UNIT), F.concat(F.lit("<|"), kind, F.lit("|>"))).otherwise(F.lit("<|attachment|>"))


def _tokens(part: Column) -> Column:
    units = F.coalesce(part["units"], F.lit(1.0))
    rate = F.lit(1)
    for k, v in TOKENS_PER_UNIT.items():
        rate = F.when(part["kind"] == k, v).otherwise(rate)
    return F.ceil(units * rate).cast("long")


def visited(content: Column) -> Column:
    """struct(body, attachments array<kind, ref, tokens>) of a content array, in order."""
    parts = F.coalesce(F.filter(content, lambda p: p.isNotNull()), F.array().cast(f"array<{PART}>"))
    is_text = lambda p: F.coalesce(p["kind"], F.lit("")) == "text"
    # text parts that follow each other are one text when they are escaped, so that no control string forms across their border
    said = F.aggregate(parts, F.struct(F.lit("").alias("done"), F.lit("").alias("text")), lambda s, p: F.when(
        is_text(p), F.struct(s["done"].alias("done"), F.concat(s["text"], F.coalesce(p["text"], F.lit(""))).alias("text"))).otherwise(
        F.struct(F.concat(s["done"], escaped(s["text"]), _placeholder(F.coalesce(p["kind"], F.lit("")))).alias("done"), F.lit("").alias("text"))),
        lambda s: F.concat(s["done"], escaped(s["text"])))
    found = F.transform(F.filter(parts, lambda p: ~is_text(p)), lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    return F.struct(said.alias("body"), found.alias("attachments"))


def format_chat(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, content array of parts):

    conv_id, formatted, mask array<start, length> in code points, attachments array<kind, ref, tokens>, attachment_tokens.
    """
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visited(F.col("content")).alias("v"))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY))
    m = m.select("conv_id", "turn", "role", head.alias("head"), "v.body", "v.attachments").withColumn("piece", F.concat("head", "body", F.lit(END)))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    m = m.withColumn("at", F.row_number().over(w)).withColumn("end", F.sum(F.char_length("piece")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    turn = F.struct("at", "piece", "attachments", (F.col("role") == loss_role).alias("loss"),
                    (F.col("end") - F.char_length("piece") + F.char_length("head")).cast("int").alias("start"), F.char_length("body").alias("length"))
    g = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    found = F.flatten("turns.attachments")
    return g.select(
        "conv_id", F.array_join("turns.piece", "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("mask"),
        found.alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"))


def read_back(formatted: Column) -> Column:
    """array<role, text> of a formatted conversation (placeholders stay as they are)."""
    turns = F.split(formatted, r"<\|turn\|>")
    turns = F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(0)))
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.get(F.split(t, r"<\|body\|>"), F.lit(0))).alias("role"),
        unescaped(F.regexp_replace(F.coalesce(F.get(F.split(t, r"<\|body\|>", 2), F.lit(1)), F.lit("")), r"<\|end\|>$", "")).alias("text")))


def masked_text(formatted: Column, mask: Column) -> Column:
    """What the loss mask covers, unescaped, nothing between."""
    return F.array_join(F.transform(mask, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), "")


PROBE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    chat = format_chat(rows.unionByName(probe).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("content")))
    turns = read_back(F.col("formatted"))
    back = chat.select("conv_id", "formatted", turns.alias("turns"), masked_text(F.col("formatted"), F.col("mask")).alias("loss"), "attachment_tokens")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


# the digests from the rows themselves; formatted_chars from the marks and one character per control string
_CONTROL_SQL = CONTROLS.replace("(?:", "(").replace("'", "''")
OP2_SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + {len(TURN + BODY + END)}
    + length(regexp_extract_all(role || chr(1) || text, '[<\[]\\*({_CONTROL_SQL})'))) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""
