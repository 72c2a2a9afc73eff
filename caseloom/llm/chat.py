"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as context and that reply, the only trainable
part. Turns after the last reply (or a conversation without any) give one more example that has no trainable part, so
that the formatted text holds every turn and can be read back.

Template: "<|turn|>" role "<|text|>" text "<|end|>" per turn. Inside roles and texts a backslash is doubled and every
control string, of this template or of common others, gets a backslash after its first character; dropping the
backslash before each character restores the text exactly.

Defined results: turns are ordered by turn (nulls first), then role, then text, so repeated turns are kept side by side
in one order; a null role or text counts as empty; roles are compared as they are ("assistant" replies); all turns of a
null conv_id are one conversation, as those of any other conv_id (the query's planted conversation -7 would join turns of
that number in the table); a conversation is one row, so its turns must fit in memory; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of this and other common templates.
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_FIRST_AND_REST = r"<(?=\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _FIRST_AND_REST, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, nth (from 0), formatted, loss_start, loss_length (code points; length null: nothing is trainable)."""
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conversations = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
    shown = F.transform("all", lambda t: F.struct(t.role.alias("role"), escape(t.role).alias("r"), escape(t.text).alias("t")))
    replies = F.filter(F.sequence(F.lit(1), F.size("all")), lambda i: F.element_at("all", i).role == "assistant")
    ends = F.array_distinct(F.concat("replies", F.array(F.size("all"))))
    c = conversations.select("conv_id", "all", shown.alias("shown"), replies.alias("replies"))
    e = c.select("conv_id", "shown", F.posexplode(ends).alias("nth", "upto"))
    target = F.element_at("shown", F.col("upto"))
    trained = target.role == "assistant"
    before = F.array_join(F.transform(F.slice("shown", 1, F.col("upto") - 1), lambda t: F.concat(F.lit(TURN), t.r, F.lit(TEXT), t.t, F.lit(END))), "")
    head = F.concat(before, F.lit(TURN), target.r, F.lit(TEXT))
    return e.select("conv_id", "nth", head.alias("head"), target.t.alias("reply"), trained.alias("trained")).select(
        "conv_id", "nth", F.concat("head", "reply", F.lit(END)).alias("formatted"), F.length("head").alias("loss_start"), F.when(F.col("trained"), F.length("reply")).alias("loss_length")
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    # control strings inside texts are broken by their escapes, so these three only stand where the template put them
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    inner = F.transform(parts, lambda p: F.split(F.substring(p, F.lit(1), F.length(p) - len(END)), r"<\|text\|>", 2))
    return F.transform(inner, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def summary(formatted: DataFrame) -> DataFrame:
    """A row per conversation, from the formatted texts and their loss masks alone: the last example holds all turns."""
    masked = F.when(F.col("loss_length").isNotNull(), unescape(F.expr("substring(formatted, loss_start + 1, loss_length)")))
    x = formatted.select("conv_id", "nth", masked.alias("loss"), F.length("formatted").alias("n"), F.lead("nth").over(W.partitionBy("conv_id").orderBy("nth")).isNull().alias("last"), "formatted")
    x = x.select("conv_id", "nth", "loss", "n", F.when(F.col("last"), read_back(F.col("formatted"))).alias("turns"))
    g = x.groupBy("conv_id").agg(F.sum("n").alias("formatted_chars"), F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("nth", "loss")))).alias("losses"), F.max_by("turns", "nth").alias("turns"))
    loss = F.array_join(F.transform("losses", lambda e: e.loss), "")
    text = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return g.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))


def op7_chat_formatting(spark, sf_dir):
    planted = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return summary(examples(turns.unionByName(more)))


QUERIES = {"op7_chat_formatting": op7_chat_formatting}
_CONTROL_RE = r"<\|turn\|>|<\|text\|>|<\|end\|>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|<</?SYS>>|\[/?INST\]"
ORACLE_SQL = {
    "op7_chat_formatting": rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS size,
  {len(TURN + TEXT + END)} + length(role) + length(text) + length(concat(role, text)) - length(replace(concat(role, text), chr(92), ''))
  + len(regexp_extract_all(role, '{_CONTROL_RE}')) + len(regexp_extract_all(text, '{_CONTROL_RE}')) AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR i = size) AS BIGINT) AS formatted_chars FROM p GROUP BY conv_id"""
}
