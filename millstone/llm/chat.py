"""Operator 1: chat formatting by event-sourced reconstruction (columns only).

A log holds events per conversation and turn.  Kinds: ``message`` (a whole
message), ``delta`` (streamed text, appended to the turn's last message, or
the start of one), ``edit`` (replaces the turn's text) and ``regenerate``
(drops what the turn held and starts again with its own text).  Events of a
turn, of whatever kind, are folded in one order of ``seq``, the messages of a
conversation in order of ``turn``, then rendered.

Defined cases: NULL kind is ``message``; NULL text or role is empty; a NULL
conv_id or turn is a value of its own that sorts first; repeated ``message``
rows stay separate messages, those of one turn in the order of (seq, role,
text); other events with equal seq fold after them in the order of (text,
kind); an edit or regenerate without a role takes that of the latest event
before it that has one; an empty log gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.llm.common import table

IM_START, IM_END = "<|im_start|>", "<|im_end|>"
EVENT_COLS = ["conv_id", "turn", "seq", "kind", "role", "text"]


def message_events(conversations: DataFrame) -> DataFrame:
    """A table of whole messages as a log."""
    return conversations.select("conv_id", "turn", F.lit(0).cast("long").alias("seq"),
                                F.lit("message").alias("kind"), "role", "text")


def fold_messages(events: DataFrame) -> DataFrame:
    """Log -> (conv_id, turn, messages array<struct<role, text>>)."""
    kind = F.coalesce(F.lower("kind"), F.lit("message"))
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    e = events.select("conv_id", "turn", F.coalesce("seq", F.lit(-1).cast("long")).alias("seq"),
                      kind.alias("kind"), role.alias("role"), text.alias("text"))
    e = e.where(F.col("kind").isin("message", "delta", "edit", "regenerate"))
    part = F.col("kind") != "message"
    turns = e.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct(
        "seq", part.alias("part"), F.when(part, "").otherwise(F.col("role")).alias("by"), "text", "kind", "role"))).alias("log"))
    # the log from its last reset on, then the places where its messages start
    turns = turns.withColumn("reset", F.expr("""coalesce(array_max(filter(sequence(1, size(log)),
        i -> log[i - 1].kind IN ('edit', 'regenerate'))), 0)"""))
    turns = turns.withColumn("rest", F.expr("slice(log, greatest(reset, 1), size(log))"))
    turns = turns.withColumn("role", F.expr("""CASE WHEN reset > 0 AND rest[0].role = '' THEN coalesce(get(
        filter(reverse(slice(log, 1, reset)), e -> e.role <> ''), 0).role, '') ELSE rest[0].role END"""))
    turns = turns.withColumn("starts", F.expr("""filter(sequence(0, size(rest) - 1),
        i -> i = 0 OR rest[i].kind = 'message')"""))
    return turns.select("conv_id", "turn", F.expr("""
        transform(starts, (a, k) -> struct(CASE WHEN a = 0 THEN role ELSE rest[a].role END AS role,
            array_join(transform(slice(rest, a + 1, coalesce(get(starts, k + 1), size(rest)) - a),
                                 e -> e.text), '') AS text))
    """).alias("messages"))


def escape(c: Column) -> Column:
    """No control string survives in the result, and ``unescape`` undoes it."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(c, F.lit("<|"), F.lit("<\\|"))


def escape_role(c: Column) -> Column:
    """A role is one line: its line ends are escaped as well."""
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape(c: Column) -> Column:
    """Escapes are a backslash and one character; pairs of backslashes are cut
    first, so that what remains of a backslash starts an escape."""
    parts = F.split(c, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(
        F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def format_chats(events: DataFrame) -> DataFrame:
    """Log -> one row per conversation: conv_id, formatted, loss_mask (run
    lengths over ``formatted``: array<struct<chars, loss>>, three per message:
    header, text, footer; loss marks assistant texts)."""
    turns = fold_messages(events)
    conv = turns.groupBy("conv_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "messages"))), lambda t: t["messages"])).alias("messages"))
    conv = conv.select("conv_id", F.transform("messages", lambda m: F.struct(
        F.concat(F.lit(IM_START), escape_role(m["role"]), F.lit("\n")).alias("head"),
        escape(m["text"]).alias("body"), (m["role"] == "assistant").alias("loss"))).alias("parts"))
    return conv.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(IM_END + "\n"))),
                     "").alias("formatted"),
        F.flatten(F.transform("parts", lambda p: F.array(
            F.struct(F.length(p["head"]).alias("chars"), F.lit(False).alias("loss")),
            F.struct(F.length(p["body"]).alias("chars"), p["loss"].alias("loss")),
            F.struct(F.lit(len(IM_END) + 1).alias("chars"), F.lit(False).alias("loss"))))).alias("loss_mask"))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """Inverse of ``format_chats``: adds ``turns`` array<struct<role, text,
    loss>>, read from ``formatted`` and ``loss_mask`` alone."""
    pieces = F.expr(r"split(formatted, '<\\|im_end\\|>\n', -1)")
    d = formatted.withColumn("pieces", pieces)
    d = d.withColumn("pieces", F.slice("pieces", F.lit(1), F.size("pieces") - 1))
    return d.withColumn("turns", F.transform("pieces", lambda p, i: F.struct(
        unescape(F.substring_index(F.substring(p, len(IM_START) + 1, 2147483647), "\n", 1)).alias("role"),
        unescape(p.substr(F.instr(p, "\n") + 1, F.length(p))).alias("text"),
        F.col("loss_mask")[i * 3 + 1]["loss"].alias("loss")))).drop("pieces")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold control strings."""
    ctl = f"{IM_END}{IM_START}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ctl).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    d = parse_chats(format_chats(message_events(rows)))
    turns_text = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss_text = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return d.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(turns_text, 256).alias("turns_sha256"),
                    F.length(loss_text).cast("long").alias("loss_chars"),
                    F.sha2(loss_text, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|'))
          + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + 24 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
