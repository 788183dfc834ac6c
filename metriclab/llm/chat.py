"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log has a row per event of a conversation: whole messages, streamed deltas,
edits and regenerations.  Events are dealt out by conversation and block of turns,
sorted by sequence and folded into final messages, which are then rendered with a
template.  The template's marks cannot occur in the rendered texts: they are
escaped, and the escape can be undone.

Conversations are rendered in blocks of ``block_turns`` turns, so that one very
long conversation is folded and rendered by many tasks; its blocks in order, put
together, are its rendered text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of public chat templates; each is escaped in a text.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Kinds of events in the order in which events of equal sequence are taken.
KINDS = ("message", "regenerate", "edit", "delta")


@dataclass(frozen=True)
class Template:
    """Marks around a turn.  A backslash after its first character makes a control string plain."""

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    control: tuple[str, ...] = CONTROL
    trained_role: str = "assistant"

    def escaped(self, text: Column) -> Column:
        """Backslashes are doubled, and every control string gets one after its first character."""
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in sorted({*self.control, self.start, self.middle, self.end}))
        return F.regexp_replace(doubled, f"({heads})", "$1\\\\")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.start), self.escaped(role), F.lit(self.middle), self.escaped(text), F.lit(self.end))

    @property
    def pattern(self) -> str:
        """One rendered turn: group 1 is the escaped role, group 2 the escaped text."""
        return f"(?s){re.escape(self.start)}(.*?){re.escape(self.middle)}(.*?){re.escape(self.end)}"


def as_log(messages: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as a log of whole messages."""
    return messages.select("conv_id", F.col("turn").alias("seq"), "turn", F.lit("message").alias("kind"), "role", "text")


def folded(log: DataFrame, block_turns: int = 64) -> DataFrame:
    """(conv_id, block, turn, part, role, text): the final messages of a log.

    ``log`` has conv_id, seq, turn, kind, role, text.  A ``message`` opens a message
    of its turn, so repeated rows are messages of their own; an ``edit`` or a
    ``regenerate`` throws away what the turn's message holds so far and starts it
    again with its text; a ``delta`` adds its text.  An unknown or null kind counts as
    ``delta``.  Null text and role are empty; the message has the role of the first of
    its events that names one.  Events of equal sequence stand by kind, role and
    text.  Rows of null conversation belong together; null turns come first.
    """
    turn = F.coalesce(F.col("turn"), F.lit(-1))
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.coalesce("kind", F.lit("delta"))), F.lit(0))
    events = log.select(
        "conv_id", "turn", F.floor(turn / F.lit(block_turns)).alias("block"), "seq", F.when(rank == 0, F.lit(len(KINDS))).otherwise(rank).cast("int").alias("rank"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("conv_id", "block")
    order = Window.partitionBy("conv_id", "block", "turn").orderBy("seq", "rank", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)  # by rows: equal events count one after the other
    events = events.withColumns({
        "at": F.row_number().over(order),
        "part": F.sum((F.col("rank") == 1).cast("int")).over(so_far),
        "start": F.sum((F.col("rank") < len(KINDS)).cast("int")).over(so_far),
    })
    pieces = events.groupBy("conv_id", "block", "turn", "part", "start").agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("events"))
    role = F.get(F.filter(F.col("events.role"), lambda r: r != ""), F.lit(0))
    pieces = pieces.select("conv_id", "block", "turn", "part", "start", role.alias("role"), F.array_join(F.col("events.text"), "").alias("text"))
    named = F.min(F.when(F.col("role").isNotNull(), F.struct("start", "role")))["role"]
    last = F.max(F.struct("start", "text"))["text"]
    return pieces.groupBy("conv_id", "block", "turn", "part").agg(F.coalesce(named, F.lit("")).alias("role"), last.alias("text"))


def rendered(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, block, formatted, n_turns, spans) from ``folded`` messages.

    ``spans`` lists (start, size) in code points of the trained texts in ``formatted``.
    """
    body = template.turn(F.col("role"), F.col("text"))
    trained = F.col("role") == template.trained_role
    own = messages.select(
        "conv_id", "block", F.col("turn"), F.col("part"), body.alias("body"), trained.alias("trained"),
        (F.length(template.escaped(F.col("role"))) + len(template.start) + len(template.middle)).alias("skip"), F.length(template.escaped(F.col("text"))).alias("size"),
    )
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "part", "body")
    own = own.withColumn("place", F.row_number().over(order)).withColumn("begin", F.sum(F.length("body")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("body"))
    grouped = own.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "body"))).alias("bodies"),
        F.sort_array(F.collect_list(F.when(F.col("trained"), F.struct((F.col("begin") + F.col("skip")).alias("start"), F.col("size").cast("long").alias("size"))))).alias("spans"),
        F.count("*").alias("n_turns"),
    )
    return grouped.select("conv_id", "block", F.array_join(F.col("bodies.body"), "").alias("formatted"), "n_turns", "spans")


def digests(blocks: DataFrame, template: Template = Template()) -> DataFrame:
    """What the rendered text says, read back from it: a row per conversation.

    Turns are found by the template's marks, the trained text by the spans; both are
    unescaped.  A conversation's texts meet in one row because the digests are of all of it.
    """
    roles, texts = (F.regexp_extract_all("formatted", F.lit(template.pattern), F.lit(k)) for k in (1, 2))
    said = F.zip_with(roles, texts, lambda r, t: F.concat(template.unescaped(r), F.lit("\n"), template.unescaped(t), F.lit("\n")))
    cut = F.transform("spans", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["size"].cast("int")))
    read = blocks.select(
        "conv_id", "block", F.size(texts).alias("n"), F.array_join(said, "").alias("said"),
        template.unescaped(F.array_join(cut, "")).alias("loss"), F.length("formatted").alias("chars"),
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "said", "loss")))
    out = read.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), parts.alias("parts"), F.sum("chars").cast("long").alias("formatted_chars"))
    said, loss = F.array_join(F.col("parts.said"), ""), F.array_join(F.col("parts.loss"), "")
    return out.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def chat_formatted(log: DataFrame, template: Template = Template(), block_turns: int = 64) -> DataFrame:
    """Blocks of rendered conversations from a log; see ``folded`` and ``rendered``."""
    return rendered(folded(log, block_turns), template)


#: DuckDB: the digests from the table itself and the lengths from the template's rule.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM c),
e AS (SELECT *, length(role) + length(text)
      + 2 * (length(role) - length(replace(role, '\', '')) + length(text) - length(replace(text, '\', ''))) / 2
      + len(regexp_extract_all(role, '<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
      + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) + 32 AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
