"""Chat formatting by event-sourced reconstruction (native).

A log row is an event (conv_id, seq, kind, msg, turn, role, text):
  open        message `msg` begins at position `turn` with `role`
  delta       `text` is appended to the message
  edit        `text` replaces what the message has so far
  regenerate  the message starts anew, and every message at a later turn that was opened before
              this event leaves the conversation (it answered the discarded text)
Events are folded in order of seq, messages are ordered by (turn, role, text). A message without
an open event is dropped. Null text is empty, null role is empty, null seq sorts first, a null
conv_id is a conversation of its own, repeated messages stay (they differ in `msg`).

Rendering: each message becomes <|im_start|>role\\ntext<|im_end|>\\n. Inside texts and roles `&`
becomes `&amp;` and `<|` becomes `&lt;|` (roles also: line feed `&#10;`), so a control string can
only come from the template, and reading back undoes it exactly. The loss mask lists for every
assistant message its block number, and start and length (code points) inside that block.

Scale: the log is grouped by (conversation, message) first, then messages by conversation; a
conversation is one output row, so a single conversation must fit a row (any digest over it needs
its whole text in one place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def fold_messages(events: DataFrame) -> DataFrame:
    """One row per message: conv_id, msg, turn, role, text, opened and regenerated (seq)."""
    e = F.struct("seq", "kind", F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def step(so_far: Column, x: Column) -> Column:
        fresh = x.kind.isin("edit", "regenerate", "open")
        text = F.when(x.kind == "regenerate", "").otherwise(x.text)
        return F.when(fresh, F.array(text)).otherwise(F.concat(so_far, F.array(text)))

    opened = F.col("kind") == "open"
    return (
        events.groupBy("conv_id", "msg")
        .agg(
            F.min(F.when(opened, F.col("turn"))).alias("turn"),
            F.coalesce(F.min(F.when(opened, F.col("role"))), F.lit("")).alias("role"),
            F.max(F.when(opened, F.col("seq"))).alias("opened"),
            F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
            F.bool_or(opened).alias("real"),
            F.array_sort(F.collect_list(e)).alias("log"),
        )
        .where("real")
        .withColumn("text", F.array_join(F.aggregate("log", F.array(F.lit("")), step), ""))
        .drop("log", "real")
    )


def conversations(events: DataFrame) -> DataFrame:
    """conv_id, messages: array of (turn, role, text), after edits and regenerations."""
    one = F.struct("turn", "role", "text", "opened", "regenerated")
    grouped = fold_messages(events).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(one)).alias("all"),
        F.collect_list(F.when(F.col("regenerated").isNotNull(), F.struct("turn", "regenerated"))).alias("cuts"),
    )
    alive = F.filter("all", lambda m: ~F.exists("cuts", lambda r: (r.turn < m.turn) & (r.regenerated > m.opened)))
    return grouped.select("conv_id", F.transform(alive, lambda m: F.struct(m.turn.alias("turn"), m.role.alias("role"), m.text.alias("text"))).alias("messages"))


def render(convs: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask."""
    role = lambda m: F.replace(escape(m.role), F.lit("\n"), F.lit("&#10;"))
    block = lambda m: F.concat(F.lit(OPEN), role(m), F.lit("\n"), escape(m.text), F.lit(CLOSE + "\n"))
    mask = F.transform(
        "messages",
        lambda m, i: F.when(
            m.role == "assistant",
            F.struct(i.alias("block"), (F.char_length(role(m)) + len(OPEN) + 1).alias("start"), F.char_length(escape(m.text)).alias("length")),
        ),
    )
    return convs.select(
        "conv_id",
        F.array_join(F.transform("messages", block), "").alias("formatted"),
        F.filter(mask, lambda x: x.isNotNull()).alias("loss_mask"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) parsed from the output, loss_text: the unescaped
    text under the loss mask, concatenated."""
    blocks = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.greatest(F.size(F.split("formatted", r"<\|im_start\|>", -1)) - 1, F.lit(0)))

    def parse(x: Column) -> Column:
        at = F.instr(x, "\n")
        body = F.substr(x, at + 1, F.char_length(x) - at - len(CLOSE) - 1)
        head = F.substr(x, F.lit(1), at - 1)
        return F.struct(unescape(F.replace(head, F.lit("&#10;"), F.lit("\n"))).alias("role"), unescape(body).alias("text"))

    out = rendered.withColumn("blocks", blocks)
    loss = F.transform("loss_mask", lambda s: unescape(F.substr(F.element_at("blocks", s.block + 1), s.start - len(OPEN) + 1, s.length)))
    return out.select("conv_id", "formatted", F.transform("blocks", parse).alias("turns"), F.array_join(loss, "").alias("loss_text"))


def log_of_rows(rows: DataFrame) -> DataFrame:
    """The event log of finished rows (conv_id, turn, role, text): an open event and the text in
    two streamed deltas. Every row is a message of its own, repeated rows too."""
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    kinds = F.array(
        F.struct(F.lit(0).alias("k"), F.lit("open").alias("kind"), F.lit("").alias("text")),
        F.struct(F.lit(1).alias("k"), F.lit("delta").alias("kind"), F.substr(text, F.lit(1), half).alias("text")),
        F.struct(F.lit(2).alias("k"), F.lit("delta").alias("kind"), F.substr(text, half + 1, F.char_length(text)).alias("text")),
    )
    return (
        rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("msg"))
        .select("conv_id", "turn", "role", "msg", F.inline(kinds))
        .withColumn("seq", F.coalesce(F.col("turn"), F.lit(-1)) * 3 + F.col("k"))
        .select("conv_id", "seq", "kind", "msg", "turn", "role", "text")
    )


__all__ = ["escape", "unescape", "fold_messages", "conversations", "render", "read_back", "log_of_rows"]
