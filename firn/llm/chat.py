"""Chat formatting by event-sourced reconstruction (DataFrame only).

A log has rows ``(conv_id, seq, message, kind, role, text)``.  Sorted by
``seq`` inside a conversation it folds into final messages:

* ``message`` sets a message's role and text,
* ``delta`` appends to its text,
* ``edit`` replaces its text,
* ``regenerate`` replaces its text (deltas may follow) and drops every message that
  began after it and before the regeneration.

The rendering marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``.  A control
string inside a text gets a backslash after its first character, and one
that has n backslashes there already gets n + 1, so unescaping is exact.

Scale: the fold groups by (conversation, message); text is gathered per
message, then per conversation, because a rendered conversation is one
string.  That string is the only thing that grows with a conversation.

Defined cases: null text is empty, a null role is an empty role, a null
conv_id is a conversation of its own; an unknown or null kind counts as
``message``; equal rows of a log are one delivery; of rows of one message with the same ``seq`` all texts stand, in order
of text; very long texts are rendered whole; other columns of a log are not read, whatever their names; a log without rows gives no
conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates, first character apart.
_CONTROL = r"(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"
ESCAPE = (rf"([<\[])(\\*){_CONTROL}", r"$1\\$2$3")
UNESCAPE = (rf"([<\[])\\(\\*){_CONTROL}", r"$1$2$3")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE[0]), F.lit(ESCAPE[1]))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE[0]), F.lit(UNESCAPE[1]))


def escape_role(role: Column) -> Column:
    """Roles stand on the marker's line, so line ends are escaped too."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")  # at each escaped backslash
    return unescape(F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\"))


def fold_messages(log: DataFrame) -> DataFrame:
    """``(conv_id, first_seq, message, role, text)``: the messages that stand at the end of the log."""
    log = log.select("conv_id", "seq", "message",
                     F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind"))
                     .otherwise(F.lit("message")).alias("kind"), "role",
                     F.coalesce("text", F.lit("")).alias("text")).distinct()
    of_message = Window.partitionBy("conv_id", "message")
    live = (log.withColumn("reset", F.max(F.when(F.col("kind") != "delta", F.col("seq"))).over(of_message))
            .withColumn("first_seq", F.min("seq").over(of_message)))
    said = F.when(F.col("reset").isNull() | (F.col("seq") >= F.col("reset")), F.struct(
        "seq", (F.col("kind") == "delta").alias("later"), "text"))
    messages = live.groupBy("conv_id", "message", "first_seq").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.array_join(F.transform(F.sort_array(F.collect_list(said)), lambda x: x["text"]), "").alias("text"))
    earlier = (Window.partitionBy("conv_id").orderBy("first_seq")
               .rangeBetween(Window.unboundedPreceding, -1))
    cut = F.max("regenerated").over(earlier)
    return (messages.withColumn("cut", cut).where(F.col("cut").isNull() | (F.col("cut") < F.col("first_seq")))
            .select("conv_id", "first_seq", "message", F.coalesce("role", F.lit("")).alias("role"), "text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_spans)``: spans are the (start, length) in
    code points of the texts that a loss counts, without markers."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = messages.select("conv_id", "first_seq", "message", "role", head.alias("head"), body.alias("body"))
    before = (Window.partitionBy("conv_id").orderBy("first_seq", "message")
              .rowsBetween(Window.unboundedPreceding, -1))
    whole = F.length("head") + F.length("body") + len(END) + 1
    turns = turns.withColumn("at", F.coalesce(F.sum(whole.cast("long")).over(before), F.lit(0)))
    span = F.when(F.col("role") == loss_role, F.struct(
        (F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    turn = F.struct("at", F.concat("head", "body", F.lit(END + "\n")).alias("said"))
    return turns.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(turn)), lambda x: x["said"]), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation: array of ``(role, text)``.  Texts
    hold no bare control string, so splitting at the markers is exact."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.greatest(
        F.size(F.split(formatted, r"<\|im_start\|>")) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - len(END) - 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))
    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """What the loss mask covers: the text under each span of the rendered string, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_chats(log: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """A log folded and rendered: ``(conv_id, formatted, loss_spans)``."""
    return render(fold_messages(log), loss_role)
