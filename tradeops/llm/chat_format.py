"""Chat formatting by event sourcing: an event log is folded into messages, messages are rendered.

DataFrame functions only. An event is one row ``(conversation, seq, kind, message, role, text)``:

* ``message``     starts the message or sets its text (also an unknown or null kind);
* ``delta``       appends a streamed piece;
* ``edit``        replaces the text;
* ``regenerate``  throws away what was said so far; its text, if any, begins the new answer.

A message keeps the place of its first event and takes the last non-null role of its log.

Defined cases: null text or role counts as empty; a null conversation or message is a key of its own; events with equal
``seq`` apply in the order kind (``message``, ``regenerate``, ``edit``, ``delta``), text, role; repeated events apply as
often as they occur; messages with equal places are ordered by role, text, message; an empty log gives no conversation;
further columns are ignored.

A conversation is one cell of the output, as a digest or a training example needs it whole; before that, its events are
spread over the cluster by (conversation, message) and superseded text is gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Every control string, ours or another template's, starts with one of these; ``&`` makes the mapping reversible.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
KINDS = ("message", "regenerate", "edit", "delta")


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def fold_events(events: DataFrame) -> DataFrame:
    """(conversation, message, place, role, text): the final state of every message."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    event = F.struct(
        F.col("seq"),
        F.when(F.coalesce(rank, F.lit(0)) == 0, 1).otherwise(rank).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("role"),
    )
    grouped = events.groupBy("conversation", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    resets = F.transform("log", lambda e, i: F.when(e["kind"] != len(KINDS), i))
    start = F.coalesce(F.array_max(resets), F.lit(0))
    return grouped.select(
        "conversation",
        "message",
        F.col("log")[0]["seq"].alias("place"),
        F.coalesce(
            F.try_element_at(F.filter(F.col("log")["role"], lambda r: r.isNotNull()), F.lit(-1)), F.lit("")
        ).alias("role"),
        F.array_join(F.slice(F.col("log")["text"], start + 1, F.size("log")), "").alias("text"),
    )


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conversation, formatted, loss_spans): one text a conversation, and where its loss mask is on.

    ``loss_spans`` holds (start, length) in code points of ``formatted``, one for each text of the role ``trained``.
    """
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    order = ["place", "role", "text", "message"]
    before = W.partitionBy("conversation").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    parts = (
        messages.withColumn("head", head)
        .withColumn("body", body)
        .withColumn("piece", F.concat("head", "body", F.lit(END)))
        .withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
        .withColumn(
            "span",
            F.when(
                F.col("role") == trained,
                F.struct(
                    (F.col("start") + F.length("head")).cast("long").alias("start"),
                    F.length("body").cast("long").alias("length"),
                ),
            ),
        )
    )
    # Pieces have at least one character, so their starts order them.
    turns = F.sort_array(F.collect_list(F.struct("start", "piece", "span")))
    return (
        parts.groupBy("conversation")
        .agg(turns.alias("turns"))
        .select(
            "conversation",
            F.array_join(F.col("turns")["piece"], "").alias("formatted"),
            F.filter(F.col("turns")["span"], lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def format_chats(events: DataFrame, trained: str = "assistant") -> DataFrame:
    return render(fold_events(events), trained)


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> from a formatted conversation: the inverse of ``render``."""
    pieces = F.split(formatted, END.replace("|", r"\|"))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(F.substr(piece, F.lit(len(TURN) + 1)), TEXT.replace("|", r"\|"))
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    cut = F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))))
    return F.array_join(cut, "")


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """The event log of a table of finished turns: every row is one ``message``, also where rows repeat."""
    number = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return conversations.select(
        F.col("conv_id").alias("conversation"),
        number.alias("message"),
        number.alias("seq"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )
