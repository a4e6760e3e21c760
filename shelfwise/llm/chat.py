"""Operator 5, chat formatting [native]: logs folded into messages, rendered with a reversible template and a loss mask."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.quality import let


class Template(NamedTuple):
    """Marks of a turn. All begin with `<|`, which an escaped text never holds; nor does it hold `foreign` strings whole."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    foreign: tuple[str, ...] = ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")


CHAT = Template()
#: Events of one sequence number are applied in this order.
EVENT_ORDER = ("start", "regenerate", "edit", "delta")


def escape(text: Column, template: Template = CHAT) -> Column:
    """A backslash before each backslash and after the first sign of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.foreign:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of an event log.

    Columns: conv_id, seq, event, message (number in its conversation), role, text. `start` opens a message, `delta`
    adds to its text, `edit` replaces the text by its own, `regenerate` empties it and takes back later messages begun
    before it. A message's text is what follows its last edit or regeneration, that edit's text included. Null text is
    empty; the last role given counts (none: empty); unknown events change nothing. Ties of seq go by EVENT_ORDER, then
    role and text; a repeated row is applied again, so a log delivered twice must be made distinct before.

    The log is shuffled once, by conversation; messages, taken-back ones and, later, the rendering use that layout.
    """
    order = F.array_position(F.array(*map(F.lit, EVENT_ORDER)), F.col("event"))
    own = F.struct("seq", order.alias("order"), F.col("role").alias("role"), F.col("text").alias("text"))
    grouped = (
        events.filter(F.coalesce(order, F.lit(0)) > 0)
        .repartition("conv_id")
        .groupBy("conv_id", "message")
        .agg(F.sort_array(F.collect_list(own)).alias("log"))
    )
    regenerate, edit = EVENT_ORDER.index("regenerate") + 1, EVENT_ORDER.index("edit") + 1

    def last_text(log: Column) -> Column:
        resets = F.array_max(F.transform(log, lambda e, i: F.when((e["order"] == regenerate) | (e["order"] == edit), i).otherwise(F.lit(0))))
        return let(resets, lambda at: F.array_join(F.transform(F.filter(log, lambda e, i: i >= at), lambda e: F.coalesce(e["text"], F.lit(""))), ""))

    def last_role(log: Column) -> Column:
        roles = F.filter(F.transform(log, lambda e: e["role"]), lambda r: r.isNotNull())
        return F.coalesce(F.get(roles, F.size(roles) - 1), F.lit(""))

    taken_back = F.array_max(F.transform(F.filter("log", lambda e: e["order"] == regenerate), lambda e: e["seq"]))
    messages = grouped.select(
        "conv_id", "message", F.get("log", F.lit(0))["seq"].alias("begun"), taken_back.alias("regenerated"),
        last_role(F.col("log")).alias("role"), let(F.col("log"), last_text).alias("text"),
    )
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("message")).rowsBetween(Window.unboundedPreceding, -1)
    dropped = F.coalesce(F.max("regenerated").over(earlier) > F.col("begun"), F.lit(False))
    return messages.withColumn("dropped", dropped).filter(~F.col("dropped")).select("conv_id", "message", "role", "text")


def render(messages: DataFrame, template: Template = CHAT, learn: str = "assistant") -> DataFrame:
    """One row per conversation: `formatted`, and `mask`, one (head, body, tail, loss) of code points per turn.

    A turn is head (marks and role), body (the escaped text) and tail (the end mark); the loss is taken on the bodies
    of `learn`. Rows of a conversation come together because its text is the output.
    """
    head = F.concat(F.lit(template.turn), escape(F.col("role"), template), F.lit(template.text))
    body = escape(F.col("text"), template)
    turns = messages.select("conv_id", "message", (F.col("role") == learn).alias("loss"), head.alias("head"), body.alias("body"))
    one = F.struct(F.col("message"), F.col("head"), F.col("body"), F.col("loss"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return ordered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(template.end))), "").alias("formatted"),
        F.transform(
            "turns",
            lambda t: F.struct(
                F.length(t["head"]).alias("head"), F.length(t["body"]).alias("body"), F.lit(len(template.end)).alias("tail"), t["loss"].alias("loss")
            ),
        ).alias("mask"),
    )


def parse(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) that a formatted conversation holds, unescaped."""
    quoted = lambda mark: "\\Q" + mark + "\\E"
    pieces = F.split(formatted, quoted(template.end))

    def turn(piece: Column) -> Column:
        sides = F.split(piece, quoted(template.text), 2)
        return let(sides, lambda s: F.struct(unescape(F.substr(s[0], F.lit(len(template.turn) + 1))).alias("role"), unescape(s[1]).alias("text")))

    return let(pieces, lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), turn))


def under_loss(formatted: Column, mask: Column, template: Template = CHAT) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    pieces = F.split(formatted, "\\Q" + template.end + "\\E")
    cut = lambda m, p: F.when(m["loss"], unescape(F.substr(p, m["head"] + 1, m["body"])))
    return F.filter(F.zip_with(mask, let(pieces, lambda p: F.slice(p, 1, F.size(p) - 1)), cut), lambda t: t.isNotNull())


def digests(rendered: DataFrame, template: Template = CHAT) -> DataFrame:
    """Counts and digests of rendered conversations, all read back from the output."""
    read = rendered.select(
        "conv_id", F.length("formatted").alias("formatted_chars"), parse(F.col("formatted"), template).alias("turns"),
        F.array_join(under_loss(F.col("formatted"), F.col("mask"), template), "").alias("learnt"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
    )


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as a log: a start and two deltas per row.

    Messages are numbered by turn (null first), ties by role and text, so repeated rows are turns of their own.
    """
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id")
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), "text")
    numbered = rows.withColumn("message", F.row_number().over(place).cast("bigint"))
    half = F.floor(F.length("text") / 2).cast("int")
    none = F.lit(None).cast("string")
    log = F.array(
        F.struct((F.col("message") * 3).alias("seq"), F.lit("start").alias("event"), F.col("role").alias("role"), none.alias("text")),
        F.struct((F.col("message") * 3 + 1).alias("seq"), F.lit("delta").alias("event"), none.alias("role"), F.substr("text", F.lit(1), half).alias("text")),
        F.struct((F.col("message") * 3 + 2).alias("seq"), F.lit("delta").alias("event"), none.alias("role"), F.substr("text", half + 1).alias("text")),
    )
    return numbered.select("conv_id", "message", F.inline(log)).select("conv_id", "seq", "event", "message", "role", "text")


def format_chats(events: DataFrame, template: Template = CHAT) -> DataFrame:
    """Event log to rendered conversations (conv_id, formatted, mask). An empty log gives no conversation."""
    return render(fold_events(events), template)
