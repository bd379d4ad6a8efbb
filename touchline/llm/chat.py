"""Operator 6: chat formatting from event logs.

A log holds events (conv_id, turn, seq, kind, role, text). The events of a turn are gathered,
sorted by sequence, and folded into messages, before these are gathered by conversation:

* ``message`` opens a message, also when its turn has one already;
* ``delta`` adds its text to the message (streaming);
* ``edit`` and ``regenerate`` replace what the message holds so far, which later deltas
  go on from.

A turn whose first event is no ``message`` opens one as well. The role is the first that is
not null among the events of the message.

Rendering: ``### role:\\n`` text ``</turn>\\n`` for each message. In texts and roles ``\\``,
``#`` and ``<`` are written ``\\b``, ``\\h`` and ``\\l``, in roles ``:`` as ``\\c`` too, so no
control string can stand in one, and reading back is exact. The loss mask is the list of
character spans of the assistant texts in the formatted string.

A table of whole messages becomes the log that would have led to it: a draft of each message, an
edit or, for the assistant, a regeneration that takes its place, and deltas with the rest.

Only DataFrame functions are used. Edge cases: null texts and roles are empty strings;
null turns come first; rows with the same turn are separate messages, in the order of seq,
role and text; rows with a null conv_id form one conversation; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
ESCAPES = (("#", "h"), ("<", "l"))


def escape(text: Column, more: tuple[tuple[str, str], ...] = ()) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for plain, name in (*ESCAPES, *more):
        text = F.replace(text, F.lit(plain), F.lit("\\" + name))
    return text


def unescape(text: Column, more: tuple[tuple[str, str], ...] = ()) -> Column:
    """A backslash is always followed by the letter that tells what it stands for, so the
    replacements can't meet; that of the backslash itself comes last."""
    for plain, name in (*ESCAPES, *more):
        text = F.replace(text, F.lit("\\" + name), F.lit(plain))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


COLON = ((":", "c"),)


#: Code points of a delta.
DELTA = 256
#: Sequence numbers of a message, where several rows have one turn.
STEP = 1 << 32
EVENT = "array<struct<kind string, role string, text string>>"


def as_events(rows: DataFrame) -> DataFrame:
    """A table of whole messages (conv_id, turn, role, text) as a log of streamed ones."""
    turn, role = F.col("turn").cast("long"), F.col("role").cast("string")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = rows.select("conv_id", turn.alias("turn"), role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    first = F.coalesce(F.get(pieces, F.lit(0)), F.lit(""))

    def event(kind: Column, text: Column, role: Column = F.lit(None)) -> Column:
        return F.struct(kind.alias("kind"), role.alias("role"), text.alias("text"))

    again = F.when(F.col("role") == "assistant", "regenerate").otherwise("edit")
    draft = F.array(
        event(F.lit("message"), first, F.col("role")),
        event(F.lit("delta"), F.lit(" (draft)")),
        event(again, first),
    ).cast(EVENT)
    rest = F.transform(
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(1))),
        lambda p: event(F.lit("delta"), p),
    ).cast(EVENT)
    numbered = whole.withColumn("place", place.cast("long") * STEP)
    events = numbered.select("conv_id", "turn", "place", F.posexplode(F.concat(draft, rest)).alias("n", "event"))
    return events.select("conv_id", "turn", (F.col("place") + F.col("n")).alias("seq"), "event.*")


def _folded(events: Column) -> Column:
    """One message of its events, in order."""
    places = F.sequence(F.lit(0), F.size(events) - 1)
    fresh = F.array_max(
        F.transform(places, lambda i: F.when(F.get(events, i)["kind"] != "delta", i).otherwise(0))
    )
    tail = F.slice(events, fresh + 1, F.size(events))
    texts = F.transform(tail, lambda e: F.coalesce(e["text"], F.lit("")))
    roles = F.filter(F.transform(events, lambda e: e["role"]), lambda r: r.isNotNull())
    return F.struct(
        F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
        F.array_join(texts, "").alias("text"),
    )


def reconstruct(log: DataFrame) -> DataFrame:
    """conv_id and ``messages``, an array of (role, text) in the order of turns."""
    event = F.struct("seq", "role", "text", "kind")
    by_turn = log.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(event)).alias("events"))
    events = F.col("events")
    places = F.sequence(F.lit(0), F.size(events) - 1)
    opens = F.filter(places, lambda i: (i == 0) | (F.get(events, i)["kind"] == "message"))
    starts = F.col("starts")
    messages = F.transform(
        starts,
        lambda s, k: _folded(
            F.slice(events, s + 1, F.coalesce(F.get(starts, k + 1), F.size(events)) - s)
        ),
    )
    folded = by_turn.withColumn("starts", opens).select("conv_id", "turn", messages.alias("messages"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "messages")))
    gathered = folded.groupBy("conv_id").agg(turns.alias("turns"))
    return gathered.select("conv_id", F.flatten(F.col("turns")["messages"]).alias("messages"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, the formatted string, and the spans [start, end) that carry loss."""

    def block(m: Column) -> Column:
        return F.struct(
            F.concat(F.lit(OPEN), escape(m["role"], COLON), F.lit(":\n")).alias("head"),
            escape(m["text"]).alias("body"),
            m["role"].alias("role"),
        )

    blocks = conversations.select("conv_id", F.transform("messages", block).alias("blocks"))
    sizes = F.transform(
        "blocks",
        lambda b: F.struct(
            F.length(b["head"]).alias("head"),
            F.length(b["body"]).alias("body"),
            (b["role"] == "assistant").alias("loss"),
        ),
    )
    none = F.array().cast("array<struct<start:long,end:long>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def walk(state: Column, s: Column) -> Column:
        begin = state["at"] + s["head"]
        end = begin + s["body"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(CLOSE)).alias("at"),
            F.when(s["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    text = F.array_join(
        F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit(CLOSE))), ""
    )
    mask = F.aggregate(sizes, start, walk, lambda s: s["spans"])
    return blocks.select("conv_id", text.alias("formatted"), mask.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, ``messages`` as parsed from the string, ``loss_text`` as cut by the mask."""
    turns = F.split(F.col("formatted"), CLOSE, -1)
    turns = F.slice(turns, 1, F.size(turns) - 1)

    def parse(t: Column) -> Column:
        head = F.substring_index(t, ":\n", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1)), COLON).alias("role"),
            unescape(F.substr(t, F.length(head) + 3)).alias("text"),
        )

    def cut(s: Column) -> Column:
        start = (s["start"] + 1).cast("int")
        return unescape(F.substr(F.col("formatted"), start, (s["end"] - s["start"]).cast("int")))

    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(turns, parse).alias("messages"),
        F.array_join(F.transform("loss_spans", cut), "").alias("loss_text"),
    )


def digests(read: DataFrame) -> DataFrame:
    """The digest of what was read back, for each conversation."""
    told = F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
