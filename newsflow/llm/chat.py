"""Chat formatting: rebuild conversations from event logs, render them, and read them back.

A log has one row per event: conv_id, seq (its order in the conversation), message (which
message it is about), role, kind and text. A ``delta`` adds text to its message, an
``edit`` replaces the text, a ``regenerate`` starts the message again and voids what was
logged so far for all later messages. Redelivered events (all values equal) count once.

Rendered turns are ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts every run
of bars after ``<`` gets one bar more, so a control string never occurs there, and taking
one bar away gives the text back. In roles a backslash is written as ``\\b`` and a line
end as ``\\n``.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Code points in one streamed delta of a stored turn.
DELTA_CHARS = 256

_TURN_END = r"<\|im_end\|>\n"


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The log of stored turns (conv_id, turn, role, text): each is streamed in deltas.

    Turns follow each other by turn number, then role, then text; repeated rows are turns
    of their own. A null role or text is empty; turns without a number come first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("message", F.row_number().over(order).cast("long"))
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))
    deltas = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(chunks)
    return rows.select("conv_id", "message", "role", F.posexplode(deltas).alias("part", "text")).select(
        "conv_id",
        ((F.col("message") * (1 << 31)) + F.col("part")).alias("seq"),
        "message",
        "role",
        F.lit("delta").alias("kind"),
        "text",
    )


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages of an event log: conv_id, message, role, text.

    Events of a message are folded in the order of seq, kind, text; its role is that of its
    last event with one. A message all of whose events are void is gone. Events of unknown
    kinds and of null messages are left out; a null text adds nothing. An empty log gives
    no messages.
    """
    known = events.where("message IS NOT NULL AND kind IN ('delta', 'edit', 'regenerate')").select(
        "conv_id", "seq", "message", "role", "kind", F.coalesce("text", F.lit("")).alias("text")
    )
    by_message = known.groupBy("conv_id", "message").agg(
        F.sort_array(F.array_distinct(F.collect_list(F.struct("seq", "kind", "text", "role")))).alias(
            "events"
        ),
        F.max(F.expr("if(kind = 'regenerate', seq, NULL)")).alias("restarted"),
    )
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("message")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    valid = by_message.withColumn("void_to", F.max("restarted").over(earlier)).withColumn(
        "events", F.expr("if(void_to IS NULL, events, filter(events, e -> e.seq > void_to))")
    )
    return valid.where("size(events) > 0").select(
        "conv_id",
        "message",
        F.expr(
            "coalesce(aggregate(events, cast(NULL AS string), (r, e) -> coalesce(e.role, r)), '')"
        ).alias("role"),
        _folded(F.col("events")).alias("text"),
    )


def _folded(events: Column) -> Column:
    """The text of sorted events: what follows the last edit or restart, and that edit."""
    from_ = F.array_max(
        F.transform(events, lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(F.lit(1)))
    )
    live = F.slice(events, from_, F.size(events))
    return F.array_join(
        F.transform(live, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"])), ""
    )


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<|$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", r"<$1")


def _escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    ``loss_mask`` has one (start, length) per turn, in code points from the start of the
    turn's block; turns of other roles have length 0.
    """
    block = messages.select(
        "conv_id",
        "message",
        (F.col("role") == trained_role).alias("trained"),
        _escaped_role(F.col("role")).alias("role"),
        escaped(F.col("text")).alias("text"),
    )
    head = F.concat(F.lit(START), F.col("role"), F.lit("\n"))
    block = block.select(
        "conv_id",
        F.struct(
            "message",
            F.concat(head, F.col("text"), F.lit(END + "\n")).alias("block"),
            F.length(head).alias("start"),
            F.when(F.col("trained"), F.length("text")).otherwise(F.lit(0)).alias("length"),
        ).alias("turn"),
    )
    turns = block.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return turns.select(
        "conv_id",
        F.array_join("turns.block", "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias(
            "loss_mask"
        ),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trained texts from rendered text: conv_id, turns (role, text), loss."""
    blocks = formatted.withColumn("blocks", F.split("formatted", _TURN_END)).withColumn(
        "blocks", F.slice("blocks", 1, F.size("blocks") - 1)
    )
    start = len(START) + 1

    def turn(block: Column) -> Column:
        line = F.substring_index(block, "\n", 1)
        return F.struct(
            _unescaped_role(F.substr(line, F.lit(start))).alias("role"),
            unescaped(F.substr(block, F.length(line) + 2)).alias("text"),
        )

    trained = F.zip_with(
        "blocks", "loss_mask", lambda b, m: unescaped(F.substr(b, m["start"] + 1, m["length"]))
    )
    return blocks.select(
        "conv_id",
        "formatted",
        F.transform("blocks", turn).alias("turns"),
        F.array_join(trained, "").alias("loss"),
    )


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Stored turns through the log, the fold and the template (see ``render``).

    Rows of a null conv_id are one conversation. A conversation is one row, so its text
    must fit into one value; an empty table gives no rows.
    """
    return render(reconstruct(events_of_turns(turns)), trained_role)
