"""Chat formatting from an event log.

A log row is an event of one message of one conversation: ``start`` opens a message and names its
role, ``delta`` appends streamed text, ``edit`` replaces the text so far and ``regenerate`` throws it
away so that later deltas begin anew.  Events of a conversation are ordered by ``seq``.  Folding them
gives the final messages, which are rendered with a template; control strings inside texts are
escaped so that the rendering can be read back exactly.

Only DataFrame functions are used.  A message's text and a conversation's rendering are values of one
row, as the output asks for; everything else is a window over rows or an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the template.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """``<|`` never occurs in the result; ``&`` marks what was changed."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    """A role ends at the first line break, so its own line breaks are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def final_messages(events: DataFrame) -> DataFrame:
    """Messages (``conv_id``, ``message``, ``role``, ``text``) folded from a log.

    ``events``: conv_id, message (orders the messages of a conversation), seq, kind, role, text.
    The text is that of the last ``edit``, or nothing after a ``regenerate``, followed by all later
    deltas.  The role is that of the last event that names one.  Ties of seq are ordered start, edit and
    regenerate first, then by text.  Null text: empty; null role everywhere: empty; null conv_id: a
    conversation of its own; unknown kinds, ``start`` included, add no text.  Extra columns are ignored.
    """
    is_reset = F.col("kind").isin("edit", "regenerate")
    log = events.select(
        "conv_id", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"),
    )
    message = Window.partitionBy("conv_id", "message")
    upto = message.orderBy("seq", F.when(F.col("kind") == "delta", 1).otherwise(0), "text")
    numbered = log.withColumn("at", F.row_number().over(upto))
    lasts = numbered.withColumn("reset_at", F.max(F.when(is_reset, F.col("at"))).over(message))
    live = F.col("kind").isin("delta", "edit") & (F.col("at") >= F.coalesce("reset_at", F.lit(0)))
    pieces = F.array_sort(F.collect_list(F.when(live, F.struct("at", "text"))))
    return lasts.groupBy("conv_id", "message").agg(
        F.coalesce(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))), F.lit("")).alias("role"),
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_spans``.

    A span (``turn_at``, ``start``, ``length``, in code points) marks the escaped text of one assistant
    message: ``turn_at`` is where its turn starts in ``formatted`` and ``start`` counts from there.
    """
    conversation = Window.partitionBy("conv_id").orderBy("message")
    head = F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = messages.select(
        "conv_id", "message", "role", head.alias("head"), body.alias("body"),
    ).withColumn("turn", F.concat("head", "body", F.lit(TURN_END + "\n")))
    placed = turns.withColumn(
        "turn_at",
        F.coalesce(
            F.sum(F.length("turn")).over(conversation.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    span = F.when(
        F.col("role") == LEARNED_ROLE,
        F.struct(
            "turn_at",
            F.length("head").cast("long").alias("start"),
            F.length("body").cast("long").alias("length"),
        ),
    )
    rows = F.array_sort(F.collect_list(F.struct("turn_at", "turn", span.alias("span"))))
    return placed.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["turn"]), "").alias("formatted"),
        F.array_compact(F.transform("rows", lambda r: r["span"])).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Messages and learned text parsed from ``formatted`` and ``loss_spans`` alone.

    Adds ``turns`` (array of role and text) and ``loss_texts`` (unescaped text under each span).
    """
    pieces = F.slice(F.split(F.col("formatted"), r"(?=<\|im_start\|>)"), 1, 2**31 - 1)
    pieces = F.filter(pieces, lambda p: p != "")

    def turn(piece: Column) -> Column:
        inner = F.substring_index(F.substr(piece, F.lit(len(TURN_START) + 1)), TURN_END, 1)
        role = F.substring_index(inner, "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substr(inner, F.length(role) + 2)).alias("text"),
        )

    # Where each piece starts, to look a span up within its own turn only: reading a long
    # conversation stays linear in its length.
    learned = F.filter("pieces", lambda p: F.startswith(p, F.lit(f"{TURN_START}{LEARNED_ROLE}\n")))
    return (
        rendered.withColumn("pieces", pieces)
        .withColumn("turns", F.transform("pieces", turn))
        .withColumn(
            "loss_texts",
            F.transform(
                F.arrays_zip(learned.alias("piece"), F.col("loss_spans").alias("span")),
                lambda z: unescape(F.substr(z["piece"], (z["span"]["start"] + 1).cast("int"), z["span"]["length"].cast("int"))),
            ),
        )
        .drop("pieces")
    )


def digests(read: DataFrame) -> DataFrame:
    """Counts and hashes of what was read back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """The log that a table of finished turns stands for: a ``start`` and one ``delta`` each.

    Turns are numbered by turn, role and text, so rows that repeat a turn are messages of their own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn("message", F.row_number().over(order))
    nothing = F.lit(None).cast("string")
    events = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.col("role"), nothing.alias("text")),
        F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), nothing.alias("role"), F.col("text")),
    )
    return numbered.select("conv_id", "message", F.explode(events).alias("event")).select(
        "conv_id", "message", "event.*"
    )
