"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation is cut between turns. Prefix sums of turn tokens lay the turns on a line
with marks every ``budget - history`` tokens: turns between the same two marks form a
span, a turn across a mark is a span of its own. Each span becomes one window: the
system turn, the last turns before the span within ``history`` tokens, and the span.
Only the span's assistant turns are under the loss mask, so that each is learnt once.

    <|im_start|>role
    text<|im_end|>

Inside texts and roles ``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|`` (in
roles, a line break ``&#10;`` too), so control strings occur in the template alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybook.llm.shared import NO_ID

BUDGET = 1024
HISTORY = 256
START, END = "<|im_start|>", "<|im_end|>"
#: Turns whose numbers share this many are summed up first, so that no long conversation is one task's work.
_BLOCK = 1024


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def turn_tokens(text: Column) -> Column:
    """A turn's tokens as reckoned without a tokenizer: one per four bytes of text, and four for the template."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with their place on the line: ``begin`` and ``end`` in tokens of the conversation."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns(
        {
            "tokens": turn_tokens(F.col("text")),
            "block": F.coalesce(F.floor(F.col("turn") / _BLOCK), F.lit(NO_ID)).cast("long"),
        }
    )
    within = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    placed = turns.withColumn("end", F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = turns.groupBy("conv", "block").agg(F.sum("tokens").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return placed.join(blocks, ["conv", "block"]).select(
        "conv",
        "role",
        "text",
        (F.col("end") + F.col("offset")).alias("end"),
        (F.col("end") + F.col("offset") - F.col("tokens")).alias("begin"),
    )


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, first_cell and last_cell (their order), n_context, n_turns, formatted, loss.

    ``n_context`` turns lead the window that were or will be a target elsewhere: the
    system turn, if it is the conversation's first turn and not in the span, and the
    repeated history. ``loss`` lists (start, length) in code points of ``formatted``.
    History and span together keep to ``budget`` tokens unless one turn alone exceeds it;
    a retained system turn comes on top.

    Turns are in order of ``turn``, nulls last, ties by role and text. A null text or
    role is empty, a null conv_id is a conversation like others; an empty table gives an
    empty one; columns other than conv_id, turn, role and text are not looked at.
    """
    if not 0 <= history <= budget // 2:
        raise ValueError(f"a history of {history} tokens does not go with a budget of {budget}")
    cell = F.lit(budget - history)

    def at(token: Column) -> Column:
        return F.floor(token / cell).cast("long")

    turns = _turns(conversations).withColumns({"a": at(F.col("begin")), "b": at(F.col("end") - 1)})
    system = (F.col("begin") == 0) & (F.col("role") == "system")
    spans = turns.groupBy("conv", "a", "b").agg(F.min("begin").alias("span"))
    piece = ("begin", "role", "text")
    targets = turns.select("conv", "a", "b", F.lit(2).alias("kind"), *piece)
    # A turn may be history of spans that begin up to ``history`` tokens after its own begin: two cells at most.
    reach = F.explode(F.sequence(at(F.col("end")), F.greatest(at(F.col("end")), at(F.col("begin") + history)))).alias("a")
    before = (
        turns.filter(~system & (F.col("end") - F.col("begin") <= history))
        .select("conv", "begin", "end", "role", "text", reach)
        .join(spans, ["conv", "a"])
        .filter((F.col("end") <= F.col("span")) & (F.col("span") - F.col("begin") <= history))
        .select("conv", "a", "b", F.lit(1).alias("kind"), *piece)
    )
    retained = (
        spans.filter("span > 0").join(turns.filter(system).select("conv", *piece), "conv").select("conv", "a", "b", F.lit(0).alias("kind"), *piece)
    )
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    parts = targets.unionByName(before).unionByName(retained).select(
        "conv",
        "a",
        "b",
        F.struct(
            "kind",
            "begin",
            F.concat(head, body, F.lit(END + "\n")).alias("written"),
            F.char_length(head).alias("skip"),
            F.char_length(body).alias("length"),
            ((F.col("kind") == 2) & (F.col("role") == "assistant")).alias("learnt"),
        ).alias("part"),
    )
    whole = parts.groupBy("conv", "a", "b").agg(F.array_sort(F.collect_list("part")).alias("parts"))  # one window's turns
    spot = "struct<start:int,length:int>"
    begun = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spot}>").alias("loss"))

    def add(state: Column, x: Column) -> Column:
        found = F.array(F.struct((state["at"] + x["skip"]).alias("start"), x["length"].alias("length")))
        return F.struct(
            (state["at"] + F.char_length(x["written"])).alias("at"),
            F.when(x["learnt"], F.concat(state["loss"], found)).otherwise(state["loss"]).alias("loss"),
        )

    return whole.select(
        F.nullif("conv", F.lit(NO_ID)).alias("conv_id"),
        F.col("a").alias("first_cell"),
        F.col("b").alias("last_cell"),
        F.size(F.filter("parts", lambda x: x["kind"] < 2)).alias("n_context"),
        F.size("parts").alias("n_turns"),
        F.array_join("parts.written", "").alias("formatted"),
        F.aggregate("parts", begun, add)["loss"].alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted window."""

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        text = F.substring(x, F.char_length(role) + 2, F.char_length(x) - F.char_length(role) - 1 - len(END) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    pieces = F.split(formatted, START.replace("|", "\\|"), -1)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask of a formatted window, in order."""
    return F.transform(loss, lambda x: unescape(F.substring(formatted, x["start"] + 1, x["length"])))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows: its turns, the texts under the mask, and the length of all windows.

    A digest of a conversation needs it as one value, so here it is one.
    """
    turns = read_turns(F.col("formatted"))
    read = formatted.select(
        F.coalesce("conv_id", F.lit(NO_ID)).alias("conv"),
        F.struct(
            "first_cell",
            "last_cell",
            F.slice(turns, F.col("n_context") + 1, F.col("n_turns") - F.col("n_context")).alias("turns"),
            read_loss(F.col("formatted"), F.col("loss")).alias("learnt"),
            F.char_length("formatted").cast("long").alias("chars"),
        ).alias("window"),
    )
    rows = read.groupBy("conv").agg(F.array_sort(F.collect_list("window")).alias("windows"))
    return rows.select(
        F.nullif("conv", F.lit(NO_ID)).alias("conv_id"),
        F.flatten("windows.turns").alias("turns"),
        F.flatten("windows.learnt").alias("learnt"),
        F.aggregate("windows.chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("formatted_chars"),
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted windows."""
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )
