r"""Conversations as training windows: a template around turns, windows of a token budget, and a loss mask.

Template: ``<turn>role<text>text</turn>`` and a line break. The three marks are the control strings; one that occurs inside a role or text gets a
backslash after its ``<`` (one more if it has some already), so escaped text never holds a mark, and the escape can be undone.

Windows: a turn's size is its number of words plus ``OVERHEAD``. The prefix sum of the sizes up to a turn, divided by the room that the
budget leaves for new turns, names the window it starts in: turns that begin in one cell of half that room are a window, and a turn longer than a cell,
always the last to begin in its cell, has a window of its own. So windows follow from prefix sums alone, are cut between turns only
and, as no turn in a cell is longer than it, stay within the budget. Each later window of a conversation repeats its system turn (its first turn, if
its role is ``system``) and the turns that began at most ``history`` tokens before it, both outside the loss mask; a text of a trained role is
under the mask in the one window in which it is new. Texts are never cut: only where a turn alone is longer than its cell, or a system turn longer
than a quarter of the budget, a window is longer than the budget.

Scale: turns get their global place in the order of conversation and turn and are cut into runs of ``RUN`` places; prefix sums are taken within
the part of a conversation in a run, and sums of whole parts, one narrow row each, are added to them. So a conversation, or one
turn that is repeated, may hold any share of the rows: no key of a shuffle of texts has more than ``RUN`` turns. (The queries' digests are of whole
conversations, which one row each has to hold.) Windows are also cut at the end of a run. Only DataFrame functions are used.

Defined results: rows are ordered by turn, null turns first, equal turns by a hash of the row; null roles and texts are empty; rows with
a null conversation are one conversation; repeated rows are turns of their own. An empty table gives no windows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import WORD_PATTERN, only_columns
from ringlens.operators.ranking import global_positions

TURN, TEXT, END = "<turn>", "<text>", "</turn>"
_MARK = r"(turn>|text>|/turn>)"
BUDGET, HISTORY = 1024, 128  # words
OVERHEAD = 2  # words that the marks and role of a turn count for
RUN = 4096  # turns in order that are summed together
SYSTEM = "system"


def escaped(text: Column) -> Column:
    """``text`` without control strings."""
    return F.regexp_replace(text, rf"<(\\*){_MARK}", r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"<\\(\\*){_MARK}", "<$1$2")


def _placed(df: DataFrame, run: int) -> DataFrame:
    """Turns with their place in the order of conversation and turn, size and run."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = df.select("conv", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
    size = (F.regexp_count("text", F.lit(WORD_PATTERN)) + OVERHEAD).cast("long")
    placed = global_positions(rows.withColumn("size", size), ["conv", "turn"], "pos")
    # as a struct a null conversation is a key like the others, and one layout serves the join and the sums of a part
    return placed.withColumns({"run": F.expr(f"pos div {run}"), "conv": F.struct(F.col("conv").alias("name"))})


def _parts(placed: DataFrame, budget: int, history: int) -> DataFrame:
    """One row per conversation and run, which is a part of it: the tokens and cells of the parts before it, its own, the size of a cell, and
    the conversation's system turn."""
    parts = placed.groupBy("conv", "run").agg(F.sum("size").alias("tokens"), F.min("pos").alias("pos"))
    order = Window.partitionBy("conv").orderBy("run")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "run", "tokens", F.first("pos").over(order).alias("first_pos"))
    system = placed.filter(F.col("role") == SYSTEM).select(F.col("pos").alias("first_pos"), F.struct("pos", "size", "role", "text").alias("system"))
    parts = parts.join(system, "first_pos", "left")
    kept = F.least(F.coalesce(F.col("system.size"), F.lit(0)), F.lit(budget // 4))
    parts = parts.withColumn("cell", F.floor((F.lit(budget - history) - kept) / 2))
    parts = parts.withColumn("cells", F.ceil(F.col("tokens") / F.col("cell")))
    return parts.select(
        F.col("conv").alias("part_conv"), F.col("run").alias("part_run"), "tokens", "cell", "cells", "system",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_at"), F.coalesce(F.sum("cells").over(before), F.lit(0)).alias("part_cell"),
    )


def _routed(placed: DataFrame, parts: DataFrame, history: int, trained: tuple[str, ...]) -> DataFrame:
    """Each turn once for its own cell (``own``) and once for each later cell whose windows it may be history of; ``system`` comes with the
    first turn of a cell."""
    rows = placed.join(parts, (F.col("conv") == F.col("part_conv")) & (F.col("run") == F.col("part_run")))
    part = Window.partitionBy("conv", "run").orderBy("pos")
    inside = F.coalesce(F.sum("size").over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("inside", inside).withColumn("nth", F.floor(F.col("inside") / F.col("cell")))
    earlier = F.lag("nth").over(part)
    rows = rows.withColumns({
        "opens": earlier.isNull() | (earlier != F.col("nth")),
        "long": F.col("size") > F.col("cell"),
        "is_system": F.col("pos").eqNullSafe(F.col("system.pos")),
    })
    can = ~F.col("long") & ~F.col("is_system")
    none = F.array().cast("array<bigint>")
    home, next_part = F.col("part_cell") + F.col("nth"), F.col("part_cell") + F.col("cells")
    later = F.array_distinct(F.concat(
        F.when(can & ((F.col("nth") + 1) * F.col("cell") - F.col("inside") <= history), F.array(home + 1)).otherwise(none),
        F.when(can & (F.col("tokens") - F.col("inside") <= history), F.array(next_part)).otherwise(none),
    ))

    def piece(role: Column, text: Column, learned: Column, size: Column) -> Column:
        head, body = F.concat(F.lit(TURN), escaped(role), F.lit(TEXT)), escaped(text)
        return F.struct(
            size.alias("size"), learned.alias("learned"), F.length(head).cast("long").alias("head"), F.length(body).cast("long").alias("body"),
            F.concat(head, body, F.lit(f"{END}\n")).alias("piece"),
        )

    system = F.when(
        F.col("opens") & ~F.col("is_system") & F.col("system").isNotNull(),
        piece(F.col("system.role"), F.col("system.text"), F.lit(False), F.col("system.size")),
    )
    rows = rows.select(
        "conv", "pos", (F.col("part_at") + F.col("inside")).alias("at"), "long", "is_system", home.alias("home"), later.alias("later"),
        system.alias("system"), piece(F.col("role"), F.col("text"), F.col("role").isin(*trained), F.col("size")).alias("turn"),
    )
    sent = rows.withColumn("key", F.explode(F.concat(F.array("home"), "later")))
    own = F.col("home") == F.col("key")
    return sent.select("conv", "key", "pos", own.alias("own"), "at", "long", "is_system", F.when(own, F.col("system")).alias("system"), "turn")


def format_chat(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = BUDGET,
    history: int = HISTORY, trained: tuple[str, ...] = ("assistant",), run: int = RUN,
) -> DataFrame:
    """Windows of all conversations: ``conv_col``, ``window_at`` (tokens of the conversation before the window's new turns, by which its
    windows are in order), ``n_context`` (turns repeated from before), ``n_turns`` (new ones, after those), ``n_tokens``, ``formatted``, and
    ``loss``, the loss mask as spans of code points (start, end exclusive) of ``formatted``."""
    if not 0 <= history <= (budget - history - budget // 4) // 2:
        raise ValueError("history must leave at least twice its size, and a quarter of the budget, to other turns")
    placed = _placed(only_columns(df, conv=conv_col, turn=turn_col, role=role_col, text=text_col), run)  # written by its positions
    sent = _routed(placed, _parts(placed, budget, history), history, trained)
    fields = ["pos", "own", "at", "long", "is_system", "system", "turn"]
    cells = sent.groupBy("conv", "key").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("sent"))
    cells = cells.withColumn("own", F.filter("sent", lambda t: t["own"]))
    both = F.array(F.filter("own", lambda t: ~t["long"]), F.filter("own", lambda t: t["long"]))
    windows = cells.withColumn("new", F.explode(F.filter(both, lambda w: F.size(w) > 0)))
    first = F.col("new")[0]
    opened = F.col("own")[0]  # of the window's cell: the system turn itself, or a turn that has it beside it
    system = F.when(opened["is_system"], opened["turn"]).otherwise(opened["system"])
    before = F.filter(
        "sent", lambda t: ~t["long"] & ~t["is_system"] & (t["pos"] < F.col("first_pos")) & (F.col("window_at") - t["at"] <= history)
    )
    context = F.concat(
        F.filter(F.array(F.when(~first["is_system"], system)), lambda t: t.isNotNull()), F.transform(before, lambda t: t["turn"])
    )
    windows = windows.withColumns({"window_at": first["at"], "first_pos": first["pos"]}).select(
        "conv", "window_at", F.transform(context, lambda t: t.withField("learned", F.lit(False))).alias("context"),
        F.transform("new", lambda t: t["turn"]).alias("new"),
    )
    every = F.concat("context", "new")
    spans = F.aggregate(
        every, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["piece"])).alias("at"),
            F.when(
                t["learned"],
                F.concat(a["spans"], F.array(F.struct((a["at"] + t["head"]).alias("start"), (a["at"] + t["head"] + t["body"]).alias("end")))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return windows.select(
        F.col("conv.name").alias(conv_col), "window_at", F.size("context").cast("long").alias("n_context"), F.size("new").cast("long").alias("n_turns"),
        F.aggregate(every, F.lit(0).cast("long"), lambda a, t: a + t["size"]).alias("n_tokens"),
        F.array_join(F.transform(every, lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss"),
    )


def read_chat(windows: DataFrame) -> DataFrame:
    """The windows with ``turns`` (role and text of the new turns) and ``learned`` (texts under the loss mask), both read from ``formatted``."""
    pieces = F.slice(F.split("formatted", f"{END}\n", -1), (F.col("n_context") + 1).cast("int"), F.col("n_turns").cast("int"))

    def turn(piece: Column) -> Column:
        halves = F.split(piece, TEXT, -1)
        return F.struct(unescaped(F.substr(halves[0], F.lit(len(TURN) + 1))).alias("role"), unescaped(halves[1]).alias("text"))

    learned = F.transform("loss", lambda s: unescaped(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return windows.withColumns({"turns": F.transform(pieces, turn), "learned": learned})


def conversation_digests(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of whole conversations as read back from their windows; each conversation's texts meet in one row, as a digest needs."""
    read = read_chat(windows).select(
        conv_col, F.struct("window_at", "turns", F.array_join("learned", "").alias("learned"), F.length("formatted").cast("long").alias("chars")).alias("w")
    )
    whole = read.groupBy(conv_col).agg(F.sort_array(F.collect_list("w")).alias("w"))
    turns = F.flatten(F.transform("w", lambda w: w["turns"]))
    loss = F.array_join(F.transform("w", lambda w: w["learned"]), "")
    whole = whole.select(conv_col, "w", turns.alias("turns"), loss.alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, w: a + w["chars"]).alias("formatted_chars"),
    )
