"""Operator 6: chat formatting in budgeted windows, in DataFrame functions only.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``.  ``&`` and ``<|`` inside roles and texts (and line feeds
inside roles) are escaped, so control strings occur only where the template puts them, and the escape is undone exactly.

Windows hold whole turns.  With the prefix sums of a conversation's turn tokens, every ``stride`` tokens is a cell: turns that
lie in one cell share a window, and a turn across a boundary has its own.  So a window's new turns fit the stride, unless
one turn alone is longer.  The stride is the budget less the system turn and the history.  Each window starts with the
conversation's system turn, then repeats up to ``HISTORY_TURNS`` of the turns before it within ``HISTORY_TOKENS``, then has its new
turns.  The loss mask spans the texts of new assistant turns only, so each is learned once.

Prefix sums, leads and the spans are window functions over one shuffle by conversation: they stream through a long conversation in order,
and only the turns of one window are ever put together.

Defined cases: a null text or role is empty; turns are ordered by ``turn`` (null first), then role and text, and repeated rows stay; null
conversation ids are one conversation; the system turn is the first turn if its role is ``system``; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 512, 96, 2
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
TARGET, SYSTEM = "assistant", "system"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def four_characters(segment: Column) -> Column:
    """The default count of a written turn's tokens: one for each four code points begun."""
    return F.ceil(F.length(segment) / 4)


def chat_windows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS,
                 tokens=four_characters) -> DataFrame:
    """``conv, window, text, first_new, turns, loss``: a row per window, windows numbered from 1; ``first_new`` counts the repeated turns at its
    start, ``turns`` all of them, and ``loss`` lists ``(start, end)`` of the learned texts, in code points from 0."""
    rows = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("said"))
    head = F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit("\n"))
    said = escape(F.col("said"))
    rows = rows.select("conv", "turn", "role", "said", F.concat(head, said, F.lit(TURN_END)).alias("seg"),
                       F.length(head).cast("long").alias("skip"), F.length(said).cast("long").alias("chars"))

    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    rows = rows.withColumn("seq", F.row_number().over(order)).drop("turn", "said")
    w = Window.partitionBy("conv").orderBy("seq")
    is_system = (F.col("seq") == 1) & (F.col("role") == SYSTEM)
    rows = rows.withColumn("sys", is_system).withColumn("t", F.greatest(tokens(F.col("seg")).cast("long"), F.lit(1).cast("long")))
    part = F.struct("seg", F.length("seg").cast("long").alias("len"))
    first = F.first(F.struct("sys", "t")).over(w)
    rows = rows.withColumn("_f", first).withColumn(
        "stride", F.greatest(F.lit(budget - history_tokens) - F.when(F.col("_f.sys"), F.col("_f.t")).otherwise(0), F.lit(1)))
    rows = rows.withColumn("own", F.when(F.col("sys"), 0).otherwise(F.col("t")))
    rows = rows.withColumn("upto", F.sum("own").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("from", F.expr("upto - own"))
    cell = F.expr("from div stride")
    rows = rows.withColumn("cell", F.struct(cell.alias("c"), (F.col("upto") > (cell + 1) * F.col("stride")).alias("across")))
    begins = ~F.col("sys") & (F.col("_f.sys") & (F.col("seq") == 2) | (F.col("seq") == 1) | (F.col("cell") != F.lag("cell").over(w)))
    rows = rows.withColumn("begins", begins)
    number = F.sum(F.col("begins").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("window", F.greatest(number, F.lit(1)))

    # where a turn is written: in its window, and as history at the start of later ones
    times = [F.struct("window", F.lit(False).alias("again"))]
    for k in range(1, history_turns + 1):
        later = (F.lead("begins", k, False).over(w) & ~F.col("sys") & (F.lead("window", k).over(w) > F.col("window"))
                 & (F.lead("from", k).over(w) - F.col("from") <= history_tokens))
        times.append(F.when(later, F.struct(F.lead("window", k).over(w).alias("window"), F.lit(True).alias("again"))))
    rows = rows.withColumn("times", F.array_compact(F.array(*times)))
    # the system turn once more for each later window, carried by the turn that begins it
    system = F.first(F.struct("sys", part.alias("part"))).over(w)
    rows = rows.withColumn("head", F.when(F.col("begins") & (F.col("window") > 1), system))

    each = rows.select("conv", "seq", "role", "seg", "skip", "chars", "head", F.explode("times").alias("at"))
    each = each.select("conv", F.col("at.window").alias("window"), "seq", "seg", F.col("at.again").alias("again"),
                       F.when(~F.col("at.again") & F.col("head.sys"), F.col("head.part")).alias("head"),
                       F.when(~F.col("at.again") & (F.col("role") == TARGET), F.struct("skip", "chars")).alias("learn"))
    in_window = Window.partitionBy("conv", "window")
    each = each.withColumn("sys_part", F.max(F.struct(F.col("head").isNotNull().alias("is"), F.col("head").alias("part"))).over(in_window))
    before = F.coalesce(F.sum(F.length("seg").cast("long")).over(in_window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = before + F.coalesce(F.col("sys_part.part.len"), F.lit(0)) + F.col("learn.skip")
    each = each.withColumn("span", F.when(F.col("learn").isNotNull(), F.struct(at.alias("start"), (at + F.col("learn.chars")).alias("end"))))
    listed = F.sort_array(F.collect_list(F.struct("seq", "seg", "span")))
    out = each.groupBy("conv", "window").agg(
        listed.alias("l"), F.max("sys_part.part.seg").alias("head"), F.sum(F.col("again").cast("int")).alias("again"))
    body = F.array_join(F.transform("l", lambda x: x["seg"]), "")
    extra = F.col("head").isNotNull().cast("int")
    return out.select(
        F.col("conv").alias(conv), "window", F.concat(F.coalesce("head", F.lit("")), body).alias("text"),
        (F.col("again") + extra).cast("int").alias("first_new"), (F.size("l") + extra).cast("int").alias("turns"),
        F.transform(F.filter("l", lambda x: x["span"].isNotNull()), lambda x: x["span"]).alias("loss"))


def read_turns(text: Column) -> Column:
    """``(role, text)`` of each turn written in a window."""
    segments = F.split(text, r"<\|im_end\|>\n", -1)
    parts = F.filter(segments, lambda s: s != "")
    body = F.transform(parts, lambda s: F.substring(s, F.lit(len(TURN_START) + 1), F.length(s)))
    return F.transform(body, lambda s: F.struct(
        unescape_role(F.substring_index(s, "\n", 1)).alias("role"),
        unescape(F.substring(s, F.length(F.substring_index(s, "\n", 1)) + 2, F.length(s))).alias("text")))


def window_digests(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation, read from its windows."""
    new = F.slice(read_turns(F.col("text")), F.col("first_new") + 1, F.greatest(F.col("turns") - F.col("first_new"), F.lit(0)))
    lines = F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(
        F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    each = windows.select(F.col(f"`{conv}`").alias("conv"), "window", (F.col("turns") - F.col("first_new")).alias("n"), lines.alias("lines"),
                          learned.alias("learned"), F.length("text").alias("chars"))
    whole = each.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("window", "lines", "learned"))).alias("l"),
                                     F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    joined = lambda f: F.array_join(F.transform("l", lambda x: x[f]), "")
    return whole.select(F.col("conv").alias(conv), "n_turns", F.sha2(joined("lines"), 256).alias("turns_sha256"),
                        F.length(joined("learned")).cast("long").alias("loss_chars"), F.sha2(joined("learned"), 256).alias("loss_sha256"),
                        "formatted_chars")
