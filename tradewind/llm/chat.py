"""Chat formatting in budgeted windows.

A turn is written ``<s>[INST]role[/INST]text</s>``. In a role or text, each of the strings ``<s>``,
``</s>``, ``[INST]``, ``[/INST]`` gets a backslash after its first character (one more if it has some
already), so a control string in the output is always a mark, and taking one backslash away restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import WORD, prefix_sums, text_of
from tradewind.operators.ordering import ranges_in_order
from tradewind.sources.stage import stage

_OVERHEAD = 4       # tokens counted for the marks of a turn


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(/?s>|/?INST\])", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(/?s>|/?INST\])", "$1$2$3")


def format_windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", budget: int = 512, history: int = 128) -> DataFrame:
    """Training windows: ``conv``, ``window``, ``text``, ``loss`` (spans in code points, end exclusive), ``repeated``, ``tokens``.

    A turn's tokens are its words and four for its marks. A sum over the turns before gives each turn the
    window in which it is a target: windows begin at every ``budget - history`` tokens of the conversation,
    rounded to whole turns. A window repeats, before its targets, the system turn that opens the
    conversation and the turns that began within ``history`` tokens before; ``repeated`` counts these.
    The loss covers the texts of its own assistant turns only. So a window has at most ``budget`` tokens
    beside the system turn and what its last turn has beyond; a turn is never cut.

    Turns with equal number are ordered by role and text, a null number comes last; null role and text are
    empty; a null conversation is one. Every row is a turn, repeated ones too. Other columns are left out.
    """
    step = budget - history
    rows = stage(turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text_of(role_col).alias("role"),
        text_of(text_col).alias("body"), F.monotonically_increasing_id().alias("row"))
        .withColumn("tokens", F.regexp_count("body", F.lit(WORD)).cast("long") + _OVERHEAD), "turns")
    # sorted ranges hold their share of turns, also of a conversation with very many; only turns of one number that begin alike stay together
    turn = F.col("turn").asc_nulls_last()
    ranges, _ = ranges_in_order(rows, ["conv", turn, "role", "body", "row"], by=["conv", turn, F.substring("role", 1, 50), F.substring("body", 1, 100)])
    placed = prefix_sums(ranges.withColumn("block", F.shiftright("_at", 33)), ["conv"], "block", ["_at"], "tokens", "ahead")
    own = F.floor(F.col("ahead") / step).cast("long")
    system = (F.col("ahead") == 0) & (F.col("role") == "system")
    sizes = rows.groupBy(F.col("conv").alias("_c")).agg(F.floor((F.sum("tokens") - 1) / step).cast("long").alias("last"))
    last = F.when(system, F.col("last")).otherwise(F.least("last", F.floor((F.col("ahead") + history) / step)))
    spread = (placed.join(sizes, placed["conv"].eqNullSafe(sizes["_c"])).withColumn("own", own)
              .withColumn("window", F.explode(F.sequence(F.col("own"), F.greatest("own", last.cast("long"))))))
    piece = F.concat(F.lit("<s>[INST]"), escape(F.col("role")), F.lit("[/INST]"), escape(F.col("body")), F.lit("</s>"))
    pieces = spread.select(
        "conv", "window", "ahead", "turn", "row", "tokens", (F.col("own") == F.col("window")).alias("fresh"),
        (F.col("role") == "assistant").alias("answer"), piece.alias("piece"),
        (F.length(escape(F.col("role"))) + len("<s>[INST]") + len("[/INST]")).alias("head"))
    item = F.struct("ahead", "row", "fresh", "answer", "piece", "head", "tokens")
    joined = pieces.groupBy("conv", "window").agg(F.array_sort(F.collect_list(item)).alias("items")).where(
        F.exists("items", lambda x: x["fresh"]))
    ends = F.aggregate(
        "items", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["piece"])).alias("at"),
            F.when(x["fresh"] & x["answer"], F.concat(a["spans"], F.array(F.struct(
                (a["at"] + x["head"]).alias("start"), (a["at"] + F.length(x["piece"]) - len("</s>")).alias("end")))))
            .otherwise(a["spans"]).alias("spans")))
    return joined.select(
        "conv", "window", F.array_join(F.transform("items", lambda x: x["piece"]), "").alias("text"), ends["spans"].alias("loss"),
        F.size(F.filter("items", lambda x: ~x["fresh"])).alias("repeated"),
        F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens"))


def read_windows(windows: DataFrame) -> DataFrame:
    """Turns and loss text of each conversation from its windows alone.

    Returns ``conv``, ``turns`` (role and text of each turn once, in order), ``loss`` (the unescaped texts under
    the mask, in order), ``formatted_chars``. Gathers one conversation's text in a row, as its digest needs.
    """
    marks = F.split(F.col("text"), "</s>", -1)
    own = F.slice(marks, F.col("repeated") + 1, F.size(marks) - 1 - F.col("repeated"))
    read = windows.select(
        "conv", "window", F.length("text").cast("long").alias("chars"),
        F.transform(own, lambda s: F.struct(
            unescape(F.element_at(F.split(F.substring(s, len("<s>[INST]") + 1, (1 << 31) - 1), r"\[/INST\]", -1), 1)).alias("role"),
            unescape(F.element_at(F.split(s, r"\[/INST\]", -1), -1)).alias("text"))).alias("turns"),
        F.transform("loss", lambda x: unescape(F.col("text").substr(x["start"] + 1, x["end"] - x["start"]))).alias("loss"))
    gathered = read.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("all"),
                                        F.sum("chars").alias("formatted_chars"))
    return gathered.select("conv", F.flatten(F.transform("all", lambda w: w["turns"])).alias("turns"),
                           F.flatten(F.transform("all", lambda w: w["loss"])).alias("loss"), "formatted_chars")
