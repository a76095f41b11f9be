"""Quality rules: counts of a text, and the likelihood ratio of its hashed n-grams between trusted and all documents.

Words and pairs of neighbouring words fall into ``buckets`` cells by hash. Two multinomials over the cells are
counted, one of all documents and one of the trusted ones, and a document's score is the sum over its grams of
log(p_trusted / p_all), divided by their number. A document is kept if its score reaches the threshold.
Weights are whole millionths, so sums are exact and a rerun gives the same verdicts in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import SPACES, WORD, text_of
from tradewind.sources.stage import stage

SYMBOLS = "#*$%&|<>"
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_in(text: Column) -> Column:
    """The words of a text, cut in one pass: only the first and the last part can be blank."""
    def inner(parts: Column) -> Column:
        first, last = (F.element_at(parts, 1) == "").cast("int"), (F.element_at(parts, -1) == "").cast("int")
        return F.slice(parts, first + 1, F.greatest(F.size(parts) - first - last, F.lit(0)))
    return F.transform(F.array(F.split(text, SPACES, -1)), inner)[0]


def _met_again(spots: str) -> Column:
    """Of an array of (x, i) in order: each i whose x a neighbour has too."""
    size, none = F.size(spots), F.array(F.lit(None))
    xs = F.transform(spots, lambda s: s["x"])
    before = F.zip_with(xs, F.concat(none, F.slice(xs, 1, size - 1)), lambda a, b: a.eqNullSafe(b))
    after = F.concat(F.slice(before, 2, size - 1), F.array(F.lit(False)))
    either = F.zip_with(before, after, lambda a, b: a | b)
    return F.transform(F.filter(F.zip_with(spots, either, lambda s, e: F.struct(s["i"].alias("i"), e.alias("e"))), lambda x: x["e"]), lambda x: x["i"])


def count_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``words``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of its text.

    Equal three-word windows are brought together by sorting, so the cost follows the length of a text: first all windows by a
    hash, in texts where a hash occurs twice, and then those with such a hash by their words.
    """
    body = text_of(text)
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))
    kept = [c for c in docs.columns if c != text]
    a = docs.select(*kept, words_in(body).alias("words"), F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"), lines.alias("_lines"))
    c = a.select(*kept, "words", "n_symbols", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    run = lambda f: lambda i: f(*[F.get("words", i + k) for k in range(3)])
    hashes = F.when(F.size("words") > 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), run(F.xxhash64)))
    d = c.select(*kept, "n_symbols", "n_dup_lines", "words", hashes.alias("_runs"))
    spots = F.when(F.size(F.array_distinct("_runs")) < F.size("_runs"), F.sort_array(F.transform("_runs", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    e = d.withColumn("_spots", spots).drop("_runs").withColumn("_again", _met_again("_spots")).drop("_spots")
    exact = F.sort_array(F.transform("_again", lambda i: F.struct(run(lambda *w: F.concat_ws(" ", *w))(i).alias("x"), i.alias("i"))))
    f = e.withColumn("_spots", exact).drop("_again").withColumn("_again", _met_again("_spots")).drop("_spots")
    inside = F.array_distinct(F.flatten(F.transform("_again", lambda i: F.array(i, i + 1, i + 2))))
    repeated = F.when(F.col("_again").isNull(), 0).otherwise(F.size(inside))
    return f.select(*kept, "words", "n_symbols", "n_dup_lines", repeated.cast("long").alias("n_repeat_words"))


def word_rows(docs: DataFrame) -> DataFrame:
    """A row per word of ``words`` with the cells of the word and of it with the next one; a row of nulls for no words."""
    kept = [c for c in docs.columns if c != "words"]
    zipped = docs.select(*kept, "words", F.slice("words", 2, F.size("words")).alias("following"))
    return zipped.select(*kept, F.inline_outer(F.arrays_zip("words", "following")).alias("word", "following"))


def _cells(buckets: int) -> tuple[Column, Column]:
    """By checksums, 32 bits each."""
    h, g = F.crc32(F.col("word").cast("binary")), F.crc32(F.col("following").cast("binary"))
    return (h % buckets).cast("int"), ((h * 31 + g * 7919 + 12345) % buckets).cast("int")


def gram_weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 14, prior: float = 1.0) -> DataFrame:
    """``cell`` and ``weight``: log(p_trusted / p_all) in millionths, for each cell met (at most ``buckets`` rows, staged).

    ``trusted`` holds the ids of trusted documents; repeated and unknown ids do no harm. The trusted
    multinomial is smoothed towards that of all documents, by ``prior`` grams a cell, so a cell about which
    little is known weighs little. Without trusted documents every weight is 0. All documents are counted, combined in each
    task. The trusted ids are staged: few go to every task, and many are met by a sorted join.
    """
    sure = stage(trusted.select(F.col(trusted.columns[0]).alias("_id")).where("_id IS NOT NULL").distinct(), "trusted")
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sure, F.col("id") == F.col("_id"), "left")
    words = marked.select(F.col("_id").isNotNull().cast("long").alias("sure"), words_in(text_of("text")).alias("words"))
    met = word_rows(words).select("sure", F.explode(F.array(*_cells(buckets))).alias("cell")).where("cell IS NOT NULL")
    counts = stage(met.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("sure").alias("sure")), "cells")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("sure"), F.lit(0)).alias("sure")).first()
    mass = prior * buckets
    near = F.col("sure") * float(total["n"] + buckets) / (F.col("n") + 1) + mass
    return stage(counts.select("cell", F.round(1e6 * (F.log(near) - F.log(F.lit(float(total["sure"] + mass))))).cast("long").alias("weight")), "weights")


def judge(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 14, threshold: float = -0.1) -> DataFrame:
    """One row per input row: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``, ``n_grams``, ``score`` (sum of weights in millionths).

    Fails the base rules: fewer than 50 words, or more than half of the words in repeated three-word windows.
    Kept: not failed, and ``score`` at least ``threshold`` a gram. A null text is empty: no words, failed. Rows
    that repeat an id or a text are judged each; an empty table gives an empty one; other columns are left out.
    The weights are at most ``buckets`` rows, so the join may broadcast them; texts are not shuffled.
    """
    micro = round(threshold * 1e6)
    counted = word_rows(count_rules(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))))
    alone, paired = _cells(buckets)
    first = F.broadcast(weights.select(F.col("cell").alias("_a"), F.col("weight").alias("_wa")))
    second = F.broadcast(weights.select(F.col("cell").alias("_b"), F.col("weight").alias("_wb")))
    grams = (counted.withColumn("_alone", alone).withColumn("_paired", paired)
             .join(first, F.col("_alone") == F.col("_a"), "left").join(second, F.col("_paired") == F.col("_b"), "left"))
    score = F.coalesce(F.sum("_wa"), F.lit(0)) + F.coalesce(F.sum("_wb"), F.lit(0))
    scored = grams.groupBy("row", "id", "n_symbols", "n_dup_lines", "n_repeat_words").agg(
        F.count("word").alias("n_words"), F.coalesce(F.sum(F.length("word")), F.lit(0)).cast("long").alias("word_chars"),
        (F.count("word") + F.count("following")).alias("n_grams"), score.cast("long").alias("score"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(F.col("id").alias(id_col), *_BASE, failed.alias("base_failed"),
                         (~failed & (F.col("score") >= micro * F.col("n_grams"))).alias("kept"), "n_grams", "score")
