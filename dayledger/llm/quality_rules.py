"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import words_of

#: Common function words of the four languages, as they stand inside sentences.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with be by this from at "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "de la le et les des en un du une que est pour qui dans sur par "
    "el los del se las por con una su para como al lo"
).split()

MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A measure is in order from `least` to `most`, both included; None leaves a side open."""

    measure: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        value, bad = F.col(self.measure), F.lit(False)
        if self.least is not None:
            bad = bad | (value < self.least)
        if self.most is not None:
            bad = bad | (value > self.most)
        return bad


RULES = (
    Rule("mean_word_chars", least=2.0, most=14.0),
    Rule("symbol_ratio", most=0.10),
    Rule("exclamation_ratio", most=0.20),
    Rule("capital_ratio", most=0.50),
    Rule("letter_word_ratio", least=0.70),
    Rule("stop_words", least=2),
    Rule("dup_line_ratio", most=0.50),
    Rule("bullet_line_ratio", most=0.90),
    Rule("ellipsis_line_ratio", most=0.50),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _windows(words: Column) -> Column:
    """Hash and place of each 3-word window, sorted, so that equal windows are neighbours.

    Two different windows of one text share a 64-bit hash with a chance below one in 10^10
    even in a text of 40,000 words.
    """
    places = F.sequence(F.lit(0), F.size(words) - 3)
    window = F.transform(
        places,
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(words) < 3, none).otherwise(F.sort_array(window))


def _repeat_words(windows: Column) -> Column:
    """How many words lie in a window that the text has twice or more."""
    pairs = F.zip_with(
        F.slice(windows, F.lit(2), F.greatest(F.size(windows) - 1, F.lit(0))),
        F.slice(windows, F.lit(1), F.greatest(F.size(windows) - 1, F.lit(0))),
        lambda b, a: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    twice = F.array_distinct(F.flatten(F.array_compact(pairs)))
    places = lambda shift: F.transform(twice, lambda i: i + shift)
    return F.size(F.array_union(F.array_union(twice, places(1)), places(2)))


def measured(docs: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """`row` (all columns of docs) with the counts and ratios of its text.

    Words are runs of characters other than white space; a null text has none. Everything
    is an expression over whole texts: no user function, no shuffle, no state.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    has_word = lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0
    split = docs.select(F.struct("*").alias("row")).select(
        "row", words_of(text).alias("words"), F.filter(F.split(text, "\n"), has_word).alias("lines")
    )
    # A column of its own, as it is used several times.
    split = split.withColumn("windows", _windows(F.col("words")))
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    counted = split.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.regexp_count(text, F.lit("[!?]")).alias("n_exclamations"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_capitals"),
        letters.alias("n_letters"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*")).alias("n_letter_words"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, stop_words)))).alias("stop_words"),
        F.size(F.filter("lines", lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("n_bullets"),
        F.size(F.filter("lines", lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_ellipses"),
    )
    n_words, n_lines = F.col("n_words"), F.col("n_lines")
    return counted.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_words",
        _ratio(F.col("word_chars"), n_words).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), n_words).alias("symbol_ratio"),
        _ratio(F.col("n_exclamations"), n_words).alias("exclamation_ratio"),
        _ratio(F.col("n_capitals"), F.col("n_letters")).alias("capital_ratio"),
        _ratio(F.col("n_letter_words"), n_words).alias("letter_word_ratio"),
        _ratio(F.col("n_dup_lines"), n_lines).alias("dup_line_ratio"),
        _ratio(F.col("n_bullets"), n_lines).alias("bullet_line_ratio"),
        _ratio(F.col("n_ellipses"), n_lines).alias("ellipsis_line_ratio"),
    )


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`row`, the measures, base_failed, broken_rules (their measures' names) and kept.

    base_failed: fewer than 50 words, or over half of the words in repeated windows. A
    null, empty or blank text has no words and fails. Repeated rows are judged alike.
    """
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    broken = F.array_compact(F.array(*(F.when(r.broken(), F.lit(r.measure)) for r in rules)))
    return (
        measured(docs)
        .withColumn("base_failed", (n_words < MIN_WORDS) | (100 * repeated > 50 * n_words))
        .withColumn("broken_rules", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
    )


def well_written(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that no rule rejects, with exactly their own columns."""
    # The row number keeps Catalyst from moving the filter below the measures, which would
    # compute each of them once for every rule that uses it.
    numbered = judged(docs, rules).withColumn("place", F.monotonically_increasing_id())
    return numbered.where((F.col("place") >= 0) & F.col("kept")).select("row.*")
