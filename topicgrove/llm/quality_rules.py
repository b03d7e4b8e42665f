"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import ascii_lower, let, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in that is for it with as was on be by "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es "
    "de la le et les des en un du une que est pour qui dans par sur pas plus au avec "
    "el que los del se las por un para con una su al lo como más"
).split()
SYMBOLS = "#*$%&|<>"
#: How a line ends that breaks off, and how one starts that is an item of a list.
OPEN_END, BULLET = r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*$", r"^[\x20\x09-\x0D]*[-*\x{2022}]"
WINDOW = 8


class Rule(NamedTuple):
    """A document breaks the rule where ``measure`` is below ``low`` or above ``high``."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Measures are named in ``measures``. Ratios are of words or lines as their names say.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_words_per_word", 0.05, None),
    Rule("shouting", "exclamations_per_word", None, 0.2),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("open_lines", "open_line_ratio", None, 0.3),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
)


def repeated_words(words: Column) -> Column:
    """Words that lie in a run of ``WINDOW`` words found twice or more in the text, the first one included.

    Runs of 2, 4 and 8 words are hashed from those of half the length. Only a text in which two runs of four words
    meet needs those of eight, and only one in which two of these meet pays for the positions.
    """

    def doubled(values: Column, step: int) -> Column:
        return F.zip_with(values, F.slice(values, step + 1, F.size(values)), lambda a, b: F.xxhash64(a, b))

    def whole(values: Column, n: int) -> Column:
        return F.slice(values, 1, F.greatest(F.size(values) - (n - 1), F.lit(0)))

    def covered(runs: Column) -> Column:
        met = F.filter(runs, lambda x, i: (F.get(runs, i - 1)["h"] == x["h"]) | (F.get(runs, i + 1)["h"] == x["h"]))
        steps = F.aggregate(
            F.array_sort(F.transform(met, lambda x: x["p"])),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW - 1).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(p - acc["last"], F.lit(WINDOW))).alias("n"), p.alias("last")),
        )
        return steps["n"]

    def of_eights(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(pairs), covered))

    def of_fours(h: Column) -> Column:
        # the three runs at the end are shorter than four words; they differ from all others and do no harm
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(whole(doubled(h, 4), WINDOW), of_eights))

    found = let(doubled(words, 1), lambda h: let(doubled(h, 2), of_fours))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(found).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` as ``(doc_id, text, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)``
    with the counts of lines, of lines that break off or start a list item, and of stop words (A-Z lowered).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("words")).select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).cast("long").alias("n_lines"),
        let(lines, lambda x: F.size(F.filter(x, lambda line: line.rlike(OPEN_END)))).cast("long").alias("n_open_lines"),
        let(lines, lambda x: F.size(F.filter(x, lambda line: line.rlike(BULLET)))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(words_of(ascii_lower(F.col("text"))), lambda w: w.isin(list(dict.fromkeys(STOP_WORDS))))).cast("long").alias("n_stop_words"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def measures(counted: DataFrame) -> DataFrame:
    """Add what ``RULES`` name, from the counts and the text. Ratios of nothing are zero."""
    ratio = lambda n, of: F.when(F.col(of) > 0, n / F.col(of)).otherwise(F.lit(0.0))
    exclamations = F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))
    return counted.withColumns(
        {
            "mean_word_chars": ratio(F.col("word_chars"), "n_words"),
            "symbols_per_word": ratio(F.col("n_symbols"), "n_words"),
            "stop_words_per_word": ratio(F.col("n_stop_words"), "n_words"),
            "exclamations_per_word": ratio(exclamations, "n_words"),
            "dup_line_ratio": ratio(F.col("n_dup_lines"), "n_lines"),
            "open_line_ratio": ratio(F.col("n_open_lines"), "n_lines"),
            "bullet_line_ratio": ratio(F.col("n_bullet_lines"), "n_lines"),
        }
    )


def broken(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a measured row breaks, in the table's order."""
    checks = []
    for rule in rules:
        value = F.col(rule.measure)
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        checks.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``broken`` rules and ``kept``.

    A document fails the base if it has fewer than 20 words or if more than 30 % of them lie in repeated runs of
    eight words. The rest is kept if it breaks no rule. A null text has no words and fails; a null id stays null;
    repeated rows are judged alike; other columns of ``docs`` are ignored. No rows give no rows.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = measures(base_counts(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), broken(rules).alias("broken"),
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
