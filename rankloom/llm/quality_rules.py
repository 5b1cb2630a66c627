"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every text is measured once by higher-order functions, all in the scan's own
stage: nothing is exploded and nothing is shuffled. A rule bounds one ratio of
two measures in per cent, in whole numbers, so its verdict is exact.

Defined results: a null or empty text has no words, fails the base rules and is
not kept. Extra columns may have any name; `keep_good` passes them on.
Repeated rows are measured each by itself. Windows of 8 words are told apart by
64-bit hashes; two that differ are taken for equal with a chance below
n^2 / 2^64 in a text of n words.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import parse_once
from rankloom.llm.columns import BLANKS, let, whole

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PCT = 30

# Common words of English, French, German and Spanish.
STOP_WORDS = tuple(
    "a and are as be by for from in is it of on or that the this to was with what "
    "au aux avec dans de des du elle en est et il la le les ou par pas pour que qui sur un une "
    "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu "
    "al como con de del el en es la las los no para por que se su un una y".split()
)

STOP_FORMS = tuple(
    dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper()))
)


class Rule(NamedTuple):
    """`low` <= 100 * measure / base <= `high`; None leaves a side open."""

    name: str
    measure: str
    base: str
    low: int | None
    high: int | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("exclamations", "n_marks", "n_words", None, 30),
    Rule("capitals", "n_capitals", "word_chars", None, 50),
    Rule("stop_words", "n_stop_words", "n_words", 4, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
)


def _count_of(text: Column, characters: str) -> Column:
    """Characters of a regular expression's class."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def _repeated_words(words: Column) -> Column:
    """Words inside a window of 8 that the text holds at least twice."""

    def covered(windows: Column) -> Column:
        placed = F.array_sort(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def twice(placed: Column) -> Column:
            same = F.filter(
                placed,
                lambda x, k: x["h"].eqNullSafe(F.get(placed, k + 1)["h"])
                | ((k > 0) & x["h"].eqNullSafe(F.get(placed, k - 1)["h"])),
            )
            starts = F.array_sort(F.transform(same, lambda x: x["i"]))
            zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            return F.aggregate(
                starts,
                zero,
                lambda s, i: F.struct(
                    (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")
                ),
                lambda s: s["n"],
            )

        repeated = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeated, let(placed, twice)).otherwise(0)

    def joined(hashes: Column, step: int) -> Column:
        """Hashes of twice the length, each of one and the one `step` words on."""
        return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))

    def of_eight(hashes: Column) -> Column:
        windows = F.slice(joined(hashes, 4), 1, F.size(hashes) - (WINDOW - 1))
        return F.when(F.size(hashes) > WINDOW, let(windows, covered)).otherwise(0)

    def of_four(hashes: Column) -> Column:
        return let(joined(hashes, 2), of_eight)

    return let(
        F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(joined(hashes, 1), of_four)
    )


def _of_words(text: Column) -> Column:
    words = F.array_remove(F.split(text, f"[{BLANKS}]+"), "")

    def measured(words: Column) -> Column:
        stops = F.filter(words, lambda w: w.isin(*STOP_FORMS))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(stops).cast("long").alias("n_stop_words"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    return let(words, measured)


def _of_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))

    def measured(lines: Column) -> Column:
        def ending(pattern: str) -> Column:
            return F.size(F.filter(lines, lambda line: line.rlike(pattern))).cast("long")

        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            ending(r"^[ \t]*[-*•]").alias("n_bullet_lines"),
            ending(r"(\.\.\.|…)[ \t\r]*$").alias("n_ellipsis_lines"),
        )

    return let(lines, measured)


def _passes(rule: Rule) -> Column:
    share, base = 100 * F.col(rule.measure), F.col(rule.base)
    sides = [F.lit(True)]
    if rule.low is not None:
        sides.append(share >= rule.low * base)
    if rule.high is not None:
        sides.append(share <= rule.high * base)
    return reduce(and_, sides)


def _judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row whole in `_row`, clear of clashing names, with its measures and verdict."""
    text = F.col("_text")
    measured = docs.select(F.struct("*").alias("_row"), whole().alias("_text")).select(
        "_row",
        parse_once(
            F.struct(
                _of_words(text).alias("_words"),
                _of_lines(text).alias("_lines"),
                (F.length(text) - _count_of(text, BLANKS)).cast("long").alias("word_chars"),
                _count_of(text, "#*$%&|<>").cast("long").alias("n_symbols"),
                _count_of(text, "!").cast("long").alias("n_marks"),
                _count_of(text, r"\p{Lu}").cast("long").alias("n_capitals"),
            )
        ),
    )
    counts = ("word_chars", "n_symbols", "n_marks", "n_capitals")
    flat = measured.select("_row", "_words.*", "_lines.*", *counts)
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")
    )
    failed = F.array_compact(
        F.array(*[F.when(~_passes(rule), F.lit(rule.name)) for rule in rules])
    )
    judged = flat.withColumn("base_failed", base_failed).withColumn("failed_rules", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row `doc_id`, all measures, `base_failed`, `failed_rules` and `kept`."""
    judged = _judged(docs, rules)
    return judged.select("_row.doc_id", *[c for c in judged.columns if c != "_row"])


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows the rules keep, with the columns they came with."""
    return _judged(docs, rules).where("kept").select("_row.*")
