"""Operator 7: line-first cleaning with document rules, in DataFrame functions only.

Every line is held against punctuation, navigation and boilerplate rules; lines that fail are
removed, and a document goes if it fails the base rules or keeps too small a share of its text.

Defined results: a null or empty text has no words and fails the base rules; a repeated row is
judged like any other; an empty table gives an empty result; other columns of the input are
ignored, whatever their names. All work on a text stays within its row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import fenced, text_of, trimmed, without, words_of

#: Symbols that are rare in prose (fixed values).
SYMBOLS = "#*$%&|<>"

#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "enable javascript", "sign up for our newsletter", "lorem ipsum",
)


#: What ends a sentence beside ".", "!" and "?", in all scripts (fixed values of Unicode), and the
#: scripts that part sentences by blanks alone (Thai, Lao), a letter of which will do.
SENTENCE_ENDS = "…‼⁇⁈⁉。．｡！？﹒﹖﹗︒؟۔؞।॥։።፧፨།༎༏།။၊។៕᠃᠉᥄᥅᭟⸮⸼꓿꘎꘏꛳꛷"
BLANK_PARTED = "\u0e00-\u0eff"
_OTHER_ENDS = f"[{SENTENCE_ENDS}{BLANK_PARTED}]"


@dataclass(frozen=True)
class LineRules:
    """Shares are in percent, so that comparisons are between whole numbers."""

    window: int = 5
    least_words: int = 10
    repeat_share: int = 20
    symbol_share: int = 10
    shout_share: int = 30
    most_bars: int = 2
    kept_share: int = 50


def count_of(text: Column, token: str) -> Column:
    """How often a token stands in a text, without overlaps."""
    left = F.length(F.replace(text, F.lit(token), F.lit("")))
    return ((F.length(text) - left) / len(token)).cast("int")


def passes(line: Column, low: Column, rules: LineRules) -> Column:
    """Whether a line stays; ``low`` is the line in lower case. A blank line stays."""
    body = F.length(line)
    symbols = F.length(line) - F.length(without(line, SYMBOLS))
    ends = F.contains(line, F.lit(".")) | F.contains(line, F.lit("!")) | F.contains(line, F.lit("?"))
    ends = ends | line.rlike(_OTHER_ENDS)
    punctuation = (
        ends
        & (100 * symbols <= rules.symbol_share * body)
        & (100 * 2 * count_of(line, "!!") <= rules.shout_share * body)
    )
    navigation = count_of(line, "|") > rules.most_bars
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    return (trimmed(line) == "") | (punctuation & ~navigation & ~boilerplate)


def line_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: LineRules = LineRules(),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Judge every document.

    Returns the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``n_lines``, ``n_lines_kept``, ``base_failed``, ``kept``,
    ``clean_text`` (the text without the lines that fail) and the columns to ``carry`` along, which
    must not have one of these names.
    """
    w = rules.window
    also = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"), also.alias("_carried")
    )
    rows = rows.select("*", trimmed(F.col("_text")).alias("_trimmed"))
    rows = rows.select(
        "doc_id", "_text", "_carried", F.split("_text", "\n", -1).alias("_lines"),
        F.split(F.lower("_text"), "\n", -1).alias("_low"),
        words_of(F.col("_trimmed")).alias("_words"),
    )
    blank = F.array_compact(
        F.transform("_lines", lambda x: F.when(trimmed(x) != "", x))
    )
    rows = rows.select(
        "doc_id", "_text", "_carried", "_lines",
        F.size("_words").cast("long").alias("n_words"),
        F.transform("_words", lambda x: F.xxhash64(x)).alias("_hashes"),
        blank.alias("_filled"),
        F.filter("_lines", lambda x, i: passes(x, F.get("_low", i), rules)).alias("_good"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
    )
    at = lambda i, k: F.get(F.col("_hashes"), i + k)
    windows = F.when(
        F.col("n_words") >= w,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - w),
            lambda i: F.xxhash64(*[at(i, k) for k in range(w)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("*", windows.alias("_windows"))
    # Only texts with a repeated window pay for the sort.
    tagged = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(
            F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        ),
    )
    rows = rows.select("*", tagged.alias("_tagged"))
    same = lambda x, i: (
        F.coalesce(F.get(F.col("_tagged"), i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(F.col("_tagged"), i + 1)["h"] == x["h"], F.lit(False))
    )
    starts = F.sort_array(F.transform(F.filter("_tagged", same), lambda x: x["i"]))
    rows = rows.select("*", F.when(F.col("_tagged").isNotNull(), starts).alias("_starts"))
    # A start covers the words up to the next start, at most the width of a window.
    nexts = F.slice(F.col("_starts"), 2, F.greatest(F.size("_starts"), F.lit(1)))
    covers = F.zip_with(
        F.col("_starts"), nexts, lambda a, b: F.least(F.lit(w), F.coalesce(b - a, F.lit(w)))
    )
    repeated = F.coalesce(F.aggregate(covers, F.lit(0), lambda s, x: s + x), F.lit(0))
    clean = F.array_join("_good", "\n")
    rows = rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        (F.length("_text") - F.length(without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_good").cast("long").alias("n_lines_kept"),
        F.length("_text").alias("_length"),
        clean.alias("clean_text"),
        "_carried",
    )
    rows = rows.withColumn(
        "base_failed",
        (F.col("n_words") < rules.least_words)
        | (100 * F.col("n_repeat_words") > rules.repeat_share * F.col("n_words")),
    )
    enough = 100 * F.length("clean_text") >= rules.kept_share * F.col("_length")
    rows = fenced(rows.withColumn("kept", ~F.col("base_failed") & enough))
    return rows.select(
        *[c for c in rows.columns if c not in ("_length", "_carried")],
        *[F.col("_carried")[c].alias(c) for c in carry],
    )
