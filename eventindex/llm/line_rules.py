"""Line-first cleaning, in DataFrame functions only.

Each line of a text is judged by itself:

| rule | a line fails if |
| --- | --- |
| punctuation | it has under `SHORT` words and does not end a sentence, or over `SIGNS` % of its characters are signs of markup, or it has `MARKS` or more doubled exclamation or question marks |
| navigation | it has `BARS` or more separators of menus, or it is one short label of a menu |
| boilerplate | it holds a phrase of notices, licences, forms or scripts |

Failing lines are removed. A document is rejected if removed lines held over `LOST` % of the
characters of its words, or if it fails the base rule: under 20 words, or over 30 % of its words in
runs of eight words that occur twice or more in the text.

Everything is computed inside the row: a text is never exploded, so nothing is shuffled and a hot
source or a very long text makes one long row, not a large group. Repeated runs are found by sorting
the hashes of all runs with their places (64 bits; n log n), so very long texts stay cheap.

Defined results: null text counts as empty; a text without words has no lines to lose and fails the
base rule; empty lines are neither kept nor lost; repeated rows each give a row; an empty table
gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from eventindex.llm.common import text_or_empty

# fixed values: white space between words, signs counted in the base columns
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
RUN = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

SHORT, SIGNS, MARKS, BARS, LOST = 5, 8, 3, 3, 50
SENTENCE_END = r"""[.!?:;…。"'\)\]”’»][\x20\x09-\x0D]*$"""
SEPARATORS = r"[|»›•]|·|>>"
MENU = (r"(?i)^[\x20\x09-\x0D]*(home|menu|search|login|log in|sign in|sign up|register|next|previous|"
        r"back|top|share|print|contact|about|about us|sitemap|help|faq|more|read more)[\x20\x09-\x0D.]*$")
NOTICES = (r"(?i)\b(all rights reserved|copyright \S|terms of (use|service)|privacy policy|"
           r"cookie(s| policy)|javascript|click here|subscribe to|sign up for|lorem ipsum|"
           r"licensed under|permission is hereby granted|without warranty|spdx-license-identifier|"
           r"redistribution and use)\b")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once: the optimizer does not copy it into every use, as it
    would with a plain column, nor into loops over arrays."""
    return F.transform(F.array(value), use)[0]


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside runs of RUN words that occur twice or more, all occurrences counted."""
    def covered(places: Column) -> Column:
        last = F.size(places) - 1
        step = F.transform(places, lambda p, k: F.when(k == last, F.lit(RUN)).otherwise(
            F.least(F.lit(RUN), F.get(places, k + 1) - p)))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeats(pairs: Column) -> Column:
        same = F.transform(pairs, lambda p, k: F.when(
            (p["h"] == F.get(pairs, k - 1)["h"]) | (p["h"] == F.get(pairs, k + 1)["h"]),
            p["i"]).otherwise(F.lit(-1)))
        return let(F.sort_array(F.filter(same, lambda i: i >= 0)), covered)

    def by_hash(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(pairs, repeats))

    runs = let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashed: F.transform(
        F.sequence(F.lit(1), F.size(hashed) - (RUN - 1)),
        lambda i: F.xxhash64(F.slice(hashed, i, RUN))))
    return F.when(F.size(words) < RUN, F.lit(0)).otherwise(let(runs, by_hash))


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, GAP, ""))


def signs(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def fails(line: Column) -> Column:
    """Whether a line with words is removed."""
    few = ~line.rlike(r"^([\x20\x09-\x0D]*[^\x20\x09-\x0D]+){" + str(SHORT) + "}")
    punctuation = ((few & ~line.rlike(SENTENCE_END)) | (100 * signs(line) > SIGNS * F.length(line))
                   | line.rlike(r"(?s)([!?]{2}.*?){" + str(MARKS) + "}"))
    navigation = line.rlike(r"(?s)((" + SEPARATORS + r").*?){" + str(BARS) + "}") | line.rlike(MENU)
    return punctuation | navigation | line.rlike(NOTICES)


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lost_chars, cleaned (the text of the lines that stay)."""
    text = F.col("text")
    filled = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def judge(lines: Column) -> Column:
        return let(F.filter(lines, lambda x: ~fails(x)), lambda good: F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            F.array_join(good, "\n").alias("cleaned")))

    def count(words: Column) -> Column:
        return F.struct(F.size(words).cast("bigint").alias("n_words"),
                        repeated_words(words).cast("bigint").alias("n_repeat_words"))

    lost = (F.col("word_chars") - word_chars(F.col("l.cleaned"))).cast("bigint")
    return (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
            .select("doc_id", word_chars(text).cast("bigint").alias("word_chars"),
                    signs(text).cast("bigint").alias("n_symbols"),
                    let(word_list(text), count).alias("w"), let(filled, judge).alias("l"))
            .select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines",
                    "w.n_repeat_words", lost.alias("lost_chars"), "l.cleaned")
            .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed")
                        & (100 * F.col("lost_chars") <= LOST * F.col("word_chars"))))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and cleaned text of the documents that are kept."""
    return assess(docs, id_col, text_col).filter("kept").select("doc_id", F.col("cleaned").alias("text"))
