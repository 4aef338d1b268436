"""The 27 style features of a text, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P
from .text import count_literal, count_matches, find_all, matches, strip

FEATURES = [
    "log_chars", "log_words", "avg_word_len", "avg_sent_words", "ttr_first200", "newlines_per_100w",
    "blank_lines_per_100w", "headers_per_100w", "bullets_per_100w", "bold_per_100w", "code_fences",
    "table_rows_per_100w", "hr_count", "latex", "emoji_per_1kc", "emdash_per_1kc", "endash_per_1kc",
    "colon_per_1kc", "semicolon_per_1kc", "exclam_per_1kc", "question_per_1kc", "paren_per_1kc",
    "curly_quote_per_1kc", "opener_affirmation", "ends_with_offer", "first_person_per_100w",
    "you_per_100w",
]


def _count_where(array: Column, test) -> Column:
    return F.size(F.filter(array, test))


def style_features(df: DataFrame, text: str = "output") -> DataFrame:
    """``df`` plus the 27 feature columns of ``text``; narrow, no shuffle.

    Words and lines are laid out once in a first projection and read many times by the second.
    """
    t = F.col(text)
    base = df.withColumns(
        {
            "_words": F.transform(find_all(t, P.WORD), F.lower),
            "_lines": F.split(t, "\n"),
            "_word_chars": F.length(F.regexp_replace(t, f"[^{P.WORD_CHARS}]+", "")),
            "_chars": F.length(t),
        }
    )
    words, lines = F.col("_words"), F.col("_lines")
    n_words = F.size(words)
    nw = F.greatest(n_words, F.lit(1)).cast("double")
    nc = F.greatest(F.col("_chars"), F.lit(1)).cast("double")
    not_blank = P.java(r"[^\s]")
    n_sentences = _count_where(
        F.split(t, P.java(P.SENTENCE_END)), lambda s: s.rlike(not_blank)
    )
    first = F.slice(words, 1, 200)
    tail = F.right(strip(t), F.lit(300))

    def per_words(count: Column) -> Column:
        return F.lit(100.0) * count / nw

    def per_chars(count: Column) -> Column:
        return F.lit(1000.0) * count / nc

    def flag(test: Column) -> Column:
        return test.cast("double")

    curly = count_literal(t, "“") + count_literal(t, "”") + count_literal(t, "’")
    values = {
        "log_chars": F.log1p(F.col("_chars")),
        "log_words": F.log1p(n_words),
        "avg_word_len": F.col("_word_chars") / nw,
        "avg_sent_words": nw / F.greatest(n_sentences, F.lit(1)),
        "ttr_first200": F.size(F.array_distinct(first)) / F.greatest(F.size(first), F.lit(1)),
        "newlines_per_100w": per_words(F.size(lines) - 1),
        "blank_lines_per_100w": per_words(_count_where(lines, lambda x: ~x.rlike(not_blank))),
        "headers_per_100w": per_words(count_matches(t, P.MD_HEADER, "m")),
        "bullets_per_100w": per_words(count_matches(t, P.MD_BULLET, "m")),
        "bold_per_100w": per_words(count_literal(t, "**")) / 2,
        "code_fences": count_literal(t, "```") / F.lit(2.0),
        "table_rows_per_100w": per_words(_count_where(lines, lambda x: strip(x).startswith("|"))),
        "hr_count": count_matches(t, P.MD_RULE, "m").cast("double"),
        "latex": flag(matches(t, P.LATEX)),
        "emoji_per_1kc": per_chars(count_matches(t, P.EMOJI)),
        "emdash_per_1kc": per_chars(count_literal(t, "—")),
        "endash_per_1kc": per_chars(count_literal(t, "–")),
        "colon_per_1kc": per_chars(count_literal(t, ":")),
        "semicolon_per_1kc": per_chars(count_literal(t, ";")),
        "exclam_per_1kc": per_chars(count_literal(t, "!")),
        "question_per_1kc": per_chars(count_literal(t, "?")),
        "paren_per_1kc": per_chars(count_literal(t, "(")),
        "curly_quote_per_1kc": per_chars(curly),
        "opener_affirmation": flag(matches(t, P.OPENING_PRAISE, "i")),
        "ends_with_offer": flag(matches(tail, P.CLOSING_OFFER, "i")),
        "first_person_per_100w": per_words(_count_where(words, lambda w: w.isin(P.FIRST_PERSON))),
        "you_per_100w": per_words(_count_where(words, lambda w: w.isin(P.SECOND_PERSON))),
    }
    return base.withColumns(values).drop("_words", "_lines", "_word_chars", "_chars")
