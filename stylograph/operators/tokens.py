"""Vocabularies and token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import TOKENS
from ..session import materialize

INPUT_SHARE = 0.25

# Vocabulary limits by token level: (max size, min frequency, max sequence length).
LEVELS = {"char": (300, 5, 2000), "word": (30_000, 3, 400)}


def token_counts(df: DataFrame, text: str, level: str) -> DataFrame:
    """Corpus frequency of every token.  Counts are combined before the shuffle."""
    tokens = df.select(F.explode(TOKENS[level](text)).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("freq"))


def build_vocab(df: DataFrame, text: str, level: str, max_size: int, min_freq: int) -> DataFrame:
    """(token, id, freq): the ``max_size`` most frequent tokens seen at least ``min_freq`` times.

    Ids start after the special tokens, by falling frequency and then token order.
    """
    top = (
        token_counts(df, text, level)
        .orderBy(F.desc("freq"), "token")
        .limit(max_size)
        .filter(F.col("freq") >= min_freq)
    )
    # the list holds at most max_size entries, so numbering it needs no distributed pass
    entry = F.struct(-F.col("freq"), F.col("token"), F.col("freq"))
    ranked = top.agg(F.sort_array(F.collect_list(entry)).alias("v"))
    numbered = ranked.select(F.posexplode("v").alias("at", "v"))
    return numbered.select(
        F.col("v.token").alias("token"),
        (F.col("at") + P.FIRST_FREE_ID).cast("int").alias("id"),
        F.col("v.freq").alias("freq"),
    )


def encode_tokens(
    df: DataFrame, row_id: str, tokens, vocab: DataFrame, max_len: int, name: str = "ids"
) -> DataFrame:
    """(row_id, ids): the first ``max_len`` tokens as ids; unknown tokens become 1.

    The vocabulary is broadcast (bounded by its maximum size).  What is shuffled back is one short
    list of numbers per row, never the text.
    """
    cut = df.select(row_id, F.posexplode_outer(F.slice(tokens, 1, max_len)).alias("at", "token"))
    known = cut.join(F.broadcast(vocab.select("token", "id")), "token", "left")
    number = F.when(F.col("token").isNotNull(), F.coalesce("id", F.lit(P.UNKNOWN_ID)))
    pairs = F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", number.alias("id"))))
    listed = known.groupBy(row_id).agg(F.array_sort(pairs).alias("_pairs"))
    return listed.select(row_id, F.transform("_pairs", lambda p: p["id"]).alias(name))


def encode_fields(
    df: DataFrame, row_id: str, vocab: DataFrame, level: str, mode: str, max_len: int,
    input_share: float = INPUT_SHARE,
) -> DataFrame:
    """(row_id, ids) of input, output or both; for both, the input takes at most its share of ``max_len``.

    Both fields are laid end to end before the one lookup.  An empty row becomes [1].
    """
    tok = TOKENS[level]
    if mode in ("input", "output"):
        tokens = F.slice(tok(mode), 1, max_len)
    elif mode == "both":
        head = F.slice(tok("input"), 1, int(max_len * input_share))
        room = F.lit(max_len - 1) - F.size(head)
        tail = F.slice(tok("output"), F.lit(1), F.greatest(room, F.lit(0)))
        # null marks the separator, which no text can hold
        tokens = F.concat(head, F.array(F.lit(None).cast("string")), tail)
    else:
        raise ValueError(f"unknown field {mode!r}")
    ids = encode_separated(df, row_id, tokens, vocab)
    empty = F.size("ids") == 0
    return ids.withColumn("ids", F.when(empty, F.array(F.lit(P.UNKNOWN_ID))).otherwise(F.col("ids")))


def encode_separated(df: DataFrame, row_id: str, tokens, vocab: DataFrame) -> DataFrame:
    """As :func:`encode_tokens`, with null tokens standing for the separator."""
    laid = df.select(row_id, F.posexplode_outer(tokens).alias("at", "token"))
    known = laid.join(F.broadcast(vocab.select("token", "id")), "token", "left")
    number = F.when(F.col("token").isNull(), F.lit(P.SEPARATOR_ID)).otherwise(
        F.coalesce("id", F.lit(P.UNKNOWN_ID))
    )
    pairs = F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", number.alias("id"))))
    listed = known.groupBy(row_id).agg(F.array_sort(pairs).alias("_pairs"))
    return listed.select(row_id, F.transform("_pairs", lambda p: p["id"]).alias("ids"))


def fixed_vocab(vocab: DataFrame) -> DataFrame:
    """The vocabulary written once, so that every later use reads a small table."""
    return materialize(vocab, "vocab")
