"""Joins and selections that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.hashing import digest_prefix

HOT_KEYS = 1_000  # keys handled by broadcast; any other key holds less than 1/HOT_KEYS of the rows
SALTS = 4_096
SLOTS = 1 << 20  # of a bitmap, 64 bits each


def by_row(df: DataFrame, row_id: str) -> DataFrame:
    """Rows spread by id over the session's shuffle partitions.

    The number is given on purpose: left to itself, adaptive execution would merge partitions by the
    size of the texts, before they grow manyfold as tokens.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, row_id)


def flag_held(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: whether a row's ``key`` may be one of ``wanted``'s.  False is certain, true holds by chance now and then.

    The broadcast bitmap has at most ``SLOTS`` rows of 16 bytes at any size of the tables, and no row moves.
    """
    slot = F.pmod(F.shiftright(F.xxhash64(key), 6), F.lit(SLOTS)).cast("long")
    bit = F.pmod(F.xxhash64(key), F.lit(64)).cast("int")
    held = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    bitmap = wanted.groupBy(slot.alias("_slot")).agg(held.alias("_bits"))
    near = rows.withColumn("_at", slot).join(F.broadcast(bitmap), F.col("_at") == F.col("_slot"), "left")
    return near.withColumn(name, F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False))).drop("_at", "_slot", "_bits")


def lookup_by_key(
    rows: DataFrame, totals: DataFrame, key: str | list[str], weight: str, row_id: Column | str, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Left join of ``rows`` with a per-key table, one shuffle, no task with all rows of a hot key.

    The ``hot_keys`` heaviest keys (by ``weight``, a count of rows) are broadcast, a fixed bound; their rows get
    spread by a salt instead of meeting in one task.  All other rows join by key as usual.  A key may be several columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    values = [c for c in totals.columns if c not in keys]
    # said here for both uses of the totals, so that they share one exchange
    totals = totals.filter(whole)
    hot = totals.orderBy(F.desc(weight), *keys).limit(hot_keys)
    hot = hot.select(*keys, F.struct(*values).alias("_hot"))
    tagged = rows.join(F.broadcast(hot), keys, "left")
    # -1 meets the per-key table; salted rows match nothing there and need nothing from it, nor do null keys
    salt = F.when(F.col("_hot").isNull() & whole, F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")
    )
    # weights are 1 or more, so this is -1; a literal would be folded out of the join keys, and all
    # rows of a hot key would meet in one task again
    unsalted = -F.least(F.lit(1), F.col(weight)).cast("int")
    cold = totals.select(*keys, unsalted.alias("_salt"), F.struct(*values).alias("_cold"))
    joined = tagged.withColumn("_salt", salt).join(cold, [*keys, "_salt"], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(
        *[F.col(c) for c in rows.columns], *[found[c].alias(c) for c in values]
    )


def lowest_per_group(
    df: DataFrame, group: str, digest: str, tie: str, wanted: Callable[[DataFrame], DataFrame],
    hex_digits: int = 4,
) -> DataFrame:
    """The ``n`` rows of each group with the smallest digest, without sorting whole groups.

    ``digest`` is a uniform hex digest; ``wanted`` turns the group sizes (group, total) into the
    numbers wanted (group, n).  Counts per (group, digest prefix) locate the prefix at which a group
    reaches its n.  Rows beyond it are dropped as they stream by; the others are ranked within their
    prefix, so a rank never spans more than 1/65536 of a group.
    """
    rows = df.filter(F.col(group).isNotNull()).withColumn("_bin", digest_prefix(digest, hex_digits))
    bins = rows.groupBy(group, "_bin").agg(F.count("*").alias("_size"))
    totals = bins.groupBy(group).agg(F.sum("_size").alias("total"))
    upto = W.partitionBy(group).orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    # a row per group
    numbers = F.broadcast(wanted(totals).select(group, F.col("n").cast("bigint")))
    running = bins.withColumn("_upto", F.sum("_size").over(upto)).join(numbers, group)
    # per group: the last prefix to look at, and how many of its rows are still needed
    cut = (
        running.filter(F.col("_upto") - F.col("_size") < F.col("n"))
        .groupBy(group)
        .agg(
            F.max("_bin").alias("_cut"),
            F.max_by(F.col("n") - (F.col("_upto") - F.col("_size")), "_bin").alias("_need"),
        )
    )
    marked = rows.join(F.broadcast(cut), group).filter(F.col("_bin") <= F.col("_cut"))
    rank = F.row_number().over(W.partitionBy(group, "_bin").orderBy(digest, tie))
    kept = marked.withColumn("_rank", rank).filter(
        (F.col("_bin") < F.col("_cut")) | (F.col("_rank") <= F.col("_need"))
    )
    return kept.select(*df.columns)


def dense_index(df: DataFrame, digest: str, tie: str, name: str, hex_digits: int = 4) -> DataFrame:
    """Number the rows 0..n-1 in digest order without a global sort in one task.

    Rows are ranked inside each digest prefix; a table of at most 16**hex_digits counts gives
    every prefix its offset.
    """
    rows = df.withColumn("_bin", digest_prefix(digest, hex_digits))
    sizes = rows.groupBy("_bin").agg(F.count("*").alias("_size"))
    # at most 65536 counts: small enough for one ordered pass
    before = W.orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_bin", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_from"))
    rank = F.row_number().over(W.partitionBy("_bin").orderBy(digest, tie))
    return (
        rows.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bin")
        .withColumn(name, F.col("_from") + F.col("_rank") - 1)
        .select(*df.columns, name)
    )
