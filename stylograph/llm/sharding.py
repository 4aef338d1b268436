"""Sharding by sampled splitters: shards of near equal bytes, equal records side by side.

Records are ordered by a key and, within it, by a tie key.  A size-weighted sample of the keys gives quantile
boundaries of many small ranges; ranges that turn out overfull are sampled again and
subdivided, until each holds its share.  A key that is heavy by itself is cut by its ties, any other key
stays in one range.  Prefix sums inside the ranges then place every record on the line of all bytes, and shards
are equal stretches of that line.  Equal keys move to one side of a shard's end together
as long as that changes the shard by at most ``slack`` of its size.

The law is ``bytes``: sizes near equal.  Nulls: a null text has no bytes (size 1, checksum 0) and is
a group of its own; a null doc_id is ordered first.  Equal rows share key and tie and stay neighbours.
An empty table gives no rows.  Input columns keep their names unless they equal a result's.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from . import common as C

SHARDS = 8
RANGES_PER_SHARD = 32
SAMPLES = 40  # expected sampled keys per range; the whole sample goes to the driver
SLACK = 0.002
OVERFULL = 2.0


def range_of(splitters: list[tuple[int, int]]) -> Callable[[Column, Column], Column]:
    """Number of splitters at or before (key, tie)."""
    keys = np.array([s[0] for s in splitters], np.int64)
    ties = np.array([s[1] for s in splitters], np.int64)

    @F.pandas_udf("int")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        out = np.searchsorted(keys, k, "left")
        last = np.searchsorted(keys, k, "right")
        for i in np.flatnonzero(last > out):  # keys that are splitters themselves
            out[i] += np.searchsorted(ties[out[i] : last[i]], t[i], "right")
        return pd.Series(out.astype(np.int32))

    return place


def splitters_from(sample: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Boundaries of ``n`` ranges at the quantiles of a sample that was drawn by size."""
    sample = sorted(sample)
    at = sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []
    keys = [k for k, _ in at]
    # only a key on several boundaries is cut by ties
    lowest = -(2**63)
    return sorted({(k, t) if keys.count(k) > 1 else (k, lowest) for k, t in at})


def shard(
    df: DataFrame, key: Column, tie: Column, size: Column, shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD, samples: int = SAMPLES, slack: float = SLACK,
) -> DataFrame:
    """The rows of ``df`` with ``shard`` and ``slot``.

    ``key`` and ``tie`` are longs without nulls, ``size`` a positive long.  The ranges per shard are to grow with
    the data, so that one range sorts within a task.  ``shards * ranges_per_shard * samples`` keys
    are sampled and go to the driver.
    """
    rows = df.select(C.packed(df), key.alias("_key"), tie.alias("_tie"), size.alias("_size"))
    line = materialize(rows.drop("_row"), "shard-keys")
    total = line.agg(F.sum("_size")).first()[0]
    if total is None:
        return df.withColumns({"shard": F.lit(None).cast("int"), "slot": F.lit(None).cast("long")})
    n = shards * ranges_per_shard

    def drawn(some: DataFrame, words: int, wanted: int, round_: int) -> list[tuple[int, int]]:
        # a row stands once per drawn share of its size, by a hash that every rerun repeats
        u = F.pmod(F.xxhash64("_key", "_tie", F.lit(round_)), F.lit(1 << 30)) / float(1 << 30)
        times = F.floor(F.col("_size") * (wanted / words) + u).cast("int")
        picked = some.select("_key", "_tie", times.alias("times")).filter("times > 0")
        return [(r["_key"], r["_tie"]) for r in picked.collect() for _ in range(r["times"])]

    splitters = splitters_from(drawn(line, total, n * samples, 0), n)
    # sampling errors shrink with each round; equal keys and ties cannot be told apart any further
    for round_ in range(1, 4):
        ranged = line.withColumn("_range", range_of(splitters)("_key", "_tie"))
        sizes = {r["_range"]: r["s"] for r in ranged.groupBy("_range").agg(F.sum("_size").alias("s")).collect()}
        over = {r: s for r, s in sizes.items() if s > OVERFULL * total / n}
        if not over:
            break
        more = []
        inside = ranged.filter(F.col("_range").isin(list(over)))
        sample = drawn(inside, sum(over.values()), len(over) * samples * 4, round_)
        keys, ties = np.array([s[0] for s in splitters]), splitters
        by_range: dict[int, list[tuple[int, int]]] = {}
        for k, t in sorted(sample):
            at = int(np.searchsorted(keys, k, "left")) if len(keys) else 0
            while at < len(ties) and ties[at] <= (k, t):
                at += 1
            by_range.setdefault(at, []).append((k, t))
        for r, s in over.items():
            more += splitters_from(by_range.get(r, []), int(s * n / total) + 1)
        if not set(more) - set(splitters):
            break
        splitters = sorted(set(splitters) | set(more))

    place = range_of(splitters)
    # a row per range, as many as splitters: a bounded table
    per_range = line.groupBy(place("_key", "_tie").alias("_range")).agg(F.sum("_size").alias("_s"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = materialize(per_range.select("_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_from")), "shard-ranges")

    def placed(some: DataFrame) -> DataFrame:
        order = W.partitionBy("_range").orderBy("_key", "_tie")
        upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
        group = W.partitionBy("_range", "_key")
        out = some.withColumn("_range", place("_key", "_tie"))
        out = out.withColumns({"_end": F.sum("_size").over(upto), "_no": F.row_number().over(order)})
        out = out.withColumns({"_group_end": F.max("_end").over(group), "_group": F.sum("_size").over(group)})
        out = out.join(F.broadcast(starts), "_range")
        whole = F.col("_group") <= slack * total / shards
        middle = F.when(whole, F.col("_group_end") - F.col("_group") / 2).otherwise(F.col("_end") - F.col("_size") / 2)
        at = F.floor((F.col("_from") + middle) * shards / F.lit(float(total))).cast("int")
        return out.withColumn("_shard", F.least(at, F.lit(shards - 1)))

    # a row per range and shard
    counts = placed(line).groupBy("_shard", "_range").agg(F.count("*").alias("_n"), F.min("_no").alias("_first"))
    earlier = W.partitionBy("_shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("_shard", "_range", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"))
    done = placed(rows).join(F.broadcast(materialize(counts, "shard-counts")), ["_shard", "_range"])
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in ("shard", "slot")]
    return done.select(*kept, F.col("_shard").alias("shard"), (F.col("_base") + F.col("_no")).alias("slot"))


def shard_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """Documents with size, text_crc32, shard and slot; equal texts are the groups."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    names = [f"`{c}`" for c in docs.columns if c.lower() not in ("size", "text_crc32")]
    rows = docs.select(
        *names, (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    return shard(rows, F.xxhash64(text), F.xxhash64(F.lit(7), doc_id), F.col("size"), **options)


def op5_shard(spark, sf_dir):
    docs = C.documents(spark, sf_dir)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
    )
    rows = shard(narrow, F.col("key"), F.xxhash64(F.lit(7), "doc_id"), F.col("size"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
