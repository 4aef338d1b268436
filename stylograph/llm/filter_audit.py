"""Filter interaction audit: what each of five filters removes in every order, from 32 counts per part.

Each document gets a mask of the filters that it fails, and a part's documents are counted by mask (at most 32 cells, combined before
the shuffle).  A Gray code then walks through all 32 sets of active filters, toggling one filter at a time: every cell keeps how
many active filters its documents fail, and the running number of survivors changes by the cells whose counter leaves or reaches
zero.  The 32 states are stored; every step of every order is a difference of two of them.

The filters (words are maximal runs without ASCII white space, case-sensitive): A under 50 words; B 100 * different words < 65 * words;
C 100 * A-Z > 5 * code points; D holds one of ``#$%&*|``; E the same text as a row of a smaller doc_id, in whatever part.

A null text is empty, and empty texts are equal to each other.  Texts are read whole.  A null doc_id is neither smaller nor larger
than another; rows with equal doc_ids do not fail E for each other.  A null part is the empty string.  A document is good or toxic if
any label of its doc_id says so.  Repeated rows all count.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_by_key
from ..session import materialize
from . import common as C
from .arrow_texts import raw

FILTERS = "ABCDE"
FEWEST_WORDS, LEAST_DIFFERENT, MOST_CAPITALS = 50, 65, 5
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOL = re.compile(rb"[#$%&*|]")
LATER = bytes(range(0x80, 0xC0))  # all bytes of a code point but its first
PARTS_AT_ONCE = 200
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    words = text.split()  # cuts at exactly the six ASCII white space characters
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, LATER))
    failed = (
        len(words) < FEWEST_WORDS, 100 * len(set(words)) < LEAST_DIFFERENT * len(words),
        100 * capitals > MOST_CAPITALS * points, SYMBOL.search(text) is not None,
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def masks(docs: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    """(doc_id, part, mask): the filters that each document fails, E included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch.column("text"))
            mask = pa.array([failures(t) for t in texts], pa.int32())
            digest = pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), digest, mask], ["doc_id", "part", "digest", "mask"])

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    told = materialize(rows.mapInArrow(run, f"doc_id {kind}, part string, digest binary, mask int"), "filter-masks")
    first = told.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("times")).filter("times > 1")
    # the texts that most rows share are looked up by a broadcast of 1,000 digests, all others by a join
    known = lookup_by_key(told, first, "digest", "times", F.col("doc_id"))
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return known.select("doc_id", "part", (F.col("mask") + F.when(again, 16).otherwise(0)).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask."""
    said = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = masks(docs, text, doc_id, part).join(said, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if(F.col("good")).alias("good"), F.count_if(F.col("toxic")).alias("toxic")
    )


def states(counts: np.ndarray) -> np.ndarray:
    """Survivors of each of the 32 sets of active filters: counts (..., mask) to survivors (..., set)."""
    out = np.empty_like(counts)
    running, active, fails = counts.sum(axis=-1), 0, np.zeros(32, int)
    out[..., 0] = running
    cell = np.arange(32)
    for i in range(1, 32):
        toggled = (i & -i).bit_length() - 1  # one filter from each set to the next
        active ^= 1 << toggled
        hit = cell[cell >> toggled & 1 == 1]
        if active >> toggled & 1:
            fails[hit] += 1
            running = running - counts[..., hit[fails[hit] == 1]].sum(axis=-1)
        else:
            fails[hit] -= 1
            running = running + counts[..., hit[fails[hit] == 0]].sum(axis=-1)
        out[..., active] = running
    return out


ORDERS = ["".join(p) for p in permutations(FILTERS)]
AT = np.array([[FILTERS.index(c) for c in o] for o in ORDERS])  # the filter at each step
AFTER = np.cumsum(1 << AT, axis=1)  # active filters after each step
BEFORE = AFTER - (1 << AT)


def steps(counts: np.ndarray) -> np.ndarray:
    """Counts (part, 3, mask) of all, good and toxic documents to (part, order, step, one of COUNTS)."""
    alive = states(counts)
    n = alive[:, 0]
    removed = n[:, BEFORE] - n[:, AFTER]
    lost = alive[:, 1:, BEFORE] - alive[:, 1:, AFTER]
    fails = n[:, :1] - n[:, 1 << np.arange(5)]
    alone = n[:, 31 ^ (1 << np.arange(5))] - n[:, 31:]
    shapley = np.stack([(removed * (AT == f)).sum(axis=(1, 2)) for f in range(5)], axis=1)
    return np.stack([n[:, AFTER], removed, fails[:, AT] - removed, alone[:, AT], lost[:, 0], lost[:, 1], shapley[:, AT]], axis=-1)


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """(part, filter_order, step, *COUNTS): a row per part, order of the filters and step."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), PARTS_AT_ONCE):
                some = batch.iloc[a : a + PARTS_AT_ONCE]
                counts = np.zeros((len(some), 3, 32), np.int64)
                for p, found in enumerate(some["cells"]):
                    for c in found:
                        counts[p, :, c["mask"]] = c["n"], c["good"], c["toxic"]
                values = steps(counts).reshape(-1, len(COUNTS))
                out = pd.DataFrame(values, columns=COUNTS)
                out.insert(0, "step", np.tile(np.arange(1, 6, dtype=np.int32), 120 * len(some)))
                out.insert(0, "filter_order", np.tile(np.repeat(ORDERS, 5), len(some)))
                out.insert(0, "part", np.repeat(some["part"].to_numpy(), 600))
                yield out

    # at most 32 cells a part
    of = cells(docs, labels, text, doc_id, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return of.mapInPandas(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def op12_filter_audit(spark, sf_dir):
    docs = C.documents(spark, sf_dir).select("doc_id", "text", "source")
    return audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic"))


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
  said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
  m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
      (len(ws) < {FEWEST_WORDS})::INT + 2 * (100 * len(list_distinct(ws)) < {LEAST_DIFFERENT} * len(ws))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > least, false)::INT AS mask
    FROM d JOIN firsts USING (t) LEFT JOIN said ON said.doc_id = d.doc_id),
  cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
  letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
  orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
  moves AS (SELECT filter_order, CAST(s AS INT) AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS earlier FROM orders, range(1, 6) r(s)),
  sums AS (SELECT part, filter_order, step, bit,
      coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0), 0) AS removed,
      coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier > 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
      coalesce(sum(good) FILTER (mask & bit > 0 AND mask & earlier = 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & earlier = 0), 0) AS toxic_lost
    FROM cells, moves GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM sums
"""
