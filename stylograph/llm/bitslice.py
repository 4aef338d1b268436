"""Exact top-k search by inner product on a bit-sliced index.

The index deals vectors to blocks of a few thousand rows.  In a block, every component is an attribute whose leading
bits are kept as bitmaps over the rows, one per bit.  A query weighs the attributes: the slices are added
up with bitmap arithmetic, a full adder at a time, into slices of the score, and the top rows are selected from the
most significant slice downward.  Bits that were left out bound the error, so rows within that bound of the
k-th score are the boundary; they are scored exactly on the stored integers.

Queries come in blocks too and meet every block of the index once; a block answers with k rows per query.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id.  Shorter
vectors count as filled up with zeros.  Equal rows (id and vector) count once; rows that share a query's id
are its own and no candidates.  Ties go to the smaller id.  An empty table or query set gives no rows.
Scores must fit in 64 bits.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize

TOP = 5
ROWS = 4_096  # of an index block, on average
QUERIES = 256  # of a query block, on average
BITS = 7  # leading bits of each component that become slices
PAIRS = 200_000  # boundary rows scored at a time


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, x): integer components, valid vectors only, equal rows once."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).filter(finite)
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), ints.alias("x")).distinct()


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def build(ints: DataFrame, blocks: int, dims: int, low: int, width: int) -> DataFrame:
    """The index: per block its ids, its integers and the slices of its components."""
    drop = max(0, width - BITS)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        x = _matrix(rows["x"], dims)
        lead = ((x - low) >> drop).T
        words = -(-len(rows) // 64)
        padded = np.zeros((dims, 64 * words), np.int64)
        padded[:, : len(rows)] = lead
        slices = [np.packbits(((padded >> j) & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(width - drop)]
        return pd.DataFrame({
            "block": [int(key[0])], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
            "ints": [x.tobytes()], "slices": [np.stack(slices).tobytes() if slices else b""],
        })

    dealt = ints.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(run, "block int, ids binary, ints binary, slices binary")


def add_up(slices: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Slices of the scores of all rows for all queries.

    ``slices`` is bits x components x words, ``weights`` queries x components; where a weight is
    negative the complement of the component is taken, weighed by its amount.
    """
    bits, dims, words = slices.shape
    amount = np.abs(weights)
    height = max(1, int((amount.sum(axis=1) * ((1 << bits) - 1)).max()).bit_length())
    total = np.zeros((height, len(weights), words), np.uint64)
    ones = np.uint64(2**64 - 1)
    for d in range(dims):
        turned = np.where(weights[:, d] < 0, ones, np.uint64(0))[:, None]
        component = [slices[j, d][None, :] ^ turned for j in range(bits)]
        for i in range(int(amount[:, d].max()).bit_length()):
            has = ((amount[:, d] >> i) & 1).astype(bool)
            if not has.any():
                continue
            mask = np.where(has, ones, np.uint64(0))[:, None]
            carry = None
            for at in range(i, height):
                now = total[at]
                if at - i < bits:
                    addend = component[at - i] & mask
                    half = now ^ addend
                    if carry is None:
                        carry, total[at] = now & addend, half
                    else:
                        carry, total[at] = (now & addend) | (half & carry), half ^ carry
                else:
                    total[at], carry = now ^ carry, now & carry
                    if not carry.any():
                        break
    return total


def select(total: np.ndarray, candidates: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of every query, from the most significant slice downward."""
    above, equal = np.zeros_like(candidates), candidates.copy()
    kth = np.zeros(len(candidates), np.int64)
    for at in range(len(total) - 1, -1, -1):
        having = equal & total[at]
        enough = np.bitwise_count(above | having).sum(axis=1) >= k
        kth += np.where(enough, np.int64(1) << at, 0)
        take = enough[:, None]
        above = np.where(take, above, above | having)
        equal = np.where(take, having, equal & ~total[at])
    return kth


def at_least(total: np.ndarray, candidates: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Rows whose score reaches the bound of the query."""
    above, equal = np.zeros_like(candidates), candidates.copy()
    for at in range(len(total) - 1, -1, -1):
        one = ((bound >> at) & 1).astype(bool)[:, None]
        having = equal & total[at]
        above = np.where(one, above, above | having)
        equal = np.where(one, having, equal & ~total[at])
    return above | equal


def best_rows(ids: np.ndarray, ints: np.ndarray, slices: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int):
    """(query number, row number, score) of the k best rows of a block for every query."""
    rows = len(ids)
    words = slices.shape[2]
    valid = np.zeros(64 * words, np.uint8)
    valid[:rows] = 1
    candidates = np.repeat(np.packbits(valid, bitorder="little").view(np.uint64)[None, :], len(q), axis=0)
    # ids are sorted; rows under a query's own id are no candidates
    first, last = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
    for i in np.flatnonzero(last > first):
        for r in range(first[i], last[i]):
            candidates[i, r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
    total = add_up(slices, q)
    kth = select(total, candidates, k)
    # a slice sum falls short of the score by less than the sum of the weights, in its own unit
    bound = np.maximum(kth - np.abs(q).sum(axis=1), 0)
    boundary = at_least(total, candidates, bound)
    of, row = np.nonzero(np.unpackbits(boundary.view(np.uint8), axis=1, bitorder="little"))
    score = np.empty(len(of), np.int64)
    for i in range(0, len(of), PAIRS):
        part = slice(i, i + PAIRS)
        score[part] = np.einsum("ij,ij->i", q[of[part]], ints[row[part]])
    order = np.lexsort((ids[row], -score, of))
    of, row, score = of[order], row[order], score[order]
    start = np.searchsorted(of, np.arange(len(q)))
    keep = np.arange(len(of)) - start[of] < k
    return of[keep], row[keep], score[keep]


def search(
    vectors: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding",
    scale: float = 256.0, k: int = TOP, rows: int = ROWS, at_once: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for every row that meets ``queries`` (on vec_id)."""
    ints = materialize(quantised(vectors, vec_id, vector, scale), "integers")
    found = ints.agg(
        F.count("*"), F.min(F.array_min("x")), F.max(F.array_max("x")), F.max(F.size("x")),
        F.count(F.when(queries, 1)),
    ).first()
    n, low, high, dims, asked = (x or 0 for x in found)
    low, high = min(low, 0), max(high, 0)
    width = max(1, int(high - low).bit_length())
    bits = min(width, BITS)
    blocks, q_blocks = max(1, -(-n // rows)), max(1, -(-asked // at_once))
    index = materialize(build(ints, blocks, dims, low, width), "bit-slices")
    dealt = ints.filter(queries).select(F.col("vec_id").alias("query_id"), F.col("x").alias("q"))
    dealt = dealt.withColumn("q_block", F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(q_blocks)).cast("int"))
    asking = dealt.groupBy("q_block").agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))
    # every block of queries meets every block of the index
    meeting = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = index.join(meeting.hint("shuffle_hash"), "block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                ids = np.frombuffer(pair.ids, np.int64)
                own = np.frombuffer(pair.ints, np.int64).reshape(len(ids), dims)
                words = -(-len(ids) // 64)
                slices = np.frombuffer(pair.slices, np.uint64).reshape(bits, dims, words)
                q_ids = np.array([a["query_id"] for a in pair.asked], np.int64)
                q = _matrix(pd.Series([a["q"] for a in pair.asked]), dims)
                of, row, score = best_rows(ids, own, slices, q_ids, q, k)
                yield pd.DataFrame({"query_id": q_ids[of], "vec_id": ids[row], "score": score})

    best = pairs.mapInPandas(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP7_SQL = f"""WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256.0::DOUBLE * x::DOUBLE) AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM valid q JOIN valid c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= {TOP}"""
