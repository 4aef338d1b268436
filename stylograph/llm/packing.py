"""Best-fit packing of documents into sequences of fixed length.

A document is its token ids and an end id.  Only documents longer than a sequence are cut, into whole
sequences and a rest.  Rests are packed best-fit decreasing: from the longest on, each goes to the
open sequence with the least room that still takes it, found in a segment tree over
the remaining capacities.  Spark deals the documents to blocks by hash; every block is packed by itself in one
task on narrow rows, and costs at most its last few sequences against packing all at once.

Nulls: a null text is empty, a null doc_id is packed like any other.  An empty text is one end id.  Very
long texts become many pieces.  Equal rows are packed as often as they come.  An empty table
gives no pieces.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .tokens import Encoder, tokenizer_path

LENGTH = 2_048
END = 0
BLOCK = 50_000  # documents packed together, on average

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


class Capacities:
    """Open sequences by remaining capacity: a segment tree of counts with a stack per capacity."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.counts = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(self.width)]

    def _add(self, capacity: int, n: int) -> None:
        i, counts = capacity + self.width, self.counts
        while i:
            counts[i] += n
            i >>= 1

    def put(self, capacity: int, sequence: int) -> None:
        if capacity > 0:
            self.open[capacity].append(sequence)
            self._add(capacity, 1)

    def tightest(self, least: int) -> tuple[int, int] | None:
        """Takes out the open sequence with the smallest capacity of at least ``least``."""
        counts, i = self.counts, least + self.width
        while not counts[i]:
            while i & 1:  # a right child: go up until there is something to the right
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.width:
            i = 2 * i if counts[2 * i] else 2 * i + 1
        capacity = i - self.width
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every item."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room, used = Capacities(most), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = room.tightest(n)
        if found is None:
            found = most, used
            used += 1
        sequence[i], offset[i] = found[1], most - found[0]
        room.put(found[0] - n, found[1])
    return sequence, offset


def tokenized(docs: DataFrame, text: str, doc_id: str, path: str, length: int, end: int) -> DataFrame:
    """A row per document: number of ids and the checksum of each of its pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(path)
        tail = np.asarray([end], "<u2").tobytes()
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            n, sums = [], []
            for raw in encoder.encode(texts):
                ids = np.frombuffer(raw + tail, "<u2").astype("<u4")
                n.append(len(ids))
                sums.append([zlib.crc32(ids[i : i + length]) for i in range(0, len(ids), length)])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n": n, "sums": sums})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n long, sums array<long>")


def pack(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None,
    length: int = LENGTH, end: int = END, block: int = BLOCK,
) -> DataFrame:
    """A row per piece: where it starts in its document, and its sequence and place there."""
    blocks = max(1, -(-docs.count() // block))
    rows = tokenized(docs, text, doc_id, path or tokenizer_path(), length, end)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "n", "sums"), F.lit(blocks)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # the order in which rows arrive must not matter
        rows = rows.assign(first=rows["sums"].str[0]).sort_values(["n", "doc_id", "first"], kind="stable")
        n = rows["n"].to_numpy(np.int64)
        pieces = -(-n // length)
        of = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lengths = np.minimum(length, n[of] - piece * length)
        sequence, offset = best_fit_decreasing(lengths, length)
        return pd.DataFrame({
            "doc_id": rows["doc_id"].to_numpy()[of], "piece": piece.astype(np.int32), "start": piece * length,
            "length": lengths, "ids_crc32": np.concatenate(rows["sums"].to_numpy()),
            "sequence_id": sequence * blocks + int(key[0]), "offset": offset,
        })

    return rows.groupBy("block").applyInPandas(run, PIECES)


def op8_pack(spark, sf_dir):
    return pack(C.documents(spark, sf_dir).select("doc_id", "text"))
