"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

Documents become token ids and an end id, cut into sequences of at most ``length`` ids.  A sequence's number is its place
in the written token table; a keyed Feistel network on the next even power of two, walked until it falls below the
number of sequences, permutes the numbers to global slots.  The permutation needs no table: any slot of any
sequence is computed from the key alone, and another key gives another epoch.  Slots are dealt to
shards by range, each shard is one file of records of equal size in slot order, so the record of a slot is found by a
division and reading can go on anywhere.

A record is doc_id, start (64 bits each), length, checksum of the ids (32 bits each), the ids (16 bits each, filled up
with zeros) and a line feed, little-endian.  A null doc_id is stored as the least 64-bit number.

Nulls: a null text is an empty one, a single end id.  Very long texts become many sequences.  Equal
rows are written as often as they come.  An empty table gives no shards.  Extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..session import materialize, new_path
from . import common as C
from .arrow_texts import by_bytes
from .tokens import Encoder, tokenizer_path
from .words import A, B, mixed

LENGTH = 256
END = 0
PER_SHARD = 16_384
KEY = 448
ROUNDS = 6
BYTES_AT_ONCE = 1_000_000
SHARDS_PER_TASK = 8  # of 8.8 MB each
HEAD = "<qqII"
NO_ID = -(2**63)


def stride(length: int) -> int:
    return struct.calcsize(HEAD) + 2 * length + 1


def permuted(numbers: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of sequence numbers below ``n``: a permutation of 0..n-1."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [mixed(np.array([key * 1_000 + r], np.uint64))[0] for r in range(rounds)]
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            with np.errstate(over="ignore"):
                left, right = right, left ^ (mixed(right * A + k * B) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, text: str, doc_id: str, path: str, length: int, end: int) -> DataFrame:
    """(part, no, record): every sequence as its record, numbered within the task that made it."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        tail = np.asarray([end], "<u2").tobytes()
        part, no = TaskContext.get().partitionId(), 0
        for whole in batches:
            # some documents at a time, by their bytes: texts and records are objects for as long only
            for batch in by_bytes(whole, "text", BYTES_AT_ONCE):
                ids = [NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()]
                records = []
                for doc, raw in zip(ids, encoder.encode([x or "" for x in batch.column("text").to_pylist()])):
                    raw += tail
                    for at in range(0, len(raw), 2 * length):
                        piece = raw[at : at + 2 * length]
                        head = struct.pack(HEAD, doc, at // 2, len(piece) // 2, zlib.crc32(piece))
                        records.append(head + piece.ljust(2 * length, b"\0") + b"\n")
                numbers = pa.array(np.arange(no, no + len(records)))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.repeat(pa.scalar(part, pa.int32()), len(records)), "no": numbers, "record": pa.array(records, pa.binary()),
                })
                no += len(records)

    return rows.mapInArrow(run, "part int, no long, record binary")


def slots(numbered: DataFrame, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(np.int64), n, key))

    return slot(numbered["number"])


def write_shards(
    docs: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id", path: str | None = None,
    length: int = LENGTH, end: int = END, per_shard: int = PER_SHARD, key: int = KEY,
) -> int:
    """Writes ``folder/shard=N/`` with one file each and returns the number of sequences.

    The token table is written first: what numbers the sequences is then a committed file, which a
    lost executor cannot change.
    """
    table = materialize(sequences(docs, text, doc_id, path or tokenizer_path(), length, end), "sequences")
    # a row per task of the scan
    sizes = table.groupBy("part").agg((F.max("no") + 1).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = materialize(sizes.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    n = bases.agg(F.sum("n")).first()[0] or 0
    if not n:
        return 0
    numbered = table.join(F.broadcast(bases.drop("n")), "part").withColumn("number", F.col("base") + F.col("no"))
    placed = numbered.withColumn("slot", slots(numbered, n, key))
    placed = placed.withColumn("shard", F.expr(f"slot div {per_shard}").cast("int"))
    # a task writes some shards, one after the other
    tasks = -(-n // (per_shard * SHARDS_PER_TASK))
    ranges = placed.select("shard", "slot", "record").repartitionById(tasks, F.expr(f"shard div {SHARDS_PER_TASK}").cast("int"))
    # a record ends with the writer's line feed
    body = F.expr(f"substring(record, 1, {stride(length) - 1})").cast("string").alias("value")
    ranges.sortWithinPartitions("shard", "slot").select(body, "shard").write.partitionBy("shard").text(folder)
    return n


RECORDS = "slot long, shard int, byte_offset long, doc_id long, start long, length long, ids_crc32 long"


def read_from(
    spark: SparkSession, folder: str, slot: int = 0, length: int = LENGTH, per_shard: int = PER_SHARD, ids: bool = False
) -> DataFrame:
    """Records from a slot on: earlier shards are pruned, and the first one is entered by its offset."""
    step = stride(length)
    found = T.StructType([T.StructField("content", T.BinaryType())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    files = files.filter(F.col("shard") >= slot // per_shard).select("shard", *found.fieldNames())
    schema = RECORDS + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind = np.dtype([("doc_id", "<i8"), ("start", "<i8"), ("length", "<u4"), ("crc", "<u4"), ("ids", "<u2", (length,)), ("end", "u1")])
        for batch in batches:
            for shard, content in zip(batch["shard"], batch["content"]):
                at = max(0, slot - int(shard) * per_shard)
                records = np.frombuffer(content, kind, offset=at * step)
                place = np.arange(at, at + len(records))
                doc = pd.Series(records["doc_id"]).astype("Int64").mask(records["doc_id"] == NO_ID)
                out = pd.DataFrame({
                    "slot": int(shard) * per_shard + place, "shard": int(shard), "byte_offset": place * step, "doc_id": doc,
                    "start": records["start"], "length": records["length"].astype(np.int64),
                    # of what is in the file, not of what its header says
                    "ids_crc32": [zlib.crc32(r[:n].tobytes()) for r, n in zip(records["ids"], records["length"])],
                })
                if not (out["ids_crc32"].to_numpy() == records["crc"]).all():
                    raise ValueError(f"shard {shard} is damaged")
                if ids:
                    out["ids"] = [r[:n].astype(np.int32) for r, n in zip(records["ids"], records["length"])]
                yield out

    return files.mapInPandas(run, schema)


def op2_training_order(spark, sf_dir):
    folder = new_path(spark, "token-shards")
    n = write_shards(C.documents(spark, sf_dir).select("doc_id", "text"), folder)
    return read_from(spark, folder) if n else spark.createDataFrame([], RECORDS)
