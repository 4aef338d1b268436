"""Benchmark decontamination by winnowing.

A window is a run of ``span`` words of an item, or the whole of a shorter item.  Of every window the fingerprint is the smallest
hash of a few words in it (the last one of equals), so whatever holds the same window selects the same fingerprint: a document
need not compare its windows, only the fingerprints that winnowing keeps, about two of seven.  Fingerprints of documents are
joined with those of the items; around a shared one the hit is extended to the windows that hold it, which are looked up whole.
A window of L words is winnowed by hashes of k = min(5, L) words, L - k + 1 of them at a time; k + (L - k + 1) - 1 = L is the length from
which no shared span is missed.  Short items give further lengths, at most ``span - 1`` of them.

Documents are read once.  Bitmaps of the item's fingerprints and windows (at most 64 MB each) hold back what no item has, so what
crosses the network are shared windows.  Windows are looked up by their 64-bit hashes, in a join that yields true hits alone; items that share a window are told by the
window's set of items, so a passage in very many items and documents makes no pairs of them.

A null or empty text has no words: such a document is clean, such an item is never met.  Texts are read whole.  Rows with equal ids
are rows of their own, a null doc_id too; rows of one item_id are one item, an item without an id is left out.  Hits that overlap count
their words once.  An empty table of documents gives no rows, an empty benchmark clean documents.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from . import bitmaps
from . import common as C
from . import words as V
from .arrow_texts import raw, stretches

SPAN = 10  # words of a window
GRAM = 5  # words of a fingerprint, at most
# letters and digits of ASCII, lower-cased, and all that is not ASCII
LETTERS = bytes(ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
FOUND = "fp array<bigint>, start array<int>, length array<int>, win array<bigint>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def grams(words: np.ndarray, ends: np.ndarray, width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the ``width`` words from each place on, whether ``length`` words follow there in the same text)."""
    hashes = V.windows(words, width)
    out = np.zeros(len(words), np.uint64)
    out[: len(hashes)] = hashes
    return out, np.arange(len(words)) + length <= ends


def winnowed(words: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the fingerprints of all windows of ``length`` words; ``ends`` is where each word's text ends."""
    width = min(GRAM, length)
    hashes, whole = grams(words, ends, width, length)
    at = np.flatnonzero(whole)
    if not len(at):
        return at, np.empty(0, np.uint64)
    least, place = hashes[at], at.copy()
    for step in range(1, length - width + 1):
        other = hashes[at + step]
        smaller = other <= least
        least, place = np.where(smaller, other, least), np.where(smaller, at + step, place)
    place = np.unique(place)
    with np.errstate(over="ignore"):  # windows of different lengths have fingerprints of their own
        return place, V.mixed(hashes[place] + np.uint64(length) * V.A)


def flat(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, where its text ends, where each text starts)."""
    numbers, different, bounds = V.codes(lists)
    words = V.hashes(different)[numbers] if len(numbers) else np.empty(0, np.uint64)
    return words, np.repeat(bounds[1:], np.diff(bounds)), bounds


def _longs(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    joined = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(joined.astype(kind.to_pandas_dtype())))


def items_of(items: DataFrame, text: str, item_id: str, span: int) -> DataFrame:
    """(item, length, fps, wins): fingerprints and windows of every item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, fps, wins = [], [], []
            for words in map(words_of, raw(batch.column("text"))):
                length = min(span, len(words))
                lengths.append(length)
                hashes, ends, _ = flat([words])
                fps.append(winnowed(hashes, ends, length)[1].view(np.int64) if length else np.empty(0, np.int64))
                wins.append(V.windows(hashes, length).view(np.int64) if length else np.empty(0, np.int64))
            columns = [batch.column("item"), pa.array(lengths, pa.int32()), _longs(fps, pa.int64()), _longs(wins, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "length", "fps", "wins"])

    rows = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, "item string, length int, fps array<bigint>, wins array<bigint>")
    return found.filter("length > 0")


def read_documents(docs: DataFrame, text: str, doc_id: str, lengths: list[int], fps: np.ndarray, wins: np.ndarray) -> DataFrame:
    """(row, doc_id, n_words, fp, start, length, win): per document the fingerprints that an item may have and the windows about them."""
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast((fps, wins))

    def shared(words: np.ndarray, ends: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(place of the window, fingerprint, length, window) of what may be shared."""
        for length in lengths:
            place, fp = winnowed(words, ends, length)
            near = bitmaps.holds(kept.value[0], fp)
            place, fp = place[near], fp[near]
            if not len(place):
                continue
            whole, _ = grams(words, ends, length, length)
            for back in range(length - min(GRAM, length) + 1):
                start = place - back
                fits = (start >= begins[place]) & (start + length <= ends[place])
                start, of = start[fits], fp[fits]
                held = bitmaps.holds(kept.value[1], whole[start])
                yield start[held], of[held], np.full(int(held.sum()), length), whole[start[held]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = [], [[], [], [], []]
            for _, lists in stretches(raw(batch.column("text")), words_of):
                words, ends, bounds = flat(lists)
                parts = list(shared(words, ends, np.repeat(bounds[:-1], np.diff(bounds))))
                at, fp, length, win = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 4
                order = np.argsort(at, kind="stable")
                of = np.searchsorted(bounds, at[order], side="right") - 1
                cuts = np.searchsorted(of, np.arange(1, len(lists)))
                local = at[order] - bounds[of]
                for out, values in zip(found, (fp[order].view(np.int64), local, length[order], win[order].view(np.int64))):
                    out.extend(np.split(values, cuts))
                n.extend(np.diff(bounds).tolist())
            columns = [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64())]
            columns += [_longs(v, t) for v, t in zip(found, (pa.int64(), pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "fp", "start", "length", "win"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialize(rows.mapInArrow(run, f"row bigint, doc_id {kind}, n_words bigint, {FOUND}"), "winnowed")


def hits(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", span: int = SPAN):
    """(documents, spans, items): every document (row, doc_id, n_words); its hit windows (row, start, length), places and
    lengths in words; and the items met (row, item)."""
    found = materialize(items_of(items, text, item_id, span), "winnowed-items")
    lengths = sorted(r.length for r in found.select("length").distinct().collect())  # at most ``span``
    fingerprints = found.select(F.explode("fps").alias("fp")).distinct()
    of_items = found.select("item", F.explode("wins").alias("win")).distinct()
    parts = [F.count("*"), F.call_function("bit_xor", F.xxhash64("item")), F.sum(F.pmod(F.xxhash64("item", F.lit(1)), F.lit(1 << 40)))]
    windows = materialize(of_items.groupBy("win").agg(F.xxhash64(*parts).alias("set")), "windows")
    sets = materialize(of_items.join(windows, "win").select("set", "item").distinct(), "window-sets")

    read = read_documents(docs, text, doc_id, lengths, bitmaps.build(fingerprints, "fp"), bitmaps.build(windows, "win"))
    each = F.arrays_zip("fp", "start", "length", "win")
    candidates = read.filter(F.size("fp") > 0).select("row", F.explode(each).alias("x")).select("row", "x.*")
    # Spark broadcasts the items' side while its size is below the session's threshold, and splits hot keys beyond it
    shared = candidates.join(fingerprints, "fp", "left_semi").select("row", "start", "length", "win")
    extended = materialize(shared.join(windows, "win").select("row", "start", "length", "set").distinct(), "hits")
    met = extended.select("row", "set").distinct().join(sets, "set").select("row", "item").distinct()
    return read.select("row", "doc_id", "n_words"), extended.select("row", "start", "length").distinct(), met


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", span: int = SPAN) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated): a row per document; ``items`` sorted as strings."""
    read, spans, met = hits(docs, items, text, doc_id, item_id, span)
    before = W.partitionBy("row").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = spans.select("row", F.greatest(fresh, F.lit(0)).alias("n")).groupBy("row").agg(F.sum("n").alias("n_hit"))
    named = met.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    rows = read.join(hit.join(named, "row"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), (n_hit > 0).alias("contaminated"))


def op13_decontaminate(spark, sf_dir):
    docs = C.documents(spark, sf_dir).select("doc_id", "text")
    rows = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    joined = F.array_join("items", ",").cast("binary")
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), "contaminated"
    )


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
  dw AS (SELECT r, generate_subscripts(ws, 1) AS p, unnest(ws) AS w FROM d),
  dl AS (SELECT r, p, list(w) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {SPAN - 1} FOLLOWING) AS l FROM dw),
  i AS (SELECT CAST(item_id AS VARCHAR) AS item, row_number() OVER () AS q, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
  iw AS (SELECT item, q, len(ws) AS n, generate_subscripts(ws, 1) AS p, unnest(ws) AS w FROM i),
  il AS (SELECT item, n, p, list(w) OVER (PARTITION BY q ORDER BY p ROWS BETWEEN CURRENT ROW AND {SPAN - 1} FOLLOWING) AS l FROM iw),
  win AS (SELECT DISTINCT item, len(l) AS n, array_to_string(l, ' ') AS g FROM il WHERE p + least(n, {SPAN}) - 1 <= n),
  hit AS (SELECT r, p, n, item FROM (SELECT r, p, n, array_to_string(l[1:n], ' ') AS g FROM dl, (SELECT DISTINCT n FROM win) WHERE len(l) >= n) JOIN win USING (n, g)),
  covered AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, p + unnest(range(n)) AS at FROM (SELECT DISTINCT r, p, n FROM hit)) GROUP BY r),
  met AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN met USING (r)
"""
