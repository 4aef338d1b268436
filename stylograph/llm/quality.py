"""Quality rules: base counts, and a calibrated classifier on hashed word and character n-grams.

Words, pairs of words and runs of three and four characters are hashed into four blocks; a document's features are the
shares of each block's cells.  A logistic regression is fitted on labelled documents and its margins are
calibrated to probabilities on a held-out part of them.  Scoring is a pass over Arrow batches with no
shuffle; the model goes to the tasks as one array of fixed size.

At most ``TRAINING_ROWS`` labelled documents are used to fit, those with the smallest hashes; every document is
scored as a whole, whatever its length.

Nulls: a null text has no words, fails the base rules and is not kept; labels without a doc_id or quality and documents
with contradicting labels are left out of the fit.  Without labels of both kinds the base
rules alone decide.  Equal rows get equal verdicts.  An empty table gives no rows.  Other columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import common as C
from . import words as V

TRAINING_ROWS = 4_000
CELLS = 1 << 14
BLOCKS = 4
ROWS_AT_ONCE = 1_000  # rows of an Arrow batch turned into Python texts at a time
KEEP = 0.5  # least calibrated probability of good quality
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Model:
    """Weights by cell, and the calibration of margins."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margins + self.intercept) + self.shift, -500, 500)))


def blocks(texts: list[str], word: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(cell of every n-gram, first and last-but-one position per text), block by block."""
    begin, end = bounds[:-1], bounds[1:]
    cells = np.uint64(CELLS - 1)
    yield V.mixed(word) & cells, begin, end
    yield V.windows(word, 2) & cells, begin, np.maximum(begin, end - 1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(sizes)
    begin = end - sizes
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    for width in (3, 4):
        run = np.zeros(max(0, len(points) - width + 1), np.uint64)
        for j in range(width):
            run = (run ^ points[j : j + len(run)]) * V.A
            run ^= run >> np.uint64(29)
        yield (run >> np.uint64(20)) & cells, begin, np.maximum(begin, end - width + 1)


def margins(model: Model, texts: list[str], word: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, (cell, begin, end) in enumerate(blocks(texts, word, bounds)):
        sums = np.zeros(len(cell) + 1)
        np.cumsum(model.weights[i * CELLS : (i + 1) * CELLS][cell.astype(np.int64)], out=sums[1:])
        out += (sums[np.minimum(end, len(cell))] - sums[np.minimum(begin, len(cell))]) / np.maximum(1, end - begin)
    return out


def counts(texts: list[str], word: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of every text."""
    n = np.diff(bounds)
    chars, symbols, lines = [], [], []
    for t in texts:
        chars.append(len(t) - sum(map(t.count, SPACES)))
        symbols.append(sum(map(t.count, SYMBOLS)))
        cut = t.split("\n") if "\n" in t else []
        if len(set(cut)) < len(cut):
            seen = Counter(line for line in cut if line.strip(SPACES))
            lines.append(seen.total() - len(seen))
        else:
            lines.append(0)
    runs = V.windows(word, 8)
    covered = np.zeros(len(word) + 1, np.int64)
    if len(runs):
        text_of = np.repeat(np.arange(len(n)), n)
        inside = np.flatnonzero(text_of[: len(runs)] == text_of[7 : 7 + len(runs)])
        keys = V.mixed(runs[inside] + text_of[inside].astype(np.uint64) * V.B)
        _, where, often = np.unique(keys, return_inverse=True, return_counts=True)
        starts = inside[often[where] > 1]
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + 8, -1)
        covered = (np.cumsum(covered) > 0).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(covered[: len(word)])])
    return {
        "n_words": n, "word_chars": np.array(chars, np.int64), "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(lines, np.int64), "n_repeat_words": upto[bounds[1:]] - upto[bounds[:-1]],
    }


RESULTS = [
    *((name, pa.int64(), T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    ("base_failed", pa.bool_(), T.BooleanType()), ("p_good", pa.float64(), T.DoubleType()), ("kept", pa.bool_(), T.BooleanType()),
]


def judged(batch_texts: list[str | None], model: Model | None, keep: float) -> dict[str, np.ndarray]:
    parts = []
    for start, stop, lists in V.stretches(batch_texts):
        texts = [t or "" for t in batch_texts[start:stop]]
        numbers, different, bounds = V.codes(lists)
        word = V.hashes(different)[numbers] if len(numbers) else np.empty(0, np.uint64)
        found = counts(texts, word, bounds)
        found["base_failed"] = (found["n_words"] < LEAST_WORDS) | (
            100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"]
        )
        p = model.probability(margins(model, texts, word, bounds)) if model else np.ones(len(texts))
        found["p_good"] = p
        found["kept"] = ~found["base_failed"] & (p >= keep)
        parts.append(found)
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.empty(0) for name, _, _ in RESULTS}


def score(
    docs: DataFrame, model: Model | None, text: str = "text", keep: float = KEEP, passing: list[str] | None = None
) -> DataFrame:
    """The passing columns of ``docs`` with the counts and verdicts.

    All columns pass by default, except those named like a result, which the result replaces.
    """
    taken = {name for name, _, _ in RESULTS}
    names = [c for c in (passing or docs.columns) if c.lower() not in taken]
    read = "_text"
    while read in {c.lower() for c in names}:
        read = f"_{read}"
    schema = T.StructType([docs.schema[c] for c in names])
    for name, _, kind in RESULTS:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found = judged(batch.column(read).to_pylist(), model, keep)
                made = [pa.array(found[name], kind) for name, kind, _ in RESULTS]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in names] + made, names=names + [name for name, _, _ in RESULTS]
                )

    rows = docs.select(*[F.col(f"`{n}`") for n in names], F.col(text).alias(read))
    return rows.mapInArrow(run, schema)


def calibration(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-out margins, by Newton's steps on smoothed targets."""
    n = np.array([(good == 0).sum(), (good == 1).sum()])
    if not n.all():
        return 1.0, 0.0
    target = np.where(good == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    scale = max(1e-9, float(np.abs(margin).mean()))
    x = np.stack([margin / scale, np.ones_like(margin)], 1)
    b = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (target - p) - 1e-6 * b)
        b = b + step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    # margins must not be turned round
    return max(float(b[0]) / scale, 0.0), float(b[1])


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", quality: str = "quality",
    rows: int = TRAINING_ROWS,
) -> Model | None:
    """The classifier, or None if the labels do not hold both kinds."""
    told = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).cast("int").alias("good"))
    told = told.filter("doc_id is not null and good is not null").groupBy("doc_id")
    told = told.agg(F.min("good").alias("good"), F.max("good").alias("_most")).filter("good = _most").drop("_most")
    sample = told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    # at most TRAINING_ROWS rows of two numbers
    labelled = texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            cells, shares = [], []
            for start, stop, lists in V.stretches(texts):
                numbers, different, bounds = V.codes(lists)
                word = V.hashes(different)[numbers] if len(numbers) else np.empty(0, np.uint64)
                own: list[list[np.ndarray]] = [[] for _ in range(stop - start)]
                for i, (cell, begin, end) in enumerate(blocks(texts[start:stop], word, bounds)):
                    for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
                        if b > a:
                            at, n = np.unique(cell[a:b], return_counts=True)
                            own[k].append(np.stack([at.astype(np.float64) + i * CELLS, n / (b - a)]))
                joined = [np.concatenate(o, 1) if o else np.empty((2, 0)) for o in own]
                cells += [o[0].astype(np.int32) for o in joined]
                shares += [o[1] for o in joined]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("good"), pa.array(cells, pa.list_(pa.int32())),
                 pa.array(shares, pa.list_(pa.float64()))],
                names=["doc_id", "good", "cells", "shares"],
            )

    kind = labelled.schema["doc_id"].dataType.simpleString()
    found = labelled.mapInArrow(run, f"doc_id {kind}, good int, cells array<int>, shares array<double>")
    # a vector is stored as a struct, so it is written by SQL and read back as a vector
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(CELLS * BLOCKS).alias("size"), F.col("cells").alias("indices"), F.col("shares").alias("values")
    )
    held = (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0).alias("held")
    rows = found.select(F.col("good").cast("double").alias("label"), vector.alias("features"), held)
    schema = T.StructType().add("label", T.DoubleType()).add("features", VectorUDT()).add("held", T.BooleanType())
    training = materialize(rows.repartition(4), "quality-features", schema)
    fitting = training.filter("not held")
    if fitting.select("label").distinct().count() < 2:
        return None
    lr = LogisticRegression(maxIter=30, regParam=1e-5, standardization=False)
    fitted = lr.fit(fitting)
    weights = fitted.coefficients.toArray()
    # a quarter of at most TRAINING_ROWS rows
    held = [(r["label"], float(r["features"].dot(weights))) for r in training.filter("held").collect()]
    margin = np.array([m for _, m in held]) + fitted.intercept
    slope, shift = calibration(margin, np.array([g for g, _ in held])) if held else (1.0, 0.0)
    return Model(weights, float(fitted.intercept), slope, shift)


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", keep: float = KEEP) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    model = fit(docs, labels, text)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                yield batch.filter(pa.array(judged(batch.column(at).to_pylist(), model, keep)["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark, sf_dir):
    docs = C.documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, passing=["doc_id"])
