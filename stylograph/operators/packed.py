"""Linear fits on rows packed into blocks of arrays.

A block holds some hundred rows as one binary value: per row and part of its terms (words, characters) what its weights are scaled by, and the
numbers and uses of its terms, by row and once more by term.  A pass streams the blocks through the tasks: margins are products along rows,
gradients sums along terms, so nothing is looked up one term at a time, and a task holds one block and one set of sums.

The optimizer is L-BFGS on the driver, whose steps are scaled by the curvature of each term at the start.  It keeps a few vectors of the size of the
model; one fit runs at a time, as a pass keeps all cores busy.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wide import WideModel

SCHEMA = "rows long, size long, block binary"
TYPES = {"labels": np.float64, "norms": np.float64, "cuts": np.int64, "index": np.int32, "terms": np.int32, "starts": np.int64}
PARTS = [*TYPES, "segments", "uses", "uses_by_term"]
# a reader holds a row group at a time, and blocks take some MB
STORED = {"compression": "uncompressed", "parquet.block.size": 1 << 24, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
CODEC = "lz4"  # read in every pass, so quick to read
FULL = 3_000_000  # entries of a block
MEMORY = 10  # steps that the optimizer looks back on
STILL = 5  # steps over which the loss is compared
LEFT = 0.01  # of the length of each class's gradient at the start, beyond which a fit goes on
SUMMED = 24  # tasks whose sums the driver adds up by itself
SLICES = 16  # of sums, where more tasks send them
TRIES, ENOUGH, SHORTEST = 20, 1e-4, 1e-3  # of a line search: the share of the expected gain, and of a length that failed
_one_fit = Lock()


def cuts_of(of: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each of n rows begin, and where the last ends."""
    return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])


def _damped(uses: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(uses)


FEW = _damped(np.maximum(np.arange(1 << 8), 1)).astype(np.float32)


def _quickly_damped(uses: np.ndarray) -> np.ndarray:
    """The same in single precision; small numbers are looked up."""
    return FEW[uses] if uses.dtype == np.uint8 else _damped(uses.astype(np.float32))


def _norms(cuts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Lengths of the segments, 1 for those without any."""
    of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    lengths = np.sqrt(np.bincount(of, weights=weights * weights, minlength=len(cuts) - 1))
    return np.where(lengths > 0, lengths, 1.0)


def margins(
    cuts: np.ndarray, index: np.ndarray, uses: np.ndarray, idf: np.ndarray, weights: np.ndarray, intercepts: np.ndarray, rows: int
) -> np.ndarray:
    """Rows x classes; the segments are those of the first part of all rows, then of the next."""
    values = _damped(uses) * (uses * idf[index]) / uses
    values /= np.repeat(_norms(cuts, values), np.diff(cuts))
    of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)) % rows
    order = np.argsort(of, kind="stable")
    return intercepts + _along(cuts_of(of, rows), index[order], values[order], weights)


def _along(cuts: np.ndarray, index: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Segments x classes: sums of values times the weights of their terms."""
    classes = weights.shape[1]
    item = np.dtype(f"V{classes * weights.itemsize}")  # a term's weights move as one
    flat = weights.view(item).ravel()
    held = np.empty(int(np.diff(cuts).max(initial=0)), item)
    told = held.view(weights.dtype).reshape(-1, classes)
    out = np.zeros((len(cuts) - 1, classes), weights.dtype)
    edges = cuts.tolist()
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if a < b:
            flat.take(index[a:b], out=held[: b - a], mode="clip")
            np.dot(values[a:b], told[: b - a], out=out[i])
    return out


def _small(numbers: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest takes."""
    most = numbers.max(initial=0)
    return numbers.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def encoded(labels: np.ndarray, cuts: np.ndarray, index: np.ndarray, uses: np.ndarray, idf: np.ndarray) -> pa.RecordBatch:
    """A block as a row of ``SCHEMA``."""
    segments = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order = np.argsort(index, kind="stable")
    by_term = index[order]
    starts = np.flatnonzero(np.diff(by_term, prepend=-1))
    parts = {
        "labels": labels, "norms": _norms(cuts, _damped(uses) * idf[index]), "cuts": cuts, "index": index, "terms": by_term[starts],
        "starts": starts, "segments": _small(segments[order]), "uses": _small(uses), "uses_by_term": _small(uses[order]),
    }
    told = [parts[c].astype(TYPES.get(c, parts[c].dtype)).tobytes() for c in PARTS]
    whole = b"".join([np.array([*map(len, told)], np.int64).tobytes(), *told])
    columns = [pa.array([len(labels)]), pa.array([len(whole)]), pa.array([pa.compress(whole, CODEC, asbytes=True)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["rows", "size", "block"])


def decoded(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    """The blocks of a batch, one at a time."""
    for size, block in zip(batch.column("size").to_pylist(), batch.column("block")):
        whole = pa.decompress(block.as_buffer(), size, CODEC)
        lengths = np.frombuffer(whole, np.int64, len(PARTS))
        ends = (lengths.nbytes + np.cumsum(lengths)).tolist()
        parts = {c: whole[end - n : end] for c, end, n in zip(PARTS, ends, lengths.tolist())}
        out = {c: np.frombuffer(parts[c], t) for c, t in TYPES.items()}
        for c in PARTS[len(TYPES) :]:
            out[c] = np.frombuffer(parts[c], f"<u{len(parts[c]) // max(1, len(out['index']))}" if len(out["index"]) else np.uint8)
        yield out


class _Sums:
    """Loss, gradient and squares of blocks, added up."""

    def __init__(self, terms: int, classes: int, squared: bool):
        self.terms = np.zeros((terms, classes))
        self.squares = np.zeros(terms if squared else 0)
        self.intercepts = np.zeros(classes)
        self.loss = 0.0

    def add(self, block: dict[str, np.ndarray], weights: np.ndarray, intercepts: np.ndarray) -> None:
        """``weights`` are those of the terms times their idf, in single precision; what is added up over rows is in double."""
        labels, norms, classes = block["labels"].astype(np.int64), block["norms"], len(intercepts)
        each = np.arange(len(labels))
        along = _along(block["cuts"], block["index"], _quickly_damped(block["uses"]), weights)
        told = intercepts + (along / norms[:, None]).reshape(-1, len(labels), classes).sum(axis=0)
        told -= told.max(axis=1)[:, None]
        powers = np.exp(told)
        total = powers.sum(axis=1)
        self.loss += float((np.log(total) - told[each, labels]).sum())
        off = powers / total[:, None]
        off[each, labels] -= 1.0
        self.intercepts += off.sum(axis=0)
        if not len(block["index"]):
            return
        segments, starts, terms = block["segments"].astype(np.intp), block["starts"], block["terms"]
        # two classes at a time, as the parts of a complex number
        by_segment = np.zeros((len(norms), classes + classes % 2), np.float32)
        by_segment[:, :classes] = np.tile(off, (len(norms) // len(labels), 1)) / norms[:, None]
        pairs = np.ascontiguousarray(by_segment.view(np.complex64).T)
        values = _quickly_damped(block["uses_by_term"])
        found = np.empty((len(starts), len(pairs)), np.complex64)
        held = np.empty(len(segments), np.complex64)
        for k, pair in enumerate(pairs):
            pair.take(segments, out=held, mode="clip")
            held *= values
            found[:, k] = np.add.reduceat(held, starts)
        self.terms[terms] += found.view(np.float32)[:, :classes]
        if len(self.squares):
            self.squares[terms] += np.add.reduceat((values / norms[segments]) ** 2, starts)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.terms.ravel(), self.squares, self.intercepts, [self.loss]])


def _sent(slices: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
    for i, values in enumerate(slices):
        if values is not None:
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([values.tobytes()], pa.binary())], names=["slice", "sums"])


def _added(batches: Iterable[pa.RecordBatch]) -> list[np.ndarray | None]:
    """Sums of the slices, by number; those that no batch has are None."""
    out: list[np.ndarray | None] = [None] * SLICES
    for batch in batches:
        for i, raw in zip(batch.column("slice").to_pylist(), batch.column("sums")):
            values = np.frombuffer(raw.as_buffer(), np.float64)
            out[i] = values.copy() if out[i] is None else out[i] + values
    return out


@dataclass
class Packed:
    """Packed blocks and the idf weights of their terms."""

    blocks: DataFrame
    idf: np.ndarray

    def classes(self) -> np.ndarray:
        """Rows of each class, up to the highest that occurs."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in decoded(batch):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(block["labels"], return_counts=True)], names=["label", "n"])

        found = self.blocks.mapInArrow(run, "label double, n long").groupBy("label").agg(F.sum("n").alias("n")).collect()  # a row per class
        if any(np.isnan(r.label) for r in found):
            raise ValueError("labels must not be null")
        return np.bincount([int(r.label) for r in found], weights=[r.n for r in found]).astype(np.int64)

    def sums(self, weights: np.ndarray, intercepts: np.ndarray, squared: bool = False) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """(loss, its gradient by terms and classes, that of the intercepts, squared values of each term if asked for), summed over all rows."""
        terms, classes = weights.shape
        context = self.blocks.sparkSession.sparkContext
        kept = context.broadcast(((self.idf[:, None] * weights).astype(np.float32), intercepts))
        tasks = max(1, context.defaultParallelism)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, (weights, intercepts) = _Sums(terms, classes, squared), kept.value
            for batch in batches:
                for block in decoded(batch):
                    sums.add(block, weights, intercepts)
            yield from _sent(np.array_split(sums.flat(), 1 if tasks <= SUMMED else SLICES))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _sent(_added(batches))

        # as many tasks as run at a time: each streams its share and sends one set of sums
        told = self.blocks.select("size", "block").coalesce(tasks).mapInArrow(run, "slice int, sums binary")
        if tasks > SUMMED:
            told = told.repartition(SLICES, "slice").mapInArrow(add, told.schema)
        flat = np.concatenate([x for x in _added(told.toArrow().to_batches()) if x is not None])
        kept.destroy()
        gradient, squares, of_intercepts, loss = np.split(flat, np.cumsum([terms * classes, terms if squared else 0, classes]))
        return float(loss[0]), gradient.reshape(terms, classes) * self.idf[:, None], of_intercepts, squares * self.idf**2 if squared else squares


def fit(data: Packed, strength: float, max_iter: int, tol: float) -> WideModel:
    """The weights and intercepts of least mean loss plus penalty.

    It ends by the rules of Spark's optimizer, a gradient of ``tol`` times the loss or a loss that the last ``STILL`` steps changed by at most ``tol`` of
    the first; but not before each class's gradient is at most ``LEFT`` of what it is for zero weights.
    """
    with _one_fit:
        return _fit(data, strength, max_iter, tol)


def _fit(data: Packed, strength: float, max_iter: int, tol: float) -> WideModel:
    counts = data.classes()
    n, terms, classes = int(counts.sum()), len(data.idf), len(counts)
    penalty = 1.0 / (strength * n)

    def at(x: np.ndarray, squared: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
        weights = x[:-1]
        loss, gradient, of_intercepts, squares = data.sums(weights, x[-1], squared)
        gradient /= n
        gradient += penalty * weights
        return loss / n + penalty / 2 * float(np.vdot(weights, weights)), np.vstack([gradient, of_intercepts / n]), squares / n

    x = np.zeros((terms + 1, classes))
    value, gradient, squares = at(x, squared=True)
    spread = (1.0 - 1.0 / classes) / classes  # of a class's probability when all are equal
    curvature = np.append(squares * spread + penalty, max(spread, penalty))[:, None]
    start = np.linalg.norm(gradient, axis=0)
    values = deque([value], STILL + 1)
    first = value
    past: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=MEMORY)
    for _ in range(max_iter):
        still = len(values) > 1 and max(values) - value <= tol * first
        if (still or np.linalg.norm(gradient) <= max(tol * value, 1e-8)) and (np.linalg.norm(gradient, axis=0) <= LEFT * start).all():
            break
        step = _direction(gradient, curvature, past)
        slope = float(np.vdot(gradient, step))
        length = 1.0
        for _ in range(TRIES):
            moved = x + length * step
            next_value, next_gradient, _ = at(moved)
            if next_value <= value + ENOUGH * length * slope:
                break
            bend = next_value - value - length * slope  # the lowest point of the parabola through what is known
            length *= min(0.5, max(SHORTEST, -0.5 * length * slope / bend))
        else:
            break  # no lower loss in sight: rounding noise is left
        change, turn = moved - x, next_gradient - gradient
        if (product := float(np.vdot(change, turn))) > 0:
            past.append((change, turn, 1.0 / product))
        x, value, gradient = moved, next_value, next_gradient
        values.append(value)
    return WideModel(np.ascontiguousarray(x[:-1].T), x[-1] - x[-1].mean())


def _direction(gradient: np.ndarray, curvature: np.ndarray, past: deque) -> np.ndarray:
    """Downhill, by the curvature that the last steps have shown, and that of the start in all other directions."""
    out = -gradient
    parts = []
    for change, turn, inverse in reversed(past):
        parts.append(inverse * float(np.vdot(change, out)))
        out -= parts[-1] * turn
    if past:
        change, turn, inverse = past[-1]
        out /= inverse * float(np.vdot(turn, turn / curvature))
    out /= curvature
    for (change, turn, inverse), part in zip(past, reversed(parts)):
        out += (part - inverse * float(np.vdot(turn, out))) * change
    return out
