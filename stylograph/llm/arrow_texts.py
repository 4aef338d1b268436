"""Texts of Arrow batches as lists of words, a stretch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

STRETCH = 1_000_000  # bytes of text whose words are held at a time


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def stretches(
    texts: list[bytes], words: Callable[[bytes], list[bytes]], size: int = STRETCH
) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(number of the first text, words of each): as many texts at a time as fill a stretch."""
    start, held, lists = 0, 0, []
    for i, t in enumerate(texts):
        lists.append(words(t))
        held += len(t)
        if held >= size:
            yield start, lists
            start, held, lists = i + 1, 0, []
    if lists:
        yield start, lists


def by_bytes(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``size`` bytes; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(lengths.tolist()):
        held += n
        if held >= size:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
