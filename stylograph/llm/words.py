"""Words of a batch of texts as arrays: numbers of words, stable hashes, windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

STRETCH = 500_000  # bytes of text turned into arrays at a time
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def stretches(texts: list[str | None], lower: bool = False) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """(start, stop, words of each text): as many texts at a time as fill a stretch.

    ``bytes.split`` cuts at exactly the six ASCII white space characters, and ``bytes.lower``
    changes A-Z alone.
    """
    start, size, lists = 0, 0, []
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        lists.append((raw.lower() if lower else raw).split())
        size += len(raw)
        if size >= STRETCH:
            yield start, i + 1, lists
            start, size, lists = i + 1, 0, []
    if lists:
        yield start, len(texts), lists


def codes(lists: list[list[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(number of each word in turn, the different words, where each list starts, with the end)."""
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(w) for w in lists], out=bounds[1:])
    flat = np.empty(int(bounds[-1]), object)
    at = 0
    for words in lists:
        flat[at : at + len(words)] = words
        at += len(words)
    numbers, different = pd.factorize(flat)
    return numbers, list(different), bounds


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values, in order; shorter input gives none."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(width), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = mixed(out * A + values[j : j + n] * B)
    return out
