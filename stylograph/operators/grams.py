"""N-grams of characters and of words in Arrow batches: counted exactly, and found in a fitted list, as arrays of numbers.

A stretch of texts becomes one array of code points, a stretch of token lists one of token numbers.  An n-gram is numbered by its beginning and
its last piece, so grams of every size come from the ones a piece shorter; none becomes a text before it is counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH = 1_000_000  # bytes of text turned into arrays at a time
TOKENS = 250_000  # of a stretch of token lists
MOST = 1 << 62
CELLS = 1 << 22  # of a table that is looked up by place, not searched


def ranges(sizes: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Rows from one to below the other, as many at a time as fill ``most``; a larger row ends its range."""
    start = held = 0
    for i, n in enumerate(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).tolist()):
        held += n
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def stretches(texts: pa.Array) -> Iterator[list[str]]:
    """As many texts at a time as fill a stretch; a longer text is one of its own, a null text is empty."""
    for start, stop in ranges(pc.binary_length(texts), STRETCH):
        yield [t or "" for t in texts.slice(start, stop - start).to_pylist()]


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, number of the text that each belongs to)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), np.repeat(np.arange(len(texts)), sizes)


def _as_texts(codes: np.ndarray) -> list[str]:
    """The rows of a matrix of code points as texts."""
    n = codes.shape[1]
    whole = codes.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[i : i + n] for i in range(0, len(whole), n)]


def _numbered(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(numbers of all tokens, number of the list that each belongs to, the tokens by number); a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    tokens = lists.flatten().dictionary_encode()
    return tokens.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lists)), sizes), tokens.dictionary


def _joined(tokens: pa.Array, codes: np.ndarray) -> pa.Array:
    """The rows of a matrix of token numbers as texts."""
    parts = [tokens.take(pa.array(column)) for column in codes.T]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")


Counts = Iterator[tuple[list[str] | pa.Array, np.ndarray, np.ndarray]]


def count(texts: list[str], sizes: tuple[int, int]) -> Counts:
    """(grams, texts that hold each, uses of each), size by size."""
    points, of = _points(texts)
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    letters = np.flatnonzero(seen)
    number = (np.cumsum(seen) - 1)[points]
    return _counted(number, of, len(texts), len(letters), sizes, lambda codes: _as_texts(letters[codes]))


def count_words(lists: pa.ListArray, sizes: tuple[int, int]) -> Counts:
    """The same for lists of tokens, whose n-grams are joined by a blank."""
    number, of, tokens = _numbered(lists)
    return _counted(number, of, len(lists), len(tokens), sizes, lambda codes: _joined(tokens, codes))


def _counted(number: np.ndarray, of: np.ndarray, texts: int, width: int, sizes: tuple[int, int], as_texts: Callable) -> Counts:
    width = max(1, width)
    key, most = number, width  # of the gram that begins at each position, below ``most``
    shorter: list[np.ndarray | None] = []  # per size: the keys that were numbered anew, if they were

    def spelled(keys: np.ndarray, n: int) -> np.ndarray:
        out = np.empty((len(keys), n), np.int64)
        for i in range(n - 1, 0, -1):
            keys, out[:, i] = np.divmod(keys, width)
            if shorter[i - 1] is not None:
                keys = shorter[i - 1][keys]
        out[:, 0] = keys
        return out

    for n in range(1, sizes[1] + 1):
        if n > 1:
            old = None
            if most * width * 2 * texts >= MOST:
                old, key = np.unique(key, return_inverse=True)
                most = max(1, len(old))
            shorter.append(old)
            key = key[:-1] * width + number[n - 1 :]
            most *= width
        inside = of[: len(key)] == of[n - 1 :]
        if n < sizes[0] or not inside.any():
            continue
        bits = max(1, texts - 1).bit_length()
        both = np.sort((key[inside] << bits) + of[: len(key)][inside])
        gram = both >> bits
        first = np.flatnonzero(np.diff(gram, prepend=-1))
        held = np.add.reduceat((np.diff(both, prepend=-1) != 0).astype(np.int64), first)
        yield as_texts(spelled(gram[first], n)), held, np.diff(first, append=len(gram))


class Finder:
    """Finds the grams of a list in texts: a tree of their beginnings.

    For each size it holds a sorted array of (parent, letter), or their numbers by place where that is small.
    """

    def __init__(self, grams: list[str]):
        points = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4")
        letters = np.unique(points)
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[letters] = np.arange(len(letters))
        self._grow(np.fromiter(map(len, grams), np.int64, len(grams)), self.letter[points], len(letters))

    def _grow(self, lengths: np.ndarray, pieces: np.ndarray, width: int) -> None:
        """The tree of grams of these lengths, whose pieces are given one after another."""
        longest = int(lengths.max())
        codes = np.zeros((len(lengths), longest), np.int64)
        codes[np.arange(longest) < lengths[:, None]] = pieces
        self.width = width
        # keys, whether by place, and the number of the gram that ends there or -1
        self.levels: list[tuple[np.ndarray, bool, np.ndarray]] = []
        node, parents = np.zeros(len(lengths), np.int64), 1
        for n in range(1, longest + 1):
            reach = np.flatnonzero(lengths >= n)
            key = node[reach] * self.width + codes[reach, n - 1]
            keys, at = np.unique(key, return_inverse=True)
            node[reach] = at
            ends = np.full(len(keys), -1, np.int64)
            here = lengths[reach] == n
            ends[at[here]] = reach[here]
            placed = parents * self.width <= CELLS
            parents, cells = len(keys), parents * self.width
            if placed:
                numbers = np.full(cells, -1, np.int32)
                numbers[keys] = np.arange(len(keys))
                keys = numbers
            self.levels.append((keys, placed, ends))

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, gram, uses) of the grams found, by text and gram."""
        points, of = _points(texts)
        return self._found(self.letter[points], of)

    def _found(self, letter: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = max(int(ends.max(initial=-1)) for _, _, ends in self.levels) + 1
        at, node = np.arange(len(letter)), np.zeros(len(letter), np.int64)
        found = []
        for n, (keys, placed, ends) in enumerate(self.levels, 1):
            last = at + (n - 1)
            stays = last < len(letter)
            at, node, last = at[stays], node[stays], last[stays]
            stays = (letter[last] >= 0) & (of[at] == of[last])
            at, key = at[stays], node[stays] * self.width + letter[last[stays]]
            if placed:
                node = keys[key]
                stays = node >= 0
            else:
                node = np.searchsorted(keys, key)
                stays = keys[np.minimum(node, len(keys) - 1)] == key
            at, node = at[stays], node[stays].astype(np.int64)
            ending = ends[node]
            some = ending >= 0
            found.append(of[at[some]] * size + ending[some])
        both, uses = np.unique(np.concatenate(found), return_counts=True)
        return *np.divmod(both, size), uses


class WordFinder(Finder):
    """Finds n-grams of tokens, joined by a blank, in lists of tokens."""

    def __init__(self, grams: list[str]):
        parts = [g.split(" ") for g in grams]
        self.tokens = pa.array(sorted(set(chain.from_iterable(parts))), pa.string())
        number = {t: i for i, t in enumerate(self.tokens.to_pylist())}
        pieces = np.fromiter((number[t] for t in chain.from_iterable(parts)), np.int64)
        self._grow(np.fromiter(map(len, parts), np.int64, len(parts)), pieces, len(number))

    def counts(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        number, of, tokens = _numbered(lists)
        known = pc.fill_null(pc.index_in(tokens, value_set=self.tokens), -1).to_numpy()
        return self._found(known[number], of)
