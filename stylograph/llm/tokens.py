"""Token ids of texts with the public word tokenizer, computed in batches inside tasks.

The tokenizer lower-cases, drops white space and never joins two of its word pieces, so the ids of a
text are the ids of its pieces in turn.  Chunks between white space repeat, so their ids are
remembered; the pieces of unknown chunks are encoded together, and the marker that ends every piece
tells where each one stops.
Texts with characters whose normal form needs care go to the tokenizer as a whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex

PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
PLAIN = re.compile(r"[\t\n\x0b\x0c\r\x20-\x7e\xa1-įı-ɏ]*")  # Latin text; one run is matched at once
REMEMBERED = 150_000  # chunks and pieces kept per worker; later ones are forgotten after their batch


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def careful(text: str) -> bool:
    """Holds anything but plain Latin text; special token strings start with <|."""
    return PLAIN.fullmatch(text) is None or "<|" in text


def cut_chunk(chunk: str) -> tuple[str, ...] | list[str]:
    """The pieces of a chunk without white space.  Words, and words with one sign after them, need no pattern."""
    if chunk.isalpha():
        return (chunk,)
    if chunk[:-1].isalpha():
        return chunk[:-1], chunk[-1]
    return PIECE.findall(chunk)


class Encoder:
    """Encodes texts to little-endian unsigned 16-bit ids; one per Python worker."""

    _kept: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids are kept in 16 bits")
        self.ends = np.zeros(65_536, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def pieces_of(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks without white space, by way of their pieces."""
        cut = {c: cut_chunk(c) for c in chunks}
        new = list({p for pieces in cut.values() for p in pieces}.difference(self.pieces))
        fresh: dict[str, bytes] = {}
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            lines = [" ".join(part[i : i + 500]) for i in range(0, len(part), 500)]
            found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.asarray(e.ids, "<u2") for e in found])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                fresh.update((p, self.direct(p)) for p in part)  # a piece without an end marker of its own
                continue
            raw, at = ids.tobytes(), 0
            for p, stop in zip(part, (2 * stops).tolist()):
                fresh[p] = raw[at:stop]
                at = stop
        if len(self.pieces) < REMEMBERED:
            self.pieces.update(fresh)
        old = self.pieces.get
        return {c: b"".join([old(p) or fresh[p] for p in pieces]) for c, pieces in cut.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start, stop in _stretches(texts):
            cut = [None if careful(t) else t.lower().split() for t in texts[start:stop]]
            missing = set().union(*(c for c in cut if c)).difference(self.chunks)
            fresh = self.pieces_of(list(missing)) if missing else {}
            room = len(self.chunks) < REMEMBERED
            self.chunks.update(fresh)
            get = self.chunks.__getitem__
            for text, chunks in zip(texts[start:stop], cut):
                out.append(self.direct(text) if chunks is None else b"".join(map(get, chunks)))
            if not room:
                for c in fresh:
                    del self.chunks[c]
        return out


def _stretches(texts: list[str], chars: int = 1_000_000):
    """Stretches of the list with about so many characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
