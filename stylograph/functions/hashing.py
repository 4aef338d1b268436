"""Keys, digests and hash buckets.  Everything random in this library is a function of a key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def content_key(text: Column | str) -> Column:
    """First 16 hex digits of the md5 of the text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.substring(F.md5(t.cast("binary")), 1, 16)


def seeded_digest(seed: int, *key: Column | str) -> Column:
    """md5 of ``seed|key``: the hash order used for sampling and shuffling."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *key))


def _hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def bucket(seed: int, *key: Column | str, n: int = BUCKETS) -> Column:
    """Stable bucket 0..n-1 of a key; the same row always lands in the same bucket."""
    return _hex_number(seeded_digest(seed, *key), 8) % n


def digest_prefix(digest: Column | str, hex_digits: int = 4) -> Column:
    d = F.col(digest) if isinstance(digest, str) else digest
    return _hex_number(d, hex_digits)


def row_digest(*cols: Column | str) -> Column:
    """128-bit digest of several texts.  Lengths go in, so ('ab','c') and ('a','bc') differ."""
    parts = []
    for c in cols:
        t = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts += [F.coalesce(F.length(t), F.lit(-1)).cast("string"), F.coalesce(t, F.lit(""))]
    return F.md5(F.concat_ws("\x1f", *parts))
