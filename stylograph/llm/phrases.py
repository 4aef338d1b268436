"""Phrase collocations: frequent phrases of two to five words that belong together, by language.

Texts are cut into pieces at punctuation, pieces into words; a suffix is a word's place in its piece with the words that follow.
Frequent phrases are the large groups of equal leading words in the sorted suffixes.  Words and pairs of words are counted first:
they tell which suffixes can lead to a frequent phrase, and how to route them (pairs are counted by hash; what is reported is counted by its words).  Suffixes go to partitions by their two
leading words, those of the heaviest pairs by a salt of the words that follow besides.  There they are sorted by a multikey
three-way quicksort of suffix pointers: a pointer set is split by a pivot word into smaller, equal and larger ones; the size of the equal part
is the count of its phrase, and it is split by the next word.  Parts with fewer than ``least`` occurrences are abandoned, unless the group
of their leading pair goes on elsewhere (a salted pair, or one cut by the end of a chunk); such groups send all their counts, which are added up.
A task holds a chunk of suffixes at a time, whatever its partition.  Equal suffixes of one stretch of text travel once, with their number.

The score of a phrase is the lowest floor(1000 * a * n / (l * r)) over the places where it can be cut in two (a, l, r: occurrences of
the phrase, its first and its second part; n: all words of the language); decimals of 38 digits keep it exact below 10^17 words.
A phrase inside a longer one that occurs as often is dropped.  It is enough to look at phrases one word longer, since any that occurs as often
has those between as well.

A null or empty text has no words; a null language is ``und``.  Texts are read whole and pieces never cross texts.  Repeated rows all
count.  Ties go by count, then by phrase in UTF-8 byte order, ties between cuts to the first.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import discard, materialize
from . import bitmaps
from . import common as C
from . import words as V
from .arrow_texts import raw

LONGEST = 5  # words
LEAST = 100  # occurrences
TOP = 2_000  # phrases of a language that are reported
CUTS = b".,;:!?\n\x0b\x0c\r"
MARK = b"\xff"  # stands in no UTF-8 text
LETTERS = bytes(MARK[0] if b in CUTS else 32 if b == 9 else ord(chr(b).lower()) if b < 128 else b for b in range(256))
STRETCH = 4_000_000  # bytes of text whose suffixes are counted at a time
CHUNK = 200_000  # suffixes sorted at a time
HEAVY, SALTS = 1_000, 64  # leading pairs that are spread, and over how many partitions
SPREAD = 64  # parts of a language that are ranked before the whole
SEED = np.uint64(42)


def words_of(text: bytes) -> list[bytes]:
    """Words in order, with a mark at the end of each piece."""
    words = text.translate(LETTERS).replace(MARK, b" \xff ").split()
    words.append(MARK)
    return words


class Stretch:
    """The words of some texts of one language as numbers."""

    def __init__(self, lang: str, words: list[bytes]):
        flat = np.empty(len(words), object)
        flat[:] = words
        self.lang = lang
        self.codes, self.words = pd.factorize(flat)
        self.is_word = np.array([w != MARK for w in self.words], bool)[self.codes]
        ends = np.flatnonzero(~self.is_word)
        at = np.arange(len(words))
        self.left = ends[np.searchsorted(ends, at)] - at  # words of the piece from each place on
        self.hashed = self.hashes(self.words)[self.codes]

    def hashes(self, phrases: list[bytes]) -> np.ndarray:
        """What Spark's xxhash64(lang, phrase) gives."""
        seed = xxhash.xxh64_intdigest(self.lang.encode(), seed=int(SEED))
        return np.fromiter((xxhash.xxh64_intdigest(p, seed=seed) for p in phrases), np.uint64, len(phrases))

    def pairs(self, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of two good words in a row, a hash of language and words for each)."""
        at = np.flatnonzero(good & (self.left >= 2))
        at = at[good[at + 1]]
        with np.errstate(over="ignore"):
            return at, V.mixed(self.hashed[at] * V.A + V.mixed(self.hashed[at + 1]) * V.B)


def per_stretch(docs: DataFrame, count, schema: str) -> DataFrame:
    """What ``count`` says of every stretch of texts of one language, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), raw(batch.column("text"))):
                held.setdefault(lang, []).extend(words_of(text))
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] >= STRETCH:
                    yield from count(Stretch(lang, held.pop(lang)))
                    size[lang] = 0
                elif sum(size.values()) >= 2 * STRETCH:  # many languages, few texts of each
                    for x in list(held):
                        yield from count(Stretch(x, held.pop(x)))
                    size.clear()
        for lang, words in held.items():
            yield from count(Stretch(lang, words))

    return docs.mapInArrow(run, schema)


def _batch(lang: str, n: np.ndarray, **texts: list[bytes]) -> pa.RecordBatch:
    columns = {"lang": pa.repeat(pa.scalar(lang), len(n)), **{k: pa.array(v, pa.binary()).cast(pa.string()) for k, v in texts.items()}}
    return pa.RecordBatch.from_pydict({**columns, "n": pa.array(n, pa.int64())})


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of all words."""

    def words(s: Stretch) -> Iterator[pa.RecordBatch]:
        n = np.bincount(s.codes, minlength=len(s.words))
        keep = [i for i, w in enumerate(s.words) if w != MARK]
        yield _batch(s.lang, n[keep], phrase=[s.words[i] for i in keep])

    return per_stretch(docs, words, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def count_pairs(docs: DataFrame, words: np.ndarray, least: int) -> DataFrame:
    """(key, n) of the frequent pairs of frequent words, by their hashes: they only say where to look on."""
    kept = docs.sparkSession.sparkContext.broadcast(words)

    def pairs(s: Stretch) -> Iterator[pa.RecordBatch]:
        _, keys = s.pairs(s.is_word & bitmaps.holds(kept.value, s.hashed))
        different, n = np.unique(keys, return_counts=True)
        yield pa.RecordBatch.from_pydict({"key": pa.array(different.view(np.int64)), "n": pa.array(n, pa.int64())})

    return per_stretch(docs, pairs, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def suffixes(docs: DataFrame, words: np.ndarray, pairs: np.ndarray, heavy: np.ndarray) -> DataFrame:
    """(lang, head, rest, n, salt): leading pair and up to three words after it, as far as all pairs on the way are frequent."""
    kept = docs.sparkSession.sparkContext.broadcast((words, pairs, heavy))

    def run(s: Stretch) -> Iterator[pa.RecordBatch]:
        frequent_words, frequent_pairs, heaviest = kept.value
        at, keys = s.pairs(s.is_word & bitmaps.holds(frequent_words, s.hashed))
        held = bitmaps.holds(frequent_pairs, keys)
        at, keys = at[held], keys[held]
        if not len(at):
            return
        pair = np.zeros(len(s.codes) + LONGEST, bool)
        pair[at] = True
        length = np.full(len(at), 2)
        for step in range(1, LONGEST - 1):  # one more word while the pair that ends there is frequent
            length += (length == step + 1) & pair[at + step]
        size = np.int64(len(s.words) + 1)
        of = s.codes[at].astype(np.int64)
        for step in range(1, LONGEST):
            after = np.where(length > step, s.codes[np.minimum(at + step, len(s.codes) - 1)] + 1, 0)
            of = np.unique(of * size + after, return_inverse=True)[1].astype(np.int64)
        _, first, n = np.unique(of, return_index=True, return_counts=True)
        at, keys, length = at[first], keys[first], length[first]
        # a text for each different leading pair, then the words after it
        _, leads, head = np.unique(keys, return_index=True, return_inverse=True)
        texts = [s.words[a] + b" " + s.words[b] for a, b in zip(s.codes[at[leads]].tolist(), s.codes[at[leads] + 1].tolist())]
        rest, tail = [b""] * len(at), np.zeros(len(at), np.uint64)
        for width in range(3, LONGEST + 1):
            rows = np.flatnonzero(length == width)
            columns = [s.codes[at[rows] + step].tolist() for step in range(2, width)]
            for r, row in zip(rows.tolist(), zip(*columns)):
                rest[r] = b" ".join([s.words[c] for c in row])
            with np.errstate(over="ignore"):
                for step in range(2, width):
                    tail[rows] = V.mixed(tail[rows] * V.A + s.hashed[at[rows] + step])
        salt = np.where(np.isin(keys, heaviest), 1 + (tail % np.uint64(SALTS)).astype(np.int64), 0)
        rows = _batch(s.lang, n, head=[texts[h] for h in head.tolist()], rest=rest)
        yield rows.append_column("salt", pa.array(salt, pa.int32()))

    return per_stretch(docs, run, "lang string, head string, rest string, n bigint, salt int")


def quicksorted(words: np.ndarray, n: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(a pointer, depth, occurrences): the groups of equal leading words of suffixes with at least ``least`` occurrences.

    ``words`` has a row of numbers per suffix, padded by -1, and ``n`` how often each occurs.
    """
    deepest = words.shape[1]
    parts = [(np.arange(len(words)), 0)]
    while parts:
        pointers, depth = parts.pop()
        if depth == deepest or n[pointers].sum() < least:
            continue  # abandoned: nothing in it is frequent
        key = words[pointers, depth]
        pivot = key[len(key) // 2]
        for side in (key < pivot, key > pivot):
            if side.any():
                parts.append((pointers[side], depth))
        same = pointers[key == pivot]
        if pivot >= 0 and (total := int(n[same].sum())) >= least:
            yield int(same[0]), depth + 1, total
            parts.append((same, depth + 1))


def sorted_counts(routed: DataFrame, least: int, most: int) -> DataFrame:
    """(lang, phrase, n): counts of the phrases of two words or more among routed suffixes, to be added up.

    Partitions are sorted by leading pair, so only the first and the last pair of a chunk may go on elsewhere.
    """

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= most:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks(batches):
            split = [r.split(" ") if r else [] for r in chunk["rest"]]
            width = np.array([len(s) for s in split])
            codes, _ = pd.factorize(np.array([w for s in split for w in s], object))
            words = np.full((len(chunk), LONGEST - 2), -1)
            rows = np.repeat(np.arange(len(chunk)), width)
            words[rows, np.arange(len(rows)) - np.repeat(np.cumsum(width) - width, width)] = codes
            n, salted = chunk["n"].to_numpy(), chunk["salt"].to_numpy() > 0
            lang, head = chunk["lang"].to_numpy(), chunk["head"].to_numpy()
            new = np.flatnonzero(np.append(True, (lang[1:] != lang[:-1]) | (head[1:] != head[:-1])))
            out = []
            for k, (a, b) in enumerate(zip(new, np.append(new[1:], len(chunk)))):
                whole = 0 < k < len(new) - 1 and not salted[a]
                total = int(n[a:b].sum())
                if whole and total < least:
                    continue
                out.append((lang[a], head[a], total))
                for at, depth, total in quicksorted(words[a:b], n[a:b], least if whole else 1):
                    out.append((lang[a], f"{head[a]} {' '.join(split[a + at][:depth])}", total))
            yield pd.DataFrame(out, columns=["lang", "phrase", "n"])

    return routed.mapInPandas(run, "lang string, phrase string, n bigint")


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, heaviest: int = HEAVY, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of all phrases of up to five words with ``least`` occurrences, (lang, n) of all words)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    every = materialize(count_words(rows), "words")
    totals = materialize(every.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    words = every.filter(F.col("n") >= least)
    frequent_words = bitmaps.build(words.select(F.xxhash64("lang", "phrase").alias("key")), "key")
    pairs = materialize(count_pairs(rows, frequent_words, least), "pairs")
    heavy = np.array([r.key for r in pairs.orderBy(F.desc("n"), "key").limit(heaviest).collect()], np.int64).view(np.uint64)
    longer = materialize(suffixes(rows, frequent_words, bitmaps.build(pairs, "key"), heavy), "suffixes")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), longer.count() // chunk)
    routed = longer.repartition(parts, "lang", "head", "salt").sortWithinPartitions("lang", "head")
    counted = sorted_counts(routed, least, chunk).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)

    found = words.select("lang", "phrase", "n").unionByName(counted)
    size = (F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1).cast("int")
    out = materialize(found.select("lang", "phrase", size.alias("words"), "n"), "phrases")
    discard(every, pairs, longer)
    return out, totals


def _without_first(phrase: Column) -> Column:
    return F.regexp_extract(phrase, "^[^ ]+ (.*)$", 1)


def _without_last(phrase: Column) -> Column:
    return F.regexp_extract(phrase, "^(.*) [^ ]+$", 1)


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of every phrase of two words or more."""
    phrases = found.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cut = phrases.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    parts = F.split("phrase", " ")
    first, rest = F.slice(parts, F.lit(1), F.col("k")), F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k"))
    cut = cut.withColumns({"first": F.array_join(first, " "), "rest": F.array_join(rest, " ")})
    l, r = (found.select("lang", F.col("phrase").alias(c), F.col("n").alias(x)) for c, x in (("first", "l"), ("rest", "r")))
    both = cut.join(l, ["lang", "first"]).join(r, ["lang", "rest"]).join(totals, "lang")
    exact = "CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)) div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r", "n")).alias("x")
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "x.l", "x.r", "x.n", "x.score")


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one holds as often."""
    longer = phrases.filter("words > 2").select(
        "lang", F.explode(F.array(_without_first(F.col("phrase")), _without_last(F.col("phrase")))).alias("phrase"), "a"
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return phrases.join(most, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language; ``options`` as for ``frequent_phrases``."""
    found, totals = frequent_phrases(docs, text, lang, least, **options)
    kept = maximal(materialize(scored(found, totals), "scored-phrases"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # ranked in parts first, so that no task gets all phrases of a language
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    some = kept.withColumn("_part", part).withColumn("_rank", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order)))
    some = some.filter(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark, sf_dir):
    return collocations(C.documents(spark, sf_dir).select("text", "lang"))


OP11_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
  numbered AS (SELECT lang, row_number() OVER () AS q, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM pieces),
  each AS (SELECT lang, q, generate_subscripts(ws, 1) AS p, unnest(ws) AS w FROM numbered),
  runs AS (SELECT lang, list(w) OVER (PARTITION BY q ORDER BY p ROWS BETWEEN CURRENT ROW AND {LONGEST - 1} FOLLOWING) AS s FROM each),
  f AS (SELECT lang, m, array_to_string(s[1:m], ' ') AS phrase, count(*) AS c FROM runs, range(1, {LONGEST + 1}) t(m) WHERE len(s) >= m GROUP BY ALL HAVING count(*) >= {LEAST}),
  totals AS (SELECT lang, count(*) AS n FROM each GROUP BY lang),
  cuts AS (SELECT f.lang, phrase, f.m, c AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
    FROM f, range(1, {LONGEST}) t(k) WHERE k < f.m),
  scored AS (SELECT x.lang, x.phrase, x.m, a, y.c AS l, z.c AS r, n, k, (1000::HUGEINT * a * n) // (y.c::HUGEINT * z.c) AS score
    FROM cuts x JOIN f y ON y.lang = x.lang AND y.phrase = x.first JOIN f z ON z.lang = x.lang AND z.phrase = x.rest JOIN totals t ON t.lang = x.lang),
  best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  inner_ AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + len_ - 1], ' ') AS phrase, max(c) AS longer
    FROM f, range(2, {LONGEST}) t(len_), range(1, {LONGEST + 1}) u(i) WHERE len_ < m AND i + len_ - 1 <= m GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR longer < a QUALIFY rank <= {TOP}
"""
