"""TF-IDF weights of word and character n-grams, as sparse vectors, as packed blocks or as one long table.

Fitting is one aggregate by term.  Weighing is narrow: each row's n-grams are counted against the
fitted list where the row is, so texts and n-grams never cross the network.  N-grams are counted and found in Arrow batches
(``grams``): a stretch of texts sends a row for each of its different ones, not one for every use, and what is found goes on
stretch by stretch, so that a task holds the arrays of one stretch at a time, however long the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions.text import find_all, replace_all
from ..session import materialize
from . import grams as G
from . import packed

FOUND = 500_000  # bytes of text whose terms are found at a time
PER_TOKEN = 4  # bytes that a token counts as


@dataclass(frozen=True)
class Block:
    name: str
    sizes: tuple[int, int]
    max_terms: int
    min_df: int


WORDS = Block("word", (1, 2), 50_000, 2)
CHARS = Block("char", (2, 5), 100_000, 3)


def _word_grams(tokens: Column, sizes: tuple[int, int]) -> Column:
    grams = []
    for n in range(sizes[0], sizes[1] + 1):
        room = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        shifted = [F.slice(tokens, F.lit(1 + i), room).alias(f"t{i}") for i in range(n)]
        grams.append(tokens if n == 1 else F.transform(F.arrays_zip(*shifted), _joined(n)))
    return F.concat(*grams)


def _joined(n: int):
    return lambda z: F.concat_ws(" ", *[z[f"t{i}"] for i in range(n)])


def _longest_at(text: Column, sizes: tuple[int, int]) -> Column:
    """The longest n-gram at every position, captured by a look-ahead in one linear scan; cutting substrings by
    position would walk the text from its start each time.  The second half of a surrogate pair is
    not a position.
    """
    pattern = rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{sizes[0]},{sizes[1]}}}))"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _char_grams(longest: Column, sizes: tuple[int, int]) -> Column:
    """All n-grams are beginnings of the longest ones.  Only the last few of those are shorter than the largest size, one
    for each smaller size, so the first of the array are long enough.
    """
    least, most = sizes
    grams = []
    for n in range(least, most + 1):
        some = F.slice(longest, F.lit(1), F.greatest(F.size(longest) - (n - least), F.lit(0)))
        grams.append(some if n == most else F.transform(some, _beginning(n)))
    return F.concat(*grams)


def _beginning(n: int):
    return lambda gram: F.substring(gram, 1, n)


def _spaced(text: Column) -> Column:
    return replace_all(text, r"\s\s+", " ")


def _base(text: Column, block: Block) -> Column:
    """What the n-grams of a block are made of: a row's tokens, or its text with single blanks."""
    if block.name == "word":
        return find_all(F.lower(text), P.TERM_TOKEN)
    if block.name == "char":
        return _spaced(text)
    raise ValueError(f"unknown block {block.name!r}")


def with_terms(df: DataFrame, text: str, block: Block, name: str) -> DataFrame:
    """Adds the array of a row's n-grams, repeats and all.

    Words: lower-cased words and single marks, joined by a blank.  Characters: case kept, over text
    whose runs of blanks are one space.
    """
    # a column of its own, as the n-grams read it many times over
    base = _base(F.col(text), block)
    staged = df.withColumn("_base", base if block.name == "word" else _longest_at(base, block.sizes))
    grams = _word_grams if block.name == "word" else _char_grams
    return staged.withColumn(name, grams(F.col("_base"), block.sizes)).drop("_base")


def _counts(df: DataFrame, text: str, block: Block) -> DataFrame:
    """(term, df, total): rows that hold a term, and its uses."""
    sizes, words = block.sizes, block.name == "word"

    def stretches(base: pa.Array) -> Iterator:
        if not words:
            return (G.count(texts, sizes) for texts in G.stretches(base))
        lengths = pc.list_value_length(base)
        return (G.count_words(base.slice(start, stop - start), sizes) for start, stop in G.ranges(lengths, G.TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counted in stretches(batch.column("_base")):
                for terms, held, uses in counted:
                    terms = terms if words else pa.array(terms, pa.string())
                    yield pa.RecordBatch.from_arrays([terms, pa.array(held), pa.array(uses)], names=["term", "df", "total"])

    each = df.select(_base(F.col(text), block).alias("_base")).mapInArrow(run, "term string, df long, total long")
    return each.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def fit_terms(df: DataFrame, text: str, block: Block) -> DataFrame:
    """(term, df, total, idf): terms in at least ``min_df`` rows, the ``max_terms`` most frequent of them.

    Presence and uses are counted by term before the shuffle, so frequent n-grams are no burden.  Ties go by term order.
    """
    stats = _counts(df, text, block)
    top = (
        stats.filter(F.col("df") >= block.min_df)
        .orderBy(F.desc("total"), "term")
        .limit(block.max_terms)
    )
    n_rows = df.agg(F.count("*").alias("n"))
    idf = F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1.0
    return top.crossJoin(F.broadcast(n_rows)).select("term", "df", "total", idf.alias("idf"))


@dataclass
class FittedBlock:
    """A block's terms and idf weights, numbered in term order from ``offset`` on."""

    block: Block
    terms: list[str]
    idf: list[float]
    offset: int = 0

    @property
    def size(self) -> int:
        return len(self.terms)

    def table(self, spark) -> DataFrame:
        """(block, term, index) of all terms."""
        rows = [(self.block.name, t, self.offset + i) for i, t in enumerate(self.terms)]
        return spark.createDataFrame(rows, "block string, term string, index int")


def fit_blocks(df: DataFrame, text: str, blocks: tuple[Block, ...] = (WORDS, CHARS)) -> list[FittedBlock]:
    """Fit every block on all rows of ``df``.

    The fitted lists, at most ``max_terms`` entries each whatever the data, come to the driver as a
    model's parameters do.
    """
    out, offset = [], 0
    for b in blocks:
        fitted = sorted((r.term, r.idf) for r in fit_terms(df, text, b).select("term", "idf").collect())
        if not fitted:
            raise ValueError(f"no {b.name} term occurs in {b.min_df} rows")
        out.append(FittedBlock(b, [t for t, _ in fitted], [w for _, w in fitted], offset))
        offset += len(fitted)
    return out


def _finder(f: FittedBlock) -> G.Finder:
    return G.WordFinder(f.terms) if f.block.name == "word" else G.Finder(f.terms)


def _bases(df: DataFrame, text: str, fitted: list[FittedBlock], carry: list[str | Column]) -> DataFrame:
    return df.select(*carry, *[_base(F.col(text), f.block).alias(f"_base_{f.block.name}") for f in fitted])


def _in_stretches(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """(rows, their bases): as many rows at a time as hold ``FOUND`` bytes; a null base is empty."""
    total = np.zeros(batch.num_rows, np.int64)
    for name in names:
        base = batch.column(f"_base_{name}")
        sizes = pc.multiply(pc.list_value_length(base), PER_TOKEN) if name == "word" else pc.binary_length(base)
        total += pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
    for start, stop in G.ranges(pa.array(total), FOUND):
        part = batch.slice(start, stop - start)
        bases = [part.column(f"_base_{name}") for name in names]
        yield part, [b if n == "word" else [t or "" for t in b.to_pylist()] for n, b in zip(names, bases)]


def _weighed(df: DataFrame, text: str, fitted: list[FittedBlock], carry: list[str]) -> DataFrame:
    """``carry`` and of each block ``_at`` and ``_w``: places and weights (1 + ln tf) * idf of a row's fitted terms, scaled to length 1."""
    names = [f.block.name for f in fitted]
    kept = df.sparkSession.sparkContext.broadcast([(_finder(f), np.asarray(f.idf, np.float64)) for f in fitted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, bases in _in_stretches(batch, names):
                columns = [part.column(c) for c in carry]
                for (finder, idf), base in zip(kept.value, bases):
                    of, term, uses = finder.counts(base)
                    cuts = pa.array(packed.cuts_of(of, part.num_rows), pa.int32())
                    tf = uses.astype(np.float64)
                    lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (term.astype(np.int32), tf, tf * idf[term])]
                    columns.append(pa.StructArray.from_arrays(lists, ["indices", "counts", "scaled"]))
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, *[f"_found_{n}" for n in names]])

    bases = _bases(df, text, fitted, carry)
    found = T.StructType.fromDDL("indices array<int>, counts array<double>, scaled array<double>")
    schema = T.StructType([*[bases.schema[c] for c in carry], *[T.StructField(f"_found_{n}", found) for n in names]])
    out = bases.mapInArrow(run, schema)
    for f in fitted:
        n, c = f.block.name, F.col(f"_found_{f.block.name}")
        weights = F.zip_with(c["counts"], c["scaled"], lambda tf, x: (F.lit(1.0) + F.log(tf)) * x / tf)
        out = out.withColumns({f"_at_{n}": F.transform(c["indices"], lambda i: i + f.offset), f"_w_{n}": weights})
        out = out.withColumn("_norm", F.sqrt(F.aggregate(f"_w_{n}", F.lit(0.0), lambda a, w: a + w * w)))
        scaled = F.transform(f"_w_{n}", lambda w: F.when(F.col("_norm") > 0, w / F.col("_norm")).otherwise(w))
        out = out.withColumn(f"_w_{n}", scaled).drop(f"_found_{n}", "_norm")
    return out


def as_vectors(df: DataFrame, text: str, fitted: list[FittedBlock], carry: list[str]) -> DataFrame:
    """``carry`` columns plus a sparse ``features`` vector per row, blocks side by side; no shuffle.

    A vector is stored as a struct, so structs of SQL expressions are written and read back as
    vectors.  That also is the one place where the text work happens, however often the vectors are read.
    """
    out = _weighed(df, text, fitted, carry)
    places = F.concat(*[F.col(f"_at_{f.block.name}") for f in fitted])
    weights = F.concat(*[F.col(f"_w_{f.block.name}") for f in fitted])
    size = sum(f.size for f in fitted)
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), places.alias("indices"), weights.alias("values")
    )
    rows = out.select(*carry, vector.alias("features"))
    kept = [rows.schema[c] for c in carry]
    return materialize(rows, "vectors", T.StructType([*kept, T.StructField("features", VectorUDT())]))


Rows = tuple[np.ndarray, np.ndarray, np.ndarray]  # cuts, index, uses


def _rows_of(finders: list, bases: list, n: int) -> list[Rows]:
    """Of each block, where the terms of n rows are cut, their numbers and uses."""
    found = [(offset, finder.counts(base)) for (finder, offset), base in zip(finders, bases)]
    return [(packed.cuts_of(of, n), term + offset, uses) for offset, (of, term, uses) in found]


def _together(rows: list[Rows]) -> Rows:
    """One after another."""
    cuts, index, uses = zip(*rows)
    starts = np.cumsum([0, *[c[-1] for c in cuts]])
    return np.concatenate([[0], *[c[1:] + start for c, start in zip(cuts, starts)]]), np.concatenate(index), np.concatenate(uses)


def as_packed(df: DataFrame, text: str, fitted: list[FittedBlock], label: Column) -> packed.Packed:
    """Labelled rows as packed blocks of what the weights are made of, written once: every pass of a fit reads them."""
    names = [f.block.name for f in fitted]
    kept = df.sparkSession.sparkContext.broadcast([(_finder(f), f.offset) for f in fitted])
    idf = np.concatenate([np.asarray(f.idf, np.float64) for f in fitted])
    weights = df.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, rows, held = [], [], 0

        def block() -> pa.RecordBatch:
            # all rows of the first block of terms, then all of the next
            return packed.encoded(np.concatenate(labels), *_together([r for each in zip(*rows) for r in each]), weights.value)

        for batch in batches:
            for part, bases in _in_stretches(batch, names):
                labels.append(part.column("_label").to_numpy(zero_copy_only=False))
                rows.append(_rows_of(kept.value, bases, part.num_rows))
                held += sum(len(index) for _, index, _ in rows[-1])
                if held >= packed.FULL:
                    yield block()
                    labels, rows, held = [], [], 0
        if rows:
            yield block()

    bases = _bases(df, text, fitted, [label.cast("double").alias("_label")])
    return packed.Packed(materialize(bases.mapInArrow(run, packed.SCHEMA), "packed", options=packed.STORED), idf)


def margins(
    df: DataFrame, text: str, fitted: list[FittedBlock], coefficients: np.ndarray, intercepts: np.ndarray, keep: list[str]
) -> DataFrame:
    """(keep, _margins): the margins of a linear model for every row, without vectors in between."""
    names = [f.block.name for f in fitted]
    context = df.sparkSession.sparkContext
    kept = context.broadcast([(_finder(f), f.offset) for f in fitted])
    idf = np.concatenate([np.asarray(f.idf, np.float64) for f in fitted])
    model = context.broadcast((idf, np.ascontiguousarray(coefficients.T), intercepts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, weights, intercepts = model.value
        for batch in batches:
            for part, bases in _in_stretches(batch, names):
                found = packed.margins(*_together(_rows_of(kept.value, bases, part.num_rows)), idf, weights, intercepts, part.num_rows)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], lists], names=[*keep, "_margins"])

    bases = _bases(df, text, fitted, keep)
    schema = T.StructType([*[bases.schema[c] for c in keep], T.StructField("_margins", T.ArrayType(T.DoubleType()))])
    return bases.mapInArrow(run, schema)


def term_weights(
    df: DataFrame, row_id: str, text: str, fitted: list[FittedBlock], keep: list[str] = ()
) -> DataFrame:
    """(row_id, *keep, block, term, weight): the non-zero weights of every row, as a long table."""
    long = None
    for f in fitted:
        rows = _weighed(df, text, [f], [row_id, *keep])
        pairs = F.arrays_zip(F.col(f"_at_{f.block.name}").alias("index"), F.col(f"_w_{f.block.name}").alias("weight"))
        one = rows.select(row_id, *keep, F.explode(pairs).alias("e")).select(row_id, *keep, "e.*").filter("weight != 0")
        # at most max_terms entries
        one = one.join(F.broadcast(f.table(df.sparkSession)), "index").select(row_id, *keep, "block", "term", "weight")
        long = one if long is None else long.unionByName(one)
    return long


def tfidf(
    df: DataFrame, row_id: str, text: str, blocks: tuple[Block, ...], fit_on: Column | None = None
) -> DataFrame:
    """Weights of all rows; terms, frequencies and n come from the ``fit_on`` rows alone."""
    train = df if fit_on is None else df.filter(fit_on)
    return term_weights(df, row_id, text, fit_blocks(train, text, blocks))


def stack_blocks(df: DataFrame, row_id: str, text: str, fit_on: Column | None = None) -> DataFrame:
    """Word and character weights side by side, as one long table with a block column."""
    return tfidf(df, row_id, text, (WORDS, CHARS), fit_on)
