"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times in the mix.  Documents stand in
a line, large ones first; their expected copies are summed up along the line, an offset is
added, and a document is taken once per integer that its stretch of the sum crosses.  The line
of one source is never sorted in one task: size classes and hash digits cut it into short windows, whose
offsets come from their row counts.

Nulls: a null source is a source of its own, the last one; a null text has size 0.  Empty texts are
taken like others but add no words.  Equal rows are told apart by their place in the line only.
An empty table gives an empty mix.  Input columns keep their names, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from . import common as C

SEED = 448
REPEATS = 3  # no document is taken more often
WEIGHTS = (1, 2, 3)  # repeated along the sources in code point order
OFFSETS = 16  # offsets looked at per source; the one whose mix comes closest to the target is used


def size_class(size: Column) -> Column:
    """Sixteen classes for each doubling of the size, from integer steps only."""
    bits = F.length(F.bin(size))
    return (bits * 32 + F.call_function("shiftright", size, F.greatest(bits - 5, F.lit(0)).cast("int"))).cast("int")


def targets(sources: DataFrame, weight: str, repeats: int = REPEATS) -> DataFrame:
    """Words to take per source: shares by weight of all words, none above ``repeats`` times its size.

    Sources sorted by size over weight fill up in that order, so one pass finds where sharing
    the excess again ends.  ``sources`` has a row per source; it is ordered in one task.
    """
    line = W.orderBy(F.col("source_size") / F.col(weight), "place")
    before = line.rowsBetween(W.unboundedPreceding, -1)
    onward = line.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    total = F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum(F.col("source_size") * repeats).over(before), F.lit(0))
    level = (total - capped) / F.sum(weight).over(onward)
    full = F.col("source_size") * repeats <= level * F.col(weight)
    staged = sources.withColumn("_level", level).withColumn("_full", full)
    # the first source that does not fill up sets the level of all after it
    common = F.min(F.when(~F.col("_full"), F.struct(F.col("source_size") / F.col(weight), "place", "_level"))).over(everything)
    return staged.withColumn("_common", common["_level"]).withColumn(
        "target",
        F.when(F.col("_full"), F.col("source_size").cast("double") * repeats).otherwise(
            F.col("_common") * F.col(weight)
        ),
    ).drop("_level", "_full", "_common")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = SEED,
    offsets: int = OFFSETS,
) -> DataFrame:
    """Rows as ``_row`` (all input columns) with size, source_size, target and copies."""
    rows = docs.select(
        C.packed(docs),
        F.col(source).alias("source"),
        C.n_words(text).alias("size"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(doc_id).cast("string"), F.col(text)).cast("binary")).alias("_h"),
        F.col(doc_id).alias("_id"),
    )
    rows = rows.withColumn("_class", size_class(F.col("size"))).withColumn("_digits", F.substring("_h", 1, 2))
    # what the line needs, without texts, so that they are read once for it and once for the result
    line = materialize(rows.drop("_row"), "mix-line")

    # a few hundred classes of 256 cells per source, however many rows
    cells = materialize(
        line.groupBy("source", "_class", "_digits").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-cells"
    )
    within = W.partitionBy("source", "_class").orderBy("_digits").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_in_class", F.coalesce(F.sum("n").over(within), F.lit(0)))
    classes = cells.groupBy("source", "_class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    larger = W.partitionBy("source").orderBy(F.desc("_class")).rowsBetween(W.unboundedPreceding, -1)
    classes = classes.withColumn("_larger", F.coalesce(F.sum("n").over(larger), F.lit(0)))

    sources = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = sources.withColumn("place", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))))
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = sources.withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    shares = targets(sources, "weight", repeats).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    start = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "source").cast("binary")), 1, 8), 16, 10)
    shares = shares.withColumn("start", start.cast("double") / 4294967296.0)

    c, k, s = cells.alias("c"), classes.alias("k"), shares.alias("s")
    places = (
        c.join(k, F.col("c.source").eqNullSafe(F.col("k.source")) & (F.col("c._class") == F.col("k._class")))
        .join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
        .select("c.source", "c._class", "c._digits", (F.col("_larger") + F.col("_in_class")).alias("_before"),
                "source_size", "target", "rate", "start")
    )
    places = materialize(places, "mix-places")

    def place_in_line(some: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("source", "_class", "_digits").orderBy("_h", "_id"))
        r, p = some.withColumn("_rank", rank).alias("r"), places.alias("p")
        same = F.col("r.source").eqNullSafe(F.col("p.source"))
        same = same & (F.col("r._class") == F.col("p._class")) & (F.col("r._digits") == F.col("p._digits"))
        kept = [F.col(f"r.{c}") for c in some.columns if c in ("_row", "source", "size")]
        return r.join(p, same).select(
            *kept, (F.col("_before") + F.col("_rank")).alias("_at"), "source_size", "target", "rate", "start"
        )

    def copies(offset: Column) -> Column:
        crossed = F.floor(F.col("rate") * F.col("_at") + offset)
        return (crossed - F.floor(F.col("rate") * (F.col("_at") - 1) + offset)).cast("long")

    def offset(i: int) -> Column:
        u = F.col("start") + i / offsets
        return u - F.floor(u)

    taken = place_in_line(line).groupBy("source", "target").agg(
        *[F.sum(F.col("size") * copies(offset(i))).alias(f"_t{i}") for i in range(offsets)]
    )
    misses = F.array(*[F.struct(F.abs(F.col(f"_t{i}") - F.col("target")), F.lit(i).alias("i")) for i in range(offsets)])
    best = materialize(taken.select("source", F.array_min(misses)["i"].alias("best")), "mix-best").alias("b")
    chosen = F.element_at(F.array(*[offset(i) for i in range(offsets)]), F.col("best") + 1)
    return (
        place_in_line(rows).alias("m")
        .join(best, F.col("m.source").eqNullSafe(F.col("b.source")))
        .select("_row", "size", "source_size", "target", copies(chosen).alias("copies"))
    )


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with."""
    rows = mix(docs, **options).filter("copies > 0")
    return rows.select(F.explode(F.array_repeat("_row", F.col("copies").cast("int"))).alias("_row")).select("_row.*")


def op3_mix(spark, sf_dir):
    rows = mix(C.documents(spark, sf_dir).select("doc_id", "text", "source"))
    return rows.select(
        "_row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixing_sql(docs: str = "documents") -> str:
    """Common table expressions for DuckDB that end in ``mixed``: the columns of ``docs``, size, source_size, target, copies."""
    return f"""sized AS (
      SELECT *, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
        md5(concat_ws('|', '{SEED}', doc_id, text)) AS h FROM {docs}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY
        length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0)) DESC, h, doc_id) AS at_ FROM sized),
    sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
      FROM sized GROUP BY source),
    weighed AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][(place - 1) % {len(WEIGHTS)} + 1] AS weight FROM sources),
    levels AS (
      SELECT *, CAST(CAST(sum(source_size) OVER () - coalesce(sum(source_size * {REPEATS}) OVER before, 0) AS BIGINT) AS DOUBLE)
        / CAST(CAST(sum(weight) OVER onward AS BIGINT) AS DOUBLE) AS level_
      FROM weighed WINDOW
        before AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        onward AS (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    shared AS (
      SELECT *, CASE WHEN source_size * {REPEATS} <= level_ * weight THEN CAST(source_size AS DOUBLE) * {REPEATS}
        ELSE (SELECT level_ FROM levels WHERE NOT (source_size * {REPEATS} <= level_ * weight) ORDER BY source_size / weight, place LIMIT 1)
          * weight END AS target FROM levels),
    rates AS (
      SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
        CAST(('0x' || substr(md5(concat_ws('|', '{SEED}', source)), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE AS start_
      FROM shared),
    offsets AS (
      SELECT source, source_size, target, rate, i, (start_ + i / {OFFSETS}.0::DOUBLE) - floor(start_ + i / {OFFSETS}.0::DOUBLE) AS u
      FROM rates, (SELECT unnest(range({OFFSETS})) AS i)),
    tried AS (
      SELECT o.source, o.i, o.u, o.target, o.source_size, o.rate,
        sum(size * CAST(floor(rate * at_ + u) - floor(rate * (at_ - 1) + u) AS BIGINT)) AS words
      FROM ranked r JOIN offsets o ON r.source IS NOT DISTINCT FROM o.source GROUP BY ALL),
    best AS (SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(words - target), i) = 1),
    mixed AS (
      SELECT r.*, b.source_size, b.target, CAST(floor(rate * at_ + u) - floor(rate * (at_ - 1) + u) AS BIGINT) AS copies
      FROM ranked r JOIN best b ON r.source IS NOT DISTINCT FROM b.source)"""


OP3_SQL = f"""WITH {mixing_sql()}
SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"""
