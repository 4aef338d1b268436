"""Spans of patterns in whole texts, found with column expressions only.

A text is cut by ``.*?(pattern)`` into pieces that each end in a match; the lengths of the pieces, added up
along the text, give the places of the matches in code points.  Adding up happens in a window over the rows of
one text's matches, so a text with very many matches costs no more than its matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, a cheap test that a text may hold it, and what a match must fulfil."""

    name: str
    pattern: str  # without capturing groups
    hint: Callable[[Column], Column]
    holds: Callable[[Column], Column] = lambda match: F.lit(True)


PIECES = "array<struct<kind:int,no:int,piece:bigint,match:string>>"


def pieces(text: Column, kind: Kind, number: int) -> Column:
    """All pieces of a text that end in a match of the kind."""
    pattern = F.lit(rf"(?s).*?(?:({kind.pattern})|\z)")
    cut = F.regexp_extract_all(text, pattern, F.lit(0))
    match = F.regexp_extract_all(text, pattern, F.lit(1))
    both = F.zip_with(cut, match, lambda c, m: F.struct(F.length(c).cast("long").alias("piece"), m.alias("match")))
    told = F.transform(
        both,
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.cast("int").alias("no"), x["piece"].alias("piece"), x["match"].alias("match")
        ),
    )
    found = F.filter(told, lambda x: x["match"] != "")
    return F.when(kind.hint(text), found).otherwise(F.lit(None)).cast(PIECES)


def find(docs: DataFrame, text: str, keep: list[str], kinds: list[Kind], name: str, with_text: bool = False) -> DataFrame:
    """(_row, *keep, kind, start, end, match[, text]): a row per match that holds, and for a text without
    any a row of nulls; written once, as the rest of an operator reads it several times.

    ``_row`` numbers the rows of ``docs`` and is stored, so that it means the same ever after.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lists = [F.coalesce(pieces(whole, k, i), F.array().cast(PIECES)) for i, k in enumerate(kinds)]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keep, F.concat(*lists).alias("_found"), whole.alias("_text"))
    # texts without a match need not be kept
    text_kept = F.when(F.size("_found") > 0, F.col("_text")) if with_text else F.lit(None).cast("string")
    return materialize(rows.withColumn("_text", text_kept), name)


def placed(found: DataFrame, keep: list[str], kinds: list[Kind]) -> DataFrame:
    """(_row, *keep, kind, start, end, match) of the matches that hold; texts without any have none."""
    each = found.filter(F.size("_found") > 0).select("_row", *keep, F.explode("_found").alias("x")).select("_row", *keep, "x.*")
    along = W.partitionBy("_row", "kind").orderBy("no").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = each.withColumn("end", F.sum("piece").over(along)).withColumn("start", F.col("end") - F.length("match"))
    holds = F.lit(False)
    for i, k in enumerate(kinds):
        holds = F.when(F.col("kind") == i, k.holds(F.col("match"))).otherwise(holds)
    return ends.filter(holds).select("_row", *keep, "kind", "start", "end", "match")


def joined(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    kind_names = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kind_names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest(found: DataFrame, spans: DataFrame, keep: list[str], names: list[str], base: int, order: list[str]) -> DataFrame:
    """A row per text: counts of the base kinds, digest of the base spans, and all spans.

    ``order`` names the fields (kind, start) by which spans are sorted.
    """
    fields = [*order, "end"]
    lists = spans.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct(*fields))).alias("_spans"))
    empty = F.array().cast(lists.schema["_spans"].dataType)
    rows = found.select("_row", *keep).join(lists, "_row", "left").withColumn("_spans", F.coalesce("_spans", empty))
    of_base = F.filter("_spans", lambda s: s["kind"] < base)

    def count(kind: int) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{names[kind]}")

    counts = [count(i) for i in range(base)]
    return rows.select(
        *keep, *counts, F.sha2(joined(of_base, names).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("_spans"), names).alias("spans"),
    )
