"""Cleaning, masking and leak-free splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.hashing import BUCKETS, bucket
from .curate import SEED
from .skew import lookup_by_key

SPLITS = {"train": 7000, "val": 8500, "test": 10_000}  # upper bucket bounds out of 10,000


def drop_near_empty(rows: DataFrame, text: str = "output_raw", minimum: int = 20) -> DataFrame:
    return rows.filter(F.length(text) >= minimum)


def cleaning_report(rows: DataFrame, minimum: int = 20) -> DataFrame:
    """Rows before, rows with a trace, rows after: one pass."""
    cleaned = F.length(X.strip_traces("output"))
    return rows.agg(
        F.count("*").alias("rows_before"),
        F.count_if(X.has_trace("output")).alias("rows_with_trace"),
        F.count_if(cleaned >= minimum).alias("rows_after"),
    )


def clean_texts(rows: DataFrame) -> DataFrame:
    """Raw copies without reasoning traces, flags, and masked input and output.  Narrow: no shuffle."""
    rows = rows.withColumns({"output_raw": X.strip_traces("output"), "input_raw": X.strip("input")})
    rows = drop_near_empty(rows).withColumns(
        {"_out": X.may_hold_name("output_raw"), "_in": X.may_hold_name("input_raw")}
    )
    out, inp = F.col("_out"), F.col("_in")
    return rows.withColumns(
        {
            "is_reasoning": X.is_reasoning("model"),
            "refusal": X.is_refusal("output_raw"),
            "self_id": X.names_own_label("output_raw", "family", out),
            "prompt_names_model": X.names_any("input_raw", inp),
            "input": X.mask_terms("input_raw", maybe=inp),
            "output": X.mask_terms("output_raw", maybe=out),
        }
    ).drop("_out", "_in")


def assign_split(rows: DataFrame, key: str = "prompt_id", seed: int = SEED) -> DataFrame:
    """train / val / test by a bucket of the key: all rows of a key share a split, without a shuffle.

    70/15/15 of the keys in expectation; a key keeps its split when data is added.
    """
    b = bucket(seed, key)
    split = F.lit("test")
    split = F.when(b < SPLITS["train"], "train").when(b < SPLITS["val"], "val").otherwise(split)
    return rows.withColumn("split", split)


def group_split(rows: DataFrame, share: float, seed: int, key: str = "prompt_id") -> tuple[DataFrame, DataFrame]:
    """(rest, held out): about ``share`` of the keys are held out, whole keys at a time."""
    held = bucket(seed, key) >= int(round((1 - share) * BUCKETS))
    return rows.filter(~held), rows.filter(held)


def leaked_groups(rows: DataFrame, key: str = "prompt_id", split: str = "split") -> DataFrame:
    """Keys found in more than one split; min and max pre-aggregate before the shuffle."""
    seen = rows.groupBy(key).agg(F.min(split).alias("first"), F.max(split).alias("last"))
    return seen.filter(F.col("first") != F.col("last"))


def assert_no_group_leak(rows: DataFrame, key: str = "prompt_id", split: str = "split") -> None:
    leaked = leaked_groups(rows, key, split).limit(1).count()
    if leaked:
        raise ValueError(f"{key} found in more than one {split}")


def split_sizes(rows: DataFrame, split: str = "split") -> DataFrame:
    return rows.groupBy(split).agg(F.count("*").alias("n"))


def matched_pair(
    rows: DataFrame, row_id, key: str = "prompt_id", label: str = "family"
) -> DataFrame:
    """Adds ``matched_pair``: the key was answered by exactly two labels.  Null labels do not count, null keys have no pair."""
    # (key, label) first: copies and hot keys collapse on the map side
    per_label = rows.groupBy(key, label).agg(F.count("*").alias("_rows"))
    totals = per_label.groupBy(key).agg(
        F.count(label).alias("_labels"), F.sum("_rows").alias("_rows")
    )
    found = lookup_by_key(rows, totals, key, "_rows", row_id)
    return found.withColumn("matched_pair", F.coalesce(F.col("_labels") == 2, F.lit(False))).drop("_labels", "_rows")
