"""Raw battles to curated rows, and curated rows to processed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean, curate
from ..session import materialize


def eligible_rows(battles: DataFrame) -> DataFrame:
    """All usable sides of all battles, once each.  Cheap filters come before any text work."""
    sides = curate.label_families(curate.unpivot_sides(curate.filter_language(battles)))
    rows = curate.describe_rows(curate.filter_lengths(curate.single_turn_pair(sides)))
    return curate.dedup_exact(rows, ["model", "input", "output"], curate.ROW_KEY)


def curated_rows(
    battles: DataFrame, cap: int = 2000, minimum: int = 800, seed: int = curate.SEED, cut: bool = True
) -> DataFrame:
    """The balanced, labelled dataset.

    Class counts, the sampling histogram and the sample itself each read the eligible rows, so
    these are written once (``cut``) rather than derived three times.
    """
    rows = eligible_rows(battles)
    if cut:
        rows = materialize(rows, "eligible")
    return curate.balanced_sample(rows, cap, seed, minimum=minimum).drop("side")


def processed_rows(
    curated: DataFrame, seed: int = curate.SEED, row_id=("model", "input", "output")
) -> DataFrame:
    """Cleaned, masked, split and marked rows.  Only the matched-pair lookup shuffles."""
    rows = clean.assign_split(clean.clean_texts(curated), seed=seed)
    return clean.matched_pair(rows, F.xxhash64(*row_id))


def curation_audit(curated: DataFrame, domains: list[str]) -> dict[str, DataFrame]:
    """The tables printed after curation."""
    return {
        "classes": curate.class_counts(curated),
        "domains": curate.crosstab(curated, "family", "domain", domains),
        "models": curate.distinct_per_group(curated, "family", "model"),
        "reasoning": curate.flag_share(curated, ["is_reasoning"], 2),
        "traces": curate.leak_audit(curated),
        "pairs": curate.pair_count(curated),
    }


def processing_audit(curated: DataFrame, processed: DataFrame) -> dict[str, DataFrame]:
    """The tables printed after preprocessing; fails if a prompt leaked across splits."""
    clean.assert_no_group_leak(processed)
    flags = ["is_reasoning", "refusal", "self_id", "prompt_names_model"]
    return {
        "rows": clean.cleaning_report(curated),
        "splits": clean.split_sizes(processed),
        "flags": curate.flag_share(processed, flags, 3),
        "pairs": processed.agg(F.count_if("matched_pair").alias("matched_rows")),
    }
