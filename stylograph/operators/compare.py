"""Comparisons between classes, domains and conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_digest
from ..functions.stats import proportion_p_value, round_even
from ..functions.style import FEATURES
from ..functions.text import count_matches, from_wall_micros, wall_micros
from .clean import group_split
from .quantiles import quantiles_of_counts, quantiles_of_wide
from .skew import lowest_per_group

HOUR_US = 3_600_000_000


# ---- time -------------------------------------------------------------------------------------


def time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds whole days since 2025-01-01 (rounded down) and the hour of the day."""
    start = F.lit("2025-01-01").cast("date")
    # a date drops the time of day, which rounds whole days down
    days = F.datediff(F.to_date(F.col(ts)), start).cast("bigint")
    return df.withColumns({"day": days, "hour": F.hour(ts)})


def time_range_by_class(df: DataFrame, label: str = "family", ts: str = "timestamp") -> DataFrame:
    """First, median and last timestamp of each class, in microseconds resolution."""
    micros = df.select(label, wall_micros(ts).alias("_us"))
    q = quantiles_of_wide(micros, "_us", [0.0, 0.5, 1.0], label, HOUR_US)
    wide = q.groupBy(label).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
            for name, p in (("first", 0.0), ("median", 0.5), ("last", 1.0))
        ]
    )
    as_time = {c: from_wall_micros(F.floor(c).cast("bigint")) for c in ("first", "median", "last")}
    return wide.withColumns(as_time)


def timeline_density(df: DataFrame, label: str = "family", ts: str = "timestamp") -> DataFrame:
    return df.groupBy(label, F.to_date(ts).alias("date")).agg(F.count("*").alias("n"))


# ---- length -----------------------------------------------------------------------------------


def word_count(text: str = "output") -> Column:
    """Blank-separated words."""
    return count_matches(text, r"[^\s]+")


def length_median(df: DataFrame, label: str = "family", text: str = "output") -> DataFrame:
    words = df.select(label, word_count(text).alias("_words"))
    q = quantiles_of_counts(words, "_words", [0.5], [label])
    return q.select(label, F.col("q")[0].alias("median_words"))


def length_box(df: DataFrame, label: str = "family", text: str = "output") -> DataFrame:
    """Box plot numbers of log10(max(words, 1)): quartiles, and the furthest values within 1.5 ranges.

    Works on the counts of distinct word numbers, as the boxes and whiskers of all classes need no more.
    """
    words = df.select(label, F.greatest(word_count(text), F.lit(1)).alias("_words"))
    counts = words.groupBy(label, "_words").agg(F.count("*").alias("_n"))
    x = counts.withColumn("_x", F.log10(F.col("_words").cast("double")))
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    q = x.groupBy(label).agg(F.percentile("_x", probs, F.col("_n")).alias("_q"))
    # one row per class
    with_q = x.join(F.broadcast(q), label)
    q1, med, q3 = (F.col("_q")[i] for i in range(3))
    reach = (q3 - q1) * 1.5
    low = F.min(F.when(F.col("_x") >= q1 - reach, F.col("_x")))
    high = F.max(F.when(F.col("_x") <= q3 + reach, F.col("_x")))
    return with_q.groupBy(label).agg(
        F.max(q1).alias("q1"), F.max(med).alias("median"), F.max(q3).alias("q3"),
        F.least(low, F.max(q1)).alias("whisker_low"), F.greatest(high, F.max(q3)).alias("whisker_high"),
    )


# ---- style ------------------------------------------------------------------------------------


def style_profile(features: DataFrame, label: str = "family", names: list[str] = FEATURES) -> DataFrame:
    """(label, feature, mean, z): class mean, and its distance from the overall mean in sample deviations.

    One roll-up yields the class rows and the overall row, so the features are computed once.
    """
    aggs = [F.avg(c).alias(f"m_{c}") for c in names] + [F.stddev_samp(c).alias(f"s_{c}") for c in names]
    rolled = features.rollup(label).agg(F.grouping(label).alias("_all"), *aggs)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("m"), F.col(f"s_{c}").alias("s"))
            for c in names
        ]
    )
    # classes + 1 rows from here on
    long = rolled.select(label, "_all", F.explode(entries).alias("e")).select(label, "_all", "e.*")
    whole = long.filter("_all = 1").select("feature", F.col("m").alias("all_m"), F.col("s").alias("all_s"))
    classes = long.filter("_all = 0").select(label, "feature", "m")
    z = F.coalesce(F.try_divide(F.col("m") - F.col("all_m"), F.nullif("all_s", F.lit(0.0))), F.lit(0.0))
    return classes.join(F.broadcast(whole), "feature").select(
        label, "feature", round_even(F.col("m"), 4).alias("mean"), z.alias("z")
    )


# ---- domains ----------------------------------------------------------------------------------


def domain_gate(
    df: DataFrame, n_labels: int, minimum: int = 200, domain: str = "domain", label: str = "family"
) -> DataFrame:
    """Domains that hold every label and at least ``minimum`` rows."""
    cells = df.groupBy(domain, label).agg(F.count("*").alias("_n"))
    sizes = cells.groupBy(domain).agg(F.count(label).alias("labels"), F.sum("_n").alias("n"))
    return sizes.filter((F.col("labels") >= n_labels) & (F.col("n") >= minimum))


def domain_holdout(
    df: DataFrame, target: str, seed: int, key: str = "prompt_id", domain: str = "domain"
) -> dict[str, DataFrame]:
    """Rows of one domain as train, val and test by prompt, and all other rows as ``rest``."""
    inside, rest = df.filter(F.col(domain) == target), df.filter(F.col(domain) != target)
    train_val, test = group_split(inside, 0.30, seed, key)
    # another seed: the same buckets would put every second cut inside the first
    train, val = group_split(train_val, 0.15, seed + 1, key)
    return {"train": train, "val": val, "test": test, "rest": rest}


def size_matched_sample(
    pool: DataFrame, size: DataFrame, seed: int, key: list[str], label: str = "family"
) -> DataFrame:
    """From each label min(available, n // labels) rows; ``size`` is a one-row table (n)."""

    def wanted(totals: DataFrame) -> DataFrame:
        share = totals.agg(F.count("*").alias("labels")).crossJoin(F.broadcast(size))
        share = share.select(F.floor(F.col("n") / F.col("labels")).alias("n"))
        return totals.select(label).crossJoin(F.broadcast(share))

    keyed = pool.withColumns({"_digest": seeded_digest(seed, *key), "_tie": F.concat_ws("|", *key)})
    return lowest_per_group(keyed, label, "_digest", "_tie", wanted).drop("_digest", "_tie")


def recall_drop_matrix(recalls: DataFrame, domains: list[str]) -> DataFrame:
    """label x domain: mean over models of in-domain minus cross-domain recall.

    ``recalls`` has (domain, model, condition, label, recall).
    """
    sides = recalls.groupBy("domain", "model", "label").agg(
        F.max(F.when(F.col("condition") == "in_domain", F.col("recall"))).alias("_in"),
        F.max(F.when(F.col("condition") == "cross_domain", F.col("recall"))).alias("_cross"),
    )
    return sides.groupBy("label").pivot("domain", domains).agg(F.avg(F.col("_in") - F.col("_cross")))


def transfer_drop_error(summary: DataFrame) -> DataFrame:
    """(domain, model): accuracy drop, its error, and the share of accuracy kept.

    ``summary`` has (domain, model, condition, mean, std).
    """
    def side(c: str, condition: str) -> Column:
        return F.max(F.when(F.col("condition") == condition, F.col(c)))

    wide = summary.groupBy("domain", "model").agg(
        side("mean", "in_domain").alias("m1"), side("mean", "cross_domain").alias("m2"),
        side("std", "in_domain").alias("s1"), side("std", "cross_domain").alias("s2"),
    )
    return wide.select(
        "domain", "model", (F.col("m1") - F.col("m2")).alias("accuracy_drop"),
        F.sqrt(F.col("s1") * F.col("s1") + F.col("s2") * F.col("s2")).alias("error"),
        F.try_divide("m2", "m1").alias("retention"),
    )


# ---- report numbers ---------------------------------------------------------------------------


def proportion_test(scores: DataFrame, p0: float) -> DataFrame:
    """Adds ``p_value`` of accuracy over n rows against ``p0``."""
    return scores.withColumn("p_value", proportion_p_value(F.col("accuracy"), F.col("n"), p0))


def within_class_spread(by_model: DataFrame, minimum: int = 20, by: list[str] = ()) -> DataFrame:
    """Per run and family: models with enough rows, the best and worst of them and their gap."""
    best_first = F.struct("accuracy", F.col("model"))
    kept = by_model.filter(F.col("n") >= minimum)
    ends = kept.groupBy(*by, "family").agg(
        F.count("*").alias("models"), F.max(best_first).alias("_b"), F.min(best_first).alias("_w")
    )
    return ends.select(
        *by, "family", "models", F.col("_b.model").alias("best"), F.col("_b.accuracy").alias("best_accuracy"),
        F.col("_w.model").alias("worst"), F.col("_w.accuracy").alias("worst_accuracy"),
        (F.col("_b.accuracy") - F.col("_w.accuracy")).alias("gap"),
    )


def ablation_table(scores: DataFrame, baseline: str = "none") -> DataFrame:
    """(model, variant): refit mean and deviation, test-time accuracy, and both changes to the baseline.

    ``scores`` has (model, variant, kind, accuracy) with kind 'refit' or 'test_time'.
    """
    def of(kind: str) -> Column:
        return F.when(F.col("kind") == kind, F.col("accuracy"))

    table = scores.groupBy("model", "variant").agg(
        F.avg(of("refit")).alias("refit_mean"), F.stddev_pop(of("refit")).alias("refit_std"),
        F.avg(of("test_time")).alias("test_time"),
    )
    base = table.filter(F.col("variant") == baseline).select(
        "model", F.col("refit_mean").alias("_r"), F.col("test_time").alias("_t")
    )
    # a model without the baseline variant has no changes to show
    return table.join(base, "model", "left").select(
        "model", "variant", "refit_mean", "refit_std", "test_time",
        (F.col("refit_mean") - F.col("_r")).alias("refit_change"),
        (F.col("test_time") - F.col("_t")).alias("test_time_change"),
    )


def describe(processed: DataFrame, label: str = "family") -> dict[str, DataFrame]:
    """Shares, lengths and time spans by class."""
    from .curate import flag_share

    return {
        "flags": flag_share(processed, ["self_id", "refusal", "is_reasoning"], 4, label),
        "median_words": length_median(processed, label),
        "box": length_box(processed, label),
        "time": time_range_by_class(processed, label),
    }

