"""Metrics and slices over one long prediction table.

Prediction tables hold one row per (run, test set, row): the columns in ``by`` name the run, ``true``
and ``pred`` are labels.  Every metric serves all runs in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.stats import round_even
from .quantiles import quantiles_of_counts

QUARTILES = ["Q1 short", "Q2", "Q3", "Q4 long"]


def correct() -> Column:
    return (F.col("pred") == F.col("true")).cast("int")


def accuracy_n(preds: DataFrame, by: list[str]) -> DataFrame:
    return preds.groupBy(*by).agg(F.avg(correct()).alias("accuracy"), F.count("*").alias("n"))


def confusion(preds: DataFrame, labels: list[str], by: list[str]) -> DataFrame:
    """(by, true, pred, n): the full label grid per run, zeros kept."""
    counts = preds.groupBy(*by, "true", "pred").agg(F.count("*").alias("n"))
    # one short map per run, labels x labels at most: the predictions are read once
    cell = F.struct(F.col("true"), F.col("pred"))
    seen = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(cell, "n"))).alias("_n"))
    cells = [F.struct(F.lit(t).alias("true"), F.lit(p).alias("pred")) for t in labels for p in labels]
    grid = seen.select(*by, "_n", F.explode(F.array(*cells)).alias("c"))
    n = F.coalesce(F.try_element_at("_n", F.col("c")), F.lit(0)).cast("bigint")
    return grid.select(*by, "c.true", "c.pred", n.alias("n"))


def confusion_norm(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Each cell over its row sum; an empty row gives zeros."""
    row = F.sum("n").over(W.partitionBy(*by, "true"))
    return matrix.select(*by, "true", "pred", (F.col("n") / F.greatest(row, F.lit(1))).alias("share"))


def _class_scores(matrix: DataFrame, by: list[str]) -> DataFrame:
    """(by, label, hits, actual, predicted) from the confusion grid."""
    cell = F.explode(
        F.array(
            F.struct(F.col("true").alias("label"), F.lit(True).alias("is_true")),
            F.struct(F.col("pred").alias("label"), F.lit(False).alias("is_true")),
        )
    )
    sides = matrix.select(*by, "true", "pred", "n", cell.alias("s")).select(*by, "true", "pred", "n", "s.*")
    hit = F.col("is_true") & (F.col("true") == F.col("pred"))
    return sides.groupBy(*by, "label").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("is_true"), F.col("n")).otherwise(0)).alias("actual"),
        F.sum(F.when(~F.col("is_true"), F.col("n")).otherwise(0)).alias("predicted"),
    )


def recall_per_class(matrix: DataFrame, by: list[str]) -> DataFrame:
    scores = _class_scores(matrix, by)
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    return scores.select(*by, "label", round_even(recall, 4).alias("recall"))


def macro_f1(matrix: DataFrame, by: list[str], seen_only: bool = False) -> DataFrame:
    """Mean F1 over the labels of the grid; a label without rows scores 0.

    ``seen_only`` leaves out labels that are neither true nor predicted anywhere in the run.
    """
    scores = _class_scores(matrix, by)
    if seen_only:
        scores = scores.filter(F.col("actual") + F.col("predicted") > 0)
    f1 = F.coalesce(
        F.try_divide(F.lit(2.0) * F.col("hits"), F.col("actual") + F.col("predicted")), F.lit(0.0)
    )
    return scores.groupBy(*by).agg(F.avg(f1).alias("macro_f1"))


def metrics(preds: DataFrame, labels: list[str], by: list[str]) -> DataFrame:
    """Tidy (by, metric, class, value): accuracy, n, macro_f1 and recall by class."""
    scores = _class_scores(confusion(preds, labels, by), by)
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(F.lit(2.0) * F.col("hits"), F.col("actual") + F.col("predicted")), F.lit(0.0)
    )

    def entry(metric: str, value: Column, label: Column | None = None) -> Column:
        name = F.lit(None).cast("string") if label is None else label
        return F.struct(F.lit(metric).alias("metric"), name.alias("class"), value.cast("double").alias("value"))

    total = F.sum("actual")
    whole = [entry("accuracy", F.sum("hits") / total), entry("macro_f1", F.avg(f1)), entry("n", total)]
    per_class = F.collect_list(entry("recall", round_even(recall, 4), F.col("label")))
    rows = scores.groupBy(*by).agg(F.concat(F.array(*whole), per_class).alias("_m"))
    return rows.select(*by, F.explode("_m").alias("m")).select(*by, "m.*")


def breakdown(preds: DataFrame, slices: list[str], by: list[str] = ()) -> DataFrame:
    """(by, slice, value, accuracy, n) for several slicing columns, in one aggregate."""
    entries = F.array(
        *[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("value")) for s in slices]
    )
    # the row's few slice values go through one map-side aggregate
    counts = preds.groupBy(*by, *slices).agg(F.sum(correct()).alias("_hits"), F.count("*").alias("_n"))
    long = counts.select(*by, "_hits", "_n", F.explode(entries).alias("e")).select(*by, "_hits", "_n", "e.*")
    share = F.sum("_hits") / F.sum("_n")
    return long.groupBy(*by, "slice", "value").agg(
        round_even(share, 4).alias("accuracy"), F.sum("_n").alias("n")
    )


def length_quartile(rows: DataFrame, length: str, name: str = "quartile") -> DataFrame:
    """Adds the quartile of a text length: right-closed bins at the exact 25, 50 and 75 % points."""
    cuts = quantiles_of_counts(rows, length, [0.25, 0.5, 0.75], name="_cuts")
    x = F.col(length)
    label = (
        F.when(x <= F.col("_cuts")[0], QUARTILES[0])
        .when(x <= F.col("_cuts")[1], QUARTILES[1])
        .when(x <= F.col("_cuts")[2], QUARTILES[2])
        .otherwise(QUARTILES[3])
    )
    # one row of cut points
    return rows.crossJoin(F.broadcast(cuts)).withColumn(name, label).drop("_cuts")


def breakdown_length_quartile(preds: DataFrame, length: str, by: list[str] = ()) -> DataFrame:
    """Accuracy by quartile of length; every run named by ``by`` has its own cut points."""
    counts = preds.groupBy(*by, length).agg(F.sum(correct()).alias("_hits"), F.count("*").alias("_n"))
    q = F.percentile(length, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("_n"))
    # distinct lengths only: the cut points and the bins both come from this small table
    cuts = counts.groupBy(*by).agg(q.alias("_cuts"))
    x = F.col(length)
    label = (
        F.when(x <= F.col("_cuts")[0], QUARTILES[0])
        .when(x <= F.col("_cuts")[1], QUARTILES[1])
        .when(x <= F.col("_cuts")[2], QUARTILES[2])
        .otherwise(QUARTILES[3])
    )
    # a row of cut points per run
    joined = counts.join(cuts, list(by)) if by else counts.crossJoin(F.broadcast(cuts))
    binned = joined.withColumn("quartile", label)
    share = F.sum("_hits") / F.sum("_n")
    return binned.groupBy(*by, "quartile").agg(round_even(share, 4).alias("accuracy"), F.sum("_n").alias("n"))


def breakdown_model(preds: DataFrame, model: str = "model", by: list[str] = ()) -> DataFrame:
    return preds.groupBy(*by, model).agg(
        round_even(F.avg(correct()), 4).alias("accuracy"), F.count("*").alias("n")
    )


def summarize_runs(scores: DataFrame, value: str, by: list[str], run: str = "seed") -> DataFrame:
    """Mean, population deviation and the list of values over the runs, in run order."""
    runs = F.transform(F.array_sort(F.collect_list(F.struct(run, value))), lambda s: s[value])
    return scores.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), runs.alias("runs")
    )


def drop_predictions(results: DataFrame, columns: list[str] = ("pred", "probs", "true", "row_id")) -> DataFrame:
    """Run records without their per-row columns."""
    kept = [c for c in results.columns if c not in columns]
    return results.select(*kept).distinct()


def mean_recall_over_runs(recalls: DataFrame, by: list[str]) -> DataFrame:
    return recalls.groupBy(*by, "label").agg(F.avg("recall").alias("recall"))


def subset_eval(preds: DataFrame, member: str, by: list[str], names: tuple[str, str] = ("test", "test_matched")) -> DataFrame:
    """Accuracy of the same predictions on all rows and on the marked subset."""
    counts = preds.groupBy(*by, member).agg(F.sum(correct()).alias("_hits"), F.count("*").alias("_n"))
    sets = F.when(F.col(member), F.array(*map(F.lit, names))).otherwise(F.array(F.lit(names[0])))
    long = counts.select(*by, "_hits", "_n", F.explode(sets).alias("test_set"))
    return long.groupBy(*by, "test_set").agg(
        (F.sum("_hits") / F.sum("_n")).alias("accuracy"), F.sum("_n").alias("n")
    )


def pair_agreement(preds: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Share of keys whose rows all got the same prediction."""
    same = preds.groupBy(*by, key).agg((F.min("pred") == F.max("pred")).cast("int").alias("_same"))
    return same.groupBy(*by).agg(F.avg("_same").alias("agreement"), F.count("*").alias("pairs"))


def select_best_run(scores: DataFrame, score: str, by: list[str], run: str = "seed") -> DataFrame:
    """The run with the highest score; the earliest of equals."""
    best = F.max_by(F.struct(*[c for c in scores.columns if c not in by]), F.struct(F.col(score), -F.col(run)))
    return scores.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")
