"""Run keys, dataset fingerprints and skipping finished runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_digest


def dataset_fingerprint(
    df: DataFrame, columns: list[str] = ("family", "input", "output"), by: list[str] = ()
) -> DataFrame:
    """Digest of a table's rows, whatever their order: count and sums of four digest parts.

    Sums are 38-digit decimals, which billions of billions of rows cannot overflow.
    """
    digest = row_digest(*columns)
    rows = df.select(*by, digest.alias("_d"))
    sums = []
    for i in range(4):
        part = F.conv(F.substring("_d", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")
        sums.append(F.sum(part).cast("decimal(38,0)").alias(f"_s{i}"))
    totals = rows.groupBy(*by).agg(F.count("*").alias("n"), *sums)
    parts = [F.coalesce(F.col(f"_s{i}"), F.lit(0)).cast("string") for i in range(4)]
    return totals.select(*by, "n", F.md5(F.concat_ws("|", F.col("n").cast("string"), *parts)).alias("fingerprint"))


def run_key(grid: DataFrame, params: list[str], data: str = "fingerprint") -> DataFrame:
    """Adds ``run_key``: a digest of the run's parameters and of its data."""
    blob = F.concat_ws("\x1f", *[F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit(""))) for p in params], F.col(data))
    return grid.withColumn("run_key", F.substring(F.md5(blob), 1, 20))


def skip_done_runs(grid: DataFrame, results: DataFrame) -> DataFrame:
    """Runs of the grid without results."""
    # both are tables of runs, not of data rows
    return grid.join(results.select("run_key").distinct(), "run_key", "left_anti")


def results_as_json(results: DataFrame, keys: list[str]) -> DataFrame:
    """One JSON document per key, metric rows nested as a list: one record per run, not per data row."""
    rest = [c for c in results.columns if c not in keys]
    rows = F.array_sort(F.collect_list(F.struct(*rest)))
    return results.groupBy(*keys).agg(F.to_json(F.struct(rows.alias("results"))).alias("json"))


def params_text(params: dict) -> str:
    return json.dumps(params, sort_keys=True, default=str)
