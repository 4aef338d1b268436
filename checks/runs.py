"""Fingerprints and resumable runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stylograph.operators import runs

from . import views as V
from .registry import query

D = V.sql_row_digest("family", "input", "output")
PARTS = [f"CAST(sum(('0x' || substr(d, {1 + 8 * i}, 8))::BIGINT::HUGEINT) AS VARCHAR)" for i in range(4)]
PRINT = f"md5(CAST(count(*) AS VARCHAR) || '|' || {" || '|' || ".join(PARTS)})"


@query(
    "dataset_fingerprint",
    f"""WITH {V.ANSWERS}, r AS (SELECT domain, {D} AS d FROM answers)
    SELECT domain, count(*) AS n, {PRINT} AS fingerprint FROM r GROUP BY domain""",
)
def dataset_fingerprint(spark, sf):
    return runs.dataset_fingerprint(V.answers(spark, sf), by=["domain"])


FIELDS, SEEDS = ["input", "output", "both"], [0, 1, 2]
KEY = "substr(md5('field=' || field || chr(31) || 'seed=' || seed || chr(31) || fingerprint), 1, 20)"


@query(
    "skip_done_runs",
    f"""WITH {V.ANSWERS}, r AS (SELECT domain, {D} AS d FROM answers),
      f AS (SELECT domain, {PRINT} AS fingerprint FROM r GROUP BY domain),
      grid AS (SELECT *, {KEY} AS run_key FROM f, (SELECT unnest({V.sql_list(FIELDS)}) AS field), (SELECT unnest({SEEDS}) AS seed))
    SELECT domain, field, CAST(seed AS INT) AS seed, run_key FROM grid WHERE NOT (domain = 'code' AND seed <= 1)""",
)
def skip_done_runs(spark, sf):
    prints = runs.dataset_fingerprint(V.answers(spark, sf), by=["domain"]).drop("n")
    grid = prints.withColumn("field", F.explode(F.array(*map(F.lit, FIELDS))))
    grid = runs.run_key(grid.withColumn("seed", F.explode(F.array(*map(F.lit, SEEDS)))), ["field", "seed"])
    done = grid.filter("domain = 'code' AND seed <= 1").select("run_key", F.lit("accuracy").alias("metric"))
    return runs.skip_done_runs(grid, done).select("domain", "field", "seed", "run_key")
