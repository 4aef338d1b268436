"""The registered queries of the operators, and their SQL where SQL can say them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bitslice, filter_audit, lines, minhash, mixing, packing, phrases, privacy, quality, secrets, sharding, training_order, winnowing

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": lines.op1_lines,
    "op2_training_order": training_order.op2_training_order,
    "op3_mix": mixing.op3_mix,
    "op4_near_duplicates": minhash.op4_near_duplicates,
    "op5_shard": sharding.op5_shard,
    "op6_secrets": secrets.op6_secrets,
    "op7_topk": bitslice.op7_topk,
    "op8_pack": packing.op8_pack,
    "op9_quality": quality.op9_quality,
    "op10_privacy": privacy.op10_privacy,
    "op11_phrases": phrases.op11_phrases,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_decontaminate": winnowing.op13_decontaminate,
}
SQL: dict[str, str] = {
    "op3_mix": mixing.OP3_SQL, "op7_topk": bitslice.OP7_SQL, "op11_phrases": phrases.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL, "op13_decontaminate": winnowing.OP13_SQL,
}


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, also in sessions begun elsewhere."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        return run

    return {name: ready(fn) for name, fn in QUERIES.items()}
