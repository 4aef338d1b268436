"""Cleaning, masking and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions import text as X
from stylograph.operators import clean
from stylograph.plans import prepare

from . import views as V
from .registry import query

THINK = V.quote(P.re2(P.THINK_BLOCK, "is"))


@query(
    "strip_traces",
    f"""WITH {V.ANSWERS} SELECT row_id, {V.sql_strip_traces('output')} AS output_raw,
      regexp_matches(output, {THINK}) AS had_trace FROM answers""",
)
def strip_traces(spark, sf):
    rows = V.answers(spark, sf)
    return rows.select(
        "row_id", X.strip_traces("output").alias("output_raw"), X.has_trace("output").alias("had_trace")
    )


@query(
    "drop_near_empty",
    f"""WITH {V.ANSWERS} SELECT count(*) AS rows_before,
      count(*) FILTER (regexp_matches(output, {THINK})) AS rows_with_trace,
      count(*) FILTER (length({V.sql_strip_traces('output')}) >= 20) AS rows_after FROM answers""",
)
def drop_near_empty(spark, sf):
    return clean.cleaning_report(V.answers(spark, sf))


@query("flag_refusal", f"WITH {V.CLEANED} SELECT row_id, refusal FROM cleaned")
def flag_refusal(spark, sf):
    return V.cleaned(spark, sf).select("row_id", "refusal")


@query("flag_self_id", f"WITH {V.CLEANED} SELECT row_id, family, self_id FROM cleaned")
def flag_self_id(spark, sf):
    return V.cleaned(spark, sf).select("row_id", "family", "self_id")


@query("flag_names_any", f"WITH {V.CLEANED} SELECT row_id, prompt_names_model FROM cleaned")
def flag_names_any(spark, sf):
    return V.cleaned(spark, sf).select("row_id", "prompt_names_model")


@query("mask_terms", f"WITH {V.CLEANED} SELECT row_id, input, output, input_raw, output_raw FROM cleaned")
def mask_terms(spark, sf):
    return V.cleaned(spark, sf).select("row_id", "input", "output", "input_raw", "output_raw")


@query(
    "group_split",
    f"WITH {V.ANSWERS} SELECT row_id, prompt_id, {V.SPLIT_CASE} AS split FROM answers",
)
def group_split(spark, sf):
    return clean.assign_split(V.answers(spark, sf)).select("row_id", "prompt_id", "split")


@query(
    "assert_no_group_leak",
    f"""WITH {V.ANSWERS}, s AS (SELECT prompt_id, {V.SPLIT_CASE} AS split FROM answers)
    SELECT prompt_id, min(split) AS first, max(split) AS last FROM s GROUP BY prompt_id
    HAVING count(DISTINCT split) > 1""",
)
def assert_no_group_leak(spark, sf):
    return clean.leaked_groups(clean.assign_split(V.answers(spark, sf)))


@query(
    "leaked_groups",
    """SELECT lang AS prompt_id, min(source) AS first, max(source) AS last FROM documents GROUP BY lang
    HAVING count(DISTINCT source) > 1""",
)
def leaked_groups(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.col("lang").alias("prompt_id"), "source")
    return clean.leaked_groups(docs, "prompt_id", "source")


@query(
    "split_sizes",
    f"WITH {V.ANSWERS} SELECT {V.SPLIT_CASE} AS split, count(*) AS n FROM answers GROUP BY ALL",
)
def split_sizes(spark, sf):
    return clean.split_sizes(clean.assign_split(V.answers(spark, sf)))


@query(
    "matched_pair",
    f"""WITH {V.ANSWERS}, k AS (SELECT prompt_id, count(DISTINCT family) AS f FROM answers GROUP BY prompt_id)
    SELECT row_id, prompt_id, family, f = 2 AS matched_pair FROM answers JOIN k USING (prompt_id)""",
)
def matched_pair(spark, sf):
    rows = V.answers(spark, sf).select("row_id", "prompt_id", "family")
    return clean.matched_pair(rows, "row_id")


@query(
    "preprocess",
    f"""WITH {V.CLEANED}, k AS (SELECT prompt_id, count(DISTINCT family) AS f FROM cleaned GROUP BY prompt_id)
    SELECT row_id, prompt_id, model, family, domain, is_reasoning, refusal, self_id, prompt_names_model,
      input, output, input_raw, output_raw, {V.SPLIT_CASE} AS split, f = 2 AS matched_pair
    FROM cleaned JOIN k USING (prompt_id)""",
)
def preprocess(spark, sf):
    rows = V.answers(spark, sf).drop("timestamp")
    return prepare.processed_rows(rows, row_id=["row_id"])
