"""Metrics, slices and comparisons over rule-based predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions import stats
from stylograph.functions.style import FEATURES, style_features
from stylograph.operators import clean, compare, evaluate

from . import views as V
from .registry import query
from .text import sql_style

RUN = ["kind", "seed"]
HIT = 'CAST(pred = "true" AS INT)'
R4 = "round_even({} * 10000, 0) / 10000"


def _matrix(spark, sf):
    return evaluate.confusion(V.predictions(spark, sf), P.FAMILIES, RUN)


# The grid per run, from the label list and the runs that occur.
MATRIX = f"""{V.PREDICTIONS}, {V.SQL_LABELS}, matrix AS (
  SELECT r.kind, r.seed, t.label AS "true", p.label AS pred, count(x.row_id) AS n
  FROM (SELECT DISTINCT kind, seed FROM predictions) r CROSS JOIN labels8 t CROSS JOIN labels8 p
  LEFT JOIN predictions x ON x.kind = r.kind AND x.seed = r.seed AND x."true" = t.label AND x.pred = p.label
  GROUP BY ALL
), scores AS (
  SELECT kind, seed, label,
    CAST(sum(CASE WHEN "true" = label AND pred = label THEN n ELSE 0 END) AS BIGINT) AS hits,
    CAST(sum(CASE WHEN "true" = label THEN n ELSE 0 END) AS BIGINT) AS actual,
    CAST(sum(CASE WHEN pred = label THEN n ELSE 0 END) AS BIGINT) AS predicted
  FROM matrix CROSS JOIN labels8 GROUP BY ALL
)"""
F1 = "coalesce(2.0 * hits / nullif(actual + predicted, 0), 0)"
RECALL = R4.format("coalesce(CAST(hits AS DOUBLE) / nullif(actual, 0), 0)")


@query(
    "accuracy_n",
    f"WITH {V.PREDICTIONS} SELECT kind, seed, avg({HIT}) AS accuracy, count(*) AS n FROM predictions GROUP BY ALL",
)
def accuracy_n(spark, sf):
    return evaluate.accuracy_n(V.predictions(spark, sf), RUN)


@query("confusion", f"WITH {MATRIX} SELECT * FROM matrix")
def confusion(spark, sf):
    return _matrix(spark, sf)


@query(
    "confusion_norm",
    f"""WITH {MATRIX} SELECT kind, seed, "true", pred,
      CAST(n AS DOUBLE) / greatest(sum(n) OVER (PARTITION BY kind, seed, "true"), 1) AS share FROM matrix""",
)
def confusion_norm(spark, sf):
    return evaluate.confusion_norm(_matrix(spark, sf), RUN)


@query("recall_per_class", f"WITH {MATRIX} SELECT kind, seed, label, {RECALL} AS recall FROM scores")
def recall_per_class(spark, sf):
    return evaluate.recall_per_class(_matrix(spark, sf), RUN)


@query("macro_f1", f"WITH {MATRIX} SELECT kind, seed, avg({F1}) AS macro_f1 FROM scores GROUP BY ALL")
def macro_f1(spark, sf):
    return evaluate.macro_f1(_matrix(spark, sf), RUN)


@query(
    "macro_f1_seen",
    f"WITH {MATRIX} SELECT kind, seed, avg({F1}) AS macro_f1 FROM scores WHERE actual + predicted > 0 GROUP BY ALL",
)
def macro_f1_seen(spark, sf):
    return evaluate.macro_f1(_matrix(spark, sf), RUN, seen_only=True)


@query(
    "metrics",
    f"""WITH {MATRIX}, s AS (SELECT kind, seed, sum(hits) / sum(actual) AS accuracy, avg({F1}) AS macro_f1,
      CAST(sum(actual) AS DOUBLE) AS n FROM scores GROUP BY ALL)
    SELECT kind, seed, 'accuracy' AS metric, NULL AS class, accuracy AS value FROM s
    UNION ALL SELECT kind, seed, 'macro_f1', NULL, macro_f1 FROM s UNION ALL SELECT kind, seed, 'n', NULL, n FROM s
    UNION ALL SELECT kind, seed, 'recall', label, {RECALL} FROM scores""",
)
def metrics(spark, sf):
    return evaluate.metrics(V.predictions(spark, sf), P.FAMILIES, RUN)


def _sql_breakdown(column: str) -> str:
    return (
        f"SELECT kind, seed, '{column}' AS slice, CAST({column} AS VARCHAR) AS value, "
        f"{R4.format(f'avg({HIT})')} AS accuracy, count(*) AS n FROM predictions GROUP BY ALL"
    )


for _name, _column in (("domain", "domain"), ("reasoning", "is_reasoning"), ("refusal", "refusal")):

    def _register(name: str, column: str):
        @query(f"breakdown_{name}", f"WITH {V.PREDICTIONS} {_sql_breakdown(column)}")
        def run(spark, sf):
            return evaluate.breakdown(V.predictions(spark, sf), [column], RUN)

    _register(_name, _column)


@query(
    "breakdown",
    f"WITH {V.PREDICTIONS} " + " UNION ALL ".join(map(_sql_breakdown, ["domain", "is_reasoning", "refusal"])),
)
def breakdown(spark, sf):
    return evaluate.breakdown(V.predictions(spark, sf), ["domain", "is_reasoning", "refusal"], RUN)


@query(
    "breakdown_length_quartile",
    f"""WITH {V.PREDICTIONS}, cuts AS (SELECT kind, seed, quantile_cont(length, [0.25, 0.5, 0.75]) AS c FROM predictions GROUP BY ALL)
    SELECT kind, seed, CASE WHEN length <= c[1] THEN 'Q1 short' WHEN length <= c[2] THEN 'Q2'
        WHEN length <= c[3] THEN 'Q3' ELSE 'Q4 long' END AS quartile,
      {R4.format(f'avg({HIT})')} AS accuracy, count(*) AS n FROM predictions JOIN cuts USING (kind, seed) GROUP BY ALL""",
)
def breakdown_length_quartile(spark, sf):
    return evaluate.breakdown_length_quartile(V.predictions(spark, sf), "length", RUN)


@query(
    "length_quartile",
    f"""WITH {V.ANSWERS}, cuts AS (SELECT quantile_cont(length(output), [0.25, 0.5, 0.75]) AS c FROM answers)
    SELECT row_id, CASE WHEN length(output) <= c[1] THEN 'Q1 short' WHEN length(output) <= c[2] THEN 'Q2'
      WHEN length(output) <= c[3] THEN 'Q3' ELSE 'Q4 long' END AS quartile FROM answers CROSS JOIN cuts""",
)
def length_quartile(spark, sf):
    rows = V.answers(spark, sf).select("row_id", F.length("output").alias("length"))
    return evaluate.length_quartile(rows, "length").select("row_id", "quartile")


@query(
    "breakdown_model",
    f"""WITH {V.PREDICTIONS} SELECT kind, seed, model, {R4.format(f'avg({HIT})')} AS accuracy, count(*) AS n
    FROM predictions GROUP BY ALL""",
)
def breakdown_model(spark, sf):
    return evaluate.breakdown_model(V.predictions(spark, sf), by=RUN)


ACCURACY = f'acc AS (SELECT kind, seed, avg({HIT}) AS accuracy FROM predictions GROUP BY ALL)'


@query(
    "summarize_runs",
    f"""WITH {V.PREDICTIONS}, {ACCURACY} SELECT kind, avg(accuracy) AS mean, stddev_pop(accuracy) AS std,
      string_agg(CAST(CAST(round(accuracy * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY seed) AS runs FROM acc GROUP BY kind""",
)
def summarize_runs(spark, sf):
    scores = evaluate.accuracy_n(V.predictions(spark, sf), RUN)
    out = evaluate.summarize_runs(scores, "accuracy", ["kind"])
    millionths = F.transform("runs", lambda x: F.round(x * 1_000_000).cast("bigint").cast("string"))
    return out.withColumn("runs", F.array_join(millionths, ","))


@query(
    "select_best_run",
    f"""WITH {MATRIX}, f AS (SELECT kind, seed, avg({F1}) AS macro_f1 FROM scores GROUP BY ALL)
    SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY kind ORDER BY macro_f1 DESC, seed) = 1""",
)
def select_best_run(spark, sf):
    scores = evaluate.macro_f1(_matrix(spark, sf), RUN)
    return evaluate.select_best_run(scores, "macro_f1", ["kind"])


@query("drop_predictions", f"WITH {V.PREDICTIONS} SELECT DISTINCT kind, seed, domain FROM predictions")
def drop_predictions(spark, sf):
    preds = V.predictions(spark, sf).select("kind", "seed", "domain", "row_id", "true", "pred")
    return evaluate.drop_predictions(preds)


@query(
    "mean_recall_over_runs",
    f"""WITH {MATRIX}, r AS (SELECT kind, seed, label, {RECALL} AS recall FROM scores)
    SELECT kind, label, avg(recall) AS recall FROM r GROUP BY ALL""",
)
def mean_recall_over_runs(spark, sf):
    return evaluate.mean_recall_over_runs(evaluate.recall_per_class(_matrix(spark, sf), RUN), ["kind"])


# ---- subsets and pairs ------------------------------------------------------------------------

MATCHED = f"""{V.PREDICTIONS}, m AS (SELECT prompt_id, count(DISTINCT family) = 2 AS matched FROM answers GROUP BY prompt_id),
  p AS (SELECT * FROM predictions JOIN m USING (prompt_id))"""


def _matched(spark, sf):
    rows = V.answers(spark, sf).select("row_id", "prompt_id", "family")
    flags = clean.matched_pair(rows, "row_id").select("row_id", "matched_pair")
    return V.predictions(spark, sf).join(flags, "row_id")


@query(
    "subset_eval",
    f"""WITH {MATCHED} SELECT kind, seed, 'test' AS test_set, avg({HIT}) AS accuracy, count(*) AS n FROM p GROUP BY ALL
    UNION ALL SELECT kind, seed, 'test_matched', avg({HIT}), count(*) FROM p WHERE matched GROUP BY ALL""",
)
def subset_eval(spark, sf):
    return evaluate.subset_eval(_matched(spark, sf), "matched_pair", RUN)


@query(
    "pair_agreement",
    f"""WITH {MATCHED}, k AS (SELECT kind, seed, prompt_id, count(DISTINCT pred) = 1 AS same FROM p WHERE matched GROUP BY ALL)
    SELECT kind, seed, avg(CAST(same AS INT)) AS agreement, count(*) AS pairs FROM k GROUP BY ALL""",
)
def pair_agreement(spark, sf):
    return evaluate.pair_agreement(_matched(spark, sf).filter("matched_pair"), "prompt_id", RUN)


# ---- time and length --------------------------------------------------------------------------


@query(
    "time_features",
    f"""WITH {V.ANSWERS} SELECT row_id, CAST(floor((epoch_us(timestamp) - epoch_us(TIMESTAMP '2025-01-01')) / 86400000000.0) AS BIGINT) AS day,
      CAST(hour(timestamp) AS INT) AS hour FROM answers""",
)
def time_features(spark, sf):
    return compare.time_features(V.answers(spark, sf)).select("row_id", "day", "hour")


@query(
    "time_range_by_class",
    f"""WITH {V.ANSWERS} SELECT family, epoch_us(min(timestamp)) AS first,
      CAST(floor(quantile_cont(epoch_us(timestamp), 0.5)) AS BIGINT) AS median, epoch_us(max(timestamp)) AS last
    FROM answers GROUP BY family""",
)
def time_range_by_class(spark, sf):
    from stylograph.functions.text import wall_micros

    spans = compare.time_range_by_class(V.answers(spark, sf))
    return spans.select("family", *[wall_micros(c).alias(c) for c in ("first", "median", "last")])


@query(
    "timeline_density",
    f"""WITH {V.ANSWERS} SELECT family, strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS n FROM answers GROUP BY ALL""",
)
def timeline_density(spark, sf):
    days = compare.timeline_density(V.answers(spark, sf))
    return days.withColumn("date", F.col("date").cast("string"))


WORDS = f"len(regexp_extract_all(output, {V.quote(P.re2(r'[^\s]+'))}))"


@query(
    "length_median",
    f"WITH {V.ANSWERS} SELECT family, quantile_cont({WORDS}, 0.5) AS median_words FROM answers GROUP BY family",
)
def length_median(spark, sf):
    return compare.length_median(V.answers(spark, sf))


@query(
    "length_box",
    f"""WITH {V.ANSWERS}, x AS (SELECT family, log10(greatest({WORDS}, 1)) AS x FROM answers),
      q AS (SELECT family, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM x GROUP BY family)
    SELECT family, round(q[1], 6) AS q1, round(q[2], 6) AS median, round(q[3], 6) AS q3,
      round(least(min(x) FILTER (x >= q[1] - 1.5 * (q[3] - q[1])), q[1]), 6) AS whisker_low,
      round(greatest(max(x) FILTER (x <= q[3] + 1.5 * (q[3] - q[1])), q[3]), 6) AS whisker_high
    FROM x JOIN q USING (family) GROUP BY family, q""",
)
def length_box(spark, sf):
    box = compare.length_box(V.answers(spark, sf))
    return box.select("family", *[F.round(c, 6).alias(c) for c in box.columns if c != "family"])


# ---- style and domains ------------------------------------------------------------------------

SQL_Z = "coalesce((avg({c}) - any_value(m_{c})) / nullif(any_value(s_{c}), 0), 0)"


@query(
    "style_profile",
    f"""WITH {V.ANSWERS}, {sql_style('answers', 'output', 'family')},
      whole AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in FEATURES)} FROM style) """
    + " UNION ALL ".join(
        f"SELECT family, '{c}' AS feature, {R4.format(f'avg({c})')} AS mean, round({SQL_Z.format(c=c)}, 3) AS z "
        "FROM style CROSS JOIN whole GROUP BY family"
        for c in FEATURES
    ),
)
def style_profile(spark, sf):
    features = style_features(V.answers(spark, sf).select("family", "output")).drop("output")
    profile = compare.style_profile(features)
    return profile.select("family", "feature", "mean", F.round("z", 3).alias("z"))


@query(
    "domain_gate",
    f"""WITH {V.ANSWERS} SELECT domain, count(DISTINCT family) AS labels, count(*) AS n FROM answers
    GROUP BY domain HAVING count(DISTINCT family) >= 8 AND count(*) >= 200""",
)
def domain_gate(spark, sf):
    return compare.domain_gate(V.answers(spark, sf), len(P.FAMILIES), 200)


HOLDOUT = (
    f"CASE WHEN domain <> 'code' THEN 'rest' WHEN {V.sql_bucket(0, 'prompt_id')} >= 7000 THEN 'test' "
    f"WHEN {V.sql_bucket(1, 'prompt_id')} >= 8500 THEN 'val' ELSE 'train' END"
)


@query("domain_holdout", f"WITH {V.ANSWERS} SELECT row_id, {HOLDOUT} AS part FROM answers")
def domain_holdout(spark, sf):
    parts = compare.domain_holdout(V.answers(spark, sf), "code", 0)
    out = None
    for name, df in parts.items():
        one = df.select("row_id", F.lit(name).alias("part"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "size_matched_sample",
    f"""WITH {V.ANSWERS}, parts AS (SELECT *, {HOLDOUT} AS part FROM answers),
      size AS (SELECT count(*) AS n FROM parts WHERE part IN ('train', 'val')),
      pool AS (SELECT * FROM parts WHERE part = 'rest')
    SELECT row_id, family FROM pool
    QUALIFY row_number() OVER (PARTITION BY family ORDER BY {V.sql_digest(0, 'row_id')}, CAST(row_id AS VARCHAR))
      <= (SELECT n FROM size) // (SELECT count(DISTINCT family) FROM pool)""",
)
def size_matched_sample(spark, sf):
    parts = compare.domain_holdout(V.answers(spark, sf), "code", 0)
    size = parts["train"].unionByName(parts["val"]).agg(F.count("*").alias("n"))
    sample = compare.size_matched_sample(parts["rest"], size, 0, ["row_id"])
    return sample.select("row_id", "family")


# The trees' runs stand for the cross-domain condition: same rows, lower accuracy.
CONDITION = "CASE kind WHEN 'linear' THEN 'in_domain' ELSE 'cross_domain' END"


def _conditions(spark, sf):
    preds = V.predictions(spark, sf)
    condition = F.when(F.col("kind") == "linear", "in_domain").otherwise("cross_domain")
    return preds.withColumns({"condition": condition, "model": F.concat(F.lit("m"), "seed")})


@query(
    "recall_drop_matrix",
    f"""WITH {V.PREDICTIONS}, r AS (SELECT domain, 'm' || seed AS model, {CONDITION} AS condition, "true" AS label,
        {R4.format(f'avg({HIT})')} AS recall FROM predictions GROUP BY ALL),
      d AS (SELECT label, domain, max(recall) FILTER (condition = 'in_domain') - max(recall) FILTER (condition = 'cross_domain') AS d
        FROM r GROUP BY label, domain, model)
    SELECT label, {', '.join(f"avg(d) FILTER (domain = '{x}') AS {x}" for x in V.DOMAINS)} FROM d GROUP BY label""",
)
def recall_drop_matrix(spark, sf):
    by = ["domain", "model", "condition"]
    matrix = evaluate.confusion(_conditions(spark, sf), P.FAMILIES, by)
    # labels that a domain does not hold have no recall there
    held = matrix.groupBy(*by, F.col("true").alias("label")).agg(F.sum("n").alias("rows")).filter("rows > 0")
    recalls = evaluate.recall_per_class(matrix, by).join(held.drop("rows"), [*by, "label"], "left_semi")
    return compare.recall_drop_matrix(recalls, V.DOMAINS)


@query(
    "transfer_drop_error",
    f"""WITH {V.PREDICTIONS}, a AS (SELECT domain, {CONDITION} AS condition, seed, avg({HIT}) AS accuracy
        FROM predictions GROUP BY ALL),
      s AS (SELECT domain, condition, avg(accuracy) AS mean, stddev_pop(accuracy) AS std FROM a GROUP BY ALL),
      w AS (SELECT domain, max(mean) FILTER (condition = 'in_domain') AS m1, max(mean) FILTER (condition = 'cross_domain') AS m2,
        max(std) FILTER (condition = 'in_domain') AS s1, max(std) FILTER (condition = 'cross_domain') AS s2 FROM s GROUP BY domain)
    SELECT domain, 'rules' AS model, m1 - m2 AS accuracy_drop, sqrt(s1 * s1 + s2 * s2) AS error, m2 / m1 AS retention FROM w""",
)
def transfer_drop_error(spark, sf):
    scores = evaluate.accuracy_n(_conditions(spark, sf), ["domain", "condition", "seed"])
    summary = evaluate.summarize_runs(scores, "accuracy", ["domain", "condition"])
    return compare.transfer_drop_error(summary.withColumn("model", F.lit("rules")))


# ---- report numbers ---------------------------------------------------------------------------


def _sql_tail(x: str, t: str) -> str:
    """One minus the error function of x, by the same series as the operator."""
    series = "0.0"
    for a in reversed(stats.ERF_A):
        series = f"({series} * {t} + ({a}))"
    return f"{series} * {t} * exp(-{x} * {x})"


@query(
    "proportion_test",
    f"""WITH {V.PREDICTIONS}, s AS (SELECT kind, seed, domain, avg({HIT}) AS accuracy, count(*) AS n FROM predictions GROUP BY ALL),
      z AS (SELECT *, abs((accuracy - 0.7) / sqrt(0.7 * 0.3 / n)) / sqrt(2.0) AS x FROM s),
      t AS (SELECT *, 1.0 / (1.0 + {stats.ERF_P} * x) AS t FROM z)
    SELECT kind, seed, domain, accuracy, n, round({_sql_tail('x', 't')}, 6) AS p_value FROM t""",
)
def proportion_test(spark, sf):
    scores = evaluate.accuracy_n(V.predictions(spark, sf), [*RUN, "domain"])
    return compare.proportion_test(scores, 0.7).withColumn("p_value", F.round("p_value", 6))


@query(
    "within_class_spread",
    f"""WITH {V.PREDICTIONS}, m AS (SELECT kind, seed, "true" AS family, model, {R4.format(f'avg({HIT})')} AS accuracy, count(*) AS n
        FROM predictions GROUP BY ALL HAVING count(*) >= 20),
      r AS (SELECT *, row_number() OVER (PARTITION BY kind, seed, family ORDER BY accuracy DESC, model DESC) AS b,
        row_number() OVER (PARTITION BY kind, seed, family ORDER BY accuracy, model) AS w FROM m)
    SELECT kind, seed, family, count(*) AS models, max(model) FILTER (b = 1) AS best, max(accuracy) AS best_accuracy,
      max(model) FILTER (w = 1) AS worst, min(accuracy) AS worst_accuracy, max(accuracy) - min(accuracy) AS gap
    FROM r GROUP BY kind, seed, family""",
)
def within_class_spread(spark, sf):
    preds = V.predictions(spark, sf)
    by_model = preds.groupBy(*RUN, F.col("true").alias("family"), "model").agg(
        F.avg(evaluate.correct()).alias("accuracy"), F.count("*").alias("n")
    )
    by_model = by_model.withColumn("accuracy", evaluate.round_even(F.col("accuracy"), 4))
    return compare.within_class_spread(by_model, by=RUN)


# Domains stand for variants here; the first seed is the test-time score, the others are refits.
@query(
    "ablation_table",
    f"""WITH {V.PREDICTIONS}, a AS (SELECT kind AS model, domain AS variant, seed,
        CASE WHEN seed = 0 THEN 'test_time' ELSE 'refit' END AS kind, avg({HIT}) AS accuracy FROM predictions GROUP BY ALL),
      t AS (SELECT model, variant, avg(accuracy) FILTER (kind = 'refit') AS refit_mean,
        stddev_pop(accuracy) FILTER (kind = 'refit') AS refit_std, avg(accuracy) FILTER (kind = 'test_time') AS test_time FROM a GROUP BY ALL)
    SELECT t.*, t.refit_mean - b.refit_mean AS refit_change, t.test_time - b.test_time AS test_time_change
    FROM t LEFT JOIN t b ON b.model = t.model AND b.variant = 'general'""",
)
def ablation_table(spark, sf):
    scores = evaluate.accuracy_n(V.predictions(spark, sf), [*RUN, "domain"])
    scores = scores.select(
        F.col("kind").alias("model"), F.col("domain").alias("variant"),
        F.when(F.col("seed") == 0, "test_time").otherwise("refit").alias("kind"), "accuracy",
    )
    return compare.ablation_table(scores, "general")
