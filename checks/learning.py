"""Fitted models and what they use.

SQL cannot fit, so what it says of a fit is what holds for a right one: which rows it was fitted on and scored on, that its
gradient is zero (the loss is strictly convex, so no other weights have that), that a forest's stored nodes vote as the model does.  The ways from
margins to labels, from shuffled features to importance and from variants to accuracies are checked in full with
scorers that SQL can say; term and token reports on a weight table that SQL can build.  What the fits themselves
say is in the queries without a twin.  All fits are on all rows, at the operators' own settings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions import text as X
from stylograph.functions.hashing import bucket
from stylograph.functions.style import FEATURES, style_features
from stylograph.operators import certify, clean, evaluate, explain, learn
from stylograph.plans import experiments as E
from stylograph.session import materialize, new_path, shared_dir

from . import views as V
from .registry import query
from .text import SQL_ABLATIONS, sql_style, sql_word_tokens

MODES = ["input", "output", "both"]


def _grid(spark) -> E.Grid:
    """One grid for a session: finished runs are read, not refitted."""
    return E.Grid(f"{shared_dir(spark)}/grid")


def _processed(spark, sf):
    """Cleaned and split rows, written once: fits, fingerprints and scores all read them."""
    rows = clean.assign_split(V.cleaned(spark, sf))
    return materialize(clean.matched_pair(rows, "row_id"), "processed")


PROCESSED = f"""{V.CLEANED}, processed AS (SELECT *, {V.SPLIT_CASE} AS split,
    prompt_id IN (SELECT prompt_id FROM cleaned GROUP BY prompt_id HAVING count(DISTINCT family) = 2) AS matched_pair FROM cleaned),
  sizes AS (SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test FROM processed)"""


def _scores(preds, labels=P.FAMILIES, by=("test_set",)):
    return evaluate.metrics(preds.withColumnRenamed("kind", "model"), labels, list(by))


# ---- fits ---------------------------------------------------------------------------------------


@query(
    "fit_linear_text",
    f"""WITH {PROCESSED} SELECT family AS label, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test,
      0.0::DOUBLE AS gradient, true AS told_apart FROM processed GROUP BY family""",
)
def fit_linear_text(spark, sf):
    """Per label: rows, what is left of its gradient, and whether more than the largest class is told apart."""
    rows = _processed(spark, sf)
    train, _, test = E.split_parts(rows)
    data = learn.prepare_linear_text(train, P.FAMILIES, "output")
    clf = learn.fit_linear(data)
    left = certify.gradient(clf, data)
    preds = learn.score(clf, {"test": test})
    hits = preds.agg(F.avg((F.col("pred") == F.col("true")).cast("int")).alias("accuracy"))
    sizes = rows.groupBy(F.col("family").alias("label")).agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test")
    )
    largest = sizes.agg((F.max("n_test") / F.sum("n_test")).alias("largest"))
    told = sizes.join(left, "label").crossJoin(F.broadcast(hits)).crossJoin(F.broadcast(largest))  # one row each
    ratio = F.round(F.col("gradient") / F.col("at_start"), 1)
    return told.select("label", "n_train", "n_test", F.abs(ratio).alias("gradient"), (F.col("accuracy") > F.col("largest")).alias("told_apart"))


@query("fit_linear_metrics")
def fit_linear_metrics(spark, sf):
    train, val, test = E.split_parts(_processed(spark, sf))
    return _scores(E.experiment_grid(_grid(spark), [E.Run("linear")], train, {"val": val, "test": test}).drop("kind"))


def _forest(spark, sf, kind: str):
    """(n_train, n, trees, unlike_votes, unlike_labels, steps): the fitted forest against its stored table of nodes."""
    train, _, test = E.split_parts(_processed(spark, sf))
    data = E.prepare(_grid(spark), E.Run(kind), train)
    clf = E.fit_on(_grid(spark), E.Run(kind), data)
    path = new_path(spark, "forest")
    clf.save(path)
    vectors = E.prepare(_grid(spark), E.Run(kind), test).vectors.withColumn("row_id", F.monotonically_increasing_id())
    vectors = materialize(vectors, "forest-test")
    told = certify.forest_check(clf, path, vectors, "row_id")
    trees = certify.node_table(spark, path).agg(F.count_distinct("tree").alias("trees"))
    n_train = data.vectors.agg(F.count("*").alias("n_train"))
    return told.crossJoin(trees).crossJoin(n_train)  # one row each


def _sql_forest(trees: int) -> str:
    return f"WITH {PROCESSED} SELECT n_test AS rows, 0::BIGINT AS unlike_votes, 0::BIGINT AS unlike_labels, {trees}::BIGINT AS trees, n_train FROM sizes"


@query("fit_style_trees", _sql_forest(E.FULL.style_rounds))
def fit_style_trees(spark, sf):
    return _forest(spark, sf, "style")


@query("fit_time_trees", _sql_forest(E.FULL.time_rounds))
def fit_time_trees(spark, sf):
    return _forest(spark, sf, "time")


@query("fit_trees_metrics")
def fit_trees_metrics(spark, sf):
    train, _, test = E.split_parts(_processed(spark, sf))
    todo = [E.Run("style"), E.Run("time", "time")]
    return _scores(E.experiment_grid(_grid(spark), todo, train, {"test": test}), by=("model", "test_set"))


# ---- grids: every run, with the rows it was fitted on and scored on -------------------------------


def _told(preds, by, done, spark):
    """Per run and test set: rows, training rows, and rows whose probabilities do not sum to 1 or whose label is not the likeliest."""
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    wrong = (F.abs(total - 1) > 1e-6) | (F.col("pred") != learn.best_label("probs", P.FAMILIES))
    trained = F.broadcast(spark.createDataFrame([(r.run_key, r.n_train) for r in done], "run_key string, n_train long"))  # a row per run
    return preds.join(trained, "run_key").groupBy(*by, "n_train").agg(F.count("*").alias("n"), F.count_if(wrong).alias("flawed"))


@query(
    "experiment_grid",
    f"""WITH {PROCESSED} SELECT kind, field, 'none' AS variant, seed, 'test' AS test_set, n_test AS n, n_train, 0::BIGINT AS flawed
      FROM sizes, (VALUES ('linear', 'input', 0), ('linear', 'output', 0), ('linear', 'both', 0), ('style', 'output', 0), ('style', 'output', 1)) r(kind, field, seed)""",
)
def experiment_grid(spark, sf):
    preds, done = _grid_runs(spark, sf)
    return _told(preds, ["kind", "field", "variant", "seed", "test_set"], done, spark)


def _grid_runs(spark, sf):
    grid = _grid(spark)
    train, _, test = E.split_parts(_processed(spark, sf))
    todo = [*[E.Run("linear", m) for m in MODES], *[E.Run("style", seed=s) for s in (0, 1)]]
    done = E.run_all(grid, [E.Job(r, train, {"test": test}) for r in todo])
    return E.predictions(grid, spark, done), done


@query("experiment_metrics")
def experiment_metrics(spark, sf):
    return evaluate.metrics(_grid_runs(spark, sf)[0], P.FAMILIES, ["kind", "field", "variant", "seed", "test_set"])


@query(
    "compare_fields",
    f"""WITH {PROCESSED} SELECT kind, field, test_set, CAST(count(*) AS BIGINT) AS n, any_value(n_train) AS n_train
      FROM processed, sizes, (VALUES ('linear', 'input'), ('linear', 'output'), ('linear', 'both'), ('time', 'time')) r(kind, field), (VALUES ('test'), ('test_matched')) t(test_set)
      WHERE split = 'test' AND (test_set = 'test' OR matched_pair) GROUP BY kind, field, test_set""",
)
def compare_fields(spark, sf):
    rows = _processed(spark, sf)
    told = E.compare_fields(_grid(spark), rows)["accuracy"]
    trained = rows.agg(F.count_if(F.col("split") == "train").alias("n_train"))
    return told.select("kind", "field", "test_set", F.col("n").cast("long").alias("n")).crossJoin(F.broadcast(trained))  # one row


@query("compare_fields_accuracy")
def compare_fields_accuracy(spark, sf):
    return E.compare_fields(_grid(spark), _processed(spark, sf))["accuracy"]


def _sql_transfer() -> str:
    parts = []
    for d in V.DOMAINS:
        hold = (
            f"CASE WHEN domain <> '{d}' THEN 'rest' WHEN {V.sql_bucket(0, 'prompt_id')} >= 7000 THEN 'test' ELSE 'inside' END"
        )
        parts.append(f"SELECT '{d}' AS target, family, {hold} AS part FROM cleaned WHERE '{d}' IN (SELECT domain FROM gate)")
    return f"""WITH {V.CLEANED}, gate AS (SELECT domain FROM cleaned GROUP BY domain
        HAVING count(DISTINCT family) >= (SELECT count(DISTINCT family) FROM cleaned) AND count(*) >= 200),
      parts AS ({' UNION ALL '.join(parts)}),
      sizes AS (SELECT target, count(*) FILTER (part = 'inside') AS inside, count(*) FILTER (part = 'test') AS n,
        count(DISTINCT family) FILTER (part = 'rest') AS labels FROM parts GROUP BY target),
      pool AS (SELECT target, family, count(*) AS c FROM parts WHERE part = 'rest' GROUP BY target, family),
      outside AS (SELECT target, CAST(sum(least(c, inside // labels)) AS BIGINT) AS outside FROM pool JOIN sizes USING (target) GROUP BY target)
    SELECT target AS domain, condition, n, CASE condition WHEN 'in_domain' THEN inside ELSE outside END AS n_train, 0::BIGINT AS flawed
    FROM sizes JOIN outside USING (target), (VALUES ('in_domain'), ('cross_domain')) c(condition)"""


@query("transfer_eval", _sql_transfer())
def transfer_eval(spark, sf):
    preds = E.transfer_eval(_grid(spark), _processed(spark, sf), V.DOMAINS)
    unknown = ~F.col("pred").isin(P.FAMILIES) | F.col("pred").isNull()
    return preds.groupBy("domain", "condition", "n_train").agg(F.count("*").alias("n"), F.count_if(unknown).alias("flawed"))


@query("transfer_accuracy")
def transfer_accuracy(spark, sf):
    preds = E.transfer_eval(_grid(spark), _processed(spark, sf), V.DOMAINS)
    return evaluate.accuracy_n(preds, ["domain", "condition"])


# ---- from margins to labels, importance, ablation: scorers that SQL can say -----------------------

CLASSES = range(len(P.FAMILIES))
SQL_MARGINS = "[" + ", ".join(f"({V.sql_bucket(k, 'row_id', n=2000)} - 1000) / 250.0" for k in CLASSES) + "]"


@query(
    "predict_batch",
    f"""WITH {V.ANSWERS}, m AS (SELECT row_id, CAST({SQL_MARGINS} AS DOUBLE[]) AS m FROM answers),
      e AS (SELECT row_id, [exp(x - list_max(m)) FOR x IN m] AS e FROM m),
      p AS (SELECT row_id, [x / list_sum(e) FOR x IN e] AS p FROM e)
    SELECT row_id, {V.sql_list(P.FAMILIES)}[list_position(p, list_max(p))] AS pred,
      {', '.join(f"round(p[{k + 1}], 6) AS p{k}" for k in CLASSES)} FROM p""",
)
def predict_batch(spark, sf):
    """Margins to probabilities to labels, on margins drawn by hash."""
    margins = F.array(*[(bucket(k, F.col("row_id").cast("string"), n=2000) - 1000) / F.lit(250.0) for k in CLASSES])
    rows = V.answers(spark, sf).select("row_id", margins.alias("margins"))
    preds = learn.predict_margins(rows, "margins", P.FAMILIES, ["row_id"])
    return preds.select("row_id", "pred", *[F.round(F.element_at("probs", k + 1), 6).alias(f"p{k}") for k in CLASSES])


@query("predict_batch_fitted")
def predict_batch_fitted(spark, sf):
    train, _, test = E.split_parts(_processed(spark, sf))
    preds = E.experiment_grid(_grid(spark), [E.Run("linear", "input")], train, {"test": test})
    return preds.select("test_set", "row_id", "true", "pred", F.to_json("probs").alias("probs"))


def _rule(numbers):
    """A label by a sum of whole numbers."""
    names = F.array(*[F.lit(x) for x in P.FAMILIES])
    return F.element_at(names, (F.pmod(numbers, F.lit(len(P.FAMILIES))) + 1).cast("int"))


def _feature_rule(rows, keep):
    """A label that every feature has a say in."""
    numbers = [F.floor(F.element_at("x", i + 1) * 8) * (i + 1) for i in range(len(FEATURES))]
    return rows.select(*keep, _rule(sum(numbers[1:], numbers[0])).alias("pred"))


def _sql_importance(repeats: int = 5) -> str:
    def vector(swapped: int | None) -> str:
        return " + ".join(f"floor({'d' if i == swapped else 'b'}.{n} * 8)::BIGINT * {i + 1}" for i, n in enumerate(FEATURES))

    def hit(swapped: int | None) -> str:
        return f"avg(({V.sql_list(P.FAMILIES)}[({vector(swapped)}) % {len(P.FAMILIES)} + 1] = b.family)::INT)"

    place = f"row_number() OVER (PARTITION BY r ORDER BY md5(r || '|' || row_id), CAST(row_id AS VARCHAR)) - 1"
    each = " UNION ALL ".join(f"SELECT '{n}' AS feature, whole - a{i} AS lost FROM hits" for i, n in enumerate(FEATURES))
    return f"""WITH {V.ANSWERS}, {sql_style('answers', 'output', 'row_id, family')},
      orders AS (SELECT row_id, r, {place} AS place FROM style, range(0, {repeats + 1}) t(r)),
      donors AS (SELECT place, s.* FROM orders JOIN style s USING (row_id) WHERE r = 0),
      hits AS (SELECT r, {hit(None)} AS whole, {', '.join(f'{hit(i)} AS a{i}' for i in range(len(FEATURES)))}
        FROM orders o JOIN style b ON b.row_id = o.row_id JOIN donors d ON d.place = o.place WHERE o.r > 0 GROUP BY r)
    SELECT feature, round(avg(lost), 6) AS importance FROM ({each}) GROUP BY feature"""


@query("permutation_importance", _sql_importance())
def permutation_importance(spark, sf):
    rows = style_features(V.answers(spark, sf).select("row_id", "family", "output"))
    told = explain.permutation_importance(_feature_rule, rows, "row_id", names=FEATURES)
    return told.select("feature", F.round("importance", 6).alias("importance"))


@query("permutation_importance_fitted")
def permutation_importance_fitted(spark, sf):
    train, _, test = E.split_parts(_processed(spark, sf))
    clf = E.model_of(_grid(spark), E.Run("style"), train, {"test": test})
    features = style_features(test.select("row_id", "family", "output"))
    return explain.permutation_importance(clf, features, "row_id")


def _text_rule(rows, keep):
    """A label that case, marks, white space and lengths have a say in."""
    marks = F.length("output") - F.length(F.translate("output", "*#|\n—’🚀ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return rows.select(*keep, _rule(F.length("output") + 3 * marks + 5 * F.length("input")).alias("pred"))


def _sql_text_ablation() -> str:
    def one(variant: str, output: str, inp: str) -> str:
        return f"SELECT family, '{variant}' AS variant, {output} AS output, {inp} AS input FROM cleaned"

    parts = [one(v, SQL_ABLATIONS[v]("output"), "input") for v in X.ABLATIONS] + [one("no_masking", "output_raw", "input_raw")]
    marks = "length(output) - length(translate(output, '*#|' || chr(10) || '—’🚀ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))"
    return f"""WITH {V.CLEANED}, v AS ({' UNION ALL '.join(parts)})
      SELECT variant, avg(({V.sql_list(P.FAMILIES)}[(length(output) + 3 * ({marks}) + 5 * length(input)) % {len(P.FAMILIES)} + 1] = family)::INT) AS accuracy,
        count(*) AS n FROM v GROUP BY variant"""


@query("test_time_ablation", _sql_text_ablation())
def test_time_ablation(spark, sf):
    return E.test_time_ablation(_grid(spark), _text_rule, V.cleaned(spark, sf))


@query("test_time_ablation_fitted")
def test_time_ablation_fitted(spark, sf):
    train, _, test = E.split_parts(_processed(spark, sf))
    clf = E.model_of(_grid(spark), E.Run("linear"), train, {"test": test})
    return E.test_time_ablation(_grid(spark), clf, test)


@query("top_class_terms_fitted")
def top_class_terms_fitted(spark, sf):
    return E.explain_terms(_grid(spark), _processed(spark, sf), "input", 12)


# ---- reports over weight tables -----------------------------------------------------------------

# Share of a token's uses that fall in texts of a family.
SQL_WEIGHTS = f"""tokens AS (SELECT row_id, family AS label, unnest({sql_word_tokens('output')}) AS token FROM answers),
  weights AS (SELECT label, token, count(*) / any_value(n) AS weight
    FROM tokens JOIN (SELECT token, count(*) AS n FROM tokens GROUP BY token) USING (token) GROUP BY label, token)"""


def _weights(rows):
    tokens = X.word_tokens("output")
    counts = rows.select(F.col("family").alias("label"), F.explode(tokens).alias("token"))
    counts = counts.groupBy("label", "token").agg(F.count("*").alias("_n"))
    totals = counts.groupBy("token").agg(F.sum("_n").alias("_all"))
    return counts.join(totals, "token").select("label", "token", (F.col("_n") / F.col("_all")).alias("weight"))


@query(
    "top_class_terms",
    f"""WITH {V.ANSWERS}, {SQL_WEIGHTS} SELECT label, token AS term, weight,
      CAST(row_number() OVER (PARTITION BY label ORDER BY weight DESC, token) AS INT) AS rank FROM weights QUALIFY rank <= 20""",
)
def top_class_terms(spark, sf):
    weights = _weights(V.answers(spark, sf)).withColumnRenamed("token", "term")
    return explain.top_class_terms(weights, 20)


@query(
    "token_saliency",
    f"""WITH {V.ANSWERS}, {SQL_WEIGHTS},
      hits AS (SELECT row_id, label, token, count(*) AS hits FROM tokens GROUP BY ALL),
      w AS (SELECT *, sum(hits * weight) OVER (PARTITION BY row_id) AS mass, sum(hits) OVER (PARTITION BY row_id) AS len
        FROM hits JOIN weights USING (label, token)),
      s AS (SELECT label, token, CAST(sum(hits) AS BIGINT) AS hits, sum(hits * weight * len / mass) / sum(hits) AS s FROM w
        GROUP BY ALL HAVING sum(hits) >= 30)
    SELECT label, token, hits, round_even(s * 100, 0) / 100 AS saliency,
      CAST(row_number() OVER (PARTITION BY label ORDER BY round(s, 9) DESC, token) AS INT) AS rank FROM s QUALIFY rank <= 15""",
)
def token_saliency(spark, sf):
    rows = V.answers(spark, sf).select("row_id", "family", "output")
    return explain.token_saliency(rows, _weights(rows), "row_id")


@query("token_saliency_fitted")
def token_saliency_fitted(spark, sf):
    grid = _grid(spark)
    train, _, test = E.split_parts(_processed(spark, sf))
    done = E.run_all(grid, [E.Job(E.Run("linear"), train, {"test": test})])
    weights = E.stored_terms(grid, spark, done[0].run_key).filter("block = 'word'")
    positive = weights.select("label", F.col("term").alias("token"), F.greatest("weight", F.lit(0.0)).alias("weight"))
    return explain.token_saliency(test, positive, "row_id")
