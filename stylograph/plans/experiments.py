"""Experiment grids: identify, compare fields, transfer across domains, ablate and explain.

Each run fits on the cluster and writes its prediction rows to one table.  All metrics of all runs
are then aggregates over that table; finished runs are found by key and not fitted again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import asdict, dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X
from ..functions.style import FEATURES, style_features
from ..operators import compare, evaluate, explain, learn, runs
from ..operators.tfidf import CHARS, WORDS, Block
from ..sources.tables import known_labels

RUN = ["run_key", "kind", "field", "variant", "seed"]
PARALLEL_RUNS = 4  # fits under way at a time


@dataclass(frozen=True)
class Settings:
    """Model sizes."""

    max_iter: int = 2000
    strength: float = 4.0
    blocks: tuple[Block, ...] = (WORDS, CHARS)
    style_rounds: int = 300
    time_rounds: int = 200
    depth: int | None = None


FULL = Settings()


@dataclass(frozen=True)
class Run:
    """One fit: kind 'linear', 'style' or 'time', a field, a text variant and a seed."""

    kind: str
    field: str = "output"
    variant: str = "none"
    seed: int = 0


@dataclass(frozen=True)
class Grid:
    """Where results live and which row columns play which part."""

    path: str
    labels: tuple[str, ...] = tuple(P.FAMILIES)
    settings: Settings = FULL
    row_id: str = "row_id"
    label: str = "family"
    ts: str = "timestamp"
    parallel: int = PARALLEL_RUNS


def prepare(grid: Grid, run: Run, train: DataFrame) -> learn.Prepared:
    """Training vectors of a run; ``train`` has the run's text variant already."""
    labels = list(grid.labels)
    if run.kind == "linear":
        return learn.prepare_linear_text(train, labels, run.field, grid.label, grid.settings.blocks)
    if run.kind == "style":
        return learn.prepare_numbers(style_features(train, "output"), labels, FEATURES, grid.label)
    if run.kind == "time":
        return learn.prepare_numbers(compare.time_features(train, grid.ts), labels, learn.TIME_FEATURES, grid.label)
    raise ValueError(f"unknown kind {run.kind!r}")


def fit_on(grid: Grid, run: Run, data: learn.Prepared) -> learn.Classifier:
    """The fit of a run on its prepared vectors."""
    s = grid.settings
    if run.kind == "linear":
        return learn.fit_linear(data, s.strength, s.max_iter)
    rounds, rate = (s.style_rounds, 0.08) if run.kind == "style" else (s.time_rounds, 0.1)
    return learn.fit_prepared_trees(data, rounds, rate, s.depth, run.seed)


def fit(grid: Grid, run: Run, train: DataFrame) -> learn.Classifier:
    return fit_on(grid, run, prepare(grid, run, train))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_known_labels(grid: Grid, rows: DataFrame) -> Grid:
    """The grid with the labels that occur, in their given order."""
    found = known_labels(rows, list(grid.labels), grid.label).orderBy("position").collect()  # a row per label
    return replace(grid, labels=tuple(r[grid.label] for r in found))


def columns_read(grid: Grid, run: Run) -> list[str]:
    """What a run's fit and predictions depend on, after the run's text variant."""
    fields = {"input": ["input"], "output": ["output"], "both": ["input", "output"]}
    read = {"linear": fields.get(run.field, []), "style": ["output"], "time": [grid.ts]}[run.kind]
    return [grid.row_id, grid.label, *read]


@dataclass(frozen=True, eq=False)
class Job:
    """A run with the rows it is fitted on and those it is scored on, before the run's text variant."""

    run: Run
    train: DataFrame
    tests: dict[str, DataFrame]

    def view(self, grid: Grid) -> tuple:
        """Jobs with equal views are fitted on the same vectors."""
        return id(self.train), self.run.kind, self.run.variant, *columns_read(grid, self.run)

    def fit_key(self, grid: Grid) -> tuple:
        """Jobs with equal keys have the same model: a linear fit has one optimum, whatever its seed."""
        return *self.view(grid), None if self.run.kind == "linear" else self.run.seed


def changed(df: DataFrame, variant: str) -> DataFrame:
    return df if variant == "none" else X.ablate(df, variant)


def plan_runs(grid: Grid, jobs: list[Job]) -> tuple[DataFrame, DataFrame]:
    """(all runs with their keys and n_train, those without stored results), in tables of a row per job.

    The fingerprints of everything that any job reads are one action.
    """
    spark = jobs[0].train.sparkSession
    views: dict[tuple, tuple[int, DataFrame]] = {}
    of = []
    for job in jobs:
        columns = tuple(columns_read(grid, job.run))
        parts = {}
        for name, df in {"train": job.train, **job.tests}.items():
            parts[name] = (id(df), job.run.variant, columns)
            views.setdefault(parts[name], (len(views), df))
        of.append(parts)
    prints = None
    for (_, variant, columns), (i, df) in views.items():
        one = runs.dataset_fingerprint(changed(df, variant), list(columns)).select(F.lit(i).alias("view"), "n", "fingerprint")
        prints = one if prints is None else prints.unionByName(one)
    found = {r.view: r for r in prints.collect()}  # a row per table that is read
    settings = runs.params_text({**asdict(grid.settings), "labels": grid.labels})
    rows = []
    for i, (job, parts) in enumerate(zip(jobs, of)):
        r, seen = job.run, {name: found[views[p][0]] for name, p in parts.items()}
        data = runs.params_text({name: x.fingerprint for name, x in seen.items()})
        rows.append((i, r.kind, r.field, r.variant, r.seed, settings, data, seen["train"].n))
    table = spark.createDataFrame(
        rows, "job int, kind string, field string, variant string, seed int, settings string, fingerprint string, n_train long"
    )
    keyed = runs.run_key(table, ["kind", "field", "variant", "seed", "settings"]).select("job", *RUN, "n_train")
    # a row per run: its key is worked out once
    keyed = spark.createDataFrame(keyed.collect(), keyed.schema)
    done = _stored(spark, f"{grid.path}/runs")
    return keyed, keyed if done is None else runs.skip_done_runs(keyed, done).select(*keyed.columns)


def run_all(grid: Grid, jobs: list[Job]) -> list[Row]:
    """Fits and scores what has no stored results yet; the runs (job, RUN, n_train) in the order of the jobs.

    Runs that read the same rows and columns share one table of vectors, and runs that only differ in the seed of a linear fit share
    the fit.  A fit mostly waits for its driver between short passes over the data, so ``parallel`` of them are under way at a time, each under a
    job group of its own.  A run's rows replace what an interrupted attempt may have left; its entry in the table
    of finished runs comes last.
    """
    spark = jobs[0].train.sparkSession
    keyed, missing = plan_runs(grid, jobs)
    every = sorted(keyed.collect(), key=lambda r: r.job)  # runs, not data rows
    todo: dict[str, Row] = {}
    for row in sorted(missing.collect(), key=lambda r: r.job):
        todo.setdefault(row.run_key, row)
    fits: dict[tuple, list[Row]] = {}
    for row in todo.values():
        fits.setdefault(jobs[row.job].fit_key(grid), []).append(row)
    views = {}
    for rows in fits.values():
        job = jobs[rows[0].job]
        views.setdefault(job.view(grid), job)

    def grouped(what: str, work):
        def start(arg):
            spark.sparkContext.setJobGroup(f"grid-{what}", f"experiment grid: {what}")
            return work(arg)

        return inheritable_thread_target(start)

    def vectors(job: Job) -> learn.Prepared:
        return prepare(grid, job.run, changed(job.train, job.run.variant))

    def one_fit(rows: list[Row]) -> list[Row]:
        job = jobs[rows[0].job]
        clf = fit_on(grid, job.run, prepared[job.view(grid)])
        for row in rows:
            own = jobs[row.job]
            clf.save(f"{grid.path}/models/{row.run_key}")
            tests = {n: changed(t, own.run.variant) for n, t in own.tests.items()}
            scored = learn.score(clf, tests, grid.row_id, grid.label, ts=grid.ts)
            scored = scored.withColumns({c: F.lit(row[c]) for c in RUN})
            # a folder of its own, so that runs do not wait for each other's commits
            scored.write.mode("overwrite").option("compression", "zstd").parquet(f"{grid.path}/predictions/{row.run_key}")
        return rows

    with ThreadPoolExecutor(grid.parallel) as pool:
        prepared = dict(zip(views, pool.map(grouped("vectors", vectors), views.values())))
        for future in as_completed([pool.submit(grouped("fit", one_fit), rows) for rows in fits.values()]):
            done = spark.createDataFrame(future.result(), keyed.schema).drop("job")
            done.write.mode("append").parquet(f"{grid.path}/runs")
    return every


def predictions(grid: Grid, spark: SparkSession, rows: list[Row]) -> DataFrame:
    """Prediction rows (RUN, test_set, row_id, true, pred, probs) of finished runs."""
    return spark.read.parquet(*sorted({f"{grid.path}/predictions/{r.run_key}" for r in rows}))


def experiment_grid(grid: Grid, todo: list[Run], train: DataFrame, tests: dict[str, DataFrame]) -> DataFrame:
    """Prediction rows (RUN, test_set, row_id, true, pred, probs) of all runs of the grid."""
    return predictions(grid, train.sparkSession, run_all(grid, [Job(r, train, tests) for r in todo]))


def stored_model(grid: Grid, spark: SparkSession, run_key: str) -> learn.Classifier:
    return learn.Classifier.load(spark, f"{grid.path}/models/{run_key}")


def stored_terms(grid: Grid, spark: SparkSession, run_key: str) -> DataFrame:
    """(label, block, term, weight): the coefficients of a finished linear run, as stored beside its model."""
    return spark.read.parquet(f"{grid.path}/models/{run_key}/terms")


def model_of(grid: Grid, run: Run, train: DataFrame, tests: dict[str, DataFrame]) -> learn.Classifier:
    """The model of a run: the stored one, fitted first if the run is not done yet."""
    return stored_model(grid, train.sparkSession, run_all(grid, [Job(run, train, tests)])[0].run_key)


def split_parts(processed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(processed.filter(F.col("split") == s) for s in ("train", "val", "test"))


# ---- the four studies -------------------------------------------------------------------------


def identify(grid: Grid, processed: DataFrame, seeds: list[int]) -> dict[str, DataFrame]:
    """Can the label be told from the output?  Metrics, run summaries and accuracy by slice."""
    grid = with_known_labels(grid, processed)
    train, _, test = split_parts(processed)
    todo = [Run("linear"), *[Run("style", seed=s) for s in seeds]]
    preds = experiment_grid(grid, todo, train, {"test": test})
    by = [*RUN, "test_set"]
    scores = evaluate.metrics(preds, list(grid.labels), by)
    accuracy = scores.filter(F.col("metric").isin("accuracy", "macro_f1"))
    facts = test.select(
        F.col(grid.row_id).alias("row_id"), "domain", "is_reasoning", "refusal", "model",
        F.length("output").alias("length"),
    )
    sliced = preds.drop("probs").join(facts, "row_id")
    arm = ["kind", "seed"]
    best = evaluate.select_best_run(
        accuracy.filter("metric = 'macro_f1'").select("kind", "seed", "run_key", F.col("value").alias("macro_f1")),
        "macro_f1", ["kind"],
    )
    return {
        "metrics": scores,
        "summary": evaluate.summarize_runs(accuracy, "value", ["kind", "test_set", "metric"]),
        "recall": evaluate.mean_recall_over_runs(
            scores.filter("metric = 'recall'").select(
                *by, F.col("class").alias("label"), F.col("value").alias("recall")
            ),
            ["kind"],
        ),
        "best": best,
        "slices": evaluate.breakdown(sliced, ["domain", "is_reasoning", "refusal"], arm),
        "lengths": evaluate.breakdown_length_quartile(sliced, "length", arm),
        "models": evaluate.breakdown_model(sliced, by=arm),
    }


def compare_fields(grid: Grid, processed: DataFrame, modes: list[str] = ("input", "output", "both")) -> dict[str, DataFrame]:
    """Does the prompt help?  Accuracy by field on all and on matched rows, pair agreement, time control."""
    grid = with_known_labels(grid, processed)
    train, _, test = split_parts(processed)
    spark = train.sparkSession
    todo = [*[Run("linear", m) for m in modes], Run("time", "time")]
    done = run_all(grid, [Job(r, train, {"test": test}) for r in todo])
    preds = predictions(grid, spark, done).drop("probs")
    # the terms a prompt-only model leans on
    prompt_only = next((r.run_key for r in done if (r.kind, r.field) == ("linear", "input")), None)
    terms = {"input_terms": explain.top_class_terms(stored_terms(grid, spark, prompt_only), 20)} if prompt_only else {}
    keys = test.select(F.col(grid.row_id).alias("row_id"), "prompt_id", "matched_pair")
    marked = preds.join(keys, "row_id")
    inputs = marked.filter((F.col("field") == "input") & F.col("matched_pair"))
    return {
        **terms,
        "accuracy": evaluate.subset_eval(marked, "matched_pair", ["kind", "field"]),
        "agreement": evaluate.pair_agreement(inputs, "prompt_id", ["kind"]),
        "time_span": compare.time_range_by_class(processed, grid.label, grid.ts),
        "timeline": compare.timeline_density(processed, grid.label, grid.ts),
    }


def transfer_eval(
    grid: Grid, processed: DataFrame, domains: list[str], seed: int = 0, minimum: int = 200
) -> DataFrame:
    """Prediction rows with columns ``domain`` and ``condition``: trained in the domain or outside it.

    Domains that lack a label or have fewer than ``minimum`` rows are left out.

    Both conditions score the same held-out rows of the domain; the outside sample matches the
    inside training set in size.  The linear model needs no validation rows and trains on them too.
    """
    grid = with_known_labels(grid, processed)
    fit_for_it = {r.domain for r in compare.domain_gate(processed, len(grid.labels), minimum).collect()}  # a row per domain
    if not fit_for_it.intersection(domains):
        raise ValueError(f"no domain has every label and {minimum} rows")
    jobs, about = [], []
    for d in [d for d in domains if d in fit_for_it]:
        parts = compare.domain_holdout(processed, d, seed)
        inside = parts["train"].unionByName(parts["val"])
        size = inside.agg(F.count("*").alias("n"))
        outside = compare.size_matched_sample(parts["rest"], size, seed, [grid.row_id], grid.label)
        for condition, train in (("in_domain", inside), ("cross_domain", outside)):
            jobs.append(Job(Run("linear", seed=seed), train, {"test": parts["test"]}))
            about.append((d, condition))
    done = run_all(grid, jobs)
    spark = processed.sparkSession
    names = [(r.run_key, d, c, r.n_train) for r, (d, c) in zip(done, about)]
    # a row per run
    names = F.broadcast(spark.createDataFrame(names, "run_key string, domain string, condition string, n_train long"))
    return predictions(grid, spark, done).drop("probs").join(names, "run_key")


def transfer_tables(preds: DataFrame, labels: list[str], domains: list[str]) -> dict[str, DataFrame]:
    by = ["domain", "condition", "kind", "seed"]
    recalls = evaluate.recall_per_class(evaluate.confusion(preds, labels, by), by)
    means = evaluate.mean_recall_over_runs(recalls, ["domain", "condition", "kind"])
    summary = evaluate.summarize_runs(evaluate.accuracy_n(preds, by), "accuracy", by[:-1])
    return {
        "recall_drop": compare.recall_drop_matrix(means.withColumnRenamed("kind", "model"), domains),
        "drop": compare.transfer_drop_error(summary.withColumnRenamed("kind", "model")),
    }


def text_scorer(clf: learn.Classifier) -> explain.Scorer:
    """A text classifier as a scorer of rows with ``input`` and ``output``."""
    return lambda rows, keep: learn.predict_texts(clf, rows, keep)


def test_time_ablation(
    grid: Grid, scorer: learn.Classifier | explain.Scorer, test: DataFrame, variants: list[str] = X.VARIANTS
) -> DataFrame:
    """(variant, accuracy, n) of one scorer on every variant of the test rows, scored in one pass.

    ``scorer`` is a text classifier, or any function that adds ``pred`` to rows with ``input`` and ``output``.
    """
    scorer = text_scorer(scorer) if isinstance(scorer, learn.Classifier) else scorer
    versions = X.ablate_all(test.select(grid.row_id, grid.label, "input", "output", "input_raw", "output_raw"), variants)
    preds = scorer(versions, [grid.label, "variant"])
    return evaluate.accuracy_n(preds.withColumnRenamed(grid.label, "true"), ["variant"])


def ablations(grid: Grid, processed: DataFrame, variants: list[str] = X.VARIANTS) -> DataFrame:
    """Per variant: refitted accuracy, accuracy of the clean model, and both changes to no ablation."""
    grid = with_known_labels(grid, processed)
    train, _, test = split_parts(processed)
    preds = experiment_grid(grid, [Run("linear", variant=v) for v in variants], train, {"test": test})
    refit = evaluate.accuracy_n(preds, ["kind", "variant", "seed"]).select(
        F.col("kind").alias("model"), "variant", F.lit("refit").alias("kind"), "accuracy"
    )
    clean_model = model_of(grid, Run("linear"), train, {"test": test})
    direct = test_time_ablation(grid, clean_model, test, variants).select(
        F.lit("linear").alias("model"), "variant", F.lit("test_time").alias("kind"), "accuracy"
    )
    return compare.ablation_table(refit.unionByName(direct))


def explain_style(grid: Grid, processed: DataFrame, repeats: int = 5) -> dict[str, DataFrame]:
    """Style profile by label and what the style model leans on."""
    grid = with_known_labels(grid, processed)
    train, _, test = split_parts(processed)
    features = style_features(processed.select(grid.label, "output")).drop("output")
    clf = model_of(grid, Run("style"), train, {"test": test})
    rows = style_features(test.select(grid.row_id, grid.label, "output"))
    return {
        **compare.describe(processed, grid.label),
        "profile": compare.style_profile(features, grid.label, FEATURES),
        "importance": explain.permutation_importance(clf, rows, grid.row_id, grid.label, repeats),
    }


def explain_terms(grid: Grid, processed: DataFrame, field: str = "output", k: int = 20) -> DataFrame:
    """The heaviest terms of each label in the linear model of one field."""
    grid = with_known_labels(grid, processed)
    train, _, test = split_parts(processed)
    done = run_all(grid, [Job(Run("linear", field), train, {"test": test})])
    return explain.top_class_terms(stored_terms(grid, processed.sparkSession, done[0].run_key), k)
