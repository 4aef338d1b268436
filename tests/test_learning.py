"""Fitted models: better than chance where there is a signal, at chance where there is none."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from stylograph.operators import certify, evaluate, explain, learn
from stylograph.operators.tfidf import Block
from stylograph.functions.style import style_features
from stylograph.plans import experiments as E
from stylograph.plans import prepare

LABELS = ["Claude", "GPT", "Qwen"]
SETTINGS = E.Settings(
    max_iter=30, style_rounds=3, time_rounds=2, depth=3,
    blocks=(Block("word", (1, 2), 500, 2), Block("char", (2, 5), 800, 3)),
)
WORDS = "the result is because value function clearly we see rain sort code line".split()


@pytest.fixture(scope="module")
def processed(spark):
    """Pairs of answers to one prompt, each family with a habit of its own."""
    habits = {"Claude": "I would say {}\n\n- point — one", "GPT": "Great question! {}\n\n---\n**Key**", "Qwen": "### Answer\n\n{}\n\n1. step"}
    models = {"Claude": "claude-3", "GPT": "gpt-4.1", "Qwen": "qwen3"}
    rows = []
    for i in range(150):
        h = hashlib.md5(str(i).encode()).digest()
        for j in (0, 1):
            family = LABELS[(h[0] + j) % 3]
            body = " ".join(WORDS[b % len(WORDS)] for b in h[1 + j :])
            prompt = "please write about " + " ".join(WORDS[b % len(WORDS)] for b in h[:4]) + f" {i}"
            ts = f"2025-0{1 + h[2] % 6}-1{h[3] % 9} 0{h[4] % 9}:00:00"
            pid = hashlib.md5(prompt.encode()).hexdigest()[:16]
            domain = ["code", "general"][h[5] % 2]
            rows.append((2 * i + j, pid, models[family], family, domain, ts, prompt, habits[family].format(body)))
    schema = "row_id long, prompt_id string, model string, family string, domain string, ts string, input string, output string"
    df = spark.createDataFrame(rows, schema).withColumn("timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts")
    return prepare.processed_rows(df, row_id=["row_id"]).cache()


@pytest.fixture
def grid(tmp_path):
    return E.Grid(str(tmp_path / "results"), tuple(LABELS), SETTINGS)


def test_identify(grid, processed):
    got = E.identify(grid, processed, [0])
    accuracy = {r.kind: r["mean"] for r in got["summary"].filter("metric = 'accuracy'").collect()}
    assert accuracy["linear"] > 0.9 and accuracy["style"] > 0.9
    assert {r.kind for r in got["lengths"].collect()} == {r.kind for r in got["slices"].collect()} == {"linear", "style"}
    assert got["lengths"].count() <= 8 and got["models"].count() == 6 and got["best"].count() == 2
    assert {r.label for r in got["recall"].collect()} == set(LABELS)


def test_prompt_alone_says_nothing(grid, processed):
    got = E.compare_fields(grid, processed)
    accuracy = {(r.field, r.test_set): r.accuracy for r in got["accuracy"].collect()}
    assert accuracy["output", "test"] > 0.9 and accuracy["both", "test"] > 0.9
    assert accuracy["input", "test"] < 0.7
    # both answers to a prompt must get the same guess, so at most half are right
    assert got["agreement"].first().agreement == 1.0
    assert accuracy["input", "test_matched"] <= 0.5


def test_finished_runs_are_not_fitted_again(grid, processed, monkeypatch):
    train, _, test = E.split_parts(processed)
    todo = [E.Run("linear", "input"), E.Run("style")]
    first = E.experiment_grid(grid, todo, train, {"test": test}).select("run_key", "row_id", "pred").collect()
    monkeypatch.setattr(E, "fit_on", lambda *a: pytest.fail("fitted again"))
    again = E.experiment_grid(grid, todo, train, {"test": test}).select("run_key", "row_id", "pred").collect()
    assert sorted(first) == sorted(again) and len({r.run_key for r in first}) == 2
    with pytest.raises(BaseException, match="fitted again"):
        E.experiment_grid(grid, todo, train.filter("row_id > 3"), {"test": test})


def test_a_run_is_done_again_when_what_it_reads_changes(grid, processed):
    train, _, test = E.split_parts(processed)
    todo = [E.Run("linear", "input"), E.Run("linear", variant="no_masking"), E.Run("style"), E.Run("time", "time")]

    def keys(df):
        return [r.run_key for r in sorted(E.plan_runs(grid, [E.Job(r, df, {"test": test}) for r in todo])[0].collect(), key=lambda r: (r.kind, r.variant))]

    before = keys(train)  # linear unmasked, linear on the input, style, time
    changes = {
        "timestamp": F.expr("timestamp + INTERVAL 1 DAY"), "output_raw": F.concat("output_raw", F.lit("!")),
        "input": F.concat("input", F.lit("!")), "output": F.concat("output", F.lit("!")), "row_id": F.col("row_id") + 1_000,
    }
    changed = {c: [a != b for a, b in zip(before, keys(train.withColumn(c, e)))] for c, e in changes.items()}
    assert changed["timestamp"] == [False, False, False, True]
    assert changed["output_raw"] == [True, False, False, False]
    assert changed["input"][1] and not changed["input"][3]
    assert changed["output"][2] and not changed["output"][1]
    assert changed["row_id"] == [True] * 4


def test_labels_are_those_that_occur(grid, processed):
    wide = replace(grid, labels=("Claude", "Gemini", "GPT", "Qwen"))
    assert E.with_known_labels(wide, processed).labels == ("Claude", "GPT", "Qwen")


def test_stored_model_scores_alike(spark, grid, processed):
    train, _, test = E.split_parts(processed)
    for run in (E.Run("linear", "input"), E.Run("style")):
        stored = E.model_of(grid, run, train, {"test": test})
        fresh = E.fit(grid, run, train)
        a, b = ({r.row_id: r.pred for r in learn.score(c, {"test": test}).collect()} for c in (stored, fresh))
        assert a == b


def test_same_fit_twice_and_probabilities(grid, processed):
    train, _, test = E.split_parts(processed)
    runs = [learn.score(E.fit(grid, E.Run(kind), train), {"test": test}) for kind in ("linear", "linear", "style")]
    a, b, trees = ({r.row_id: (r.pred, r.probs) for r in df.collect()} for df in runs)
    assert {k: v[0] for k, v in a.items()} == {k: v[0] for k, v in b.items()}
    for pred, probs in [*a.values(), *trees.values()]:
        assert sum(probs) == pytest.approx(1.0) and pred == LABELS[probs.index(max(probs))]


def test_transfer_scores_the_same_rows(grid, processed):
    preds = E.transfer_eval(grid, processed, ["code", "general"], minimum=50)
    n = {(r.domain, r.condition): r.n for r in evaluate.accuracy_n(preds, ["domain", "condition"]).collect()}
    assert n["code", "in_domain"] == n["code", "cross_domain"] > 0
    tables = E.transfer_tables(preds, LABELS, ["code", "general"])
    assert tables["recall_drop"].count() == 3 and tables["drop"].count() == 2


def test_ablations(grid, processed):
    table = {r.variant: r for r in E.ablations(grid, processed, ["none", "all_structure_removed", "no_masking"]).collect()}
    assert table["none"].refit_change == 0 and table["none"].test_time_change == 0
    assert table["none"].test_time == pytest.approx(table["none"].refit_mean)
    assert table["all_structure_removed"].test_time <= table["none"].test_time


def test_explanations(spark, grid, processed):
    train, _, test = E.split_parts(processed)
    clf = E.fit(grid, E.Run("linear"), train)
    weights = explain.coefficient_table(spark, clf)
    top = explain.top_class_terms(weights, 5)
    assert top.count() == 5 * len(LABELS)
    terms = {r.label: r.terms for r in top.groupBy("label").agg(F.collect_list("term").alias("terms")).collect()}
    assert any("-" in t or "—" in t or "I" in t for t in terms["Claude"])
    words = weights.filter("block = 'word'").select("label", F.col("term").alias("token"), F.greatest("weight", F.lit(0.0)).alias("weight"))
    saliency = explain.token_saliency(test, words, "row_id", min_count=3, k=4).collect()
    assert saliency and all(r["rank"] <= 4 and r.hits >= 3 for r in saliency)


def test_permutation_importance(grid, processed):
    # with one tree the classes rest on few features; more trees use features that stand in
    # for each other, and shuffling one of them then costs little
    one_round = replace(grid, settings=replace(SETTINGS, style_rounds=1))
    train, _, test = E.split_parts(processed)
    clf = E.fit(one_round, E.Run("style"), train)
    rows = style_features(test.select("row_id", "family", "output"))
    got = {r.feature: r.importance for r in explain.permutation_importance(clf, rows, "row_id", repeats=2).collect()}
    assert len(got) == 27 and max(got.values()) > 0.1
    assert got["latex"] == 0 and got["code_fences"] == 0  # the same value in every row


def test_many_rows_are_fitted_on_packed_blocks(spark, processed, monkeypatch):
    """The same optimum as in the span of the rows, without Spark ML's optimizer, also where sums come in slices and a class is missing."""
    train, _, test = E.split_parts(processed)
    data = learn.prepare_linear_text(train, LABELS, blocks=SETTINGS.blocks)
    span = learn.fit_linear(data)
    monkeypatch.setattr(learn.wide, "MOST_ROWS", 0)
    monkeypatch.setattr(learn.LogisticRegression, "fit", lambda *a: pytest.fail("rows of vectors are read in every step"))
    clf = learn.fit_linear(data)
    monkeypatch.setattr(learn.packed, "SUMMED", 0)
    sliced = learn.fit_linear(data)
    for told in (clf, sliced):
        assert all(r.gradient < 0.02 * r.at_start for r in certify.gradient(told, data).collect())
    assert np.allclose(clf.model.weights, sliced.model.weights, atol=1e-3)
    a, b = ({r.row_id: r.pred for r in learn.score(c, {"test": test}).collect()} for c in (span, clf))
    assert sum(a[k] == b[k] for k in a) >= 0.95 * len(a)
    vectors = {r.row_id: r.probs for r in learn.predict_batch(clf, clf.vectors(test, ["row_id"]), ["row_id"]).collect()}
    assert all(r.probs == pytest.approx(vectors[r.row_id]) for r in learn.score(clf, {"test": test}).collect())
    two = learn.prepare_linear_text(train.filter("family <> 'Qwen'"), LABELS, blocks=SETTINGS.blocks)
    assert learn.fit_linear(two).model.weights.shape[0] == 2
    unknown = learn.prepare_linear_text(train.withColumn("family", F.lit(None).cast("string")), LABELS, blocks=SETTINGS.blocks)
    with pytest.raises(ValueError, match="null"):
        learn.fit_linear(unknown)
