"""Classifiers fitted with Spark ML, and predictions as plain rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel, OneVsRest, OneVsRestModel, RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.style import FEATURES, style_features
from ..functions.text import field_view
from ..session import materialize, shared_dir
from . import packed, wide
from .compare import time_features
from .tfidf import CHARS, WORDS, Block, FittedBlock, as_packed, as_vectors, fit_blocks
from .tfidf import margins as text_margins

TIME_FEATURES = ["day", "hour"]
PARALLEL_FITS = 4
MODELS = {m.__name__: m for m in (LogisticRegressionModel, OneVsRestModel, RandomForestClassificationModel, wide.WideModel)}
ABOUT = "kind string, labels array<string>, mode string, features array<string>"
BLOCKS = "offset int, name string, sizes array<int>, max_terms int, min_df int, terms array<string>, idf array<double>"
FOREST_DEPTH, BOOSTED_DEPTH = 10, 5
TOLERANCE = 1e-4


def label_index(labels: list[str], label: str = "family") -> Column:
    """Position of the label in the fixed list, as the number Spark ML trains on."""
    return (F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label)) - 1).cast("double")


@dataclass
class Classifier:
    """A fitted model with what it takes to score new rows."""

    model: Model | wide.WideModel
    labels: list[str]
    mode: str = "output"
    features: list[str] = field(default_factory=list)
    blocks: list[FittedBlock] = field(default_factory=list)

    def vectors(self, df: DataFrame, carry: list[str]) -> DataFrame:
        if self.blocks:
            return as_vectors(df.withColumn("_field", field_view(self.mode)), "_field", self.blocks, carry)
        return VectorAssembler(inputCols=self.features, outputCol="features").transform(df)


    def save(self, path: str) -> None:
        """The model by its own writer, and beside it what it takes to score."""
        if isinstance(self.model, wide.WideModel):
            self.model.save(f"{path}/model")
        else:
            self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        about = [(type(self.model).__name__, self.labels, self.mode, self.features)]
        spark.createDataFrame(about, ABOUT).write.mode("overwrite").parquet(f"{path}/about")
        blocks = [
            (f.offset, f.block.name, list(f.block.sizes), f.block.max_terms, f.block.min_df, f.terms, f.idf) for f in self.blocks
        ]
        spark.createDataFrame(blocks, BLOCKS).write.mode("overwrite").parquet(f"{path}/blocks")
        if self.blocks:  # for whoever reads the weights, not the model
            coefficient_table(spark, self).write.mode("overwrite").parquet(f"{path}/terms")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Classifier:
        about = spark.read.parquet(f"{path}/about").first()
        blocks = [
            FittedBlock(Block(r.name, tuple(r.sizes), r.max_terms, r.min_df), r.terms, r.idf, r.offset)
            for r in spark.read.schema(BLOCKS).parquet(f"{path}/blocks").orderBy("offset").collect()
        ]
        return cls(MODELS[about.kind].load(f"{path}/model"), about.labels, about.mode, about.features, blocks)


def coefficient_table(spark: SparkSession, clf: Classifier) -> DataFrame:
    """(label, block, term, weight) of a linear text model; labels x terms rows."""
    matrix = clf.model.coefficientMatrix.toArray()
    terms = [(f.block.name, t) for f in clf.blocks for t in f.terms]
    # fitted parameters, already on the driver: an array per label, taken apart by the executors
    rows = [(label, matrix[k].tolist()) for k, label in enumerate(clf.labels[: matrix.shape[0]])]
    names = spark.createDataFrame([([b for b, _ in terms], [t for _, t in terms])], "blocks array<string>, terms array<string>")
    weights = spark.createDataFrame(rows, "label string, weights array<double>")
    # one row of names
    together = weights.crossJoin(F.broadcast(names))
    each = F.arrays_zip(F.col("blocks").alias("block"), F.col("terms").alias("term"), F.col("weights").alias("weight"))
    return together.select("label", F.explode(each).alias("e")).select("label", "e.*")


def probabilities(margins: Column | str, kind: str = "linear") -> Column:
    """Class probabilities of an array of margins.

    ``linear``: soft-max, from which the largest margin is taken off first, so that no power overflows.  ``forest``: shares of the votes.
    ``one_vs_rest``: each margin squashed by itself, then scaled to sum 1.  All margins of a row equal (zero votes too) give equal shares.
    """
    margins = F.col(margins) if isinstance(margins, str) else margins
    if kind == "linear":
        top = F.array_max(margins)
        raw = F.transform(margins, lambda x: F.exp(x - top))
    elif kind == "one_vs_rest":
        raw = F.transform(margins, lambda x: 1.0 / (1.0 + F.exp(-2.0 * x)))
    elif kind == "forest":
        raw = margins
    else:
        raise ValueError(f"unknown kind {kind!r}")
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raw, lambda x: F.coalesce(F.try_divide(x, total), 1.0 / F.size(margins)))


def best_label(values: Column | str, labels: list[str]) -> Column:
    """The first label with the highest value."""
    names = F.array(*[F.lit(x) for x in labels])
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


def predict_margins(rows: DataFrame, margins: str, labels: list[str], keep: list[str], kind: str = "linear") -> DataFrame:
    """(keep, pred, probs) of rows with an array of margins, whatever made them."""
    scored = rows.select(*keep, probabilities(margins, kind).alias("probs"))
    return scored.withColumn("pred", best_label("probs", labels))


def predict_batch(clf: Classifier, vectors: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, pred, probs): class probabilities and the first class with the highest one."""
    if isinstance(clf.model, wide.WideModel):
        return predict_margins(clf.model.margins(vectors, keep), "_margins", clf.labels, keep)
    kinds = {LogisticRegressionModel: "linear", RandomForestClassificationModel: "forest", OneVsRestModel: "one_vs_rest"}
    margins = clf.model.transform(vectors).select(*keep, vector_to_array("rawPrediction").alias("_margins"))
    return predict_margins(margins, "_margins", clf.labels, keep, kinds[type(clf.model)])


def predict_texts(clf: Classifier, df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, pred, probs) of rows with ``input`` and ``output`` by a text classifier; margins come straight from the texts."""
    if not isinstance(clf.model, wide.WideModel):  # stored by an earlier version
        return predict_batch(clf, clf.vectors(df, keep), keep)
    texts = df.withColumn("_field", field_view(clf.mode))
    told = text_margins(texts, "_field", clf.blocks, clf.model.weights, clf.model.intercepts, keep)
    return predict_margins(told, "_margins", clf.labels, keep)


@dataclass
class Prepared:
    """Training vectors, written once, with what a classifier fitted on them needs besides."""

    vectors: DataFrame  # label, features
    labels: list[str]
    mode: str = "output"
    features: list[str] = field(default_factory=list)
    blocks: list[FittedBlock] = field(default_factory=list)


class PreparedText(Prepared):
    """Training texts with their fitted blocks; packed blocks or vectors are written when a fit or a check first asks for them."""

    def __init__(self, text: DataFrame, labels: list[str], mode: str, label: str, blocks: list[FittedBlock]):
        self.text, self.labels, self.mode, self.label, self.blocks = text, labels, mode, label, blocks
        self.features = []

    @cached_property
    def vectors(self) -> DataFrame:
        return as_vectors(self.text, "_field", self.blocks, [self.label]).withColumn("label", label_index(self.labels, self.label))

    @cached_property
    def packed(self) -> packed.Packed:
        return as_packed(self.text, "_field", self.blocks, label_index(self.labels, self.label))


def prepare_linear_text(
    train: DataFrame, labels: list[str], mode: str = "output", label: str = "family", blocks: tuple[Block, ...] = (WORDS, CHARS)
) -> Prepared:
    """Word and character TF-IDF of one field.

    The field is derived once: every block's terms, the packed blocks and the vectors read it.
    """
    text = materialize(train.select(label, field_view(mode).alias("_field")), "field")
    return PreparedText(text, labels, mode, label, fit_blocks(text, "_field", blocks))


def fit_linear(data: PreparedText, strength: float = 4.0, max_iter: int = 2000, tol: float = TOLERANCE) -> Classifier:
    """Multinomial logistic regression on prepared texts.

    ``strength`` weighs the loss against half the squared coefficients, so the penalty of a mean loss is
    1 / (strength * n).  The loss is strictly convex, so there is one best model; tables with few rows are fitted in
    the span of their rows (``wide``), others on packed blocks (``packed``), which is the same one.
    """
    n = data.text.count()
    if n <= wide.MOST_ROWS and n < sum(f.size for f in data.blocks):
        lr = LogisticRegression(
            family="multinomial", maxIter=max_iter, regParam=1.0 / (strength * n), elasticNetParam=0.0, standardization=False, tol=tol,
        )
        model = wide.fit_in_span(data.vectors, lr)
    else:
        model = packed.fit(data.packed, strength, max_iter, tol)
    return Classifier(model, data.labels, data.mode, blocks=data.blocks)


def fit_linear_text(
    train: DataFrame, labels: list[str], mode: str = "output", label: str = "family", strength: float = 4.0,
    max_iter: int = 2000, blocks: tuple[Block, ...] = (WORDS, CHARS),
) -> Classifier:
    """Multinomial logistic regression on word and character TF-IDF of one field.

    Packed blocks are written once: every optimizer step reads them, none repeats the text work.
    """
    return fit_linear(prepare_linear_text(train, labels, mode, label, blocks), strength, max_iter)


def _fit_boosted(vectors: DataFrame, rounds: int, rate: float, depth: int, seed: int) -> Model:
    context = vectors.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        # boosting cuts its growing lineage there every few rounds
        context.setCheckpointDir(shared_dir(vectors.sparkSession))
    trees = GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed, maxBins=64)
    # the classes' boosters are independent: several at a time keep the executors busy
    return OneVsRest(classifier=trees, parallelism=PARALLEL_FITS).fit(vectors)


def _fit_forest(vectors: DataFrame, trees: int, depth: int, seed: int) -> Model:
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, featureSubsetStrategy="sqrt")
    return forest.fit(vectors)


def prepare_numbers(train: DataFrame, labels: list[str], features: list[str], label: str = "family") -> Prepared:
    """Vectors of numeric columns."""
    numbered = train.withColumn("label", label_index(labels, label)).select("label", *features)
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(numbered)
    return Prepared(materialize(vectors.select("label", "features"), "vectors"), labels, features=features)


def fit_prepared_trees(
    data: Prepared, rounds: int = 300, rate: float = 0.08, depth: int | None = None, seed: int = 0, boosted: bool = False
) -> Classifier:
    """A forest of ``rounds`` trees on prepared vectors, all classes at once.

    ``boosted`` fits one booster per class instead (Spark's booster knows two classes): as many jobs
    in sequence as rounds times depth, for about the same accuracy.
    """
    if boosted:
        model = _fit_boosted(data.vectors, rounds, rate, depth or BOOSTED_DEPTH, seed)
    else:
        model = _fit_forest(data.vectors, rounds, depth or FOREST_DEPTH, seed)
    return Classifier(model, data.labels, features=data.features)


def fit_trees(
    train: DataFrame, labels: list[str], features: list[str], label: str = "family", rounds: int = 300,
    rate: float = 0.08, depth: int | None = None, seed: int = 0, boosted: bool = False,
) -> Classifier:
    """``fit_prepared_trees`` on numeric columns."""
    return fit_prepared_trees(prepare_numbers(train, labels, features, label), rounds, rate, depth, seed, boosted)


def fit_style_trees(
    train: DataFrame, labels: list[str], label: str = "family", text: str = "output", rounds: int = 300,
    rate: float = 0.08, seed: int = 0, depth: int | None = None, boosted: bool = False,
) -> Classifier:
    """Trees on the 27 style features alone."""
    return fit_trees(style_features(train, text), labels, FEATURES, label, rounds, rate, depth, seed, boosted)


def fit_time_trees(
    train: DataFrame, labels: list[str], label: str = "family", ts: str = "timestamp", rounds: int = 200,
    rate: float = 0.1, seed: int = 0, depth: int | None = None, boosted: bool = False,
) -> Classifier:
    """Trees on day and hour alone: a control for leakage through time."""
    return fit_trees(time_features(train, ts), labels, TIME_FEATURES, label, rounds, rate, depth, seed, boosted)


def score(
    clf: Classifier, tests: dict[str, DataFrame], row_id: str = "row_id", label: str = "family",
    text: str = "output", ts: str = "timestamp",
) -> DataFrame:
    """Prediction rows (test_set, row_id, true, pred, probs) of all test sets, in one plan."""
    out = None
    for name, df in tests.items():
        if clf.features == FEATURES:
            df = style_features(df, text)
        elif clf.features == TIME_FEATURES:
            df = time_features(df, ts)
        keep = [row_id, label]
        told = predict_texts(clf, df, keep) if clf.blocks else predict_batch(clf, clf.vectors(df, keep), keep)
        rows = told.select(
            F.lit(name).alias("test_set"), F.col(row_id).alias("row_id"), F.col(label).alias("true"), "pred", "probs"
        )
        out = rows if out is None else out.unionByName(rows)
    return out
