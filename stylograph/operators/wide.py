"""Linear fits on tables with fewer rows than terms.

A penalised linear model's best weights are a combination of the training rows: anything at right angles to all of them costs penalty and
changes no margin.  So with n rows and p > n terms the fit has n unknowns a class, not p.  The rows are turned into coordinates of
their own span, in which all inner products and lengths are the same, Spark ML fits there, and the weights are turned
back.  The optimum is the same; an optimizer step sends n numbers a class instead of p, which is what steps take their time for.

Only for tables of at most ``MOST_ROWS`` rows: those are collected as arrays, and their inner products are n x n numbers (32 MB).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_ROWS = 2_000
NOTHING = 1e-10  # share of the largest length below which a direction is rounding noise


@dataclass
class WideModel:
    """Coefficients of a linear model, a row per class, and intercepts."""

    weights: np.ndarray
    intercepts: np.ndarray

    @property
    def coefficientMatrix(self) -> DenseMatrix:
        return DenseMatrix(*self.weights.shape, self.weights.ravel(order="F"))

    @property
    def interceptVector(self) -> DenseVector:
        return DenseVector(self.intercepts)

    def margins(self, vectors: DataFrame, keep: list[str]) -> DataFrame:
        """(keep, _margins): the margins of every class, an array, in Arrow batches against broadcast weights."""
        kept = vectors.sparkSession.sparkContext.broadcast((np.ascontiguousarray(self.weights.T), self.intercepts))

        @F.pandas_udf("array<double>")
        def margin(v: pd.DataFrame) -> pd.Series:
            weights, intercepts = kept.value
            out = []
            for at, values in zip(v["indices"], v["values"]):
                rows = weights if at is None else weights[np.asarray(at, np.int64)]
                out.append(intercepts + np.asarray(values, np.float64) @ rows)
            return pd.Series(out)

        return vectors.select(*keep, margin(F.unwrap_udt("features")).alias("_margins"))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(k, float(b), w.tolist()) for k, (b, w) in enumerate(zip(self.intercepts, self.weights))]
        spark.createDataFrame(rows, "class int, intercept double, weights array<double>").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> WideModel:
        rows = SparkSession.active().read.parquet(path).orderBy("class").collect()  # a row per class
        return cls(np.array([r.weights for r in rows]), np.array([r.intercept for r in rows]))


def _inner_products(spark: SparkSession, row: np.ndarray, index: np.ndarray, value: np.ndarray, n: int, size: int) -> np.ndarray:
    """n x n inner products, some rows in each task."""
    kept = spark.sparkContext.broadcast((row, index, value))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row, index, value = kept.value
        for batch in batches:
            for i in batch["id"]:
                dense = np.zeros(size)
                mine = row == i
                dense[index[mine]] = value[mine]
                products = np.bincount(row, weights=dense[index] * value, minlength=n)
                yield pd.DataFrame({"i": [i], "products": [products.tobytes()]})

    found = spark.range(0, n, 1, spark.sparkContext.defaultParallelism).mapInPandas(run, "i long, products binary")
    out = np.zeros((n, n))
    for r in found.collect():
        out[r.i] = np.frombuffer(r.products)
    return (out + out.T) / 2


def fit_in_span(vectors: DataFrame, lr: LogisticRegression) -> WideModel:
    """The fit of ``lr`` on (label, features), worked out in the span of the rows."""
    spark = vectors.sparkSession
    table = vectors.select("label", F.unwrap_udt("features").alias("v")).select("label", "v.size", "v.indices", "v.values").toArrow()
    n = table.num_rows
    labels = table.column("label").to_numpy()
    size = int(table.column("size").drop_null()[0].as_py()) if table.column("size").null_count < n else len(table.column("values")[0])
    indices = [np.arange(size) if x is None else np.asarray(x.values) for x in map(_list, table.column("indices"))]
    values = [np.asarray(x.values, np.float64) for x in table.column("values")]
    row = np.repeat(np.arange(n), [len(v) for v in values])
    index, value = np.concatenate(indices).astype(np.int64), np.concatenate(values)
    lengths, axes = np.linalg.eigh(_inner_products(spark, row, index, value, n, size))
    real = lengths > NOTHING * lengths[-1]
    lengths, axes = np.sqrt(lengths[real]), axes[:, real]
    places = axes * lengths
    flat = pa.FixedSizeListArray.from_arrays(pa.array(places.ravel()), places.shape[1]).cast(pa.list_(pa.float64()))
    inside = spark.createDataFrame(pa.table({"label": labels, "x": flat})).select("label", array_to_vector("x").alias("features"))
    model = lr.fit(inside.coalesce(1))  # a few MB at most: one task saves every step the exchange
    parts = axes @ (model.coefficientMatrix.toArray() / lengths).T  # of each row in each class's weights
    weights = np.array([np.bincount(index, weights=value * parts[row, k], minlength=size) for k in range(parts.shape[1])])
    return WideModel(weights, model.interceptVector.toArray())


def _list(scalar):
    return scalar if scalar.is_valid else None
