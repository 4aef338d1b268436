"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import BATTLES, require


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return require(df, columns).select(*columns) if columns else df


def scan_battles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw battles.  Parquet brings its own types and is checked; other formats get the schema given."""
    if fmt == "parquet":
        return require(spark.read.parquet(path), BATTLES.fieldNames())
    return spark.read.schema(BATTLES).format(fmt).load(path)


def battles_from_raw_json(raw: DataFrame, column: str = "value") -> DataFrame:
    """Battles from JSON lines whose message content is a string or a list of typed parts.

    Lines are parsed to variants, so the content keeps its JSON type: a string stays plain text even if it
    looks like a list, a list becomes parts, anything else its JSON text.  Broken lines give a row of nulls.
    """
    kinds = {f.name: f.dataType.simpleString() for f in BATTLES.fields}
    parts = BATTLES["conversation_a"].dataType.elementType["content_parts"].dataType.simpleString()

    def split_content(m):
        is_list = F.coalesce(F.schema_of_variant(m["content"]).startswith("ARRAY"), F.lit(False))
        return F.struct(
            m["role"].alias("role"),
            F.when(~is_list, F.try_variant_get(m["content"], "$", "string")).alias("content_text"),
            F.when(is_list, F.try_variant_get(m["content"], "$", parts)).alias("content_parts"),
        )

    line = F.col("_line")
    columns = []
    for name, kind in kinds.items():
        if name.startswith("conversation_"):
            messages = F.try_variant_get(line, f"$.{name}", "array<struct<role:string,content:variant>>")
            columns.append(F.transform(messages, split_content).alias(name))
        else:
            columns.append(F.try_variant_get(line, f"$.{name}", kind).alias(name))
    return raw.select(F.try_parse_json(column).alias("_line")).select(*columns)


def known_labels(df: DataFrame, labels: list[str], label: str = "family") -> DataFrame:
    """The known labels that occur, in their given order (``position``)."""
    order = df.sparkSession.createDataFrame(
        list(enumerate(labels)), f"position int, {label} string"
    )
    # the label list is a literal, so its size is fixed
    return df.select(label).distinct().join(F.broadcast(order), label).select(label, "position")


def inspect_columns(df: DataFrame, cut: int = 300, first_by: str | None = None) -> DataFrame:
    """One row per column: name, type and the first row's value cut to ``cut`` characters.

    The first row is the one read first, or the one with the smallest ``first_by``, which does not depend on the files' order.
    """
    schema = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    names = df.sparkSession.createDataFrame(schema, "position int, column string, type string")
    values = F.array(*[F.left(F.col(c).cast("string"), F.lit(cut)) for c in df.columns])
    first = (df.orderBy(first_by) if first_by else df).limit(1).select(F.posexplode(values).alias("position", "first_value"))
    # as many rows as the table has columns
    return names.join(F.broadcast(first), "position", "left")


def top_models(battles: DataFrame, limit: int = 60) -> DataFrame:
    """Most common models over both sides."""
    sides = battles.select(F.explode(F.array("model_a", "model_b")).alias("model"))
    return (
        sides.filter(F.col("model").isNotNull())
        .groupBy("model")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "model")
        .limit(limit)
    )


def inspect_source(battles: DataFrame, limit: int = 60) -> dict[str, DataFrame]:
    """Schema with a sample, row count and most common models: three lazy tables."""
    return {
        "columns": inspect_columns(battles),
        "rows": battles.agg(F.count("*").alias("rows")),
        "models": top_models(battles, limit),
    }


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "error") -> None:
    """Parquet with zstd.  Partitioning by the split column lets later reads prune whole splits."""
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def sink_results(results: DataFrame, path: str, experiment: str, tag: str = "", mode: str = "append") -> None:
    """Result rows under ``experiment=…/tag=…``; appending a run leaves the others untouched."""
    tagged = results.withColumns({"experiment": F.lit(experiment), "tag": F.lit(tag or "default")})
    tagged.write.mode(mode).partitionBy("experiment", "tag").option("compression", "zstd").parquet(path)


def read_results(spark: SparkSession, path: str, experiment: str, tag: str = "") -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter((F.col("experiment") == experiment) & (F.col("tag") == (tag or "default")))
