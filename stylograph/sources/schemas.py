"""Table layouts.  Readers check them; a missing column is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content_text", T.StringType()),
        T.StructField(
            "content_parts",
            T.ArrayType(
                T.StructType(
                    [T.StructField("type", T.StringType()), T.StructField("text", T.StringType())]
                )
            ),
        ),
    ]
)

BATTLES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("model_a", T.StringType()),
        T.StructField("model_b", T.StringType()),
        T.StructField("conversation_a", T.ArrayType(MESSAGE)),
        T.StructField("conversation_b", T.ArrayType(MESSAGE)),
        T.StructField(
            "category_tag", T.MapType(T.StringType(), T.MapType(T.StringType(), T.BooleanType()))
        ),
        T.StructField("is_code", T.BooleanType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

CURATED = T.StructType(
    [
        T.StructField("prompt_id", T.StringType()),
        T.StructField("battle_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("is_reasoning", T.BooleanType()),
        T.StructField("family", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)

PROCESSED = T.StructType(
    [
        *CURATED.fields,
        T.StructField("output_raw", T.StringType()),
        T.StructField("input_raw", T.StringType()),
        T.StructField("refusal", T.BooleanType()),
        T.StructField("self_id", T.BooleanType()),
        T.StructField("prompt_names_model", T.BooleanType()),
        T.StructField("split", T.StringType()),
        T.StructField("matched_pair", T.BooleanType()),
    ]
)


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
