"""Column contracts of the two ends of the pipeline."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_SCHEMA = T.StructType(
    [
        T.StructField("chat_id", T.StringType()),
        T.StructField("turn_id", T.StringType()),
        T.StructField("turn_rank", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("chat_date", T.StringType()),
        T.StructField("question_raw", T.StringType()),
        T.StructField("response_raw", T.StringType()),
    ]
)

CHAT_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("chat_id", T.StringType()),
        T.StructField("chat_date", T.StringType()),
        T.StructField(
            "turns",
            T.ArrayType(
                T.StructType([f for f in TURN_SCHEMA if f.name not in ("chat_id", "chat_date")])
            ),
        ),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("chat_id", T.StringType()),
        T.StructField("chat_date", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("chat_sentiment", T.StringType()),
        T.StructField("keywords", T.StringType()),
        T.StructField("is_in_scope", T.StringType()),
        T.StructField("acronym_count", T.IntegerType()),
        T.StructField("acronyms_found", T.StringType()),
        T.StructField("user_language", T.StringType()),
        T.StructField("total_turns", T.LongType()),
        T.StructField("summarized_at", T.StringType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to exactly the columns and types of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
