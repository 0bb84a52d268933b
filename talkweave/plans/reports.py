"""Reports on the summary table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sentiment_by_language(summaries: DataFrame) -> DataFrame:
    """Chats by day, language and sentiment, with subtotals (grouping_level 0 = detail)."""
    return summaries.rollup("chat_date", "user_language", "chat_sentiment").agg(
        F.count(F.lit(1)).alias("chats"),
        F.grouping_id().cast("int").alias("grouping_level"),
    )


def resolution_rate(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("chat_date", "user_language").agg(
        F.count(F.lit(1)).alias("chats"),
        F.round(F.avg((F.col("is_in_scope") == "Y").cast("int")), 6).alias("in_scope_rate"),
    )


def keyword_trend(summaries: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent keywords of each day, and the change to the day they last occurred."""
    daily = (
        summaries.select("chat_date", F.explode(F.split("keywords", ", ")).alias("keyword"))
        .filter(F.col("keyword") != "")
        .groupBy("chat_date", "keyword")
        .agg(F.count(F.lit(1)).alias("chats"))
    )
    by_day = Window.partitionBy("keyword").orderBy("chat_date")
    previous_day = F.date_sub(F.col("chat_date").try_cast("date"), 1).cast("string")
    before = F.when(
        F.lag("chat_date").over(by_day) == previous_day, F.lag("chats").over(by_day)
    ).otherwise(0)
    best = Window.partitionBy("chat_date").orderBy(F.desc("chats"), "keyword")
    return (
        daily.withColumn("change", F.col("chats") - before)
        .withColumn("position", F.row_number().over(best))
        .filter(F.col("position") <= top)
    )


def acronym_frequency(summaries: DataFrame) -> DataFrame:
    """Acronyms by number of chats.

    The ranking window has no partition key: it sees one row per acronym of the
    dimension, never per chat.
    """
    counts = (
        summaries.select(F.explode(F.split("acronyms_found", ", ")).alias("acronym"))
        .filter(F.col("acronym") != "")
        .groupBy("acronym")
        .agg(F.count(F.lit(1)).alias("chats"))
    )
    return counts.withColumn("place", F.dense_rank().over(Window.orderBy(F.desc("chats"))))


def turns_distribution(summaries: DataFrame) -> DataFrame:
    """Exact spread of turns per chat; counts per value are combined before the shuffle."""
    sizes = summaries.groupBy("user_language", "total_turns").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("user_language").agg(
        F.sum("n").alias("chats"),
        F.min("total_turns").alias("min_turns"),
        F.percentile("total_turns", 0.5, F.col("n")).alias("median_turns"),
        F.round(F.percentile("total_turns", 0.95, F.col("n")), 6).alias("p95_turns"),
        F.max("total_turns").alias("max_turns"),
    )
