"""Checks of the summary table and metrics of a run."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions.redact import pattern

# Widths, in bytes, of the warehouse columns.
VARCHAR_LIMITS = {
    "chat_id": 256, "chat_date": 50, "summary": 65535, "chat_sentiment": 20, "keywords": 2000,
    "is_in_scope": 20, "acronyms_found": 2000, "user_language": 100, "summarized_at": 50,
}
SENTIMENTS = ["Positive", "Negative", "Neutral", "ERROR"]
SPECIAL_SUMMARIES = ["NO_CONTENT", "CONTENT_FILTERED"]


def list_size(c: Column) -> Column:
    """Entries of a ', '-joined list; 0 for an empty one."""
    return F.when(F.coalesce(c, F.lit("")) == "", 0).otherwise(F.size(F.split(c, ", ")))


def row_rules() -> dict[str, Column]:
    """Rule name -> true where a row breaks it."""
    too_long = F.lit(False)
    for name, limit in VARCHAR_LIMITS.items():
        too_long = too_long | (F.octet_length(F.coalesce(name, F.lit(""))) > limit)
    topics = list_size(F.col("keywords"))
    return {
        "null_key": F.col("chat_id").isNull() | F.col("chat_date").isNull(),
        "sentiment_domain": ~F.coalesce("chat_sentiment", F.lit("")).isin(SENTIMENTS),
        "scope_domain": ~F.coalesce("is_in_scope", F.lit("")).isin("Y", "N"),
        "language_domain": ~F.coalesce("user_language", F.lit("")).isin(rules.LANGUAGES),
        "acronym_count": ~F.col("acronym_count").eqNullSafe(list_size(F.col("acronyms_found"))),
        "total_turns": F.coalesce("total_turns", F.lit(0)) < 1,
        "varchar_limit": too_long,
        "summary_length": F.length(F.coalesce("summary", F.lit(""))) > rules.SUMMARY_CHARS,
        "keywords_length": F.length(F.coalesce("keywords", F.lit(""))) > rules.KEYWORDS_CHARS,
        "keywords_3_to_8": ~topics.between(3, 8),
    }


def dq_report(summaries: DataFrame) -> DataFrame:
    """(rule, rows_checked, rows_failing), one row per rule."""
    broken = row_rules()
    counts = summaries.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(rule).alias(name) for name, rule in broken.items()],
    )
    by_row = counts.unpivot(["rows_checked"], list(broken), "rule", "rows_failing")
    per_key = summaries.groupBy("chat_id", "chat_date").agg(F.count(F.lit(1)).alias("n"))
    unique = per_key.agg(
        F.lit("unique_key").alias("rule"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_failing"),
    )
    return by_row.select("rule", "rows_checked", "rows_failing").unionByName(unique)


def acronym_report(acronyms: DataFrame) -> DataFrame:
    """Acronyms that can never match, as tokens hold letters and digits only."""
    return acronyms.filter(F.col("acronym_shrt").rlike("[^A-Za-z0-9]"))


def summary_status(summary: Column) -> Column:
    return (
        F.when(summary.startswith("ERROR"), "ERROR")
        .when(summary.isin(SPECIAL_SUMMARIES), summary)
        .otherwise("OK")
    )


def dq_error_rate(summaries: DataFrame) -> DataFrame:
    """Share of failed, filtered and empty chats per day."""
    status = summary_status(F.col("summary"))
    return summaries.groupBy("chat_date").agg(
        F.count(F.lit(1)).alias("chats"),
        *[
            F.round(F.avg((status == name).cast("int")), 6).alias(f"{name.lower()}_rate")
            for name in ("ERROR", "CONTENT_FILTERED", "NO_CONTENT")
        ],
    )


def dq_residual_pii(summaries: DataFrame) -> DataFrame:
    """(label, summaries_hit): summaries in which a pattern still matches."""
    hits = summaries.agg(
        *[F.count_if(F.col("summary").rlike(pattern(label))).alias(label) for label in rules.PII_PATTERNS]
    )
    return hits.unpivot([], list(rules.PII_PATTERNS), "label", "summaries_hit")


def reprocess_set(chat_ids: DataFrame, summaries: DataFrame) -> DataFrame:
    """Chats of the input without a good row in the output."""
    good = summaries.filter(summary_status(F.col("summary")) == "OK").select("chat_id")
    return chat_ids.select("chat_id").distinct().join(good, "chat_id", "left_anti")


def run_metrics(summaries: DataFrame) -> DataFrame:
    """Completed chats and errors of a run; with files written where rows come from a scan."""
    files = "source_file" in summaries.columns
    written = F.count_distinct("source_file") if files else F.lit(0).cast("long")
    return summaries.agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if(F.col("summary").startswith("ERROR")).alias("errors"),
        written.alias("files_written"),
    )
