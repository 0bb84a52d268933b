"""Reading raw model output with string expressions; no UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions.text import contains_any, strip


def response_status(stop_reason: Column, text: Column, error: Column) -> Column:
    """FILTERED, ERROR, NO_CONTENT or OK."""
    reason = F.lower(F.coalesce(stop_reason, F.lit("")))
    failure = F.coalesce(error, F.lit(""))
    throttled = failure.contains("ThrottlingException")
    blocked = F.lower(failure).contains("content") & F.lower(failure).contains("filter")
    refused = F.lower(F.coalesce(text, F.lit(""))).contains("content filters")
    return (
        F.when(reason.contains("content_filtered") | reason.contains("guardrail"), "FILTERED")
        .when(error.isNotNull() & blocked & ~throttled, "FILTERED")
        .when(error.isNotNull(), "ERROR")
        .when(text.isNull(), "NO_CONTENT")
        .when(refused, "FILTERED")
        .otherwise("OK")
    )


def classify_sentiment(raw: Column) -> Column:
    return (
        F.when(raw.contains("positive") & ~raw.contains("not positive"), "Positive")
        .when(contains_any(raw, rules.NEGATIVE_SIGNALS), "Negative")
        .otherwise("Neutral")
    )


def _piece(text: Column, label: str, index: int) -> Column:
    return F.get(F.split(text, label, -1), F.lit(index))


def _first_line(text: Column) -> Column:
    return strip(F.get(F.split(strip(text), "\n", -1), F.lit(0)))


def _sentiment_field(text: Column) -> Column:
    return classify_sentiment(F.lower(F.rtrim(_first_line(_piece(text, "SENTIMENT:", 1)), F.lit("."))))


def _summary_field(text: Column) -> Column:
    return strip(F.replace(_piece(text, "SENTIMENT:", 0), F.lit("SUMMARY:"), F.lit("")))


def parse_response(response: Column) -> Column:
    """Struct of summary, sentiment and keywords from a first-attempt answer."""
    text = strip(response)
    labelled = text.contains("SUMMARY:") & text.contains("SENTIMENT:")
    before_keywords = _piece(text, "KEYWORDS:", 0)
    sentiment_in_place = labelled & before_keywords.contains("SENTIMENT:")
    summary = F.when(sentiment_in_place, _summary_field(before_keywords)).otherwise(text)
    sentiment = F.when(sentiment_in_place, _sentiment_field(before_keywords)).otherwise("Neutral")
    keywords = F.when(
        labelled & text.contains("KEYWORDS:"), _first_line(_piece(text, "KEYWORDS:", 1))
    ).otherwise("")
    return F.struct(
        F.left(summary, F.lit(rules.SUMMARY_CHARS)).alias("summary"),
        sentiment.alias("chat_sentiment"),
        F.left(keywords, F.lit(rules.KEYWORDS_CHARS)).alias("keywords"),
    )


def parse_simple_response(response: Column) -> Column:
    """The same struct from an answer to the fallback prompt, which has no keywords."""
    text = strip(response)
    labelled = text.contains("SENTIMENT:")
    return F.struct(
        F.left(
            F.when(labelled, _summary_field(text)).otherwise(text), F.lit(rules.SUMMARY_CHARS)
        ).alias("summary"),
        F.when(labelled, _sentiment_field(text)).otherwise("Neutral").alias("chat_sentiment"),
        F.lit("").alias("keywords"),
    )
