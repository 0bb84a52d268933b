"""The whole pipeline: turns in, summary rows out."""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.operators import chats, language, model, offline
from talkweave.schema import SUMMARY_SCHEMA, conform
from talkweave.sources.term_counts import TermCounts
from talkweave.staging import materialise


def now_utc() -> str:
    return datetime.now(timezone.utc).isoformat()


def assemble_summary(chat_rows: DataFrame, enrichment: DataFrame, run_ts: str) -> DataFrame:
    """Join chat rows with their enrichment and shape the output columns."""
    joined = chat_rows.join(
        enrichment.select("chat_id", "summary", "chat_sentiment", "keywords"), "chat_id", "left"
    ).withColumn("summarized_at", F.lit(run_ts))
    filled = joined.na.fill({"keywords": "", "chat_sentiment": "Neutral", "summary": ""})
    return conform(filled, SUMMARY_SCHEMA)


def chat_rows(
    turns: DataFrame, flagged: DataFrame, acronyms: DataFrame, profiles: DataFrame
) -> DataFrame:
    """Everything known about a chat but its text, which the output does not carry."""
    facts = chats.with_acronyms(chats.chat_facts(flagged), chats.chat_acronyms(turns, acronyms))
    return facts.join(language.chat_language(turns, profiles), "chat_id", "left")


def offline_enrichment(features: DataFrame, counts: TermCounts | None = None) -> DataFrame:
    """Summary, sentiment and keywords without a model, from stored turn features."""
    frequency = materialise(offline.term_frequency(features), "term-frequency")
    scores = materialise(offline.keyword_scores(frequency, features, counts), "keyword-scores")
    return (
        offline.chat_summary_extractive(features, scores)
        .join(offline.user_sentiment(features).select("chat_id", "chat_sentiment"), "chat_id")
        .join(offline.chat_keywords(scores), "chat_id", "left")
    )


def chat_summary(
    turns: DataFrame, acronyms: DataFrame, profiles: DataFrame, run_ts: str | None = None, counts: TermCounts | None = None
) -> DataFrame:
    """Summary rows with offline enrichment; keywords are weighed among the given chats, or among all chats that ``counts`` has seen.

    ``turns`` should be a stored table: question and response are read twice (features,
    acronyms), the raw columns once. Only features much smaller than the text are stored.
    """
    features = materialise(offline.turn_features(turns), "turn-features")
    rows = chat_rows(turns, features, acronyms, profiles)
    return assemble_summary(rows, offline_enrichment(features, counts), run_ts or now_utc())


def chat_summary_by_model(
    turns: DataFrame,
    acronyms: DataFrame,
    profiles: DataFrame,
    client_factory: Callable[[], model.Client],
    options: model.CallOptions = model.CallOptions(),
    run_ts: str | None = None,
) -> DataFrame:
    """Summary rows with a model behind ``client_factory``; ``turns`` as above."""
    answers = model.enrich_with_model(chats.prompt_text(turns), client_factory, options)
    rows = chat_rows(turns, chats.flag_turns(turns), acronyms, profiles)
    return assemble_summary(rows, answers, run_ts or now_utc())
