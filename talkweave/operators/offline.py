"""Offline enrichment: sentiment, keywords and summary from DataFrame operations only.

``turn_features`` reads the text of a turn once. Everything after it works on its
narrow columns, so it is worth storing where more than one result is wanted.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions import redact, text
from talkweave.operators.chats import drop_null_chat, turn_position
from talkweave.sources.term_counts import TermCounts

TERSE_CHARS = 15
MIN_TERM_CHARS = 4
MAX_KEYWORDS = 8
SUMMARY_WORDS = 150


def turn_features(turns: DataFrame, order: str = "specific_first") -> DataFrame:
    """What the enrichment needs of a turn, taken from its redacted text.

    terms: words of the answer that can be keywords, repeats kept. question and
    answer: first sentences; answer is null where the bot did not answer.
    """
    safe = drop_null_chat(turns).select(
        "chat_id", "turn_id", "turn_rank", "chat_date",
        redact.sanitize_text(F.coalesce("question", F.lit("")), order).alias("safe_question"),
        redact.sanitize_text(F.col("response"), order).alias("safe_response"),
        text.unhelpful_response(F.col("response")).alias("is_unhelpful"),
    )
    asked = F.lower(text.strip(F.col("safe_question")))
    words = text.letter_words(redact.strip_labels(F.col("safe_response")))
    terms = F.filter(
        words, lambda w: (F.length(w) >= MIN_TERM_CHARS) & ~w.isin(rules.STOP_WORDS)
    )
    answered = F.col("safe_response").isNotNull()
    return safe.select(
        "chat_id", "turn_id", "turn_rank", "chat_date", "is_unhelpful",
        text.polarity(F.col("safe_question")).alias("word_polarity"),
        F.md5(asked).alias("asked"),
        (F.length(asked) < TERSE_CHARS).alias("is_terse"),
        text.first_sentence(F.col("safe_question")).alias("question"),
        F.when(answered, text.first_sentence(F.col("safe_response"))).alias("answer"),
        terms.alias("terms"),
    )


def user_sentiment(features: DataFrame) -> DataFrame:
    """Sentiment from the user's side, with the integer signals it is built from."""
    signals = features.groupBy("chat_id").agg(
        F.sum("word_polarity").alias("word_polarity"),
        F.count_if("is_unhelpful").alias("unhelpful_turns"),
        (F.count(F.lit(1)) - F.count_distinct("asked")).alias("repeated_questions"),
        F.count_if("is_terse").alias("terse_turns"),
    )
    score = (
        F.col("word_polarity") - F.col("unhelpful_turns")
        - F.col("repeated_questions") - F.col("terse_turns")
    )
    label = F.when(score > 0, "Positive").when(score < 0, "Negative").otherwise("Neutral")
    return signals.withColumn("chat_sentiment", label)


def term_frequency(features: DataFrame) -> DataFrame:
    """(chat_id, term, tf), combined before its only shuffle."""
    terms = features.select("chat_id", F.explode("terms").alias("term"))
    return terms.groupBy("chat_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def keyword_scores(frequency: DataFrame, features: DataFrame, counts: TermCounts | None = None) -> DataFrame:
    """(chat_id, term, score, position): the best TF-IDF terms of each chat, among the given chats or among all that ``counts`` has seen.

    A term common to very many chats is a hot key of the join only on the frequency
    side, where adaptive execution splits it. The limit per chat is applied within
    each task before the last shuffle.
    """
    if counts is None:
        chats = features.agg(F.count_distinct("chat_id")).scalar()
        spread = frequency.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        chats, spread = F.lit(counts.chats()), counts.frequencies()
    score = F.round(F.col("tf") * F.ln(chats / F.col("df")), 6)
    best = Window.partitionBy("chat_id").orderBy(F.desc("score"), "term")
    return (
        frequency.join(spread, "term")
        .select("chat_id", "term", score.alias("score"))
        .withColumn("position", F.row_number().over(best))
        .filter(F.col("position") <= MAX_KEYWORDS)
    )


def chat_keywords(scores: DataFrame) -> DataFrame:
    joined = F.expr("listagg(term, ', ') WITHIN GROUP (ORDER BY position)")
    return scores.groupBy("chat_id").agg(
        F.left(joined, F.lit(rules.KEYWORDS_CHARS)).alias("keywords")
    )


def chat_summary_extractive(features: DataFrame, scores: DataFrame) -> DataFrame:
    """First request, first answer, the most topical turn between, last answer.

    A turn's topicality is the number of the chat's keywords its answer names.
    """
    placed = features.withColumn("place", turn_position())
    answered = F.when(F.col("answer").isNotNull(), F.col("place"))
    ends = placed.groupBy("chat_id").agg(
        F.min_by("question", "place").alias("first_question"),
        F.min_by("answer", answered).alias("first_answer"),
        F.max_by("answer", answered).alias("last_answer"),
        F.min(answered).alias("first_place"),
        F.max(answered).alias("last_place"),
    )
    topical = (
        placed.select("chat_id", "place", F.explode_outer(F.array_distinct("terms")).alias("term"))
        .join(scores.select("chat_id", "term"), ["chat_id", "term"])
        .groupBy("chat_id", "place")
        .agg(F.count(F.lit(1)).alias("named"))
    )
    # Only the first and the last answer are excluded, so three candidates suffice.
    best = Window.partitionBy("chat_id").orderBy(F.desc("named"), "place")
    middle = (
        topical.withColumn("nth", F.row_number().over(best))
        .filter(F.col("nth") <= 3)
        .join(ends.select("chat_id", "first_place", "last_place"), "chat_id")
        .filter((F.col("place") > F.col("first_place")) & (F.col("place") < F.col("last_place")))
        .groupBy("chat_id")
        .agg(F.min_by("place", "nth").alias("place"))
    )
    middle_answer = (
        placed.select("chat_id", "place", "answer")
        .join(middle, ["chat_id", "place"])
        .groupBy("chat_id")
        .agg(F.min("answer").alias("middle_answer"))
    )

    def part(lead: str, sentence: str) -> Column:
        return F.when(F.length(sentence) > 0, F.concat(F.lit(lead), sentence))

    last = F.when(F.col("last_place") > F.col("first_place"), F.col("last_answer"))
    flow = F.concat_ws(
        " ",
        part("The user asked: ", "first_question"),
        part("The bot answered: ", "first_answer"),
        part("Later: ", "middle_answer"),
        part("At the end: ", "last_answer"),
    )
    words = F.array_join(F.slice(F.split(flow, " "), 1, SUMMARY_WORDS), " ")
    return (
        ends.join(middle_answer, "chat_id", "left")
        .withColumn("last_answer", last)
        .select("chat_id", F.left(words, F.lit(rules.SUMMARY_CHARS)).alias("summary"))
    )
