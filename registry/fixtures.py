"""Inputs of the registered queries, derived from the given tables.

The conversations hold no personal data, acronyms or unhelpful answers, so fixed
snippets are added by row number, here and identically in ``oracle.py``.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.sources.turns import pair_messages

ACRONYMS = ["API", "SLA", "KYC", "CRM"]

# (conv_id + turn_rank) % 6 -> text before the question
QUESTION_PREFIX = {
    1: "Mail ann@example.com now. ",
    2: "Call 555-123-4567 please. ",
    3: "Order 111-2345678-9012345 costs $49.99. ",
    4: "mera order kaha hai nahi batao ",
}
# (conv_id + turn_rank) % 7 -> text after the question
QUESTION_SUFFIX = {0: " Thanks, that works great.", 1: " This is useless and I am angry."}
# conv_id % 9 = 4, from the second turn on
REPEATED_QUESTION = "Any news?"
# (conv_id + turn_rank) % 11 -> text after the response
RESPONSE_SUFFIX = {
    1: " I don’t have access to that.",
    2: " Check the API and the SLA.",
    3: " The KYC team will answer, see API-2.",
    4: " Please ask for Dr",
    5: " Signed, Mr John",
    6: " We moved to 12 Oak Street",
}
# rule -> share of rows that may break it in the quality loop
ALLOWED = {"keywords_3_to_8": 1.0, "language_domain": 0.2, "acronym_count": 0.5}
# doc_id % 16 -> text after a document
DOCUMENT_SUFFIX = {
    0: " Mail ann.lee+x@mail.example.com, bob@corp.co.uk or x@y.company today.",
    1: " Call +1 555-123-4567 or (020) 7946 0958.",
    2: " Item B0ABCD1234 and B12345678Z.",
    3: " Card 4111 1111 1111 1111 or 4111-1111-1111-1111.",
    4: " Account 12345678 and 12345678901234567.",
    5: " SSN 123-45-6789 or 123 45 6789.",
    6: " Order 111-2345678-9012345 late.",
    7: " See https://example.com/a?b=1 and http://x.org now.",
    8: " Host 10.0.0.1 and 192.168.100.200.",
    9: " Pay $1,249.99 or $5 today.",
    10: " Live at 123 Main Street or 9 elm ave.",
    11: " Ask Dr. Jane Doe, Mrs Smith or Miss Lee.",
    12: " What the damn fuuuck, f**k and s*h*t, wtf.",
}
# doc_id % 12 -> text before a document, for the script rules
DOCUMENT_PREFIX = {
    0: "你好世界 ",
    1: "日本語テスト ",
    2: "カタカナ ",
    3: "안녕하세요 ",
    4: "مرحبا بكم ",
    5: "नमस्ते दुनिया ",
    6: "ışık şehir ",
    7: "mera order kaha hai nahi batao ",
}


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def pick(index: Column, texts: dict[int, str]) -> Column:
    chosen = F.lit("")
    for key, value in texts.items():
        chosen = F.when(index == key, value).otherwise(chosen)
    return chosen


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pair_messages(load(spark, sf, "conversations"))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turn rows with conv_id kept for the derived cases."""
    conv, number = F.col("conv_id"), F.col("conv_id") + F.col("turn_rank")
    asked = F.concat(
        pick(number % 6, QUESTION_PREFIX), F.col("question"), pick(number % 7, QUESTION_SUFFIX)
    )
    question = F.when((conv % 9 == 4) & (F.col("turn_rank") > 1), REPEATED_QUESTION).otherwise(asked)
    response = F.concat(F.col("response"), pick(number % 11, RESPONSE_SUFFIX))
    return pairs(spark, sf).select(
        "conv_id",
        F.concat(F.lit("chat_"), F.lpad(conv.cast("string"), 6, "0")).alias("chat_id"),
        F.concat_ws("_", F.lit("turn"), conv, "turn_rank").alias("turn_id"),
        "turn_rank",
        question.alias("question"),
        response.alias("response"),
        F.concat(F.lit("2026-01-0"), conv % 7 + 1).alias("chat_date"),
        question.alias("question_raw"),
        response.alias("response_raw"),
    )


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with personal data behind and a foreign script before the text."""
    doc = F.col("doc_id")
    return load(spark, sf, "documents").select(
        "doc_id",
        F.concat("text", pick(doc % 16, DOCUMENT_SUFFIX)).alias("text"),
        F.concat(pick(doc % 12, DOCUMENT_PREFIX), F.col("text")).alias("scripted"),
    )


def acronyms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a,) for a in ACRONYMS], "acronym_shrt string")


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Raw model output of every shape, one per turn."""
    kind = (F.col("conv_id") + F.col("turn_rank")) % 12
    q, r = F.col("question"), F.coalesce("response", F.lit("none"))

    def say(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    text = (
        F.when(kind == 0, say(" SUMMARY: ", q, "\nSENTIMENT: Positive.\nKEYWORDS: alpha, ", r))
        .when(kind == 1, say("SUMMARY: ", q, "\nSENTIMENT: not positive"))
        .when(kind == 2, say("KEYWORDS: a, b\nSUMMARY: ", q, "\nSENTIMENT: Negative"))
        .when(kind == 3, q)
        .when(kind == 4, say("SUMMARY: x\n\nSENTIMENT:  Frustrated...\nKEYWORDS:\n  one, two \n", r, "\n"))
        .when(kind == 5, F.lit(""))
        .when(kind == 6, F.lit("Sorry: blocked by our Content Filters."))
    )
    error = (
        F.when(kind == 7, "Content was stopped by a filter")
        .when(kind == 8, "ThrottlingException: content filter busy")
        .when(kind == 9, "socket closed")
    )
    stop_reason = (
        F.when(kind == 5, "CONTENT_FILTERED").when(kind == 10, "guardrail_intervened")
        .when(kind != 11, "end_turn")
    )
    return turns(spark, sf).select(
        "chat_id", "turn_id", stop_reason.alias("stop_reason"), text.alias("text"), error.alias("error")
    )


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Summary rows with every kind of defect, one per conversation."""
    conv = F.col("conv_id")
    chats = (
        turns(spark, sf)
        .groupBy("conv_id", "chat_id")
        .agg(
            F.count(F.lit(1)).alias("total_turns"),
            F.min_by("question", "turn_rank").alias("first_question"),
        )
    )
    summary = (
        F.when(conv % 13 == 1, "ERROR: backend down")
        .when(conv % 13 == 2, "CONTENT_FILTERED")
        .when(conv % 13 == 3, "NO_CONTENT")
        .otherwise(F.col("first_question"))
    )
    topics = F.concat_ws(
        ", ",
        F.concat(F.lit("topic "), conv % 7),
        F.concat(F.lit("topic "), conv % 5 + 7),
        F.when(conv % 11 != 0, F.concat(F.lit("topic "), conv % 3 + 12)),
    )
    found = F.when(conv % 4 == 1, "API").when(conv % 4 == 2, "API, SLA").when(conv % 8 == 3, "KYC")
    names = F.element_at(
        F.array(*map(F.lit, ["English", "French", "German", "Klingon"])), (conv % 4 + 1).cast("int")
    )
    return chats.select(
        "chat_id",
        F.when(conv % 17 != 5, F.concat(F.lit("2026-01-0"), conv % 7 + 1)).alias("chat_date"),
        summary.alias("summary"),
        F.when(conv % 13 == 1, "ERROR").otherwise(
            F.element_at(F.array(*map(F.lit, ["Positive", "Negative", "Neutral"])), (conv % 3 + 1).cast("int"))
        ).alias("chat_sentiment"),
        topics.alias("keywords"),
        F.when(conv % 5 == 0, "N").otherwise("Y").alias("is_in_scope"),
        (conv % 4 % 3).cast("int").alias("acronym_count"),
        F.coalesce(found, F.lit("")).alias("acronyms_found"),
        names.alias("user_language"),
        "total_turns",
        F.lit("2026-02-01T00:00:00+00:00").alias("summarized_at"),
    )


def rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A later run over the same chats; a third of them have moved to another day."""
    moved = F.substring("chat_id", -1, 1).isin("0", "3", "6", "9")
    return summaries(spark, sf).withColumns(
        {
            "chat_date": F.when(moved, "2026-01-09").otherwise(F.col("chat_date")),
            "summary": F.concat(F.lit("again: "), "summary"),
            "summarized_at": F.lit("2026-02-02T00:00:00+00:00"),
        }
    )


def stub_client():
    """A deterministic client: the digest of the prompt decides what happens."""

    def answer(prompt: str, **settings) -> tuple[str, str]:
        digest = hashlib.md5(prompt.encode()).hexdigest()
        if digest[0] in "01":
            return "content_filtered", ""
        if digest[0] == "2":
            raise RuntimeError(f"backend down {digest}")
        if digest[0] == "3":
            return "end_turn", "Blocked by content filters."
        if digest[0] == "4":
            return "end_turn", None
        mood = "Positive" if digest[1] < "6" else "Negative" if digest[1] < "c" else "Neutral"
        return "end_turn", f"SUMMARY: chat {digest}\nSENTIMENT: {mood}.\nKEYWORDS: one, {digest[:4]}"

    return answer
