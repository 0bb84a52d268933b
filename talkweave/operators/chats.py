"""From turns to chats: facts, text, acronyms, deduplication and limits."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions import redact, text
from talkweave.sources.acronyms import COLUMN as ACRONYM

IN_ORDER = "turn_rank ASC NULLS LAST, turn_id ASC NULLS LAST"
RANK_BLOCK = 1024
# A redacted turn keeps at least " :\nUser: ", so this many turns fill any prompt.
TURNS_PER_PROMPT = math.ceil(rules.PROMPT_CHARS / len(" :\nUser: ")) + 1


def turn_position(*ties: str) -> Column:
    """Orderable position of a turn in its chat; missing ranks and ids come last."""
    rank, turn = F.col("turn_rank"), F.col("turn_id")
    return F.struct(rank.isNull(), rank, turn.isNull(), turn, *ties)


def drop_null_chat(turns: DataFrame) -> DataFrame:
    return turns.filter(F.col("chat_id").isNotNull())


def flag_turns(turns: DataFrame) -> DataFrame:
    unhelpful = text.unhelpful_response(F.col("response"))
    return turns.select(
        "chat_id", "turn_id", "turn_rank", "chat_date", unhelpful.alias("is_unhelpful")
    )


def chat_facts(flagged: DataFrame) -> DataFrame:
    """Turn count, scope and first known date. Every aggregate combines before the shuffle."""
    dated = F.when(F.col("chat_date").isNotNull(), turn_position())
    return (
        drop_null_chat(flagged)
        .groupBy("chat_id")
        .agg(
            F.count("turn_rank").alias("total_turns"),
            F.when(F.bool_or("is_unhelpful"), "N").otherwise("Y").alias("is_in_scope"),
            F.min_by("chat_date", dated).alias("chat_date"),
        )
    )


def chat_text(turns: DataFrame) -> DataFrame:
    """All turns of a chat as one text, in turn order, with a blank line between turns.

    Turns are joined in runs of RANK_BLOCK ranks first, so that no task sorts all turns of a long chat; turns
    without a rank are one run, the last.
    """
    line = text.format_turn(F.col("turn_rank"), F.col("question"), F.col("response"))
    lines = drop_null_chat(turns).select("chat_id", "turn_rank", "turn_id", line.alias("line"))
    joined = F.expr(f"listagg(line, '\n\n') WITHIN GROUP (ORDER BY {IN_ORDER}, line)")
    runs = lines.groupBy("chat_id", F.floor(F.col("turn_rank") / RANK_BLOCK).alias("run")).agg(
        joined.alias("part")
    )
    return runs.groupBy("chat_id").agg(
        F.expr("listagg(part, '\n\n') WITHIN GROUP (ORDER BY run ASC NULLS LAST)").alias("chat_text")
    )


def turn_acronyms(turns: DataFrame, acronyms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, acronyms): sorted distinct acronyms per key; keys without a hit are absent.

    The dimension is joined without a hint: broadcast if its measured size allows, else
    shuffled with skewed tokens split by adaptive execution. The outer form spares the second cutting of the text, in a filter of empty
    arrays, that the other form brings.
    """
    tokens = text.alphanumeric_tokens(F.col("question"), F.col("response"))
    said = turns.select(*keys, F.explode_outer(F.array_distinct(tokens)).alias(ACRONYM))
    hits = said.join(acronyms.select(ACRONYM).distinct(), ACRONYM)
    return hits.groupBy(*keys).agg(F.array_sort(F.collect_set(ACRONYM)).alias("acronyms"))


def chat_acronyms(turns: DataFrame, acronyms: DataFrame) -> DataFrame:
    """(chat_id, acronym_count, acronyms_found) of chats with at least one acronym."""
    return turn_acronyms(drop_null_chat(turns), acronyms, ["chat_id"]).select(
        "chat_id",
        F.size("acronyms").alias("acronym_count"),
        F.array_join("acronyms", ", ").alias("acronyms_found"),
    )


def with_acronyms(chats: DataFrame, found: DataFrame) -> DataFrame:
    return chats.join(found, "chat_id", "left").na.fill({"acronym_count": 0, "acronyms_found": ""})


def group_chats(turns: DataFrame, acronyms: DataFrame, languages: DataFrame) -> DataFrame:
    """One row per chat: text, turn count, scope, date, acronyms, language.

    ``languages`` is the result of ``operators.language.chat_language``. All inputs
    of the joins are aggregated by chat_id already, so the joins add no shuffle.
    """
    chats = chat_facts(flag_turns(turns)).join(chat_text(turns), "chat_id")
    return with_acronyms(chats, chat_acronyms(turns, acronyms)).join(languages, "chat_id", "left")


def first_file_wins(turns: DataFrame) -> DataFrame:
    """Keep only the turns of a chat that lie in its first file (column source_file)."""
    first = turns.groupBy("chat_id").agg(F.min("source_file").alias("source_file"))
    return turns.join(first, ["chat_id", "source_file"], "left_semi")


def limit_chats(turns: DataFrame, n: int) -> DataFrame:
    """Turns of the first n chats by chat_id; all of them for n <= 0."""
    if n <= 0:
        return turns
    ids = drop_null_chat(turns).select("chat_id").distinct().orderBy("chat_id").limit(n)
    return turns.join(ids, "chat_id", "left_semi")


def prefilter_chats(chats: DataFrame, min_turns: int = 2) -> DataFrame:
    return chats.filter((F.col("total_turns") >= min_turns) & ~text.is_blank(F.col("chat_text")))


def unseen_chats(chats: DataFrame, done: DataFrame) -> DataFrame:
    return chats.join(done.select("chat_id"), "chat_id", "left_anti")


def _first_turns(pieces: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(
        F.asc_nulls_last("turn_rank"), F.asc_nulls_last("turn_id"), "body"
    )
    return (
        pieces.withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= TURNS_PER_PROMPT)
        .drop("nth")
    )


def prompt_text(turns: DataFrame, order: str = "specific_first") -> DataFrame:
    """(chat_id, safe_text): the redacted chat text, cut to the prompt length.

    Equal to redacting the joined text and cutting it, without building that text:
    no pattern but NAME can match across the border of two turns, and NAME (always
    last) reaches at most the word "Turn" that opens the next one. So each turn is
    redacted alone with that word appended; only turns that can reach the cut are
    collected (the limit on the window drops the rest before the shuffle), each cut where the prompt ends.
    """
    labels = rules.REDACTION_ORDERS[order]
    if labels[-1] != "NAME":
        raise ValueError("NAME must be the last label")
    opening, border = "Turn", "\n\nTurn"
    line = text.format_turn(F.col("turn_rank"), F.col("question"), F.col("response"))
    # The rank stands between a blank and a colon: alone it can be taken for an
    # identifier from seven digits on.
    has_digits = (
        (F.col("turn_rank") >= 1_000_000)
        | F.coalesce(F.col("question").rlike(redact.DIGIT), F.lit(False))
        | F.coalesce(F.col("response").rlike(redact.DIGIT), F.lit(False))
    )
    safe = redact.redact_all(line, labels[:-1], has_digits)
    pieces = drop_null_chat(turns).select(
        "chat_id", "turn_rank", "turn_id", F.substr(safe, F.lit(len(opening) + 1)).alias("body")
    )
    kept = _first_turns(pieces, ["chat_id"])
    # One character past the prompt still says that it is too long.
    inner = F.left(redact.redact(F.concat("body", F.lit(border)), "NAME"), F.lit(rules.PROMPT_CHARS + 1))
    joined = (
        kept.withColumn("inner", inner)
        .groupBy("chat_id")
        .agg(
            F.expr(f"listagg(inner, '') WITHIN GROUP (ORDER BY {IN_ORDER}, body)").alias("all_inner"),
            F.max_by("inner", turn_position("body")).alias("last_inner"),
            F.max_by("body", turn_position("body")).alias("last_body"),
        )
    )
    before_last = F.left("all_inner", F.length("all_inner") - F.length("last_inner"))
    whole = F.concat(F.lit(opening), before_last, redact.redact(F.col("last_body"), "NAME"))
    return joined.select("chat_id", text.truncate_text(whole).alias("safe_text"))
