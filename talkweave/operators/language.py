"""Statistical language identification as joins, and the vote of a chat's turns.

Rank-order character trigram profiles after Cavnar and Trenkle (1994).
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions import language as rule
from talkweave.functions.text import letter_words
from talkweave.staging import materialise

PROFILE_SIZE = 300
#: Characters at which held-out texts are cut, so that limits exist for short texts too.
CUTS = (25, 50, 100, 200)


def train_profiles(labelled: DataFrame) -> DataFrame:
    """(language, trigram, profile_rank): the most frequent trigrams per language.

    ``labelled`` has the columns text and lang (ISO code). Words are counted first,
    so trigrams are cut from distinct words only; outer forms, because the other ones also cut the words in a filter of empty arrays. The result has at most
    PROFILE_SIZE rows for each of the listed languages.
    """
    names = F.create_map(*[F.lit(x) for pair in rules.LANGUAGE_CODES.items() for x in pair])
    known = labelled.filter(F.col("lang").isin(list(rules.LANGUAGE_CODES)))
    words = (
        known.select("lang", F.explode_outer(letter_words(F.col("text"))).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = (
        words.select("lang", "n", F.explode_outer(rule.trigrams(F.col("word"))).alias("trigram"))
        .groupBy("lang", "trigram")
        .agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "trigram")
    return (
        counts.withColumn("profile_rank", F.row_number().over(by_count))
        .filter(F.col("profile_rank") <= PROFILE_SIZE)
        .select(names[F.col("lang")].alias("language"), "trigram", "profile_rank")
    )


def _distinct_texts(texts: DataFrame, column: str) -> DataFrame:
    """(text_id, scored_text), stored: each distinct text once, with a number that the steps after it carry in place of the text."""
    distinct = texts.select(F.col(column).alias("scored_text")).distinct()
    return materialise(distinct.withColumn("text_id", F.monotonically_increasing_id()), "distinct-texts")


def _language_scores(distinct: DataFrame, profiles: DataFrame) -> DataFrame:
    """(text_id, n, language, score) of ``_distinct_texts``: the number of a text's distinct trigrams and the sum of 300 - |rank difference| over the known ones.

    Trigrams are ranked within the row and meet the profiles, PROFILE_SIZE rows a language, where they are; a row per text and language is what
    a task holds. The outer form spares the ranking that a filter of empty arrays, put before the other form, would do over.
    """
    ranked = distinct.select("text_id", rule.ranked_trigrams(F.col("scored_text")).alias("ranked"))
    ranked = ranked.select("text_id", F.size("ranked").alias("n"), F.posexplode_outer("ranked").alias("before", "trigram"))
    closeness = PROFILE_SIZE - F.abs(F.col("before") + 1 - F.col("profile_rank"))
    return (
        ranked.join(F.broadcast(profiles), "trigram")
        .groupBy("text_id", "n", "language")
        .agg(F.sum(closeness).alias("score"))
    )


def ngram_language(texts: DataFrame, column: str, profiles: DataFrame, out: str) -> DataFrame:
    """``texts`` with ``out``: the best language of ``column``, null if no trigram is known.

    Each distinct text is scored once; ``column`` must not be null. ``texts`` is read twice.
    """
    distinct = _distinct_texts(texts, column)
    best = _language_scores(distinct, profiles).groupBy("text_id").agg(
        F.min_by("language", F.struct(-F.col("score"), F.col("language"))).alias(out)
    )
    found = distinct.join(best, "text_id").select("scored_text", out)
    return texts.join(found, F.col(column) == F.col("scored_text"), "left").drop("scored_text")


def closest_language(texts: DataFrame, column: str, profiles: DataFrame) -> DataFrame:
    """(scored_text, language, share, margin, band) of each distinct text with a positive score.

    ``share`` is the score in thousandths of what the text would get if each of its trigrams stood at its own rank in the profile, ``margin`` the lead over
    the second language in thousandths of the score. Both depend on the length: ``band`` is the number of distinct trigrams as a power of two.
    """
    distinct = _distinct_texts(texts, column)
    scores = _language_scores(distinct, profiles).filter(F.col("score") > 0)
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "language")))
    best = distinct.join(scores.groupBy("text_id", "n").agg(order.alias("order")), "text_id").select(
        "scored_text",
        F.col("order")[0].language.alias("language"),
        (-F.col("order")[0].minus).alias("score"),
        F.coalesce(-F.get("order", F.lit(1)).minus, F.lit(0)).alias("second"),
        "n",
    )
    return best.select(
        "scored_text", "language",
        F.expr(f"1000 * score div ({PROFILE_SIZE} * n)").alias("share"),
        F.expr("1000 * (score - second) div score").alias("margin"),
        (F.length(F.bin("n")) - 1).alias("band"),
    )


def language_limits(held_out: DataFrame, profiles: DataFrame, loss: float = 0.02) -> DataFrame:
    """(language, band, least_share, least_margin): what all but ``loss`` of the rightly named held-out texts reach, for each of the two.

    ``held_out`` has the columns text (cleaned, not null) and lang (ISO code), of texts that no profile was trained on. At most one row per
    language and power of two.
    """
    names = F.create_map(*[F.lit(x) for pair in rules.LANGUAGE_CODES.items() for x in pair])
    cut = held_out.select(
        names[F.col("lang")].alias("true_language"), F.explode(F.array(*[F.left("text", F.lit(n)) for n in CUTS])).alias("cut")
    )
    found = cut.join(closest_language(cut, "cut", profiles), F.col("cut") == F.col("scored_text"))
    return found.filter(F.col("true_language") == F.col("language")).groupBy("language", "band").agg(
        *[F.expr(f"percentile_disc({loss}) WITHIN GROUP (ORDER BY {c})").alias(f"least_{c}") for c in ("share", "margin")]
    )


def open_language(texts: DataFrame, column: str, profiles: DataFrame, out: str, limits: DataFrame) -> DataFrame:
    """``texts`` with ``out``: the best language of ``column`` if it is as close, and leads by as much, as held-out texts of that language and length.

    Null otherwise: for texts of languages without a profile, without a known trigram, or shorter than any held-out text of ``language_limits``.
    ``column`` must not be null. ``texts`` is read twice.
    """
    near = (F.col("share") >= F.col("least_share")) & (F.col("margin") >= F.col("least_margin"))
    best = closest_language(texts, column, profiles).join(limits, ["language", "band"]).filter(near)
    found = best.select("scored_text", F.col("language").alias(out))
    return texts.join(found, F.col(column) == F.col("scored_text"), "left").drop("scored_text")


def turn_language(
    turns: DataFrame, profiles: DataFrame, keys: list[str], strip_punctuation: bool = False, limits: DataFrame | None = None
) -> DataFrame:
    """(keys, language, votes): turns per language, question first, response second.

    With ``limits`` (``language_limits``) a text in a language without a profile is unknown, as one without a known trigram is. Turns that rules decide carry no text beyond the first projection and collapse
    to one row per key before the shuffle. The rest is stored and scored.
    """

    def by_score(texts, column, out):
        if limits is None:
            return ngram_language(texts, column, profiles, out)
        return open_language(texts, column, profiles, out, limits)

    def rule_of(cleaned):
        return rule.rule_language(cleaned, strip_punctuation)

    cleaned = turns.select(
        *keys,
        rule.lang_clean(F.col("question_raw")).alias("q"),
        rule.lang_clean(F.col("response_raw")).alias("r"),
    )
    ruled = cleaned.select(
        *keys,
        rule_of(F.col("q")).alias("q_rule"),
        rule_of(F.col("r")).alias("r_rule"),
        F.when(rule.has_language(F.col("q")), F.col("q")).alias("q"),
        F.when(rule.has_language(F.col("r")), F.col("r")).alias("r"),
    )
    ask = F.when(F.col("q_rule").isNull(), F.col("q"))
    reply = F.when(F.col("r_rule").isNull(), F.col("r"))
    settled = F.coalesce(
        "q_rule", F.when(ask.isNull(), F.coalesce(F.col("r_rule"), F.when(reply.isNull(), "English")))
    )
    opened = F.col("language").isNull()
    votes = materialise(
        ruled.select(*keys, "r_rule", ask.alias("ask"), reply.alias("reply"), settled.alias("language"))
        .select(
            *keys, "language",
            *[F.when(opened, F.col(c)).alias(c) for c in ("ask", "reply", "r_rule")],
        )
        .groupBy(*keys, "language", "ask", "reply", "r_rule")
        .agg(F.count(F.lit(1)).alias("votes")),
        "language-votes",
    )
    first = votes.filter(opened).withColumn("text", F.coalesce("ask", "reply"))
    named = F.coalesce("by_text", "r_rule")
    asked = materialise(
        by_score(first, "text", "by_text").select(
            *keys,
            named.alias("language"),
            # A question no profile knows leaves the decision to the response.
            F.when(named.isNull() & F.col("ask").isNotNull(), F.col("reply")).alias("reply"),
            "votes",
        ),
        "language-asked",
    )
    second = asked.filter(opened & F.col("reply").isNotNull()).drop("language")
    replied = by_score(second, "reply", "language")
    columns = [*keys, "language", "votes"]
    parts = [votes.filter(~opened), asked.filter(~opened | F.col("reply").isNull()), replied]
    whole = reduce(DataFrame.unionByName, [part.select(columns) for part in parts])
    return (
        whole.na.fill({"language": "English"})
        .groupBy(*keys, "language")
        .agg(F.sum("votes").alias("votes"))
    )


def chat_language(
    turns: DataFrame, profiles: DataFrame, strip_punctuation: bool = False, limits: DataFrame | None = None
) -> DataFrame:
    """(chat_id, user_language): the most frequent turn language, ties by name."""
    named = turns.filter(F.col("chat_id").isNotNull())
    votes = turn_language(named, profiles, ["chat_id"], strip_punctuation, limits)
    return votes.groupBy("chat_id").agg(
        F.min_by("language", F.struct(-F.col("votes"), F.col("language"))).alias("user_language")
    )
