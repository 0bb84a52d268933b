import time
from collections import Counter

from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions import language as rule
from talkweave.operators import language

LONG_ENGLISH = "this is a rather long english sentence with more than fifty letters in it"

EDGES = {
    "hi": None,
    "hey": "English",
    "12 34 56": None,
    "a 1 b 2": None,
    "x" * 49: "English",
    "x" * 50: None,
    LONG_ENGLISH: None,
    "你好世界": "Chinese",
    "漢字かな": "Japanese",
    "カタカナ": "Japanese",
    "안녕하세요": "Korean",
    "مرحبا": "Arabic",
    "नमस्ते": "Hindi",
    "ışık": "Turkish",
    "größe": "German",
    "mera order kaha hai": "Hindi",
    "mera order kaha hai?": "English",
    "Привет мир": None,
    "quelle heure est il ça": None,
}


def test_rules(column_values):
    got = column_values(rule.rule_language, list(EDGES))
    assert dict(zip(EDGES, got)) == EDGES


def test_strip_punctuation_option(column_values):
    got = column_values(lambda c: rule.rule_language(c, True), ["mera order kaha hai?"])
    assert got == ["Hindi"]


def test_trigrams(column_values):
    assert column_values(rule.trigrams, ["Ab c", "", "!"]) == [[" ab", "ab ", " c "], [], []]
    assert column_values(rule.trigrams, [None]) == [None]


def cleaned_whole(column):
    return F.left(rule._cleaned(F.coalesce(column, F.lit(""))), F.lit(rules.LANGUAGE_CHARS))


def test_the_start_of_a_long_text_is_cleaned_as_the_whole_text_is(column_values):
    first = rule.CLEANED_FIRST
    words, noise = "word " * 200, "* # ` " * 100
    texts = [
        None, "", "x" * 3 * first, words, noise + words, "\n" * first + words, words[: first - 10] + "see a@b.example.com/" + "y" * first + " " + words,
        "[" + words + "](http://x.org) after", "[[" + words + "]] after " + words, "[open\n" + words + "](x) " + words, "[open\n" * 100 + words,
        "a " * 90 + "https://x.org/" + "z" * first + " " + words, "Mail ann@example.com " + words, "é漢𝄞 " * 300, "\u3000" + words + "\u2003", "B0ABCD1234 " * 100,
        words[:-1] + "\x1c" + words, words[: first - 1] + "$5" + words, words[: first - 3] + "AB_CDE " + words,
    ]
    assert column_values(rule.lang_clean, texts) == column_values(cleaned_whole, texts)


def test_long_texts_are_not_cleaned_whole(column_values):
    # Tens of millions of steps of the pattern of addresses, were the tail looked at.
    texts = ["some words of a plain text " * 20 + "@" * 20_000] * 8
    started = time.monotonic()
    assert set(column_values(rule.lang_clean, texts)) == {("some words of a plain text " * 20)[:200]}
    assert time.monotonic() - started < 20


CORPUS = [
    ("en", "the quick brown fox jumps over the lazy dog and then the other thing with that there"),
    ("fr", "le petit chat est dans la maison avec les enfants qui sont très contents pour nous"),
    ("es", "el perro grande come en la casa de los amigos que son muy buenos para nosotros"),
    ("xx", "unknown codes are not trained"),
    (None, "nor are missing ones"),
]


def profiles(spark):
    return language.train_profiles(spark.createDataFrame(CORPUS, "lang string, text string"))


def test_profiles(spark):
    rows = profiles(spark).collect()
    assert {r.language for r in rows} == {"English", "French", "Spanish"}
    english = sorted((r.profile_rank, r.trigram) for r in rows if r.language == "English")
    assert [rank for rank, _ in english] == list(range(1, len(english) + 1))
    assert english[0][1] == " th"


def turn(chat, rank, question, response):
    return (chat, f"t{rank}", rank, question, response)


def test_turn_and_chat_language(spark):
    french = "le chat est dans la maison avec les enfants et il dort pour nous"
    spanish = "el perro come en la casa de los amigos que son buenos para el"
    cyrillic = "Привет как дела у тебя сегодня мой хороший друг из далёкого города"
    rows = [
        turn("a", 1, french, spanish),
        turn("a", 2, french, None),
        turn("a", 2, french, None),  # an equal turn counts again
        turn("a", 3, "ok thanks", None),
        turn("b", 1, None, spanish),
        turn("b", 2, "12", "größe"),
        turn("c", 1, cyrillic, spanish),  # no trigram known: the response decides
        turn("d", 1, cyrillic, None),  # nothing decides
        turn("e", 1, "", ""),
        turn(None, 1, "ok thanks", ""),
    ]
    turns = spark.createDataFrame(
        rows, "chat_id string, turn_id string, turn_rank long, question_raw string, response_raw string"
    )
    votes = language.turn_language(turns, profiles(spark), ["chat_id"]).collect()
    counted = {(r.chat_id, r.language): r.votes for r in votes}
    assert counted[("a", "French")] == 3 and counted[("a", "English")] == 1
    chats = {r.chat_id: r.user_language for r in language.chat_language(turns, profiles(spark)).collect()}
    assert chats == {"a": "French", "b": "German", "c": "Spanish", "d": "English", "e": "English"}


def test_score_is_rank_distance(spark):
    made = spark.createDataFrame(
        [("A", " ab", 1), ("A", "ab ", 2), ("B", "ab ", 1), ("B", " ab", 5)],
        "language string, trigram string, profile_rank int",
    )
    found = language.ngram_language(spark.createDataFrame([("ab",), ("zz",), ("ab",)], "x string"), "x", made, "y")
    assert sorted((r.x, r.y) for r in found.collect()) == [("ab", "A"), ("ab", "A"), ("zz", None)]


def test_trigrams_are_ranked_by_count_and_name_within_the_row(column_values):
    texts = ["abab ab", "", "1 2", "é é ée", "aaaa", "Zz zz"]
    counted = [Counter(t) for t in column_values(rule.trigrams, texts)]
    want = [sorted(c, key=lambda t: (-c[t], t)) for c in counted]
    assert column_values(rule.ranked_trigrams, texts) == want


def test_no_step_groups_by_a_text_and_its_trigrams(spark):
    """Rows of text and trigram take hundreds of times the text, in one task."""
    made = spark.createDataFrame([("French", " ab", 1), ("English", "ab ", 1)], "language string, trigram string, profile_rank int")
    texts = spark.createDataFrame([("ab",), ("zz ab",)], "x string")
    plan = language.ngram_language(texts, "x", made, "y")._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Aggregate [")[1].split("]")[0] for line in plan.splitlines() if "Aggregate [" in line]
    assert keys and not [k for k in keys if "trigram" in k or "scored_text" in k]


def test_texts_are_cut_once(spark):
    distinct = spark.createDataFrame([(1, "el perro grande")], "text_id long, scored_text string")
    plan = language._language_scores(distinct, profiles(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 3  # the words of a labelled text, the trigrams of a word, those of a scored text
