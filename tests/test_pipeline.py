from talkweave.operators import model, offline
from talkweave.plans.chat_summary import chat_summary, chat_summary_by_model
from talkweave.schema import SUMMARY_SCHEMA
from tests.test_chats import make_turns
from tests.test_language import profiles

GOLDEN = [
    ("chat_1", "t1", 1, "My parcel still shows as processing, can you check?", "Happy to check that. What is the number?", "2026-01-15"),
    ("chat_1", "t2", 2, "It is 111-2345678-9012345", "Thank you. The parcel ships tomorrow, tracking follows.", "2026-01-15"),
    ("chat_1", "t3", 3, "Great, thanks! Can I change the shipping address?", "Yes, the parcel can go to a different address. Which one?", "2026-01-15"),
    ("chat_1", "t4", 4, "Perfect, take 123 Main Street", "The parcel address is changed. Anything else?", "2026-01-15"),
    ("chat_1", "t5", 5, "No, that's all. Thanks!", "Goodbye.", "2026-01-15"),
    ("chat_2", "t1", 1, "Help", "I'm unable to access your specific data. Ask the KYC team.", "2026-01-16"),
    ("chat_2", "t2", 2, "help ", None, "2026-01-16"),
]
AT = "2026-01-20T00:00:00+00:00"


def acronyms(spark):
    return spark.createDataFrame([("KYC",), ("API",)], "acronym_shrt string")


def test_golden_chats(spark):
    result = chat_summary(make_turns(spark, GOLDEN), acronyms(spark), profiles(spark), AT)
    assert result.schema.simpleString() == SUMMARY_SCHEMA.simpleString()
    rows = {r.chat_id: r for r in result.collect()}
    first, second = rows["chat_1"], rows["chat_2"]
    assert (first.chat_date, first.is_in_scope, first.acronym_count, first.acronyms_found) == ("2026-01-15", "Y", 0, "")
    assert (first.user_language, first.total_turns, first.chat_sentiment) == ("English", 5, "Positive")
    assert first.summarized_at == AT
    assert "parcel" in first.keywords.split(", ")
    assert first.summary.startswith("The user asked: My parcel still shows as processing, can you check? The bot")
    assert "Later:" in first.summary and first.summary.endswith("At the end: Goodbye.")
    assert (second.is_in_scope, second.acronym_count, second.acronyms_found) == ("N", 1, "KYC")
    assert second.chat_sentiment == "Negative" and "At the end" not in second.summary


def test_signals(spark):
    features = offline.turn_features(make_turns(spark, GOLDEN))
    rows = {r.chat_id: r for r in offline.user_sentiment(features).collect()}
    assert rows["chat_1"].word_polarity == 4
    second = rows["chat_2"]
    assert (second.unhelpful_turns, second.repeated_questions, second.terse_turns) == (1, 1, 2)


def test_missing_ranks_count_as_last(spark):
    rows = [("c", f"t{i}", None if i == 3 else i, f"question number {i}.", f"answer {w} number {i}.", None)
            for i, w in ((1, "alpha"), (2, "common"), (3, "omega"))]
    rows.append(("d", "t1", 1, "other", "common", None))
    features = offline.turn_features(make_turns(spark, rows))
    scores = offline.keyword_scores(offline.term_frequency(features), features)
    found = {r.chat_id: r.summary for r in offline.chat_summary_extractive(features, scores).collect()}
    assert found["c"] == (
        "The user asked: question number 1. The bot answered: answer alpha number 1. "
        "Later: answer common number 2. At the end: answer omega number 3."
    )


def test_by_model(spark):
    def factory():
        return lambda prompt, **settings: ("end_turn", f"SUMMARY: {len(prompt)}\nSENTIMENT: upset\nKEYWORDS: k")

    result = chat_summary_by_model(
        make_turns(spark, GOLDEN), acronyms(spark), profiles(spark), factory,
        model.CallOptions(partitions=2, threads=2, pause=0.0), AT,
    )
    rows = {r.chat_id: r for r in result.collect()}
    assert rows["chat_1"].chat_sentiment == "Negative" and rows["chat_1"].keywords == "k"
    assert int(rows["chat_1"].summary) > 1000


def test_empty_input(spark):
    assert chat_summary(make_turns(spark, []), acronyms(spark), profiles(spark), AT).count() == 0
