from pyspark.sql import functions as F

from talkweave.operators import offline
from talkweave.sources.term_counts import TermCounts, _terms
from talkweave.staging import new_path

FEATURES = "chat_id string, terms array<string>"


def features(spark, rows):
    return spark.createDataFrame(rows, FEATURES)


def state(counts):
    return counts.chats(), {r.term: r.df for r in counts.frequencies().collect()}


def test_differences_sum_to_the_counts_of_all_chats(spark):
    counts = TermCounts(spark, new_path(spark, "term-counts"))
    assert state(counts) == (0, {})
    first = [("a", ["x", "x", "y"]), ("a", ["x"]), ("b", ["y"]), ("c", [])]
    counts.add(features(spark, []), features(spark, first), "r", 0)
    assert state(counts) == (3, {"x": 1, "y": 2})
    after = [("a", ["z"]), ("d", ["x", "y"])]
    for _ in range(2):  # a repeated batch
        counts.add(features(spark, first[:2]), features(spark, after), "r", 1)
        assert state(counts) == (4, {"x": 1, "y": 2, "z": 1})


def test_scores_with_counts_are_those_of_all_chats(spark):
    rows = [("a", ["alpha", "beta", "beta"]), ("b", ["beta", "gamma"]), ("c", ["alpha"]), ("d", ["delta", "gamma"])]
    counts = TermCounts(spark, new_path(spark, "term-counts"))
    for n, row in enumerate(rows):
        counts.add(features(spark, []), features(spark, [row]), "r", n)
    whole = features(spark, rows)

    def scored(frame, *known):
        return {tuple(r) for r in offline.keyword_scores(offline.term_frequency(frame), frame, *known).collect()}

    everything = scored(whole)
    assert scored(whole, counts) == everything
    assert scored(whole.filter(F.col("chat_id") == "b"), counts) == {r for r in everything if r[0] == "b"}


def test_texts_are_cut_once(spark):
    turns = spark.createDataFrame([("a", "t", 1, "what", "the long answer")], "chat_id string, turn_id string, turn_rank int, question string, response string")
    found = _terms(offline.turn_features(turns.withColumn("chat_date", F.lit("2026-01-01"))), 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
