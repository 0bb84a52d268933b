"""One plan for every size: a chat of half of all rows gives the same results."""

import pytest
from pyspark.sql import functions as F

from talkweave import staging
from talkweave.operators import chats
from talkweave.sources import turns as source
from tests.test_chats import make_turns, random_turns


def one_large(spark):
    rows = random_turns(3)
    large = [("large", f"t{i:05d}", i, f"question {i}", f"answer {i}", "2026-01-01") for i in range(1, len(rows) + 3000)]
    return rows, large, make_turns(spark, rows + large)


def test_large_chat(spark):
    rows, large, turns = one_large(spark)
    texts = {r.chat_id: r.chat_text for r in chats.chat_text(turns).collect()}
    assert texts["large"] == "\n\n".join(f"Turn {i}:\nUser: question {i}\nBot: answer {i}" for i in range(1, len(large) + 1))
    alone = {r.chat_id: r.chat_text for r in chats.chat_text(make_turns(spark, rows)).collect()}
    assert {k: v for k, v in texts.items() if k != "large"} == alone
    prompts = {r.chat_id: r.safe_text for r in chats.prompt_text(turns).collect()}
    assert prompts["large"].startswith("Turn 1:") and len(prompts["large"]) <= 8100


@pytest.mark.parametrize("gap", [1, 86_400])
def test_large_conversation_in_blocks(spark, monkeypatch, gap):
    monkeypatch.setattr(source, "BLOCK", 50)
    n = 1000
    said = [(1, i * gap, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(n)]
    said += [(c, i, "user", f"c{c} {i}") for c in range(2, 300) for i in range(3)]
    pairs = source.pair_messages(spark.createDataFrame(said, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.turn_rank): (r.question, r.response) for r in pairs.collect()}
    assert len(got) == n // 2 + 298 * 3
    assert all(got[1, i + 1] == (f"m{2 * i}", f"m{2 * i + 1}") for i in range(n // 2))


def test_clustered_turn_numbers_make_even_blocks(spark, monkeypatch):
    """One conversation whose turns are times, nearly all of them within seconds, and single ones years apart."""
    monkeypatch.setattr(source, "BLOCK", 50)
    n = 6000
    times = [i * 30_000_000 for i in range(40)] + [1_300_000_000 + i for i in range(n - 80)] + [1_400_000_000 + i * 30_000_000 for i in range(40)]
    said = spark.createDataFrame(
        [("c", t, "user" if i % 3 == 0 else "assistant", f"m{i}") for i, t in enumerate(times)], "conv_id string, turn long, role string, text string"
    ).repartition(16)
    blocks = source.in_blocks(said)
    assert blocks.groupBy("block").count().agg(F.max("count")).first()[0] <= 50
    tasks = [r["count"] for r in blocks.repartition(8, "conv_id", "block").groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 8 and max(tasks) <= 2 * sorted(tasks)[4]
    got = sorted((r.turn_rank, r.question, r.response) for r in source.pair_messages(said).collect())
    assert got == [(k + 1, f"m{3 * k}", f"m{3 * k + 1}") for k in range(n // 3)]


def test_order_of_arrival_does_not_matter(spark):
    said = [(1, 0, "user", "q"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 2, "user", "r")]
    schema = "conv_id long, turn long, role string, text string"
    one, other = (
        sorted(map(tuple, source.pair_messages(spark.createDataFrame(rows, schema).coalesce(1)).collect()))
        for rows in (said, said[::-1])
    )
    assert one == other == [(1, 1, "q", "a"), (1, 2, "r", None)]


def test_scans_of_the_initial_plan(spark, tmp_path):
    said = spark.createDataFrame([(1, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    said.write.parquet(str(tmp_path / "said"))
    pairs = source.pair_messages(spark.read.parquet(str(tmp_path / "said")))
    turns = pairs.select(
        F.col("conv_id").cast("string").alias("chat_id"), F.lit("t").alias("turn_id"), "turn_rank", "question", "response"
    )
    plan = chats.chat_text(turns)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") <= 4


def test_shared_dir():
    class Fake:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        staging.shared_dir(Fake)
    Fake.sparkContext.master = "local[2]"
    assert staging.shared_dir(Fake) == staging.shared_dir(Fake)
    Fake.conf.get = staticmethod(lambda key, default: "hdfs://shared/x")
    assert staging.shared_dir(Fake) == "hdfs://shared/x"
