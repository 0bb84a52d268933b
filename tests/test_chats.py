import random

import pytest

from tests.test_redact import SEPARATORS, PIECES, sanitized
from talkweave.operators import chats
from talkweave.schema import TURN_SCHEMA
from talkweave.sources import turns as source


def make_turns(spark, rows):
    """Rows of (chat_id, turn_id, turn_rank, question, response, chat_date)."""
    return spark.createDataFrame([(*r, r[3], r[4]) for r in rows], TURN_SCHEMA)


def random_turns(seed, n_chats=60, most=6):
    rng = random.Random(seed)

    def say():
        return "".join(rng.choice(PIECES) + rng.choice(SEPARATORS) for _ in range(rng.randint(0, 5)))

    rows = []
    for chat in range(n_chats):
        for rank in range(1, rng.randint(1, most) + 1):
            response = None if rng.random() < 0.2 else say()
            rows.append((f"c{chat}", f"t{rank}", rank, say(), response, None))
    rng.shuffle(rows)
    return rows


def joined_text(rows):
    texts = {}
    for chat, _, rank, question, response, _ in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        line = f"Turn {rank}:\nUser: {question or ''}\nBot: {response or ''}"
        texts.setdefault(chat, []).append(line)
    return {chat: "\n\n".join(lines) for chat, lines in texts.items()}


@pytest.mark.parametrize("block", [1024, 2])
def test_chat_text(spark, monkeypatch, block):
    monkeypatch.setattr(chats, "RANK_BLOCK", block)
    rows = random_turns(5) + [("long", f"t{i}", i, "q", "r", None) for i in range(1, 3000)]
    got = chats.chat_text(make_turns(spark, rows))
    assert {r.chat_id: r.chat_text for r in got.collect()} == joined_text(rows)


@pytest.mark.parametrize("order", ["specific_first", "shipped"])
def test_prompt_text_equals_redacting_the_whole(spark, order):
    rows = random_turns(6)
    rows += [("wordy", f"t{i}", i, "Ask Dr", "Jane x@y.com " * 40, None) for i in range(1, 60)]
    rows += [("terse", f"t{i}", i, "", "", None) for i in range(1, 1500)]
    rows += [("far", f"t{i}", i, "a", None, None) for i in (999_999, 1_000_000, 12_345_678, 10**15)]
    got = chats.prompt_text(make_turns(spark, rows), order)
    expected = {c: sanitized(t, order)[:8000] for c, t in joined_text(rows).items()}
    assert {r.chat_id: r.safe_text for r in got.collect()} == expected


def test_facts_and_order(spark):
    rows = [
        ("a", "t2", 2, "q2", "I don't have access", "2026-01-02"),
        ("a", "t1", 1, "q1", None, None),
        ("a", "t0", None, "late", "x", "2026-01-01"),
        ("b", "t1", 1, None, "fine", None),
        (None, "t1", 1, "lost", "lost", None),
    ]
    turns = make_turns(spark, rows)
    facts = {r.chat_id: r for r in chats.chat_facts(chats.flag_turns(turns)).collect()}
    assert set(facts) == {"a", "b"}
    assert (facts["a"].total_turns, facts["a"].is_in_scope, facts["a"].chat_date) == (2, "N", "2026-01-02")
    assert (facts["b"].total_turns, facts["b"].is_in_scope, facts["b"].chat_date) == (1, "Y", None)
    texts = {r.chat_id: r.chat_text for r in chats.chat_text(turns).collect()}
    assert [line for line in texts["a"].split("\n") if line.startswith("User")] == [
        "User: q1", "User: q2", "User: late",
    ]
    assert texts["b"] == "Turn 1:\nUser: \nBot: fine"


def test_acronyms(spark):
    dim = spark.createDataFrame([("API",), ("SLA",), ("NA",)], "acronym_shrt string")
    rows = [
        ("a", "t1", 1, "the API, or api-SLA?", "APIs", None),
        ("a", "t2", 2, "API", None, None),
        ("b", "t1", 1, "none", "R&D", None),
    ]
    turns = make_turns(spark, rows)
    found = chats.chat_acronyms(turns, dim).collect()
    assert [(r.chat_id, r.acronym_count, r.acronyms_found) for r in found] == [("a", 2, "API, SLA")]
    per_turn = chats.turn_acronyms(turns, dim, ["chat_id", "turn_id"]).collect()
    assert {(r.turn_id, tuple(r.acronyms)) for r in per_turn} == {("t1", ("API", "SLA")), ("t2", ("API",))}


def test_limit_prefilter_unseen(spark):
    turns = make_turns(spark, random_turns(7, 10))
    assert chats.limit_chats(turns, 0).count() == turns.count()
    kept = {r.chat_id for r in chats.limit_chats(turns, 3).select("chat_id").collect()}
    assert kept == {"c0", "c1", "c2"}
    made = spark.createDataFrame(
        [("a", 1, "x"), ("b", 2, " \n"), ("c", 2, "x"), ("d", 3, None)],
        "chat_id string, total_turns long, chat_text string",
    )
    assert [r.chat_id for r in chats.prefilter_chats(made).collect()] == ["c"]
    done = made.filter("chat_id < 'c'")
    assert {r.chat_id for r in chats.unseen_chats(made, done).collect()} == {"c", "d"}


def test_first_file_wins(spark):
    rows = [("a", 1, "f1"), ("a", 2, "f2"), ("b", 1, "f2"), ("a", 3, "f1")]
    turns = spark.createDataFrame(rows, "chat_id string, turn_rank int, source_file string")
    kept = {(r.chat_id, r.turn_rank) for r in chats.first_file_wins(turns).collect()}
    assert kept == {("a", 1), ("a", 3), ("b", 1)}


MESSAGES = "conv_id long, turn long, role string, text string"


def paired(rows):
    expected = []
    by_conv = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        if role != "system":
            by_conv.setdefault(conv, []).append((role, text))
    for conv, said in by_conv.items():
        rank = 0
        for i, (role, text) in enumerate(said):
            if role == "user":
                rank += 1
                follows = said[i + 1] if i + 1 < len(said) else (None, None)
                expected.append((conv, rank, text, follows[1] if follows[0] == "assistant" else None))
    return sorted(expected)


@pytest.mark.parametrize("block", [4096, 4, 1])
def test_pair_messages(spark, monkeypatch, block):
    monkeypatch.setattr(source, "BLOCK", block)
    rng = random.Random(8)
    rows = []
    for conv in range(40):
        turn = 0
        for _ in range(rng.randint(1, 30)):
            turn += rng.choice([1, 1, 1, 3, 9])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "user"]), f"m{conv}.{turn}"))
    rng.shuffle(rows)
    got = source.pair_messages(spark.createDataFrame(rows, MESSAGES))
    assert sorted(tuple(r) for r in got.collect()) == paired(rows)


def test_result_does_not_depend_on_partitions(spark):
    rows = random_turns(9)
    seen = set()
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        turns = make_turns(spark, rows).repartition(int(partitions))
        texts = chats.prompt_text(turns).join(chats.chat_text(turns), "chat_id")
        seen.add(tuple(sorted(tuple(r) for r in texts.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1
