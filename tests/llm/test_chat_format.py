import hashlib
import random

import duckdb

from talkweave.llm import chat_format, queries, sql


def test_query_equals_sql(spark, sf):
    frame = queries.op8_chat_format(spark, sf)
    got = sorted(map(tuple, frame.select(sorted(frame.columns)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute(sql.oracle_sql()["op8_chat_format"]).df()
    assert got == sorted(map(tuple, want[sorted(want.columns)].itertuples(index=False)))


def test_escapes_are_exact():
    random.seed(6)
    t = chat_format.DEFAULT
    pieces = [*t.controls, "\\", "\\\\", "<", "[", "/", "</", " ", "\n", "s>", "INST]", "é", "text", t.role_end]
    for _ in range(3000):
        turns = [(random.choice(["system", "user", "assistant", "tool", "", "[TEXT]"]), "".join(random.choice(pieces) for _ in range(6))) for _ in range(3)]
        parts = [s for role, text in turns for s in t.segments(role, text)]
        assert list(t.read("".join(s for s, _ in parts))) == turns
        assert [t.unescaped(s) for s, loss in parts if loss] == [x for r, x in turns if r == "assistant"]
        for _, text in turns:
            assert not any(c in t.escaped(text) for c in t.controls)


def test_state_machine():
    faults = chat_format.turn_faults
    assert faults(["system", "user", "assistant", "user", "assistant"]) == []
    assert faults(["user"]) == [1] and faults(["assistant"]) == [0] and faults(["user", "user", "assistant"]) == [1]
    assert faults(["user", "tool", "assistant"]) == [1, 2] and faults([]) == [0]


def test_messy(spark):
    rows = [
        (1, 0, "user", None, "x"), (1, 1, "assistant", "a", "x"), (1, 1, "assistant", "a", "x"), (None, 0, "user", "n", "x"),
        (2, None, None, "no role", "x"), (2, 3, "user", "q" * 300_000, "x"), (3, 5, "user", "", "x"), (3, 4, "system", "s", "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    segments = chat_format.format_conversations(frame)
    got = {r.conv_id: r for r in chat_format.digests(segments).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\nassistant\na\nassistant\na\n") and not got[1].valid
    assert (got[1].loss_chars, got[1].loss_sha256) == (2, sha("aa"))
    assert got[2].turns_sha256 == sha("\nno role\nuser\n" + "q" * 300_000 + "\n")
    assert got[3].turns_sha256 == sha("system\ns\nuser\n\n") and got[3].loss_sha256 == sha("")
    assert got[None].n_turns == 1
    assert chat_format.digests(chat_format.format_conversations(frame.limit(0))).collect() == []
