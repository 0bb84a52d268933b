import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from talkweave.plans.quality import acronym_report
from talkweave.schema import TURN_SCHEMA
from talkweave.sources import turns as source
from talkweave.sources.acronyms import acronym_dim


def test_acronym_dim(spark, tmp_path):
    path = tmp_path / "acronyms.csv"
    path.write_bytes("id,acronym_shrt\n1,API\n2,ÄPI\n3,API\n4,\n5,NA\n6,R&D\n".encode("latin-1"))
    dim = acronym_dim(spark, str(path))
    assert {r.acronym_shrt for r in dim.collect()} == {"API", "ÄPI", "NA", "R&D"}
    assert {r.acronym_shrt for r in acronym_report(dim).collect()} == {"ÄPI", "R&D"}


def test_acronym_dim_missing(spark, tmp_path):
    assert acronym_dim(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "other.csv").write_text("name\nAPI\n")
    with pytest.raises(AnalysisException):
        acronym_dim(spark, str(tmp_path / "other.csv"))


def test_scan_turns_skips_and_prunes(spark, tmp_path):
    row = [("a", "t", 1, "q", "r", "2026-01-01", "q", "r")]
    frame = spark.createDataFrame(row, TURN_SCHEMA).withColumn("extra", F.lit(1))
    frame.write.parquet(str(tmp_path / "in"))
    frame.write.parquet(str(tmp_path / "in" / "_hidden"))
    (tmp_path / "in" / "notes.txt").write_text("x")
    turns = source.scan_turns(spark, str(tmp_path / "in"))
    assert turns.columns == TURN_SCHEMA.names and turns.count() == 1


def test_run_date_from_folders(spark, tmp_path):
    for folder in ("dt_20260101", "run-date_20260115", "undated", "dt_20261399"):
        spark.range(1).write.parquet(str(tmp_path / "in" / folder))
    scan = source.with_source_file(spark.read.parquet(*[str(p) for p in (tmp_path / "in").iterdir()]))
    default = F.lit("2026-03-01").cast("date")
    got = scan.select(source.run_date(F.col("source_file"), default).cast("string").alias("d")).collect()
    assert sorted(r.d for r in got) == ["2026-01-01", "2026-01-15", "2026-03-01", "2026-03-01"]
    today = spark.range(1).select(source.run_date(F.lit("x")) == F.current_date()).first()[0]
    assert today


@pytest.mark.parametrize("one_per_file", [True, False])
def test_chat_documents(spark, tmp_path, one_per_file):
    turn = {"turn_id": "t1", "turn_rank": 1, "question": "q", "response": None, "question_raw": "Q"}
    chat = {"chat_id": "c", "chat_date": "2026-01-15", "turns": [turn, {**turn, "turn_id": "t2", "turn_rank": 2}]}
    dumped = json.dumps(chat, indent=2 if one_per_file else None)
    (tmp_path / "chat.json").write_text(dumped)
    turns = source.explode_chat_json(spark, str(tmp_path), one_per_file)
    assert turns.schema == TURN_SCHEMA
    assert sorted(tuple(r)[:4] for r in turns.collect()) == [("c", "t1", 1, "q"), ("c", "t2", 2, "q")]


@pytest.mark.parametrize("one_per_file", [True, False])
def test_rejected_documents(spark, tmp_path, one_per_file):
    turn = {"turn_id": "t1", "turn_rank": 1, "question": "q"}
    said = [
        json.dumps({"chat_id": "fine", "turns": [turn]}), json.dumps({"chat_id": " ", "turns": [turn]}), json.dumps({"turns": [turn]}),
        json.dumps({"chat_id": "empty", "turns": []}), json.dumps({"chat_id": "none"}), '{"chat_id": "cut", "turns": [{"turn_id"',
        json.dumps({"chat_id": "typed", "turns": [{**turn, "turn_rank": "one"}]}),
    ]
    for n, text in enumerate(said):
        (tmp_path / f"{n}.json").write_text(text)
    documents = source.chat_documents(spark, str(tmp_path), one_per_file)
    rejected = source.rejected_documents(documents)
    assert {r.source_file[-6]: r.reason for r in rejected.collect()} == {
        "1": "no chat_id", "2": "no chat_id", "3": "no turns", "4": "no turns", "5": "unreadable", "6": "unreadable",
    }
    assert {r.document for r in rejected.filter("reason = 'unreadable'").collect()} == set(said[5:])
    assert {r.reason: r.rejected for r in source.reject_report(rejected).collect()} == {"no chat_id": 2, "no turns": 2, "unreadable": 2}
    accepted = source.explode_chat_json(spark, str(tmp_path), one_per_file).filter("trim(chat_id) <> ''").collect()
    assert [r.chat_id for r in accepted] == ["fine"]


def test_rejected_turns(spark):
    rows = [("a", "t", 1, "q", None), (None, "t", 1, "q", "r"), (" ", "t", 1, None, None), ("b", "t", None, None, None)]
    turns = spark.createDataFrame([(*r, None, None, None) for r in rows], TURN_SCHEMA.simpleString()[7:-1].replace(":", " "))
    turns = turns.toDF("chat_id", "turn_id", "turn_rank", "question", "response", "chat_date", "question_raw", "response_raw")
    assert {(r.chat_id, r.reason) for r in source.rejected_turns(turns).collect()} == {(None, "no chat_id"), (" ", "no chat_id"), ("b", "no text")}
