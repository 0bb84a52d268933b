from pyspark.sql import functions as F
import pytest

from talkweave.plans import quality_loop as loop
from talkweave.schema import SUMMARY_SCHEMA, conform
from talkweave.sources import summaries as table
from talkweave.staging import new_path

GOOD = ("2026-01-01", "all is well", "Neutral", "a, b, c", "Y", 0, "", "English", 2, "2026-02-01")
COLUMNS = SUMMARY_SCHEMA.names


def rows(spark, **changes):
    """A good row per chat, with the named values changed; a list gives several rows."""
    made = []
    for chat, change in changes.items():
        for one in change if isinstance(change, list) else [change]:
            made.append(tuple((dict(zip(COLUMNS, (None if chat == "none" else chat, *GOOD))) | one).values()))
    return spark.createDataFrame(made, SUMMARY_SCHEMA)


class Redo:
    """Good rows for the chats it is given, but for those called bad; notes what it was asked."""

    def __init__(self):
        self.asked = []

    def __call__(self, again):
        self.asked.append(sorted(r.chat_id for r in again.collect()))
        summary = F.when(F.col("chat_id").startswith("bad"), "ERROR: down").otherwise("done over")
        filled = {c: F.lit(v) for c, v in zip(COLUMNS[1:], GOOD)} | {"summary": summary}
        return conform(again.withColumns(filled), SUMMARY_SCHEMA)


def stored(spark, frame):
    path = new_path(spark, "quality-table")
    table.write_summaries(frame, path)
    return path


def failing(history, run):
    return {r.rule: r.rows_failing for r in history.checks().filter(F.col("run") == run).collect() if r.rows_failing}


def test_failing_chats_alone_are_done_over_and_failures_shrink(spark):
    broken = {"summary": "ERROR: down"}
    path = stored(spark, rows(spark, good={}, ill=broken, bad=broken, moved={"chat_date": None, "is_in_scope": "?"}))
    redo = Redo()
    history = loop.quality_loop(spark, path, redo, loop.Limits(max_tries=2))
    assert redo.asked == [["bad", "ill", "moved"], ["bad"]]
    assert failing(history, "check-00000001") == {"failed": 2, "null_key": 1, "scope_domain": 1}
    assert failing(history, "check-00000002") == failing(history, "check-00000003") == {"failed": 1}
    told = [(r.chats_retried, r.chats_given_up) for r in history.runs().orderBy("run").collect()]
    assert told == [(3, 0), (1, 0), (0, 1)]
    after = {r.chat_id: (r.chat_date, r.summary) for r in table.read_summaries(spark, path).collect()}
    assert after == {
        "good": ("2026-01-01", "all is well"), "ill": ("2026-01-01", "done over"),
        "bad": ("2026-01-01", "ERROR: down"), "moved": ("2026-01-01", "done over"),
    }
    changes = {(r.run[-1], r.rule): r.change for r in history.trend().filter("rule IN ('failed', 'null_key')").collect()}
    assert changes == {("1", "failed"): None, ("1", "null_key"): None, ("2", "failed"): -1, ("2", "null_key"): -1, ("3", "failed"): 0, ("3", "null_key"): 0}


def test_a_rule_within_its_limit_sends_no_chat_back(spark):
    path = stored(spark, rows(spark, a={}, b={}, c={}, d={"user_language": "Klingon"}))
    redo = Redo()
    history = loop.quality_loop(spark, path, redo, loop.Limits({"language_domain": 0.25}))
    assert redo.asked == []
    check = history.checks().filter("rule = 'language_domain'").first()
    assert (check.rows_checked, check.rows_failing, check.passed) == (4, 1, True)
    loop.quality_loop(spark, path, redo, loop.Limits({"language_domain": 0.24}))
    assert redo.asked == [["d"]]


def test_repeated_keys_become_one_row_and_rows_without_chat_stay(spark):
    path = stored(spark, rows(spark, twice=[{}, {}], none={}))
    redo = Redo()
    history = loop.quality_loop(spark, path, redo)
    assert redo.asked == [["twice"]]
    assert failing(history, "check-00000001") == {"unique_key": 2, "null_key": 1}
    assert failing(history, "check-00000002") == {"null_key": 1}
    assert sorted(str(r.chat_id) for r in table.read_summaries(spark, path).collect()) == ["None", "twice"]


def test_a_run_that_broke_off_is_done_over_under_its_name(spark):
    path = stored(spark, rows(spark, ill={"summary": "ERROR: down"}))

    def lost(again):
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        loop.quality_run(spark, path, lost)
    history = loop.history_of(spark, path)
    assert history.runs().isEmpty() and history.next_run() == "check-00000001"
    done = loop.quality_run(spark, path, Redo(), loop.Limits(max_tries=1)).first()
    assert (done.run, done.chats_retried) == ("check-00000001", 1)
    assert history.failing().count() == 1
    assert loop.quality_run(spark, path, Redo()).first().rows_failing == 0


def test_a_chat_that_redo_leaves_out_keeps_its_row_and_others_cannot_slip_in(spark):
    path = stored(spark, rows(spark, good={}, ill={"summary": "ERROR: down"}))
    loop.quality_loop(spark, path, lambda again: rows(spark, good={"summary": "not asked for"}), loop.Limits(max_tries=1))
    assert {r.summary for r in table.read_summaries(spark, path).collect()} == {"all is well", "ERROR: down"}


def test_empty_table_and_unknown_rule(spark):
    history = loop.quality_loop(spark, new_path(spark, "nothing"), Redo())
    assert {(r.rows_checked, r.passed) for r in history.checks().collect()} == {(0, True)}
    with pytest.raises(ValueError, match="no such rules"):
        loop.judge(loop.broken_rows(rows(spark, a={})), 1, {"typo": 0.5})
