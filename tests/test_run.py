import os
import subprocess
import sys
import tempfile

from pyspark.sql import functions as F

from talkweave.operators import language, model
from talkweave.plans import run
from talkweave.schema import TURN_SCHEMA, conform
from talkweave.sources import ledger, summaries
from talkweave.staging import materialise, new_path

CALLS = model.CallOptions(partitions=4, threads=1, attempts=1, pause=0.0)
COUNTS = "chat_id string, total_turns long"
STATE = "chat_id string, outcome string, last_turns long, tries long"


def logged(path):
    """Notes each prompt's chat (its text names it); chats called bad fail, lost ones are filtered."""

    def factory():
        def answer(prompt, **settings):
            name = next(w for w in prompt.split() if w.startswith("chat-"))
            with open(path, "a") as log:
                log.write(name + "\n")
            if "bad" in name:
                raise RuntimeError("down")
            if "lost" in name:
                return "content_filtered", ""
            return "end_turn", f"SUMMARY: {name}\nSENTIMENT: Neutral\nKEYWORDS: a"

        return answer

    return factory


def store(spark, inbox, names, turns=2):
    rows = [(n, f"{n}_{i}", i, "hello", f"about {n} here", "2026-01-01") for n in names for i in range(1, turns + 1)]
    frame = spark.createDataFrame(rows, "chat_id string, turn_id string, turn_rank long, question string, response string, chat_date string")
    conform(frame.withColumns({"question_raw": F.col("question"), "response_raw": F.col("response")}), TURN_SCHEMA).write.mode("append").parquet(inbox)


class Runs:
    def __init__(self, spark):
        self.spark, self.inbox, self.table = spark, new_path(spark, "inbox"), new_path(spark, "table")
        self.log = os.path.join(tempfile.mkdtemp(prefix="talkweave-test-"), "calls")
        texts = spark.createDataFrame([("the and of to in", "en"), ("der und die das", "de")], "text string, lang string")
        self.profiles = materialise(language.train_profiles(texts), "profiles")
        self.acronyms = spark.createDataFrame([], "acronym_shrt string")

    def __call__(self, **options):
        chosen = run.RunOptions(calls=CALLS, **options)
        return run.run_pipeline(self.spark, self.inbox, self.table, self.acronyms, self.profiles, logged(self.log), chosen).first()

    def calls(self):
        return open(self.log).read().split() if os.path.exists(self.log) else []

    def state(self):
        known = run.ledger_of(self.spark, self.table).state("z")
        return {r.chat_id: (r.outcome, r.tries) for r in known.collect()}


def test_limited_runs_go_on(spark):
    runs = Runs(spark)
    store(spark, runs.inbox, ["chat-a1", "chat-a2", "chat-a3"], turns=1)
    store(spark, runs.inbox, ["chat-b1", "chat-b2-bad", "chat-b3-lost", "chat-b4", "chat-b5"])
    results = [runs(limit=2, max_tries=2) for _ in range(3)]
    assert [(r.completed, r.errors, r.filtered, r.skipped, r.retried) for r in results] == [(2, 1, 0, 3, 0), (2, 0, 1, 0, 0), (2, 1, 0, 0, 1)]
    assert [r.run for r in results] == ["run-00000001", "run-00000002", "run-00000003"]
    assert all(r.files_written >= 1 and r.elapsed_seconds > 0 and r.output_path == runs.table for r in results)
    assert runs.calls().count("chat-b2-bad") == 2 and runs.calls().count("chat-b1") == 1
    assert runs.state() == {
        **{f"chat-a{i}": ("SKIPPED", 0) for i in (1, 2, 3)}, "chat-b1": ("DONE", 0), "chat-b4": ("DONE", 0), "chat-b5": ("DONE", 0),
        "chat-b2-bad": ("FAILED", 2), "chat-b3-lost": ("FILTERED", 1),
    }
    store(spark, runs.inbox, ["chat-a2"], turns=2)
    last = runs(limit=2, max_tries=2)
    assert (last.completed, last.filtered, last.skipped) == (2, 1, 0) and runs.state()["chat-a2"] == ("DONE", 0)
    idle = runs(limit=2, max_tries=2)
    assert (idle.completed, idle.skipped, idle.files_written) == (0, 0, 0)
    assert summaries.read_summaries(spark, runs.table).count() == 6
    assert run.ledger_of(spark, runs.table).runs().count() == 5


def test_choose(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 1), ("c", 3), ("d", 3), ("e", 3), ("f", 2), ("g", 2)], COUNTS)
    state = spark.createDataFrame(
        [("a", "SKIPPED", 1, 0), ("b", "SKIPPED", 2, 0), ("c", "FAILED", 3, 1), ("d", "FAILED", 3, 3), ("e", "SKIPPED", 1, 0), ("g", "DONE", 2, 0)], STATE
    )
    done = spark.createDataFrame([("f",)], "chat_id string")

    def chosen(limit):
        return sorted(tuple(r) for r in ledger.choose(counts, done, state, limit).collect())

    assert chosen(0) == [("b", 1, 0, False), ("c", 3, 1, True), ("e", 3, 0, True), ("g", 2, 0, True)]
    assert chosen(2) == [("b", 1, 0, False), ("e", 3, 0, True), ("g", 2, 0, True)]
    assert ledger.choose(counts.limit(0), done, state, 5).collect() == []


def test_a_restarted_run_takes_the_same_chats(spark):
    runs = Runs(spark)
    store(spark, runs.inbox, ["chat-m1", "chat-m2"])
    book = run.ledger_of(spark, runs.table)
    counts = spark.createDataFrame([("chat-m1", 2)], COUNTS)
    book.take(book.next_run(), ledger.choose(counts, counts.limit(0), book.state("z")))
    book.record(book.next_run(), counts, spark.createDataFrame([("chat-m1", "ERROR")], "chat_id string, status string"))
    store(spark, runs.inbox, ["chat-a0"])
    first, second = runs(limit=1), runs()
    assert (first.run, first.completed, second.completed) == ("run-00000001", 1, 2)
    assert runs.calls()[0] == "chat-m1" and runs.state() == {c: ("DONE", 0) for c in ("chat-m1", "chat-m2", "chat-a0")}


KILLED = """
import os, signal, sys
from pyspark.sql import SparkSession
from talkweave.operators import model
from tests.test_run import CALLS
driver = os.getpid()
log, journal = sys.argv[1:]

def factory():
    def answer(prompt, **settings):
        with open(log, "a") as out:
            out.write(prompt + chr(10))
        if len(open(log).read().split()) > 25:
            os.kill(driver, signal.SIGKILL)
        return "end_turn", "SUMMARY: " + prompt
    return answer

spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
prompts = spark.createDataFrame([(f"c{i}", f"p{i}") for i in range(40)], "chat_id string, prompt string")
model.call_model(prompts, factory, {"max_tokens": 5}, model.CallOptions(partitions=10, threads=1), model.Journal(journal))
"""


def noting(path):
    def factory():
        def answer(prompt, **settings):
            with open(path, "a") as log:
                log.write(prompt + "\n")
            return "end_turn", f"SUMMARY: {prompt}"

        return answer

    return factory


def test_a_lost_driver_repeats_few_calls(spark):
    log, path = os.path.join(tempfile.mkdtemp(prefix="talkweave-test-"), "calls"), new_path(spark, "journal")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    killed = subprocess.run([sys.executable, "-c", KILLED, log, path], cwd=repo, env=os.environ | {"PYTHONPATH": repo}, capture_output=True, timeout=300)
    assert killed.returncode != 0
    journal, before = model.Journal(path), open(log).read().split()
    kept = {r.chat_id for r in journal.read(spark).collect()}
    assert len(before) > 25 and len(kept) >= 10
    prompts = spark.createDataFrame([(f"c{i}", f"p{i}") for i in range(40)], "chat_id string, prompt string")
    answers = model.call_model(prompts, noting(log), {"max_tokens": 5}, model.CallOptions(partitions=4, threads=1), journal)
    assert {(r.chat_id, r.text, r.error) for r in answers.collect()} == {(f"c{i}", f"SUMMARY: p{i}", None) for i in range(40)}
    after = open(log).read().split()[len(before):]
    assert sorted(after) == sorted(f"p{i}" for i in range(40) if f"c{i}" not in kept)


def test_journal_tells_calls_apart(spark):
    log, journal = os.path.join(tempfile.mkdtemp(prefix="talkweave-test-"), "calls"), model.Journal(new_path(spark, "journal"))
    rows = [("a", "same"), ("b", "same")]
    for prompts, settings in ((rows, {"t": 1}), (rows, {"t": 1}), (rows[:1], {"t": 2}), ([("a", "other")], {"t": 1})):
        frame = spark.createDataFrame(prompts, "chat_id string, prompt string")
        assert model.call_model(frame, noting(log), settings, CALLS, journal).count() == len(prompts)
    assert sorted(open(log).read().split()) == ["other", "same", "same", "same"]


def test_failed_calls_are_made_again(spark):
    log, journal = os.path.join(tempfile.mkdtemp(prefix="talkweave-test-"), "calls"), model.Journal(new_path(spark, "journal"))
    prompts = spark.createDataFrame([("a", "chat-bad")], "chat_id string, prompt string")
    assert model.call_model(prompts, logged(log), {}, CALLS, journal).first().error == "down"
    assert model.call_model(prompts, noting(log), {}, CALLS, journal).first().text == "SUMMARY: chat-bad"
    assert model.call_model(prompts, logged(log), {}, CALLS, journal).first().error is None
