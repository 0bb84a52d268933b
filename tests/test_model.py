import os
import subprocess
import sys
import tempfile

from pyspark.sql import functions as F

from talkweave.operators import model
from talkweave.staging import ship_package

OPTIONS = model.CallOptions(partitions=2, threads=2, attempts=3, pause=0.0)


def logged_client(path):
    """Appends every prompt's last word to a file, then behaves as the word says."""

    def factory():
        def answer(prompt, **settings):
            word = prompt.split()[-1]
            with open(path, "a") as log:
                log.write(f"{word} {settings['max_tokens']}\n")
            if word == "throttled":
                raise RuntimeError("ThrottlingException: slow down")
            if word == "broken":
                raise RuntimeError("x" * 300)
            if word in ("filtered", "hopeless") and settings["max_tokens"] == 250:
                return "content_filtered", ""
            if word == "refused" and settings["max_tokens"] == 250:
                raise RuntimeError("content was filtered")
            if word == "twice":
                return "content_filtered", "SUMMARY: cut"
            if word == "silent":
                return "end_turn", None
            if word == "hopeless":
                return "end_turn", "blocked by content filters"
            return "end_turn", f" SUMMARY: about {word}\nSENTIMENT: Positive\nKEYWORDS: k1, k2 "

        return answer

    return factory


def test_enrich_with_model(spark):
    words = ["fine", "throttled", "broken", "filtered", "refused", "hopeless", "twice", "silent"]
    rows = [(w, w) for w in words] + [("blank", " \n")]
    texts = spark.createDataFrame(rows, "chat_id string, safe_text string")
    log = os.path.join(tempfile.mkdtemp(prefix="talkweave-test-"), "calls")
    result = model.enrich_with_model(texts, logged_client(log), OPTIONS)
    assert result.count() == 9  # reading again makes no calls
    got = {r.chat_id: (r.summary, r.chat_sentiment, r.keywords, r.status) for r in result.collect()}
    assert got == {
        "fine": ("about fine", "Positive", "k1, k2", "OK"),
        "throttled": ("ERROR: max retries exceeded", "ERROR", "", "ERROR"),
        "broken": ("ERROR: " + "x" * 200, "ERROR", "", "ERROR"),
        "filtered": ("about filtered", "Positive", "", "OK"),
        "refused": ("about refused", "Positive", "", "OK"),
        "hopeless": ("CONTENT_FILTERED", "Neutral", "", "CONTENT_FILTERED"),
        "twice": ("CONTENT_FILTERED", "Neutral", "", "CONTENT_FILTERED"),
        "silent": ("ERROR: no text in the answer", "ERROR", "", "ERROR"),
        "blank": ("NO_CONTENT", "Neutral", "", "NO_CONTENT"),
    }
    with open(log) as calls:
        seen = sorted(calls.read().split("\n"))
    counted = {w: sum(line.startswith(w) for line in seen) for w in words}
    assert counted == {
        "fine": 1, "throttled": 3, "broken": 3, "filtered": 2, "refused": 2, "hopeless": 2, "twice": 2, "silent": 1,
    }


def test_workers_import_the_package_from_any_folder(tmp_path):
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from talkweave.operators import model
from talkweave.staging import ship_package
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
texts = spark.createDataFrame([("a", "x")], "chat_id string, safe_text string")
say = lambda: lambda prompt, **settings: ("end_turn", "SUMMARY: s")
print("GOT", model.enrich_with_model(texts, say, model.CallOptions(1, 1)).count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "GOT 1" in done.stdout, done.stderr[-2000:]


def test_prompts_are_made_once(spark):
    texts = spark.createDataFrame([("a", "fine")], "chat_id string, safe_text string")
    made = texts.select("chat_id", F.regexp_replace("safe_text", "redaction", "").alias("safe_text"))
    result = model.enrich_with_model(made, logged_client(os.devnull), OPTIONS)
    assert "redaction" not in result._jdf.queryExecution().optimizedPlan().toString()


def test_the_package_is_shipped_once_whatever_session_asks(spark):
    """Each micro-batch has a session of its own; a second archive of the same name is refused on a cluster."""
    for session in (spark, spark.newSession(), spark.newSession()):
        ship_package(session)
    archives = [f for f in spark.sparkContext.listFiles if f.endswith("/talkweave-package.zip")]
    assert len(archives) == 1
