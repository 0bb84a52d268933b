import random
import re

from pyspark.sql import functions as F

from registry.queries import count_summary, run_ingest
from talkweave.plans import quality
from talkweave.schema import SUMMARY_SCHEMA
from talkweave.sources import summaries as table
from talkweave.sources import turns as source
from tests.test_chats import make_turns


def summaries(spark, rows):
    """Rows of (chat_id, chat_date, summary, summarized_at)."""
    made = [(c, d, s, "Neutral", "a, b, c", "Y", 0, "", "English", 1, at) for c, d, s, at in rows]
    return spark.createDataFrame(made, SUMMARY_SCHEMA)


def stored(spark, path):
    rows = table.read_summaries(spark, path).collect()
    return sorted((r.chat_id, r.chat_date or "", r.summary) for r in rows)


def test_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [("a", "2026-01-01", "old", "1"), ("b", "2026-01-02", "old", "1"), ("c", "2026-01-03", "old", "1"),
           ("n", None, "old", "1"), ("m", None, "old", "1")]
    assert table.read_summaries(spark, path).count() == 0
    table.merge_summaries(spark, path, summaries(spark, old))
    assert table.read_summaries(spark, path).count() == 5
    staged = summaries(
        spark,
        [("a", "2026-01-01", "new", "3"), ("a", "2026-01-01", "stale", "2"), ("a", "2026-01-04", "new", "3"),
         ("n", None, "new", "3")],
    )
    expected = [("a", "2026-01-01", "new"), ("a", "2026-01-04", "new"), ("b", "2026-01-02", "old"),
                ("c", "2026-01-03", "old"), ("m", "", "old"), ("n", "", "new")]
    for _ in range(2):  # a repeated merge changes nothing
        table.merge_summaries(spark, path, staged)
        assert stored(spark, path) == expected


def test_merge_with_empty_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [("a", "", "old", "1"), ("b", None, "old", "1"), ("c", "", "old", "1"), ("d", "2026-01-02", "old", "1")]
    table.merge_summaries(spark, path, summaries(spark, old))
    new = [("b", "", "new", "2"), ("e", "", "stale", "1"), ("e", None, "new", "2"), ("x", "2026-01-02", "new", "2")]
    for _ in range(2):
        table.merge_summaries(spark, path, summaries(spark, new))
        assert stored(spark, path) == [
            ("a", "", "old"), ("b", "", "new"), ("c", "", "old"), ("d", "2026-01-02", "old"), ("e", "", "new"),
            ("x", "2026-01-02", "new"),
        ]


def test_merge_moves_a_chat(spark, tmp_path):
    path = str(tmp_path / "t")
    table.merge_summaries(spark, path, summaries(spark, [("a", "2026-01-05", "old", "1"), ("b", "2026-01-06", "old", "1")]))
    staged = summaries(spark, [("a", "2026-01-01", "new", "2")])
    earlier = spark.createDataFrame([("a", "2026-01-05"), ("a", "2026-01-01")], "chat_id string, chat_date string")
    for _ in range(2):
        table.merge_summaries(spark, path, staged, earlier)
        assert stored(spark, path) == [("a", "2026-01-01", "new"), ("b", "2026-01-06", "old")]


def test_merge_reads_touched_dates_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"c{i}", f"2026-01-{i + 1:02d}", "old", "1") for i in range(9)]
    table.write_summaries(summaries(spark, rows), path)
    plan = (
        table.read_summaries(spark, path)
        .filter(F.col("chat_date").isin(["2026-01-03"]))
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert re.search(r"PartitionFilters: \[[^\]]*chat_date#\d+ = 2026-01-03", plan)


def test_rotation(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"c{i}", "2026-01-01", "s", "1") for i in range(25)]
    table.write_summaries(summaries(spark, rows), path, max_records=10)
    scan = source.with_source_file(spark.read.schema(SUMMARY_SCHEMA).parquet(path))
    sizes = [r["count"] for r in scan.groupBy("source_file").count().collect()]
    assert sum(sizes) == 25 and max(sizes) <= 10
    metrics = quality.run_metrics(scan).first()
    assert (metrics.completed, metrics.errors, metrics.files_written) == (25, 0, len(sizes))


def test_output_types(spark, tmp_path):
    path = str(tmp_path / "t")
    table.write_summaries(summaries(spark, [("a", "2026-01-01", "s", "1")]), path)
    assert table.read_summaries(spark, path).schema == SUMMARY_SCHEMA


def test_quality_rules(spark):
    good = ("a", "2026-01-01", "fine", "Neutral", "a, b, c", "Y", 1, "API", "English", 1, "t")
    bad = (None, None, "x" * 1001, "Happy", "k" * 501, "maybe", 2, "API", "Klingon", 0, "t")
    rows = spark.createDataFrame([good, good, bad], SUMMARY_SCHEMA)
    failing = {r.rule: r.rows_failing for r in quality.dq_report(rows).collect()}
    assert failing == {
        "null_key": 1, "sentiment_domain": 1, "scope_domain": 1, "language_domain": 1, "acronym_count": 1,
        "total_turns": 1, "varchar_limit": 0, "summary_length": 1, "keywords_length": 1,
        "keywords_3_to_8": 1, "unique_key": 2,
    }
    empty = quality.dq_report(rows.limit(0)).collect()
    assert {r.rows_checked for r in empty} == {0} and len(empty) == 11


def test_residual_pii_and_status(spark):
    rows = summaries(
        spark,
        [("a", "2026-01-01", "mail a@b.com", "1"), ("b", "2026-01-01", "ERROR: x", "1"),
         ("c", "2026-01-01", "NO_CONTENT", "1"), ("d", "2026-01-01", "fine", "1")],
    )
    hits = {r.label: r.summaries_hit for r in quality.dq_residual_pii(rows).collect()}
    assert hits["EMAIL"] == 1 and sum(hits.values()) == 1
    rate = quality.dq_error_rate(rows).first()
    assert (rate.chats, rate.error_rate, rate.no_content_rate) == (4, 0.25, 0.25)
    chats = spark.createDataFrame([(c,) for c in "abcde"], "chat_id string")
    assert sorted(r.chat_id for r in quality.reprocess_set(chats, rows).collect()) == ["b", "c", "e"]


def test_incremental_equals_batch(spark):
    rng = random.Random(11)
    rows = [
        (f"c{chat}", f"t{rank}", rank, "q", rng.choice(["r", "Invalid Input"]), "2026-01-01")
        for chat in range(12) for rank in range(1, rng.randint(2, 5))
    ]
    rng.shuffle(rows)
    half = len(rows) // 2
    drops = [make_turns(spark, rows[:half]), make_turns(spark, rows[half:])]
    got = sorted(map(tuple, run_ingest(spark, drops).collect()))
    assert got == sorted(map(tuple, count_summary(make_turns(spark, rows)).collect()))


def test_late_first_day_and_new_checkpoint(spark, tmp_path):
    turn = lambda rank, day: ("c", f"t{rank}", rank, "q", "r", day)
    drops = [[turn(2, "2026-01-02"), turn(3, "2026-01-02")], [turn(1, "2026-01-01")]]
    rows = run_ingest(spark, [make_turns(spark, d) for d in drops]).collect()  # ends with a new checkpoint
    assert [(r.chat_date, r.total_turns) for r in rows] == [("2026-01-01", 3)]


def test_files_rotate_by_size(spark, tmp_path):
    path, limit = str(tmp_path / "t"), 20_000
    rows = [(f"c{i}", "2026-01-01" if i % 3 else None, "x" * (1500 if i % 7 == 0 else i % 90), "1") for i in range(1500)]
    table.write_summaries(summaries(spark, rows), path, max_bytes=limit)
    scan = source.with_source_file(spark.read.schema(SUMMARY_SCHEMA).parquet(path)).withColumn("bytes", table.row_bytes())
    files = scan.groupBy("chat_date", "source_file").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in files) == 1500
    for day in ("2026-01-01", None):
        sizes = sorted(r.bytes for r in files if r.chat_date == day)
        assert len(sizes) > 3 and sizes[-1] <= 1.1 * limit and sizes[1] >= 0.9 * limit
    table.write_summaries(summaries(spark, rows[:1]), path, max_bytes=limit)
    assert table.read_summaries(spark, path).filter("chat_date = '2026-01-01'").count() == 1000
    table.write_summaries(summaries(spark, []), str(tmp_path / "none"), max_bytes=limit)
