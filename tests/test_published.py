"""A write changes all its days or none."""

import pytest
from pyspark.sql import functions as F

from talkweave.schema import SUMMARY_SCHEMA
from talkweave.sources import summaries as table
from talkweave.sources.published import PublishedDays
from tests.test_table import stored, summaries

OLD = [("a", "2026-01-01", "old", "1"), ("b", "2026-01-02", "old", "1"), ("c", "2026-01-03", "old", "1"), ("n", None, "old", "1")]
NEW = [("a", "2026-01-01", "new", "2"), ("b", "2026-01-02", "new", "2"), ("d", "2026-01-04", "new", "2"), ("n", None, "new", "2")]
BEFORE = [("a", "2026-01-01", "old"), ("b", "2026-01-02", "old"), ("c", "2026-01-03", "old"), ("n", "", "old")]
AFTER = [("a", "2026-01-01", "new"), ("b", "2026-01-02", "new"), ("c", "2026-01-03", "old"), ("d", "2026-01-04", "new"), ("n", "", "new")]


def test_a_failure_between_two_days_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table.merge_summaries(spark, path, summaries(spark, OLD))
    staged = summaries(spark, NEW)
    broken = staged.withColumn(
        "summary", F.when(F.col("chat_date") == "2026-01-04", F.raise_error(F.lit("lost"))).otherwise(F.col("summary"))
    )
    with pytest.raises(Exception, match="lost"):
        table.merge_summaries(spark, path, broken)
    assert stored(spark, path) == BEFORE
    for _ in range(2):
        table.merge_summaries(spark, path, staged)
        assert stored(spark, path) == AFTER


def test_stored_and_not_published_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table.merge_summaries(spark, path, summaries(spark, OLD))

    def stop(self, days):
        raise KeyboardInterrupt

    with monkeypatch.context() as during:
        during.setattr(PublishedDays, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            table.merge_summaries(spark, path, summaries(spark, NEW))
        with pytest.raises(KeyboardInterrupt):  # the same for a table that has no list yet
            table.merge_summaries(spark, str(tmp_path / "first"), summaries(spark, NEW))
    assert stored(spark, path) == BEFORE and stored(spark, str(tmp_path / "first")) == []
    table.merge_summaries(spark, path, summaries(spark, NEW))
    assert stored(spark, path) == AFTER


def test_a_reader_outlives_one_write_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    table.write_summaries(summaries(spark, OLD), path)
    for i in range(5):
        reader = table.read_summaries(spark, path)
        expected = stored(spark, path)
        table.write_summaries(summaries(spark, [("a", "2026-01-01", f"s{i}", "2")]), path)
        assert sorted((r.chat_id, r.chat_date or "", r.summary) for r in reader.collect()) == expected
    kept = sorted(p.name for p in (tmp_path / "t" / "_published").iterdir() if not p.name.startswith("."))
    assert kept == ["000000000005", "000000000006"]
    folders = [p for p in (tmp_path / "t").glob("version=*/chat_date=*")]
    assert len(folders) == 3 + 2 and len(stored(spark, path)) == 4


def test_days_that_lose_all_rows_and_odd_names(spark, tmp_path):
    path = str(tmp_path / "t")
    table.merge_summaries(spark, path, summaries(spark, [("a", "x=1/2 %", "old", "1"), ("b", None, "old", "1"), ("c", "é", "old", "1")]))
    gone = spark.createDataFrame([("a", "x=1/2 %"), ("b", None)], "chat_id string, chat_date string")
    table.merge_summaries(spark, path, summaries(spark, [("a", "2026-01-01", "new", "2")]), gone)
    assert stored(spark, path) == [("a", "2026-01-01", "new"), ("c", "é", "old")]
    everything = spark.createDataFrame([("a", "2026-01-01"), ("c", "é")], "chat_id string, chat_date string")
    table.merge_summaries(spark, path, summaries(spark, []), everything)
    assert stored(spark, path) == [] and table.read_summaries(spark, path).schema == SUMMARY_SCHEMA


def test_tables_without_a_list_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    summaries(spark, OLD).write.partitionBy("chat_date").parquet(path)
    assert stored(spark, path) == BEFORE
    table.merge_summaries(spark, path, summaries(spark, NEW))
    assert stored(spark, path) == AFTER
