"""The summary table: Parquet by chat_date, written idempotently and all days at once."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.schema import SUMMARY_SCHEMA, conform
from talkweave.sources.published import Days, PublishedDays
from talkweave.staging import materialise, path_exists

KEYS = ["chat_id", "chat_date"]
MAX_RECORDS_PER_FILE = 1_000_000
#: Bytes of a row beside its values, and buckets that the rows of a file of limited size are dealt to.
ROW_BYTES, BUCKETS_PER_FILE = 20, 4


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as last published, empty where there is none yet."""
    table = PublishedDays(spark, path)
    days = table.current()
    return _of_folders(spark, table, table.unlisted() if days is None else table.folders(days))


def _of_folders(spark: SparkSession, table: PublishedDays, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    rows = spark.read.schema(SUMMARY_SCHEMA).option("basePath", table.path).parquet(*folders)
    return rows.select(*SUMMARY_SCHEMA.names)


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the table's files, listed and not read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return files.load(path).select("path")


def with_known_dates(rows: DataFrame) -> DataFrame:
    """Empty dates as null, which is how the table's partitions give them back."""
    return rows.withColumn("chat_date", F.nullif(F.col("chat_date"), F.lit("")))


def row_bytes() -> Column:
    """What a row takes as text: its values and ROW_BYTES around them."""
    return sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in SUMMARY_SCHEMA.names), F.lit(ROW_BYTES)).cast("long")


def in_files(rows: DataFrame, max_bytes: int) -> tuple[DataFrame, int]:
    """``rows`` with ``file``, numbers from 0 to the number of files less 1: files of one day and ``max_bytes`` each, give or take a row, but
    for a day's last. Stored, as sizes are summed first.

    A row's file follows from the bytes before it: those of the buckets before its own (a few per file), plus a running sum in
    its bucket, so no task holds a day.
    """
    sized = materialise(rows.withColumn("bytes", row_bytes()), "sized")
    days = sized.groupBy(F.col("chat_date").alias("day")).agg(F.ceil(F.sum("bytes") / max_bytes).alias("files"))
    running = F.sum("files").over(Window.orderBy("day"))  # a row per day
    days = materialise(days.withColumn("first", running - F.col("files")), "days")
    bucket = F.pmod(F.xxhash64(*KEYS, "summary"), F.col("files") * BUCKETS_PER_FILE)
    placed = sized.join(days, F.col("chat_date").eqNullSafe(F.col("day"))).withColumn("bucket", bucket).drop("day")
    buckets = placed.groupBy("first", F.col("bucket").alias("at")).agg(F.sum("bytes").alias("size"))
    before = F.sum("size").over(Window.partitionBy("first").orderBy("at")) - F.col("size")
    buckets = buckets.select(F.col("first").alias("of"), "at", before.alias("before"))
    inside = F.sum("bytes").over(Window.partitionBy("first", "bucket").orderBy("chat_id", "bytes").rowsBetween(Window.unboundedPreceding, -1))
    found = placed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(buckets, (F.col("of") == F.col("first")) & (F.col("at") == F.col("bucket")))
    file = F.col("first") + F.floor((F.col("before") + F.col("inside")) / max_bytes)
    return found.select(*rows.columns, file.cast("int").alias("file")), days.agg(F.sum("files")).first()[0] or 0


def write_summaries(
    summaries: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE, max_bytes: int | None = None
) -> None:
    """Replace the partitions (dates) present in ``summaries``, all at once; others stay.

    File sizes follow spark.sql.adaptive.advisoryPartitionSizeInBytes: the rebalance
    merges small dates into few files and splits a large date over many tasks. With ``max_bytes`` files rotate by size instead: each holds
    rows of so many bytes (``row_bytes``), and a task writes one file.
    """
    table = PublishedDays(summaries.sparkSession, path)
    table.publish(_stored(summaries, table, max_records, max_bytes))


def _stored(summaries: DataFrame, table: PublishedDays, max_records: int, max_bytes: int | None = None) -> Days:
    """Store ``summaries`` as a version; gives the days that the table then has. Days of a table without a list are stored with it, once."""
    rows = with_known_dates(conform(summaries, SUMMARY_SCHEMA))
    days, unlisted = table.current(), table.unlisted()
    if days is None and unlisted:
        fresh = rows.select(F.col("chat_date").alias("day")).distinct()
        others = _of_folders(rows.sparkSession, table, unlisted)
        rows = rows.unionByName(others.join(fresh, F.col("chat_date").eqNullSafe(F.col("day")), "left_anti"))
    if max_bytes is None:
        dealt = rows.hint("rebalance", "chat_date")
    else:
        numbered, files = in_files(rows, max_bytes)
        dealt = numbered.repartitionById(max(files, 1), F.col("file")).drop("file")
    version, folder = table.new_version()
    dealt.write.option("maxRecordsPerFile", max_records).partitionBy("chat_date").parquet(folder)
    return (days or {}) | table.written(version)


def newest_per_key(staged: DataFrame) -> DataFrame:
    """One row per (chat_id, chat_date): the one summarised last."""
    others = [c for c in SUMMARY_SCHEMA.names if c not in KEYS and c != "summarized_at"]
    newest = F.max(F.struct("summarized_at", *others)).alias("newest")
    return conform(staged.groupBy(*KEYS).agg(newest).select(*KEYS, "newest.*"), SUMMARY_SCHEMA)


def merged(target: DataFrame, staged: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Target rows whose key is not among ``keys`` (those of ``staged``), plus the staged rows.

    Null dates are keys like any other, which keeps a repeated merge idempotent.
    """
    fresh = newest_per_key(with_known_dates(staged))
    gone = (fresh if keys is None else keys).select(*[F.col(k).alias(f"staged_{k}") for k in KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"staged_{k}")) for k in KEYS]
    return target.join(gone, same, "left_anti").unionByName(fresh)


def merge_summaries(
    spark: SparkSession, path: str, staged: DataFrame, replaced: DataFrame | None = None
) -> None:
    """Merge ``staged`` into the table at ``path``.

    ``replaced`` (chat_id, chat_date) names further rows that go. Only the touched dates are read and rewritten: their
    range prunes partitions, a join picks the dates in it. ``staged`` and ``replaced`` should be stored
    tables, since they are read several times. All days change at once: a merge that fails midway leaves the table as it was. One writer at a time.
    """
    staged = with_known_dates(staged)
    keys = staged.select(*KEYS)
    if replaced is not None:
        keys = keys.union(with_known_dates(replaced).select(*KEYS))
    date = F.col("chat_date")
    bounds = keys.agg(F.min(date).alias("low"), F.max(date).alias("high"), F.bool_or(date.isNull()).alias("nulls")).first()
    in_range = date.between(bounds.low, bounds.high) | (date.isNull() & F.lit(bool(bounds.nulls)))
    days = keys.select(date.alias("day")).distinct()
    target = read_summaries(spark, path).filter(in_range)
    touched = target.join(days, date.eqNullSafe(F.col("day")), "left_semi")
    result = merged(touched, staged, keys)
    emptied = set() if replaced is None else _emptied_days(touched, result)
    days = PublishedDays(spark, path)
    stored = _stored(result, days, MAX_RECORDS_PER_FILE)
    days.publish({day: version for day, version in stored.items() if day not in emptied})


def _emptied_days(before: DataFrame, after: DataFrame) -> set[str]:
    """Folders of the days that lose all their rows: a number of partitions, not of rows."""
    left = after.select(F.col("chat_date").alias("day")).distinct()
    gone = before.select("chat_date").distinct().join(left, F.col("chat_date").eqNullSafe(F.col("day")), "left_anti")
    escaped = before.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return {
        "chat_date=" + ("__HIVE_DEFAULT_PARTITION__" if r.chat_date is None else escaped(r.chat_date)) for r in gone.collect()
    }


def summary_sample(summaries: DataFrame, n: int = 5) -> DataFrame:
    return summaries.orderBy("chat_id", "chat_date").limit(n)


def summary_count(summaries: DataFrame) -> DataFrame:
    return summaries.agg(F.count(F.lit(1)).alias("summary_count"))
