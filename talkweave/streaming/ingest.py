"""Incremental runs: new turn files update the summary table."""

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talkweave.operators.offline import turn_features
from talkweave.schema import TURN_SCHEMA, conform
from talkweave.sources.summaries import merge_summaries
from talkweave.sources.term_counts import TermCounts
from talkweave.sources.turn_store import TurnStore
from talkweave.staging import materialise

def run_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives in the checkpoint, so that a new checkpoint is a new run."""
    path = f"{checkpoint}/turn-store-run"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
    return name


def incremental_ingest(
    spark: SparkSession,
    inbox: str,
    turn_store: str,
    summary_table: str,
    checkpoint: str,
    summarise: Callable[..., DataFrame],
    max_files: int = 1000,
    term_counts: str | None = None,
    rows_per_bucket: int = TurnStore.rows_per_bucket,
) -> StreamingQuery:
    """Process the files that arrived in ``inbox`` since the last run, then stop.

    Each micro-batch is added to ``turn_store`` (a ``TurnStore``, of ``rows_per_bucket``); chats it touches are summarised again
    from all their stored turns and merged, and their rows on other days go. A batch repeated after a
    failure finds its turns stored and merges the same rows; a new checkpoint is a new run, whose files
    take the place of the same files of earlier runs. ``summarise`` maps turns to summary rows; with ``term_counts``, a path, it is also
    given the ``TermCounts`` there, which know the chats of all batches. Chats that no batch touches keep the keywords they got; ``refresh``
    gives all chats those of the present counts.
    """
    run = run_id(spark, checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        store = TurnStore(session, turn_store, rows_per_bucket)
        store.recover()
        arrived = materialise(batch, "arrived")
        store.add(arrived, run, batch_id)
        chats = arrived.filter("chat_id IS NOT NULL").select("chat_id").distinct()
        buckets = store.touched(chats)
        turns = materialise(conform(store.turns_of(chats, buckets), TURN_SCHEMA), "touched-turns")
        earlier = materialise(turns.select("chat_id", "chat_date").distinct(), "touched-days")
        known = []
        if term_counts is not None:
            known = [TermCounts(session, term_counts)]
            before = conform(store.turns_of(chats, buckets, (run, batch_id)), TURN_SCHEMA)
            known[0].add(turn_features(before), turn_features(turns), run, batch_id)
        merge_summaries(session, summary_table, materialise(summarise(turns, *known), "staged"), earlier)
        store.pack(buckets)

    return (
        spark.readStream.schema(TURN_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(inbox)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh(
    spark: SparkSession, turn_store: str, summary_table: str, summarise: Callable[..., DataFrame], term_counts: str
) -> None:
    """Summarise all stored chats again with the present counts, which makes the table equal to a batch run over the same files."""
    turns = materialise(conform(TurnStore(spark, turn_store).everything(), TURN_SCHEMA), "all-turns")
    merge_summaries(spark, summary_table, materialise(summarise(turns, TermCounts(spark, term_counts)), "staged"))
