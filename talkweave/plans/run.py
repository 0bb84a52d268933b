"""One run from a folder of turns to the summary table."""

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkweave.operators import chats, model
from talkweave.plans import quality
from talkweave.plans.chat_summary import assemble_summary, chat_rows, now_utc
from talkweave.sources import ledger
from talkweave.sources import summaries as table
from talkweave.sources.turns import scan_turns
from talkweave.staging import materialise


@dataclass(frozen=True)
class RunOptions:
    """What a run takes on: at most ``limit`` chats (all for 0) of ``min_turns`` turns or more, each tried in ``max_tries`` runs at most.

    ``name`` names the run in the ledger (default: the next number); names must sort as the runs follow each other.
    """

    limit: int = 0
    min_turns: int = 2
    max_tries: int = 3
    calls: model.CallOptions = field(default_factory=model.CallOptions)
    run_ts: str | None = None
    name: str | None = None


def ledger_of(spark: SparkSession, summary_table: str) -> ledger.Ledger:
    """The ledger of the runs that fill a table, in a folder beside it."""
    return ledger.Ledger(spark, f"{summary_table.rstrip('/')}-ledger")


def written_metrics(status: Column) -> list[Column]:
    """What is observed as the run's rows are written."""
    return [
        F.count(F.lit(1)).alias("completed"),
        F.count_if(status == "ERROR").alias("errors"),
        F.count_if(status == "CONTENT_FILTERED").alias("filtered"),
    ]


def run_pipeline(
    spark: SparkSession,
    turns_path: str,
    summary_table: str,
    acronyms: DataFrame,
    profiles: DataFrame,
    client_factory: Callable[[], model.Client],
    options: RunOptions = RunOptions(),
) -> DataFrame:
    """Summarise the chats of ``turns_path`` that the table lacks or holds a failure of; gives one row, the run's own result.

    No model call is made for a chat that is done, over the limit, too short or tried too often. A run whose driver was lost is taken up by
    the next call: with the same chats, and asking the model only what its journal lacks.
    """
    started = time.monotonic()
    book = ledger_of(spark, summary_table)
    run = options.name or book.next_run()
    known = table.read_summaries(spark, summary_table)
    done = known.filter(quality.summary_status(F.col("summary")).isin("OK", "NO_CONTENT"))
    arrived = chats.drop_null_chat(scan_turns(spark, turns_path))
    counts = arrived.groupBy("chat_id").agg(F.count("turn_rank").alias("total_turns"))
    chosen = ledger.choose(counts, done, book.state(run), options.limit, options.min_turns, options.max_tries)
    taken = book.take(run, chosen)

    turns = materialise(arrived.join(taken.filter("ready"), "chat_id", "left_semi"), "todo")
    rows = chat_rows(turns, chats.flag_turns(turns), acronyms, profiles)
    asked = rows.join(chats.prompt_text(turns), "chat_id").withColumn("chat_text", F.col("safe_text"))
    asked = materialise(chats.prefilter_chats(asked, options.min_turns).drop("chat_text"), "asked")
    answers = model.enrich_with_model(
        asked.select("chat_id", "safe_text"), client_factory, options.calls, model.Journal(book.journal(run))
    )
    written, status = Observation("run"), quality.summary_status(F.col("summary"))
    rows = assemble_summary(asked, answers, options.run_ts or now_utc())
    staged = materialise(rows.observe(written, *written_metrics(status)), "staged")

    before = materialise(table.table_files(spark, summary_table), "files")
    table.merge_summaries(spark, summary_table, staged, rows_of(staged, known))
    files = table.table_files(spark, summary_table).join(before, "path", "left_anti").count()
    book.record(run, taken, staged.select("chat_id", status.alias("status")))
    seen = taken.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tries") > 0).alias("retried")).first()
    got = written.get
    result = [(
        got["completed"], got["errors"], got["filtered"], seen.n - got["completed"], seen.retried, files,
        time.monotonic() - started, summary_table,
    )]
    return book.finish(run, spark.createDataFrame(result, ledger.RESULT.removesuffix(", run string")))


def rows_of(staged: DataFrame, known: DataFrame) -> DataFrame:
    """Keys of the rows that the table has of the staged chats, on whatever day."""
    return materialise(known.select("chat_id", "chat_date").join(staged.select("chat_id"), "chat_id", "left_semi"), "earlier")
