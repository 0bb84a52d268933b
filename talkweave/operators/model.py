"""Enrichment by an external text model that runs inside the Spark job."""

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions import response, text
from talkweave.staging import materialise, ship_package

# A client takes (prompt, **settings) and returns (stop_reason, text), or raises.
Client = Callable[..., tuple[str, str]]

RAW = "chat_id string, stop_reason string, text string, error string, attempts int"
JOURNAL = RAW + ", call string"


@dataclass(frozen=True)
class CallOptions:
    # Calls in flight = min(task slots, partitions) * threads. More partitions mean that
    # a lost task repeats fewer calls.
    partitions: int = 2000
    threads: int = 8
    attempts: int = rules.MAX_ATTEMPTS
    pause: float = 1.0  # seconds; doubled per attempt while throttled


@dataclass(frozen=True)
class Journal:
    """Answers under a path that outlives the application: a call answered there is not made again.

    Every task adds its answers when it ends, not when the job does, so a driver that is lost loses the calls of running
    tasks only. Calls are told apart by chat and by digest of prompt and settings. Failed calls are kept and made again.
    """

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        """One answer per chat and call, a successful one if there is any."""
        try:
            rows = spark.read.schema(JOURNAL).parquet(self.path)
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], JOURNAL)
        best = F.max(F.struct(F.col("error").isNull(), "stop_reason", "text", "error", "attempts")).alias("best")
        fields = [f"best.{c}" for c in ("stop_reason", "text", "error", "attempts")]
        return rows.groupBy("chat_id", "call").agg(best).select("chat_id", *fields, "call")

    def add(self, answers: DataFrame) -> None:
        # Version 2 moves a task's files into the folder as the task commits.
        version = "mapreduce.fileoutputcommitter.algorithm.version"
        answers.write.mode("append").option(version, "2").parquet(self.path)


def call_digest(settings: dict):
    """Digest of a prompt with the settings it is sent with."""
    return F.sha2(F.concat_ws("\n", F.lit(json.dumps(settings, sort_keys=True)), "prompt"), 256)


def _ask(client: Client, prompt: str, settings: dict, options: CallOptions) -> tuple:
    for attempt in range(options.attempts):
        try:
            stop_reason, answer = client(prompt, **settings)
            return stop_reason, answer, None, attempt + 1
        except Exception as failure:  # noqa: BLE001 - any client error becomes a row
            error = str(failure)
            if "ThrottlingException" in error:
                time.sleep(options.pause * 2**attempt)
                error = "max retries exceeded"
            elif "content" in error.lower() and "filter" in error.lower():
                break
            elif attempt + 1 < options.attempts:
                time.sleep(options.pause)
    return None, None, error, attempt + 1


def _call_batches(
    batches: Iterator[pd.DataFrame],
    client_factory: Callable[[], Client],
    settings: dict,
    options: CallOptions,
) -> Iterator[pd.DataFrame]:
    client = client_factory()
    ask = partial(_ask, client, settings=settings, options=options)
    with ThreadPoolExecutor(options.threads) as pool:
        for batch in batches:
            answers = list(pool.map(ask, batch["prompt"]))
            fields = pd.DataFrame(answers, columns=["stop_reason", "text", "error", "attempts"])
            keys = batch.drop(columns="prompt").reset_index(drop=True)
            yield pd.concat([keys, fields], axis=1)


def call_model(
    prompts: DataFrame,
    client_factory: Callable[[], Client],
    settings: dict,
    options: CallOptions = CallOptions(),
    journal: Journal | None = None,
) -> DataFrame:
    """One answer row per (chat_id, prompt); failures become rows with an error.

    The answers are written once: a lost executor or a second reader must not call
    the model again. With a journal a restarted driver asks only what it lacks. Calls are at least once, so chat_id should be
    the caller's idempotency key; leave spark.speculation off for this job.
    """
    spark = prompts.sparkSession
    calls = partial(
        _call_batches, client_factory=client_factory, settings=settings, options=options
    )
    ship_package(spark)
    prompts = prompts.select("chat_id", "prompt")
    if journal is None:
        return materialise(prompts.repartition(options.partitions, "chat_id").mapInPandas(calls, RAW), "answers")
    keyed = materialise(prompts.withColumn("call", call_digest(settings)), "calls")
    answered = journal.read(spark).filter("error IS NULL").select("chat_id", "call")
    rest = keyed.join(answered, ["chat_id", "call"], "left_anti").select("chat_id", "call", "prompt")
    journal.add(rest.repartition(options.partitions, "chat_id").mapInPandas(calls, JOURNAL))
    answers = keyed.select("chat_id", "call").join(journal.read(spark), ["chat_id", "call"])
    return materialise(answers.select("chat_id", "stop_reason", "text", "error", "attempts"), "answers")


def _with_status(answers: DataFrame) -> DataFrame:
    return answers.withColumn(
        "status", response.response_status(F.col("stop_reason"), F.col("text"), F.col("error"))
    )


def enrich_with_model(
    safe_texts: DataFrame,
    client_factory: Callable[[], Client],
    options: CallOptions = CallOptions(),
    journal: Journal | None = None,
) -> DataFrame:
    """(chat_id, summary, chat_sentiment, keywords, status) from (chat_id, safe_text).

    Blank chats never reach the model. Filtered ones get a second, simpler prompt. A call that fails or
    brings no text leaves an ERROR row. The texts are stored first, so they are made once.
    """
    safe_texts = materialise(safe_texts.select("chat_id", "safe_text"), "safe-texts")
    blank = text.is_blank(F.col("safe_text"))
    content = safe_texts.filter(~blank)
    first = _with_status(
        call_model(
            content.select("chat_id", text.build_prompt(F.col("safe_text")).alias("prompt")),
            client_factory, rules.FIRST_SETTINGS, options, journal,
        )
    )
    failed = F.col("status").isin("ERROR", "NO_CONTENT")
    problem = F.coalesce("error", F.lit("no text in the answer"))
    message = F.concat(F.lit("ERROR: "), F.left(problem, F.lit(rules.ERROR_CHARS)))
    parsed = response.parse_response(F.coalesce("text", F.lit("")))
    kept = first.filter(F.col("status") != "FILTERED").select(
        "chat_id",
        F.when(failed, message).otherwise(parsed["summary"]).alias("summary"),
        F.when(failed, "ERROR").otherwise(parsed["chat_sentiment"]).alias("chat_sentiment"),
        F.when(failed, "").otherwise(parsed["keywords"]).alias("keywords"),
        F.when(failed, "ERROR").otherwise("OK").alias("status"),
    )
    filtered = content.join(first.filter(F.col("status") == "FILTERED"), "chat_id", "left_semi")
    second = retry_filtered(filtered, client_factory, options, journal)
    empty = empty_chat_result(safe_texts.filter(blank))
    return kept.unionByName(second).unionByName(empty)


def retry_filtered(
    filtered: DataFrame,
    client_factory: Callable[[], Client],
    options: CallOptions = CallOptions(),
    journal: Journal | None = None,
) -> DataFrame:
    """Second attempt with the fallback prompt; one call, no further retries. Still filtered or failing is CONTENT_FILTERED."""
    once = CallOptions(options.partitions, options.threads, 1, 0.0)
    answers = _with_status(
        call_model(
            filtered.select("chat_id", text.build_fallback_prompt(F.col("safe_text")).alias("prompt")),
            client_factory, rules.FALLBACK_SETTINGS, once, journal,
        )
    )
    refused = F.col("status") != "OK"
    parsed = response.parse_simple_response(F.coalesce("text", F.lit("")))
    return answers.select(
        "chat_id",
        F.when(refused, "CONTENT_FILTERED").otherwise(parsed["summary"]).alias("summary"),
        F.when(refused, "Neutral").otherwise(parsed["chat_sentiment"]).alias("chat_sentiment"),
        F.lit("").alias("keywords"),
        F.when(refused, "CONTENT_FILTERED").otherwise("OK").alias("status"),
    )


def empty_chat_result(blank: DataFrame) -> DataFrame:
    return blank.select(
        "chat_id",
        F.lit("NO_CONTENT").alias("summary"),
        F.lit("Neutral").alias("chat_sentiment"),
        F.lit("").alias("keywords"),
        F.lit("NO_CONTENT").alias("status"),
    )
