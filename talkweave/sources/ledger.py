"""The ledger of runs: which chats a run took on, what became of each, and the result of every run.

Tables below one folder: ``taken/<run>`` (written before any work, so that a restarted run takes the same chats), ``outcomes``
(a partition per run), ``runs`` (a row per finished run) and ``journal/<run>`` (model answers, see ``operators.model.Journal``).
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.staging import path_exists

TAKEN = "chat_id string, total_turns long, tries long, ready boolean"
OUTCOME = "chat_id string, outcome string, total_turns long, run string"
RESULT = (
    "completed long, errors long, filtered long, skipped long, retried long, files_written long, elapsed_seconds double, output_path string, run string"
)
#: Outcomes by status of the summary row; a chat without a row was skipped, being too short or blank.
BY_STATUS = {"OK": "DONE", "NO_CONTENT": "NO_CONTENT", "CONTENT_FILTERED": "FILTERED", "ERROR": "FAILED"}
SKIPPED = "SKIPPED"
UNSUCCESSFUL = ["FILTERED", "FAILED"]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_run(rows: DataFrame, path: str, run: str) -> None:
    """The partition of one run; recording a run twice leaves one copy."""
    (
        rows.withColumn("run", F.lit(run)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    )


def choose(
    counts: DataFrame, done: DataFrame, state: DataFrame, limit: int = 0, min_turns: int = 2, max_tries: int = 3
) -> DataFrame:
    """(chat_id, total_turns, tries, ready): the chats a run takes on (ready), and those too short that no run has noted yet.

    ``counts``: total_turns by chat; ``done``: chats with a good row; ``state``: ``Ledger.state``. A chat without a good row is open until it was
    tried ``max_tries`` times; one that was skipped is open again when it has more or fewer turns. The limit counts open
    chats of enough turns only, untried ones first, so limited runs go on until none is left.
    """
    tries = F.coalesce("tries", F.lit(0))
    same = F.coalesce((F.col("outcome") == SKIPPED) & (F.col("last_turns") == F.col("total_turns")), F.lit(False))
    opened = counts.join(done.select("chat_id"), "chat_id", "left_anti").join(state, "chat_id", "left")
    opened = opened.filter(~same & (tries < max_tries)).select("chat_id", "total_turns", tries.alias("tries"))
    enough = F.col("total_turns") >= min_turns
    ready = opened.filter(enough)
    if limit > 0:
        ready = ready.orderBy("tries", "chat_id").limit(limit)
    return ready.withColumn("ready", F.lit(True)).union(opened.filter(~enough).withColumn("ready", F.lit(False)))


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def outcomes(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/outcomes", OUTCOME)

    def runs(self) -> DataFrame:
        """The results of all finished runs."""
        return read_or_empty(self.spark, f"{self.path}/runs", RESULT)

    def journal(self, run: str) -> str:
        return f"{self.path}/journal/{run}"

    def next_run(self) -> str:
        """The name of the run to do: that of the one that did not finish, if there is one. Names sort as the runs follow each other."""
        return f"run-{self.runs().count() + 1:08d}"

    def state(self, before: str) -> DataFrame:
        """(chat_id, outcome, last_turns, tries) of each chat that the runs before ``before`` recorded."""
        failed = F.col("outcome").isin(UNSUCCESSFUL)
        last = F.max_by(F.struct("outcome", F.col("total_turns").alias("last_turns")), "run")
        known = self.outcomes().filter(F.col("run") < before).groupBy("chat_id")
        return known.agg(last.alias("last"), F.count_if(failed).alias("tries")).select("chat_id", "last.*", "tries")

    def take(self, run: str, chosen: DataFrame) -> DataFrame:
        """What the run takes on, stored; of a run that was started before, what it took then."""
        path = f"{self.path}/taken/{run}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            chosen.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(TAKEN).parquet(path)

    def record(self, run: str, taken: DataFrame, status: DataFrame) -> None:
        """Outcomes of the chats in ``taken`` by ``status`` (chat_id, status); those without one were skipped."""
        outcome = F.lit(SKIPPED)
        for name, value in BY_STATUS.items():
            outcome = F.when(F.col("status") == name, value).otherwise(outcome)
        rows = taken.join(status, "chat_id", "left").select("chat_id", outcome.alias("outcome"), "total_turns")
        replace_run(rows, f"{self.path}/outcomes", run)

    def finish(self, run: str, result: DataFrame) -> DataFrame:
        """Add the run's result, after which the run is over; gives it back."""
        replace_run(result, f"{self.path}/runs", run)
        return result.withColumn("run", F.lit(run))
