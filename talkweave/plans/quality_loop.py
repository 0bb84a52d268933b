"""The quality loop: rules with limits, a history of what every run found, and another try for the chats that break them.

Tables below one folder beside the summary table, each with a partition per run: ``checks`` (a row per rule), ``failing`` (a row per
chat, day and rule that it breaks) and ``runs`` (a row, written last).
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.plans.quality import row_rules, summary_status
from talkweave.plans.run import rows_of
from talkweave.schema import SUMMARY_SCHEMA, conform
from talkweave.sources import summaries as table
from talkweave.sources.ledger import read_or_empty, replace_run
from talkweave.staging import materialise

CHECK = "rule string, rows_checked long, rows_failing long, allowed double, passed boolean, run string"
FAILING = "chat_id string, chat_date string, rule string, rows long, retried boolean, run string"
RESULT = "rules_over long, rows_failing long, chats_retried long, chats_given_up long, run string"
UNIQUE, FAILED = "unique_key", "failed"

#: Summary rows of the chats given as (chat_id); a chat without a row keeps those it has.
Redo = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Limits:
    """``allowed``: the share of rows that may break a rule (0 for rules not named); a chat is tried again in ``max_tries`` runs at most."""

    allowed: Mapping[str, float] = field(default_factory=dict)
    max_tries: int = 3


def loop_rules() -> dict[str, Column]:
    """The rules of a row: those of the report, and that its summary was not filtered and did not fail."""
    return row_rules() | {FAILED: summary_status(F.col("summary")).isin("ERROR", "CONTENT_FILTERED")}


def broken_rows(summaries: DataFrame) -> DataFrame:
    """(chat_id, chat_date, rule, rows): the keys that break a rule and how many of their rows do; a key of several rows breaks ``unique_key``."""
    names = F.array(*[F.when(broken, F.lit(name)) for name, broken in loop_rules().items()])
    by_row = summaries.select(*table.KEYS, F.explode(F.array_compact(names)).alias("rule"))
    counted = by_row.groupBy(*table.KEYS, "rule").agg(F.count(F.lit(1)).alias("rows"))
    repeated = summaries.groupBy(*table.KEYS).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return counted.unionByName(repeated.withColumn("rule", F.lit(UNIQUE)))


def judge(broken: DataFrame, rows_checked: int, allowed: Mapping[str, float]) -> DataFrame:
    """(rule, rows_checked, rows_failing, allowed, passed): one row per rule, whether or not a row breaks it."""
    names = [*loop_rules(), UNIQUE]
    if unknown := set(allowed) - set(names):
        raise ValueError(f"no such rules: {sorted(unknown)}")
    limits = broken.sparkSession.createDataFrame([(n, float(allowed.get(n, 0.0))) for n in names], "rule string, allowed double")
    found = broken.groupBy("rule").agg(F.sum("rows").alias("rows_failing"))
    judged = limits.join(found, "rule", "left").withColumns(
        {"rows_failing": F.coalesce("rows_failing", F.lit(0)), "rows_checked": F.lit(rows_checked).cast("long")}
    )
    passed = F.col("rows_failing") <= F.col("allowed") * F.col("rows_checked")
    return judged.select("rule", "rows_checked", "rows_failing", "allowed", passed.alias("passed"))


@dataclass(frozen=True)
class QualityHistory:
    spark: SparkSession
    path: str

    def checks(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/checks", CHECK)

    def failing(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/failing", FAILING)

    def runs(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/runs", RESULT)

    def next_run(self) -> str:
        """The name of the run to do: that of the one that did not finish, if there is one, which is then done over."""
        return f"check-{self.runs().count() + 1:08d}"

    def tries(self, before: str) -> DataFrame:
        """(chat_id, tries): the runs before ``before`` in which a chat was tried again, whatever rule it broke."""
        known = self.failing().filter((F.col("run") < before) & F.col("retried"))
        return known.groupBy("chat_id").agg(F.count_distinct("run").alias("tries"))

    def trend(self) -> DataFrame:
        """(run, rule, rows_failing, change): how many rows break each rule, and the change to the run before."""
        previous = self.checks().select(
            "rule", F.col("rows_failing").alias("earlier"), F.format_string("check-%08d", F.substring("run", 7, 8).cast("int") + 1).alias("run")
        )
        joined = self.checks().join(previous, ["run", "rule"], "left")
        return joined.select("run", "rule", "rows_failing", (F.col("rows_failing") - F.col("earlier")).alias("change"))


def history_of(spark: SparkSession, summary_table: str) -> QualityHistory:
    return QualityHistory(spark, f"{summary_table.rstrip('/')}-quality")


def quality_run(spark: SparkSession, summary_table: str, redo: Redo, limits: Limits = Limits()) -> DataFrame:
    """Check the table once and do the chats over that break a rule which too many rows break; gives the run's row of ``runs``.

    The new rows replace all rows of their chats, on whatever day. Rows without chat_id cannot be done over, and chats tried ``max_tries`` times
    are given up; both stay in the table and in the history. A run whose driver was lost is done over by the next call.
    """
    book = history_of(spark, summary_table)
    run = book.next_run()
    rows = table.read_summaries(spark, summary_table)
    broken = materialise(broken_rows(rows), "broken")
    checks = materialise(judge(broken, rows.count(), limits.allowed), "checks")
    over = checks.filter("NOT passed").select("rule")
    blamed = broken.join(over, "rule", "left_semi").filter("chat_id IS NOT NULL").select("chat_id").distinct()
    tries = F.coalesce("tries", F.lit(0))
    chosen = blamed.join(book.tries(run), "chat_id", "left").select("chat_id", (tries < limits.max_tries).alias("retried"))
    chosen = materialise(chosen, "chosen")

    replace_run(checks, f"{book.path}/checks", run)
    noted = broken.join(chosen, "chat_id", "left").withColumn("retried", F.coalesce("retried", F.lit(False)))
    replace_run(noted, f"{book.path}/failing", run)
    counts = chosen.agg(F.count_if("retried").alias("again"), F.count_if(~F.col("retried")).alias("given_up")).first()
    if counts.again:
        again = chosen.filter("retried").select("chat_id")
        staged = conform(redo(again), SUMMARY_SCHEMA).join(again, "chat_id", "left_semi")
        staged = materialise(staged.select(*SUMMARY_SCHEMA.names), "redone")
        table.merge_summaries(spark, summary_table, staged, rows_of(staged, rows))
    found = checks.agg(
        F.count_if(~F.col("passed")).alias("rules_over"), F.coalesce(F.sum("rows_failing"), F.lit(0)).alias("rows_failing"),
        F.lit(counts.again).cast("long").alias("chats_retried"), F.lit(counts.given_up).cast("long").alias("chats_given_up"),
    )
    found = materialise(found, "result")
    replace_run(found, f"{book.path}/runs", run)
    return found.withColumn("run", F.lit(run))


def quality_loop(spark: SparkSession, summary_table: str, redo: Redo, limits: Limits = Limits()) -> QualityHistory:
    """Runs until one finds no chat to do over: all rules hold, or what breaks them has no chat or is given up.

    The last of them has only checked. Where doing chats over spoils no others, there are ``max_tries`` runs more than that at most.
    """
    while quality_run(spark, summary_table, redo, limits).first().chats_retried:
        pass
    return history_of(spark, summary_table)
