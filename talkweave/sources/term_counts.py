"""How many chats hold each term, over all incremental runs.

Every batch adds signed differences: for each chat it touches, one for a term that is new in it and minus one for a term that is gone. What
the table holds is summed on read, so a batch never reads the terms of chats it does not touch. A repeated batch replaces its own
differences.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.staging import path_exists

#: A null term counts chats.
SCHEMA = "term string, more long, run string, batch_id long"


def _terms(features: DataFrame, sign: int) -> DataFrame:
    """(term, more): each term of each chat once, and a null term for the chat.

    The outer form, because the other one brings a filter of empty arrays, in which the text of every turn is redacted and cut a second time.
    """
    words = features.select("chat_id", F.explode_outer("terms").alias("term")).filter("term IS NOT NULL")
    terms = words.distinct().select("term")
    return terms.union(features.select("chat_id").distinct().select(F.lit(None).cast("string"))).withColumn("more", F.lit(sign).cast("long"))


@dataclass(frozen=True)
class TermCounts:
    spark: SparkSession
    path: str

    def add(self, before: DataFrame, after: DataFrame, run: str, batch_id: int) -> None:
        """Add what a batch changes: ``before`` and ``after`` are the turn features of the chats it touches."""
        changed = _terms(before, -1).union(_terms(after, 1)).groupBy("term").agg(F.sum("more").alias("more")).filter("more <> 0")
        (
            changed.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)}).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(self.path)
        )

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path) if path_exists(self.spark, self.path) else self.spark.createDataFrame([], SCHEMA)

    def chats(self) -> int:
        return self._rows().filter("term IS NULL").agg(F.sum("more")).first()[0] or 0

    def frequencies(self) -> DataFrame:
        """(term, df) of all terms that some chat holds."""
        found = self._rows().filter("term IS NOT NULL").groupBy("term").agg(F.sum("more").alias("df"))
        return found.filter("df > 0")
