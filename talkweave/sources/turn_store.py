"""Turns of incremental runs, in buckets of chats whose number follows the data.

A turn lies at ``turns/depth=D/bucket=B/unit=U``: B is the low D bits of its chat's hash, U the batch that brought it. D grows by one whenever
the store has doubled; what lies at a smaller depth moves when a batch touches it next, and buckets of many
units are packed into one, so a batch reads about as much as its chats' buckets hold, however large the store is. Only the folders
of those buckets are listed. One writer at a time.
"""

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from talkweave.schema import TURN_SCHEMA, conform
from talkweave.staging import path_exists

STORED_SCHEMA = StructType([
    *TURN_SCHEMA, StructField("source_file", StringType()), StructField("run", StringType()), StructField("batch_id", LongType()),
    StructField("depth", IntegerType()), StructField("bucket", LongType()), StructField("unit", StringType()),
])
PLACE = ["depth", "bucket", "unit"]
BATCH = "rows long, depth int, run string, batch_id long"

Bucket = tuple[int, int]  # depth, number


def bucket_at(depth: int) -> Column:
    return F.xxhash64("chat_id").bitwiseAND(F.lit((1 << depth) - 1).cast("long"))


@dataclass(frozen=True)
class TurnStore:
    """``rows_per_bucket``: turns a bucket has on average, at most; ``pack_after``: units after which a bucket is packed."""

    spark: SparkSession
    path: str
    rows_per_bucket: int = 1_000_000
    pack_after: int = 8

    # Batches

    def batches(self) -> DataFrame:
        path = f"{self.path}/batches"
        return self.spark.read.schema(BATCH).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], BATCH)

    def depth(self, more: int = 0) -> int:
        """The depth for what the store holds and ``more`` turns."""
        rows = (self.batches().agg(F.sum("rows")).first()[0] or 0) + more
        return max(0, math.ceil(math.log2(max(rows, 1) / self.rows_per_bucket)))

    def add(self, arrived: DataFrame, run: str, batch_id: int) -> None:
        """Store a batch (turns and source_file). One that was stored before stays as it is, one that was cut off is written again."""
        if not self.batches().filter((F.col("run") == run) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        rows = arrived.count()
        depth = self.depth(rows)
        named = {"run": F.lit(run), "batch_id": F.lit(batch_id), "depth": F.lit(depth), "bucket": bucket_at(depth)}
        stored = conform(arrived.withColumns(named | {"unit": F.lit(f"{run}.{batch_id}")}), STORED_SCHEMA)
        self._write(stored.hint("rebalance", "bucket"), f"{self.path}/turns", PLACE)
        noted = self.spark.createDataFrame([(rows, depth, run, batch_id)], BATCH)
        self._write(noted, f"{self.path}/batches", ["run", "batch_id"])

    @staticmethod
    def _write(rows: DataFrame, path: str, by: list[str]) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    # Reading

    def touched(self, chats: DataFrame) -> list[Bucket]:
        """The buckets in which ``chats`` (chat_id) can lie, at every depth the store has had. Their number is all that reaches the driver."""
        depths = [r.depth for r in self.batches().select("depth").distinct().collect()]
        places = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), bucket_at(d).alias("bucket")) for d in depths])) if depths else None
        if places is None:
            return []
        found = chats.select(places.alias("place")).select("place.*").distinct().collect()
        return sorted((r.depth, r.bucket) for r in found if path_exists(self.spark, self._folder((r.depth, r.bucket))))

    def _folder(self, bucket: Bucket) -> str:
        return f"{self.path}/turns/depth={bucket[0]}/bucket={bucket[1]}"

    def read(self, buckets: list[Bucket]) -> DataFrame:
        """All rows of some buckets; no other folder is listed."""
        if not buckets:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        base = self.spark.read.schema(STORED_SCHEMA).option("basePath", f"{self.path}/turns")
        return base.parquet(*map(self._folder, buckets))

    def turns_of(self, chats: DataFrame, buckets: list[Bucket], but: tuple[str, int] | None = None) -> DataFrame:
        """The turns of ``chats`` in their buckets, without those of the batch ``but`` (run, batch_id). A file that several runs stored
        counts once, as the last of them had it."""
        rows = self.read(buckets).join(chats.select("chat_id").distinct(), "chat_id", "left_semi")
        return self._once(rows if but is None else rows.filter((F.col("run") != but[0]) | (F.col("batch_id") != but[1])))

    def everything(self) -> DataFrame:
        """The turns of all chats."""
        return self._once(self.spark.read.schema(STORED_SCHEMA).parquet(f"{self.path}/turns"))

    @staticmethod
    def _once(rows: DataFrame) -> DataFrame:
        """Dealt evenly over tasks: what follows costs much more a byte than the few large files of a bucket, one task each, are made for."""
        kept = rows.groupBy("source_file").agg(F.max(F.struct("run", "batch_id")).alias("kept")).select("source_file", "kept.*")
        return rows.join(kept, ["source_file", "run", "batch_id"], "left_semi").repartition("chat_id", "turn_rank", "turn_id")

    # Packing

    def pack(self, buckets: list[Bucket]) -> None:
        """Pack those of ``buckets`` that have many units or lie at an earlier depth.

        The packed units are written aside, then named with what they replace in one committed table, then put in place by ``recover``, which
        the next batch repeats should this one be cut off.
        """
        depth, units = self.depth(), self.read(buckets).select(*PLACE).distinct().collect()
        by_bucket: dict[Bucket, list[str]] = {}
        for u in units:
            by_bucket.setdefault((u.depth, u.bucket), []).append(u.unit)
        chosen = [b for b, names in by_bucket.items() if len(names) > self.pack_after or b[0] < depth]
        if not chosen:
            return
        name = f"pack-{uuid.uuid4().hex}"
        place = {"depth": F.lit(depth), "bucket": bucket_at(depth), "unit": F.lit(name)}
        packed = conform(self.read(chosen).withColumns(place), STORED_SCHEMA)
        self._write(packed.hint("rebalance", "bucket"), f"{self.path}/packing/{name}", PLACE)
        covered = [(*b, unit) for b in chosen for unit in by_bucket[b]]
        self.spark.createDataFrame(covered, "depth int, bucket long, unit string").coalesce(1).write.parquet(f"{self.path}/packs/{name}")
        self.recover()

    def recover(self) -> None:
        """Finish what a lost driver left: put committed packs in place and take out what they replace; drop others."""
        for name in self._names(f"{self.path}/packs"):
            if path_exists(self.spark, f"{self.path}/packs/{name}/_SUCCESS"):
                self._publish(name)
        for kind in ("packing", "packs"):
            self._delete(f"{self.path}/{kind}")

    def _publish(self, name: str) -> None:
        aside = f"{self.path}/packing/{name}"
        for depth in self._names(aside):
            for bucket in self._names(f"{aside}/{depth}"):
                for unit in self._names(f"{aside}/{depth}/{bucket}"):
                    self._move(f"{aside}/{depth}/{bucket}", f"{self.path}/turns/{depth}/{bucket}", unit)
        for r in self.spark.read.parquet(f"{self.path}/packs/{name}").collect():
            self._delete(f"{self._folder((r.depth, r.bucket))}/unit={r.unit}")

    def _files(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), found

    def _names(self, path: str) -> list[str]:
        """The folders in a folder, without those that Spark keeps for itself."""
        if not path_exists(self.spark, path):
            return []
        system, found = self._files(path)
        inside = [s.getPath().getName() for s in system.listStatus(found) if s.isDirectory()]
        return sorted(n for n in inside if not n.startswith(("_", ".")))

    def _move(self, source: str, target: str, name: str) -> None:
        system, folder = self._files(target)
        system.mkdirs(folder)
        if not path_exists(self.spark, f"{target}/{name}") and not system.rename(self._files(f"{source}/{name}")[1], self._files(f"{target}/{name}")[1]):
            raise OSError(f"could not move {source}/{name}")

    def _delete(self, path: str) -> None:
        system, found = self._files(path)
        system.delete(found, True)
