"""Questions about hashes of a whole corpus, asked chunk by chunk.

Documents are stored once as chunks: rows of a bounded number of compressed texts, in a table bucketed by chunk, so that joins with it move
no text. For each question a chunk sends its distinct hashes, sorted, in one row per bucket of the hash
space; each bucket sees all chunks' hashes of its range and answers every row in the order asked; the answers go back to the chunks. A
frequent hash is one entry per chunk, so no key is hot; buckets split the hash space evenly, and their number follows the number of hashes.
"""

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.arrays import map_batches, text_bytes
from talkweave.staging import new_path, ship_package

CHUNK_BYTES = 4 << 20
#: Hashes that a bucket holds on average.
BUCKET_KEYS = 2_000_000
#: Stands for a null doc_id: such documents come last.
NO_ID = np.iinfo(np.int64).max

CHUNK_SCHEMA = "chunk long, n long, n_bytes long, ids binary, offsets binary, texts binary"
ASK_SCHEMA = "bucket int, chunk long, keys binary, more binary"
ANSWER_SCHEMA = "chunk long, bucket int, answer binary"


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


@dataclass
class Chunk:
    """One stored row: ids (NO_ID for null) and texts of some documents."""

    chunk: int
    row: dict

    @cached_property
    def ids(self) -> np.ndarray:
        return unpack(self.row["ids"], np.int64)

    @cached_property
    def texts(self) -> pa.Array:
        offsets = unpack(self.row["offsets"], np.int64)
        data = zstandard.ZstdDecompressor().decompress(self.row["texts"], max_output_size=max(1, self.row["n_bytes"]))
        return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))

    @cached_property
    def rank(self) -> np.ndarray:
        """Place of each document in the chunk's order by id, then by row."""
        out = np.empty(len(self.ids), np.int64)
        out[np.argsort(self.ids, kind="stable")] = np.arange(len(self.ids))
        return out


def store(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id and text of ``docs`` as a table of chunks of whole texts; null texts are stored as empty.

    The files stay in the shared folder; the catalog forgets their table at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = np.where(
                np.asarray(batch.column(0).is_null()), NO_ID, batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            )
            data, offsets = text_bytes(batch.column(1))
            at = 0
            while at < batch.num_rows:
                to = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1
                to = min(max(to, at + 1), batch.num_rows)
                part = data[offsets[at]:offsets[to]]
                texts = zstandard.ZstdCompressor(level=3).compress(part.tobytes())
                row = [number, to - at, len(part), pack(ids[at:to]), pack(offsets[at:to + 1] - offsets[at]), texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int64()) for x in row],
                    ["chunk", "n", "n_bytes", "ids", "offsets", "texts"],
                )
                number, at = number + 1, to

    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    name, parts = f"chunks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = map_batches(texts, run, CHUNK_SCHEMA)
    rows.write.bucketBy(parts, "chunk").option("path", new_path(spark, "chunks")).option("compression", "uncompressed").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def buckets_for(keys: int, spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // BUCKET_KEYS))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key: an even share of the hash space."""
    return (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def by_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of the sorted ``keys`` begins, for buckets that have one, and the end."""
    return same_runs(bucket_of(keys, buckets))


def questions(chunk: int, keys: np.ndarray, more: Callable, buckets: int) -> pa.RecordBatch:
    """A chunk's rows: sorted ``keys`` cut at the buckets they fall in, and ``more(lo, hi)`` as bytes about each cut.

    Buckets without a key of the chunk cost nothing, however many there are.
    """
    cuts = by_bucket(keys, buckets)
    return pa.RecordBatch.from_arrays([
        pa.array(bucket_of(keys[cuts[:-1]], buckets).astype(np.int32)), pa.array(np.full(len(cuts) - 1, chunk, np.int64)),
        pa.array([keys[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary()),
        pa.array([more(lo, hi) for lo, hi in zip(cuts, cuts[1:])], pa.binary()),
    ], ["bucket", "chunk", "keys", "more"])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Chunks one at a time: one chunk's arrays and answers are in Python's memory at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def ask(chunks: DataFrame, question: Callable, buckets: int) -> DataFrame:
    """Rows of questions. ``question(chunk, answers)`` gives sorted uint64 keys and a function lo, hi -> bytes of more about them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, more = question(Chunk(row["chunk"], row), row.get("answers"))
            yield questions(row["chunk"], keys, more, buckets)

    return map_batches(chunks, run, ASK_SCHEMA)


def answer(asked: DataFrame, reply: Callable) -> DataFrame:
    """``reply(chunks, keys, mores)``, lists with an entry per row of a bucket, gives each row's answer as bytes.

    One more answer than rows is what the bucket says about all its keys; it gets chunk -1.
    """
    ship_package(asked.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        said = reply([r["chunk"] for r in rows], keys, [r["more"] for r in rows])
        to = [r["chunk"] for r in rows] + [-1] * (len(said) - len(rows))
        return pa.table({
            "chunk": pa.array(to, pa.int64()),
            "bucket": pa.array([rows[0]["bucket"]] * len(to), pa.int32()),
            "answer": pa.array(said, pa.binary()),
        })

    return asked.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def answered(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each chunk with its answers, in the order of the buckets."""
    listed = answers.where("chunk >= 0").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))
    return chunks.join(listed.select("chunk", F.transform("answers", lambda a: a.answer).alias("answers")), "chunk", "left")


def same_runs(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the start of each run of equal ones, and the end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
