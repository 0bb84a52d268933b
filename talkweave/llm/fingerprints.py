"""SimHash fingerprints of whole texts."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from talkweave.llm import arrays

WORDS = arrays.byte_class(arrays.SPACES, lower=True)
SEED = 42


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each group of hashes, the bits that are set in over half of them; zero for none."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    if len(full):
        for bit in range(64):
            ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), bounds[:-1][full])
            out[full] |= (2 * ones > sizes[full]).astype(np.uint64) << np.uint64(bit)
    return out


def shingle_hashes(words: arrays.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the runs of ``size`` words of each text, joined by a space; fewer words are one run."""
    text, at = arrays.normalised(words)
    count = np.diff(words.bounds)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=bounds[1:])
    first = np.repeat(words.bounds[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
    last = np.minimum(first + size, np.repeat(words.bounds[1:], n))
    digest = xxhash.xxh64_intdigest
    found = [digest(text[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())]
    return np.array(found, np.uint64), bounds


def simhash(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and fp, a 64-bit SimHash as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for words in arrays.words_of(batch.column(1), WORDS):
                hashes, bounds = shingle_hashes(words, size)
                out[words.first:words.first + len(bounds) - 1] = majority(hashes, bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out.view(np.int64))], ["doc_id", "fp"])

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return arrays.map_batches(texts, run, "doc_id long, fp long")
