"""Benchmark passages in documents, by SimHash over windows of each item's size.

The items are the query set. They are taken in blocks of bounded size, each sent to the workers and held against all
documents in one pass. A window can be similar to an item only if enough of its shingles are shingles
of the block, which counts over the text tell at once; such windows get a fingerprint. The 64 bits are cut into BLOCKS; two fingerprints within
``radius`` bits agree in some cut up to radius // BLOCKS bits, so the index of the items' cuts, with all values that near, gives every
item within the radius. Candidates are verified by the exact similarity of the weighted shingles.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm import arrays

WORDS = arrays.byte_class(arrays.NOT_ALPHANUMERIC, lower=True)
BLOCKS, CUT_BITS = 16, 4
#: Words of the items that are sent to the workers at a time.
ITEM_WORDS = 2_000_000


class Fingerprints:
    """SimHash of ranges of shingles: bits set in more than half. Running sums of the bits serve all ranges of a stretch."""

    STRETCH = 20_000

    def __init__(self, shingles: np.ndarray, longest: int):
        self.shingles, self.longest = shingles, longest
        self.sums: dict[int, np.ndarray] = {}

    def at(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), np.uint64)
        stretch = first // self.STRETCH
        for k in np.unique(stretch).tolist():
            mine, begin = stretch == k, k * self.STRETCH
            if k not in self.sums:
                part = self.shingles[begin:begin + self.STRETCH + self.longest]
                bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                self.sums[k] = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
            a, b = first[mine] - begin, end[mine] - begin
            most = 2 * (self.sums[k][b] - self.sums[k][a]) > (b - a)[:, None]
            out[mine] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
        return out


def similarity(a: Counter, b: Counter) -> float:
    """Dice similarity of weighted shingles; a shingle weighs as often as it occurs."""
    total = a.total() + b.total()
    return 2 * sum(min(n, b[s]) for s, n in a.items() if s in b) / total if total else 0.0


@dataclass
class Sized:
    """Items with the same number of words: ids, shingle weights, fingerprints, and the index of their cuts."""

    words: int
    ids: list[int]
    weights: list[Counter]
    fps: np.ndarray
    near: np.ndarray  # [cut, value, item]: whether the item's cut is within the cut's threshold of the value

    def candidates(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) pairs within the radius."""
        hit = np.zeros((len(fps), len(self.ids)), bool)
        for cut in range(BLOCKS):
            value = ((fps >> np.uint64(cut * CUT_BITS)) & np.uint64((1 << CUT_BITS) - 1)).astype(np.int64)
            hit |= self.near[cut][value]
        a, b = np.nonzero(hit)
        close = np.bitwise_count(fps[a] ^ self.fps[b]) <= radius
        return a[close], b[close]


class Items:
    """A block of items, ready to be held against texts."""

    def __init__(self, ids: list[int], texts: list[str], size: int, least: float, radius: int):
        self.size, self.least, self.radius = size, least, radius
        by_words: dict[int, list] = {}
        for words in arrays.words_of(pa.array(texts, pa.large_string()), WORDS):
            hashes = arrays.word_hashes(words)
            for i, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
                if b > a:
                    shingles = arrays.window_hashes(hashes[a:b], min(size, b - a))
                    by_words.setdefault(b - a, []).append((ids[words.first + i], shingles))
        self.sizes = [self._sized(n, items) for n, items in sorted(by_words.items())]
        every = [s for items in by_words.values() for _, s in items]
        self.shingles = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.shingles >> np.uint64(44)).astype(np.int64)] = True

    def _sized(self, n: int, items: list[tuple[int, np.ndarray]]) -> Sized:
        fps = np.array([Fingerprints(s, len(s)).at(np.array([0]), np.array([len(s)]))[0] for _, s in items], np.uint64)
        values = np.arange(1 << CUT_BITS)
        near = np.zeros((BLOCKS, 1 << CUT_BITS, len(items)), bool)
        for cut in range(BLOCKS):
            own = ((fps >> np.uint64(cut * CUT_BITS)) & np.uint64((1 << CUT_BITS) - 1)).astype(np.int64)
            near[cut] = np.bitwise_count(values[:, None] ^ own[None, :]) <= self.radius // BLOCKS
        return Sized(n, [i for i, _ in items], [Counter(s.tolist()) for _, s in items], fps, near)

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles are some item's."""
        out = self.table[(shingles >> np.uint64(44)).astype(np.int64)]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(self.shingles, shingles[at]), max(len(self.shingles) - 1, 0))
        out[at] = self.shingles[place] == shingles[at] if len(self.shingles) else False
        return out

    def matches(self, words: arrays.Words) -> Iterator[tuple[int, int, float, int, int]]:
        """(text of the slice, item_id, similarity, first word, words) of the best window of each text and item."""
        hashes = arrays.word_hashes(words)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        by_run: dict[int, tuple] = {}
        made: dict[tuple[int, int], Fingerprints] = {}
        for sized in self.sizes:
            run = min(self.size, sized.words)
            if run not in by_run:
                by_run[run] = self._near(words, hashes, run)
            shingles, total, texts = by_run[run]
            for text in texts:
                begin, end = int(words.bounds[text]), int(words.bounds[text + 1])
                if end - begin >= sized.words:
                    first = np.arange(begin, end - sized.words + 1)
                    last = first + sized.words - run + 1
                elif end - begin >= run:  # a text shorter than the item is one window
                    first, last = np.array([begin]), np.array([end - run + 1])
                else:
                    continue
                both = (last - first) + (sized.words - run + 1)
                enough = 2 * (total[last] - total[first]) >= ceil_of(self.least * both)
                first, last = first[enough], last[enough]
                if not len(first):
                    continue
                if (text, run) not in made:
                    made[text, run] = Fingerprints(shingles[begin:end], self.sizes[-1].words)
                fps = made[text, run].at(first - begin, last - begin)
                for w, item in zip(*(x.tolist() for x in sized.candidates(fps, self.radius))):
                    a, b = int(first[w]), int(last[w])
                    like = similarity(Counter(shingles[a:b].tolist()), sized.weights[item])
                    found = (like, begin - a, b - a + run - 1)  # the earlier of equal windows
                    if like >= self.least and found > best.get((text, sized.ids[item]), (0.0, 0, 0)):
                        best[text, sized.ids[item]] = found
        for (text, item), (like, back, n) in best.items():
            yield text, item, like, -back, n

    def _near(self, words: arrays.Words, hashes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Shingles of ``run`` words, the running number of those known, and the texts that have any."""
        shingles = arrays.window_hashes(hashes, run)
        known = np.zeros(len(hashes) + 1, bool)
        known[:len(shingles)] = self.known(shingles)
        text = words.text_of()
        known[:len(shingles)] &= text[:len(shingles)] == text[run - 1:]
        total = np.zeros(len(known) + 1, np.int64)
        np.cumsum(known, out=total[1:])
        return shingles, total, np.unique(text[np.flatnonzero(known)]).tolist()


def ceil_of(x: np.ndarray) -> np.ndarray:
    """The next whole number, with room for rounding."""
    return np.ceil(x - 1e-9)


def leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.8, radius: int = 23
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): for each row of ``docs`` and each item it holds, the best window.

    A window has as many words as the item (the whole text, if that is shorter) and counts if the Dice similarity of the weighted
    shingles of ``size`` words is at least ``least`` and the fingerprints differ in at most ``radius`` bits. Items and texts of fewer
    words use shingles of the whole item's size. Words are lower-cased letters and digits. Null and empty texts and items
    match nothing; rows with a null doc_id are kept as such; repeated rows and repeated items match each by
    itself; empty tables give an empty result; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    out = None
    for items in item_blocks(benchmark, size, least, radius):
        found = _against(texts, items)
        out = found if out is None else out.union(found)
    return out


def item_blocks(benchmark: DataFrame, size: int, least: float, radius: int) -> Iterator[Items]:
    """The items in blocks of about ITEM_WORDS words; one empty block for an empty table."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / (6 * ITEM_WORDS)) or 1
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        yield Items([r.item_id for r in rows], [r.text for r in rows], size, least, radius)


def _against(texts: DataFrame, items: Items) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            ids, out = batch.column(0), []
            for words in arrays.words_of(batch.column(1), WORDS):
                if len(words):
                    out += [(ids[words.first + t].as_py(), *rest) for t, *rest in block.matches(words)]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], LEAK_COLUMNS)

    return arrays.map_batches(texts, run, LEAK_SCHEMA)


LEAK_COLUMNS = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
LEAK_SCHEMA = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.8, radius: int = 23) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item. Judged row by row, so equal ids do not matter."""
    names = docs.columns
    text_at = names.index("text")
    kept = docs
    for items in item_blocks(benchmark, size, least, radius):
        kept = _without(kept, items, text_at)
    return kept


def _without(docs: DataFrame, items: Items, text_at: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for words in arrays.words_of(batch.column(text_at), WORDS):
                if len(words):
                    keep[[words.first + m[0] for m in block.matches(words)]] = False
            yield batch.filter(pa.array(keep))

    return arrays.map_batches(docs, run, docs.schema)
