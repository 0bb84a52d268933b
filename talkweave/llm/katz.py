"""Log probabilities of texts under a Katz back-off bigram model of the corpus.

Counts up to CUT are discounted by Good-Turing; what that frees is given to unseen followers in proportion to the lower order, with
weights that normalise exactly: over all known tokens and one unknown token, each history's probabilities sum to 1. Where a history frees nothing,
its counts are scaled by n / (n + 1). The recursion is token given history, then token alone, then unknown.

Counts live in tables partitioned by n-gram hash; documents ask them chunk by chunk (:mod:`talkweave.llm.chunks`), in three questions: counts
of tokens; counts of pairs, each of which one chunk comes to own; and per history the sums over owned pairs that its
back-off weight needs. Tokens and pairs are told apart by 64-bit hashes.
"""

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkweave.llm import arrays, chunks
from talkweave.staging import materialise

WORDS = arrays.byte_class(arrays.SPACES, lower=True)
END, BEGIN = np.uint64(0x0E0D0E0D0E0D0E0D), np.uint64(0x0B0E0B0E0B0E0B0E)
CUT = 5
CHUNK_BYTES = 8 << 20


def is_training(doc_id: int | None, folds: int = 10) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds != 0


@dataclass
class Order:
    """What is known of all n-grams of one order: number, tokens, and how many occur 1 to CUT + 1 times."""

    types: int
    tokens: int
    of_count: np.ndarray

    @property
    def discounts(self) -> np.ndarray:
        """Good-Turing factors for counts 0 to CUT (0 unused); 1 - 1 / (2 r) where the counts of counts give none between 0 and 1."""
        n, out = self.of_count.astype(float), np.ones(CUT + 1)
        for r in range(1, CUT + 1):
            out[r] = 1 - 0.5 / r
            if n[0] > 0 and n[r - 1] > 0 and n[r] > 0:
                common = (CUT + 1) * n[CUT] / n[0]
                factor = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) if common < 1 else 0
                if 0 < factor < 1:
                    out[r] = factor
        return out

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return counts * np.where(counts <= CUT, self.discounts[np.minimum(counts, CUT)], 1.0)


@dataclass
class Unigrams:
    """Probabilities of tokens by their count; count 0 is the one unknown token."""

    order: Order
    kept: float  # sum of discounted counts

    def probability(self, counts: np.ndarray) -> np.ndarray:
        n = max(self.order.tokens, 1)
        free = 1 - self.kept / n
        scale = 1.0 if free > 1e-12 else n / (n + 1)
        unknown = free if free > 1e-12 else 1 / (n + 1)
        return np.where(counts > 0, self.order.discounted(counts) * scale / n, unknown)


class Tokens:
    """Tokens of a chunk, document after document: hash, history's hash, document."""

    def __init__(self, chunk: chunks.Chunk):
        n = len(chunk.ids)
        parts, counts = [], []
        for words in arrays.words_of(chunk.texts, WORDS):
            parts.append(arrays.word_hashes(words))
            counts.append(np.diff(words.bounds))
        per_doc = np.concatenate([np.zeros(0, np.int64), *counts])
        ends = np.cumsum(per_doc + 1) - 1
        self.token = np.full(int((per_doc + 1).sum()), END, np.uint64)
        inside = np.ones(len(self.token), bool)
        inside[ends] = False
        self.token[inside] = np.concatenate([np.zeros(0, np.uint64), *parts])
        self.history = np.empty_like(self.token)
        self.history[1:] = self.token[:-1]
        self.history[ends - per_doc] = BEGIN
        self.doc = np.repeat(np.arange(n, dtype=np.int32), per_doc + 1)
        self.n = per_doc + 1
        ids = chunk.ids
        self.trains = np.array([is_training(None if i == chunks.NO_ID else i) for i in ids.tolist()], bool).reshape(n)
        self.in_training = self.trains[self.doc]
        self.words, self.word_of = _distinct(self.token)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pair hashes, an example token of each, and the pair of each token."""
        with np.errstate(over="ignore"):
            key = arrays.mix(arrays.mix(self.history) * np.uint64(0xD6E8FEB86659FD93) + self.token)
        keys, pair_of = _distinct(key)
        example = np.empty(len(keys), np.int32)
        example[pair_of] = np.arange(len(pair_of), dtype=np.int32)
        return keys, example, pair_of


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and, in 32 bits, the place of each value among them."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], place


def _reply_counts(_, keys: list[np.ndarray], mores: list[bytes]) -> list[bytes]:
    """Total of each key; whether the asking chunk owns it, as one of those that count it; and the order's counts of counts."""
    mine = np.concatenate([chunks.unpack(m, np.uint32) for m in mores]).astype(np.int64)
    every = np.concatenate(keys)
    order = np.argsort(every)
    cuts = chunks.same_runs(every[order])
    run = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    totals = np.add.reduceat(mine[order], cuts[:-1])
    counted = mine[order] > 0
    before = np.cumsum(counted) - counted
    first = counted & (before == before[cuts[:-1]][run])
    total, own = np.empty(len(every), np.int64), np.empty(len(every), np.uint8)
    total[order], own[order] = totals[run], first
    at = np.cumsum([len(k) for k in keys])[:-1]
    known = totals[totals > 0]
    of_count = np.bincount(np.minimum(known, CUT + 2), minlength=CUT + 3)[1:CUT + 2]
    stats = np.concatenate([[len(known), known.sum()], of_count]).astype(np.int64)
    return [chunks.pack(t) + o.tobytes() for t, o in zip(np.split(total, at), np.split(own, at))] + [stats.tobytes()]


def _reply_sums(_, keys: list[np.ndarray], mores: list[bytes]) -> list[bytes]:
    """The back-off weight of each history; its sign bit says that the history frees nothing and is scaled."""
    parts = [chunks.unpack(m, np.float64).reshape(3, -1) for m in mores]
    kept, lower, n = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0))
    every = np.concatenate(keys)
    order = np.argsort(every)
    cuts = chunks.same_runs(every[order])
    run = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    kept, lower = (np.add.reduceat(x[order], cuts[:-1]) for x in (kept, lower))
    n = n[order][cuts[:-1]]
    free = 1 - kept / np.maximum(n, 1)
    left = np.maximum(1 - lower, 1e-300)
    weight = np.where(free > 1e-12, free / left, -(1 / (n + 1)) / left)
    weight[n == 0] = 1.0
    out = np.empty(len(every))
    out[order] = weight[run]
    return [chunks.pack(x) for x in np.split(out, np.cumsum([len(k) for k in keys])[:-1])]


def _counts(answers: list[bytes] | None, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Totals and ownership of a chunk's keys from its answers."""
    totals, own = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    for a, n in zip(answers or [], np.diff(cuts)):
        totals.append(chunks.unpack(a[:len(a) - n], np.int64))
        own.append(np.frombuffer(a[len(a) - n:], np.uint8))
    return np.concatenate(totals), np.concatenate(own).astype(bool)


def _order(answers: DataFrame) -> Order:
    """The sum of what the buckets say, added up by tasks: the driver gets CUT + 3 numbers, however many buckets there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros(CUT + 3, np.int64)
        for batch in batches:
            for said in batch.column(0).to_pylist():
                part += np.frombuffer(said, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(part))), pa.array(part)], ["at", "n"])

    parts = arrays.map_batches(answers.where("chunk = -1").select("answer"), run, "at long, n long")
    total = np.zeros(CUT + 3, np.int64)
    for r in parts.groupBy("at").sum("n").collect():
        total[r[0]] = r[1]
    return Order(int(total[0]), int(total[1]), total[2:])


@dataclass
class Model:
    """The numbers that all tasks share; the counts stay in their tables."""

    unigrams: Unigrams
    pairs: Order | None
    documents: int
    word_buckets: int
    pair_buckets: int

    def word_counts(self, t: Tokens, answers: list[bytes] | None) -> np.ndarray:
        return _counts(answers, chunks.by_bucket(t.words, self.word_buckets))[0]


def _histories(t: Tokens, model: Model, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct histories, their training counts, and the history of each token."""
    distinct, of_token = _distinct(t.history)
    n = np.full(len(distinct), model.documents, np.int64)
    words = distinct != BEGIN
    n[words] = counts[np.searchsorted(t.words, distinct[words])]
    return distinct, n, of_token


def _sums(t: Tokens, model: Model, word_answers, pair_answers) -> tuple[np.ndarray, Callable]:
    counts = model.word_counts(t, word_answers)
    keys, example, _ = t.pairs()
    total, own = _counts(pair_answers, chunks.by_bucket(keys, model.pair_buckets))
    histories, n, of_token = _histories(t, model, counts)
    at = of_token[example[own]]
    kept = np.bincount(at, model.pairs.discounted(total[own]), len(histories))
    lower = np.bincount(at, model.unigrams.probability(counts[t.word_of[example[own]]]), len(histories))
    return histories, lambda lo, hi: chunks.pack(np.stack([kept[lo:hi], lower[lo:hi], n[lo:hi].astype(float)]))


def _score(chunk: chunks.Chunk, model: Model, words, pairs, weights) -> pa.RecordBatch:
    t = Tokens(chunk)
    counts = model.word_counts(t, words)
    keys, _, pair_of = t.pairs()
    total, _ = _counts(pairs, chunks.by_bucket(keys, model.pair_buckets))
    histories, n, history_of = _histories(t, model, counts)
    weight = np.concatenate([np.zeros(0), *(chunks.unpack(w, np.float64) for w in weights or [])])
    count, seen = counts[t.word_of], total[pair_of]
    n, w = n[history_of].astype(float), weight[history_of]
    lower = model.unigrams.probability(count)
    scaled = np.where(w < 0, n / (n + 1), 1.0)
    p = np.where(seen > 0, model.pairs.discounted(seen) * scaled / np.maximum(n, 1), np.abs(w) * lower)
    uni = model.unigrams.order
    base = np.log10((count + 0.1) / (uni.tokens + 0.1 * (uni.types + 1)))
    size = len(chunk.ids)
    columns = [
        pa.array(chunk.ids, mask=chunk.ids == chunks.NO_ID), pa.array(~t.trains), pa.array(t.n),
        pa.array(np.bincount(t.doc, count > 0, size).astype(np.int64)), pa.array(np.full(size, uni.tokens, np.int64)),
        pa.array(np.bincount(t.doc, base, size)), pa.array(np.bincount(t.doc, np.log10(p), size)),
    ]
    return pa.RecordBatch.from_arrays(columns, OUT)


OUT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of ``docs``.

    The model learns from rows whose crc32 of doc_id as text is not divisible by 10; rows with a null doc_id
    train. Tokens are lower-cased words and one end per row; null and empty texts have the end only; repeated rows count
    each time; without training rows every token is the unknown one; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    stored = chunks.store(docs, CHUNK_BYTES)
    total = stored.selectExpr("coalesce(sum(n_bytes), 0) AS n").first().n
    word_buckets, pair_buckets = chunks.buckets_for(total // 50, spark), chunks.buckets_for(total // 10, spark)

    def ask_words(chunk: chunks.Chunk, _):
        t = Tokens(chunk)
        mine = np.bincount(t.word_of[t.in_training], minlength=len(t.words)).astype(np.uint32)
        return t.words, lambda lo, hi: chunks.pack(mine[lo:hi])

    words = materialise(chunks.answer(chunks.ask(stored, ask_words, word_buckets), _reply_counts), "words")

    def ask_pairs(chunk: chunks.Chunk, _):
        t = Tokens(chunk)
        keys, _, pair_of = t.pairs()
        mine = np.bincount(pair_of[t.in_training], minlength=len(keys)).astype(np.uint32)
        return keys, lambda lo, hi: chunks.pack(mine[lo:hi])

    pairs = materialise(chunks.answer(chunks.ask(stored, ask_pairs, pair_buckets), _reply_counts), "pairs")
    order, ends = _order(words), _training_documents(stored)
    kept = _kept_unigrams(order)
    model = Model(Unigrams(order, kept), _order(pairs), ends, word_buckets, pair_buckets)
    with_words = chunks.answered(stored, words).withColumnRenamed("answers", "words")
    with_pairs = chunks.answered(with_words, pairs).withColumnRenamed("answers", "pairs")

    def ask_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunks.rows_of(batches):
            keys, more = _sums(Tokens(chunks.Chunk(row["chunk"], row)), model, row["words"], row["pairs"])
            yield chunks.questions(row["chunk"], keys, more, word_buckets)

    sums = arrays.map_batches(with_pairs, ask_sums, chunks.ASK_SCHEMA)
    weights = materialise(chunks.answer(sums, _reply_sums), "weights")
    complete = chunks.answered(with_pairs, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunks.rows_of(batches):
            yield _score(chunks.Chunk(row["chunk"], row), model, row["words"], row["pairs"], row["answers"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return arrays.map_batches(complete, run, schema)


def _training_documents(stored: DataFrame) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(
                is_training(None if i == chunks.NO_ID else i) for row in batch.column(0).to_pylist() for i in chunks.unpack(row, np.int64).tolist()
            )
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return arrays.map_batches(stored.select("ids"), run, "n long").selectExpr("coalesce(sum(n), 0) AS n").first().n


def _kept_unigrams(order: Order) -> float:
    """Sum of the discounted counts of all tokens: discounts only change counts up to CUT, whose numbers are known."""
    small = np.arange(1, CUT + 1)
    return float(order.tokens - (order.of_count[:CUT] * small * (1 - order.discounts[1:])).sum())
