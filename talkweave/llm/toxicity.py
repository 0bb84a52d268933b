"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a learned vector (words that training texts repeat) next to the sum of vectors of its character n-grams (three characters
anywhere, and prefixes), so that unseen forms of a word are known by their spelling. Two gated recurrent passes
read each window of WINDOW words, STEP apart, so that windows overlap and cover every word; attention pools the states to
the window's logit. A document's score is logistic in its highest window logits. Labels stand for documents, not windows: after a first round
over all windows, training goes on with the windows that score highest.
"""

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from talkweave.llm import arrays

WORDS = arrays.byte_class(arrays.NOT_ALPHANUMERIC, lower=True)
WINDOW, STEP = 40, 30
GRAMS, PREFIXES = 1 << 14, (2, 3, 4, 5, 6, 7, 8)
TOP = 4


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample, and the network's sizes."""

    documents_per_class: int = 2000
    longest: int = 8000
    vocabulary: int = 20_000
    word_dim: int = 8
    gram_dim: int = 16
    hidden: int = 8
    attention: int = 8
    rounds: int = 6
    least_steps: int = 250
    batch: int = 256
    rate: float = 0.015
    seed: int = 7


def _grams(words: arrays.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the words ``at``, word after word, and where each word's begin."""
    start, end = words.start[at], words.end[at]
    length = end - start
    padded = np.concatenate([np.zeros(2, np.uint8), words.data, np.zeros(3, np.uint8)])
    count = length + np.array([np.minimum(length, p) == p for p in PREFIXES]).sum(0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(bounds[-1], np.uint64)
    # Runs of three around each byte; bytes outside of the word count as its edge.
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    where = np.repeat(start, length) + place + 2
    left = np.where(place > 0, padded[where - 1], 0).astype(np.uint64)
    right = np.where(place < np.repeat(length, length) - 1, padded[where + 1], 0).astype(np.uint64)
    with np.errstate(over="ignore"):
        three = (left << np.uint64(16)) | (padded[where].astype(np.uint64) << np.uint64(8)) | right
        out[np.repeat(bounds[:-1], length) + place] = three * np.uint64(2)
        value, used = np.zeros(len(at), np.uint64), length.copy()
        for k in range(max(PREFIXES)):
            inside = np.minimum(start + k, end - 1) + 2
            value = np.where(k < length, (value + padded[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(0x100000001B3), value)
            if k + 1 in PREFIXES:
                has = length >= k + 1
                out[bounds[:-1][has] + used[has]] = value[has] * np.uint64(2) + np.uint64(1)
                used += has
    return (arrays.mix(out) % np.uint64(GRAMS)).astype(np.int64), bounds


@dataclass
class Texts:
    """Windows of some texts: ``ids[window, step]`` of distinct words (-1 after the end), ``text`` of each window."""

    ids: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray
    n_texts: int


def windows(words: arrays.Words, of_words: np.ndarray | None = None) -> Texts:
    """Windows of the texts; ``of_words``: the words' hashes, if they are known."""
    of_words = arrays.word_hashes(words) if of_words is None else of_words
    hashes, first, ids = np.unique(of_words, return_index=True, return_inverse=True)
    n = np.diff(words.bounds)
    count = np.where(n > WINDOW, -(-(n - WINDOW) // STEP) + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = words.bounds[:-1][text] + number * STEP
    place = begin[:, None] + np.arange(WINDOW)[None, :]
    inside = place < words.bounds[1:][text][:, None]
    at = np.where(inside, ids[np.minimum(place, max(len(ids) - 1, 0))] if len(ids) else -1, -1)
    grams, bounds = _grams(words, first)
    return Texts(at.astype(np.int32), text, hashes, grams, bounds, len(n))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _summed(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values of each row number below n."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(row):
        order = np.argsort(row, kind="stable")
        at = np.flatnonzero(np.diff(row[order], prepend=-1))
        out[row[order][at]] = np.add.reduceat(values[order], at, axis=0)
    return out


@dataclass
class Network:
    """Parameters by name, and the sorted hashes of the words it knows; row 0 of ``word`` is any other word."""

    known: np.ndarray
    p: dict[str, np.ndarray]
    document: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def new(cls, known: np.ndarray, how: Training) -> "Network":
        rng = np.random.default_rng(how.seed)
        h, d = how.hidden, how.word_dim + how.gram_dim

        def small(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": small(len(known) + 1, how.word_dim, scale=0.1), "gram": small(GRAMS, how.gram_dim, scale=0.1)}
        for way in ("forth", "back"):
            p[way + "_x"] = small(d, 3 * h, scale=d**-0.5)
            p[way + "_h"] = small(h, 3 * h, scale=h**-0.5)
            p[way + "_b"] = np.zeros(3 * h, np.float32)
        p["att_w"], p["att_v"] = small(2 * h, how.attention, scale=0.3), small(how.attention, scale=0.3)
        p["out_w"], p["out_b"] = small(2 * h, scale=0.3), np.zeros(1, np.float32)
        return cls(known, p)

    def inputs(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vector of each distinct word, its row of ``word``, and the weight of its n-grams."""
        row = np.searchsorted(self.known, t.hashes)
        hit = self.known[np.minimum(row, len(self.known) - 1)] == t.hashes if len(self.known) else np.zeros(len(row), bool)
        row = np.where(hit, row + 1, 0)
        weight = (1 / np.sqrt(np.maximum(np.diff(t.bounds), 1))).astype(np.float32)
        out = np.empty((len(row), self.p["word"].shape[1] + self.p["gram"].shape[1]), np.float32)
        out[:, :self.p["word"].shape[1]] = self.p["word"][row]
        for lo in range(0, len(row), 20_000):
            hi = min(lo + 20_000, len(row))
            vectors = self.p["gram"][t.grams[t.bounds[lo]:t.bounds[hi]]]
            sums = np.add.reduceat(vectors, t.bounds[lo:hi] - t.bounds[lo], axis=0)
            out[lo:hi, self.p["word"].shape[1]:] = sums * weight[lo:hi, None]
        return out, row, weight

    def _pass(self, way: str, projected: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
        n, steps = ids.shape
        size = self.p[way + "_h"].shape[0]
        state = np.zeros((n, size), np.float32)
        states = np.empty((steps, n, size), np.float32)
        for s in range(steps) if way == "forth" else range(steps - 1, -1, -1):
            at = ids[:, s]
            here = (at >= 0)[:, None]
            x, r = projected[at], state @ self.p[way + "_h"]
            gates = _sigmoid(x[:, :2 * size] + r[:, :2 * size])
            reset, stay = gates[:, :size], gates[:, size:]
            new = np.tanh(x[:, 2 * size:] + reset * r[:, 2 * size:])
            after = np.where(here, new + stay * (state - new), state)
            if keep is not None:
                keep.append((s, state, reset, stay, new, r[:, 2 * size:], here))
            states[s] = state = after
        return states

    def logits(self, vectors: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """A logit per window."""
        both = []
        for way in ("forth", "back"):
            steps: list | None = [] if keep is not None else None
            both.append(self._pass(way, vectors @ self.p[way + "_x"] + self.p[way + "_b"], ids, steps))
            if keep is not None:
                keep[way] = steps
        states = np.concatenate(both, axis=2)
        hidden = np.tanh(states @ self.p["att_w"])
        weight = np.where(ids.T >= 0, hidden @ self.p["att_v"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("sn,snd->nd", weight, states)
        if keep is not None:
            keep.update(states=states, hidden=hidden, weight=weight, pooled=pooled)
        return pooled @ self.p["out_w"] + self.p["out_b"][0]

    def gradients(self, t: Texts, ids: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over windows ``ids`` of ``t``."""
        used, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        if len(used) and used[0] < 0:
            used, local = used[1:], local - 1
        count = np.diff(t.bounds)[used]
        bounds = np.concatenate([[0], np.cumsum(count)])
        grams = t.grams[np.repeat(t.bounds[used] - bounds[:-1], count) + np.arange(bounds[-1])]
        part = Texts(local, t.text, t.hashes[used], grams, bounds, t.n_texts)
        vectors, row, weight = self.inputs(part)
        kept: dict = {}
        p, size = self.p, self.p["forth_h"].shape[0]
        d_logit = ((_sigmoid(self.logits(vectors, local, kept)) - labels) / max(len(labels), 1)).astype(np.float32)
        g = {"out_w": kept["pooled"].T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out_w"][None, :]
        states, hidden, w = kept["states"], kept["hidden"], kept["weight"]
        d_w = np.einsum("nd,snd->sn", d_pooled, states)
        d_score = w * (d_w - (w * d_w).sum(axis=0))
        g["att_v"] = np.einsum("sn,sna->a", d_score, hidden)
        d_hidden = d_score[:, :, None] * p["att_v"] * (1 - hidden**2)
        g["att_w"] = np.einsum("snd,sna->da", states, d_hidden)
        d_states = w[:, :, None] * d_pooled[None] + d_hidden @ p["att_w"].T
        d_vectors = np.zeros_like(vectors)
        for k, way in enumerate(("forth", "back")):
            words_seen, gates_seen = [], []
            g[way + "_h"] = np.zeros_like(p[way + "_h"])
            d_state = np.zeros((len(ids), size), np.float32)
            for s, before, reset, stay, new, r_new, here in reversed(kept[way]):
                d_after = d_state + d_states[s][:, k * size:(k + 1) * size]
                d_in = d_after * here
                d_new = d_in * (1 - stay) * (1 - new**2)
                d_stay = d_in * (before - new) * stay * (1 - stay)
                d_reset = d_new * r_new * reset * (1 - reset)
                d_x = np.concatenate([d_reset, d_stay, d_new], axis=1)
                d_r = np.concatenate([d_reset, d_stay, d_new * reset], axis=1)
                g[way + "_h"] += before.T @ d_r
                d_state = d_r @ p[way + "_h"].T + d_in * stay + d_after * ~here
                seen = here[:, 0]
                words_seen.append(local[seen, s])
                gates_seen.append(d_x[seen])
            d_projected = _summed(np.concatenate(words_seen), np.concatenate(gates_seen), len(vectors))
            g[way + "_x"] = vectors.T @ d_projected
            g[way + "_b"] = d_projected.sum(axis=0)
            d_vectors += d_projected @ p[way + "_x"].T
        dim = p["word"].shape[1]
        g["word"] = _summed(row, d_vectors[:, :dim], len(p["word"]))
        g["gram"] = _summed(grams, np.repeat(d_vectors[:, dim:] * weight[:, None], count, axis=0), len(p["gram"]))
        return g

    def window_logits(self, t: Texts) -> np.ndarray:
        vectors, _, _ = self.inputs(t)
        out = [self.logits(vectors, t.ids[lo:lo + 2048]) for lo in range(0, len(t.ids), 2048)]
        return np.concatenate([np.zeros(0, np.float32), *out])

    def scores(self, t: Texts) -> np.ndarray:
        """A probability per text; texts without words get that of no evidence."""
        return _sigmoid(evidence(self.window_logits(t), t) @ self.document)


def evidence(logits: np.ndarray, t: Texts) -> np.ndarray:
    """What a document's score is logistic in: its TOP window logits, those of windows above their neighbours, sums, length, and 1."""
    n = np.bincount(t.text, minlength=t.n_texts)
    out = np.full((t.n_texts, 2 * TOP + 3), -6.0)
    values = np.clip(logits.astype(float), -6, 6)
    peak = np.ones(len(values), bool)
    if len(values) > 1:
        same = t.text[1:] == t.text[:-1]
        peak[:-1] &= ~(same & (values[1:] > values[:-1]))
        peak[1:] &= ~(same & (values[:-1] >= values[1:]))
    for column, v in ((0, values), (TOP, np.where(peak, values, -6.0))):
        order = np.lexsort((-v, t.text))
        place = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
        top = place < TOP
        out[t.text[order][top], column + place[top]] = v[order][top]
    out[:, 2 * TOP] = np.log1p(np.bincount(t.text, _sigmoid(values), t.n_texts))
    out[:, 2 * TOP + 1] = np.log1p(n)
    out[:, 2 * TOP + 2] = 1
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the rarer label counts more, by the root of how much rarer it is."""
    w = np.zeros(x.shape[1])
    weight = np.where(y > 0, np.sqrt(np.maximum((y == 0).sum(), 1) / np.maximum((y > 0).sum(), 1)), 1.0)
    for _ in range(25):
        p = _sigmoid(x @ w)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (weight * (p - y)) + 0.5 * w)
    return w


def _together(parts: list[arrays.Words]) -> tuple[arrays.Words, np.ndarray]:
    """Slices of words as one, and their hashes, which are made slice by slice to save memory."""
    hashes = np.concatenate([np.zeros(0, np.uint64), *map(arrays.word_hashes, parts)])
    at = np.cumsum([0, *(len(p.data) for p in parts)])
    words = np.cumsum([0, *map(len, parts)])
    joined = arrays.Words(
        0, np.concatenate([np.zeros(0, np.uint8), *(p.data for p in parts)]),
        np.concatenate([np.zeros(0, np.int64), *(p.start + a for p, a in zip(parts, at))]),
        np.concatenate([np.zeros(0, np.int64), *(p.end + a for p, a in zip(parts, at))]),
        np.concatenate([np.zeros(1, np.int64), *(p.bounds[1:] + w for p, w in zip(parts, words))]),
    )
    return joined, hashes


def train(texts: list[str], labels: list[int], how: Training = Training()) -> Network:
    """A network for the texts and their labels (0 or 1); every third text of each label is kept for the document level."""
    own, all_hashes = _together(list(arrays.words_of(pa.array(texts, pa.large_string()), WORDS)))
    t, labels = windows(own, all_hashes), np.array(labels, float)
    text_of = own.text_of()
    pairs = np.unique(np.stack([np.searchsorted(t.hashes, all_hashes), text_of]), axis=1) if len(own) else np.zeros((2, 0), int)
    documents = np.bincount(pairs[0], minlength=len(t.hashes))
    often = np.argsort(-documents, kind="stable")[:how.vocabulary]
    net = Network.new(np.sort(t.hashes[often][documents[often] >= 3]), how)
    rng = np.random.default_rng(how.seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    fits = np.ones(len(texts), bool)
    for c in (0, 1):
        fits[np.flatnonzero(labels == c)[2::3]] = False
    mine = np.flatnonzero(fits[t.text]) if len(t.text) else np.zeros(0, int)
    step = 0
    turn = 0
    while turn < how.rounds or 0 < step < how.least_steps:
        if turn:
            logits = net.window_logits(t)
            order = mine[np.lexsort((-logits[mine], t.text[mine]))]
            n = np.bincount(t.text[order], minlength=len(texts))
            place = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
            chosen = order[place < np.where(labels[t.text[order]] > 0, 1 + (turn < 3), 3)]
        else:
            chosen = mine
        chosen = rng.permutation(chosen)
        for lo in range(0, len(chosen), how.batch):
            at = chosen[lo:lo + how.batch]
            step += 1
            for k, d in net.gradients(t, t.ids[at], labels[t.text[at]]).items():
                m, v = moments[k]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                net.p[k] -= how.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        turn += 1
    found = evidence(net.window_logits(t), t)
    net.document = _logistic(found[~fits], labels[~fits]) if (~fits).any() else np.zeros(found.shape[1])
    return net


def held_out(doc_id, folds: int = 5):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """(id, text, toxic) of a bounded training sample: of each class the ``documents_per_class`` ids that are first by hash and not held out,
    as far as their texts have at most ``longest`` characters; of an id's texts the smallest."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(~held_out(F.col("doc_id")))
    by_hash = [
        marked.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.documents_per_class) for c in (0, 1)
    ]
    texts = docs.select(F.col("doc_id").alias("id"), "text").where(F.length("text") <= how.longest)
    rows = texts.join(F.broadcast(by_hash[0].union(by_hash[1])), F.col("id") == F.col("doc_id"))
    return rows.groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Network | None:
    """A network trained on ``sample``; None without a labelled text of each class.

    One task trains, which the sample's bounds allow, and hands the network to the driver, whose memory the texts never touch.
    The texts are sorted first, so a task that is run again trains the same network.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        if len({toxic for _, _, toxic in rows}) == 2:
            network = train([text for _, text, _ in rows], [toxic for _, _, toxic in rows], how)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], ["network"])

    found = arrays.map_batches(sample(docs, labels, how).repartition(1), run, "network binary").first()
    return pickle.loads(found.network) if found else None


def _scores(network: Network | None, batch: pa.RecordBatch, text_at: int) -> np.ndarray:
    out = np.zeros(batch.num_rows)
    if network is not None:
        for words in arrays.words_of(batch.column(text_at), WORDS):
            out[words.first:words.first + len(words.bounds) - 1] = network.scores(windows(words))
    return out


def scored(docs: DataFrame, network: Network | None) -> DataFrame:
    """The columns of ``docs`` and ``score``, which replaces a column of that name.

    Null and empty texts have no windows and get the score of no evidence; without a network all scores are 0.
    """
    rows = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(network)
    text_at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array(_scores(shared.value, batch, text_at))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "score"])

    return arrays.map_batches(rows, run, StructType([*rows.schema, StructField("score", DoubleType())]))


def clean(docs: DataFrame, network: Network | None, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``limit``."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch, text_at) < limit))

    return arrays.map_batches(docs, run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``, whose ids are longs.

    Rows without doc_id are scored and not held out; a document with several labels counts as toxic if one says so;
    labels without a document, or other than 0 and 1, are ignored; repeated rows stay; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    network = fit(rows, labels, how)
    return scored(rows, network).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
