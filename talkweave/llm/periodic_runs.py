"""Periodic runs of words, by multi-scale minimizers.

A run is a longest stretch of words with smallest period q that holds at least REPEATS periods and LEAST words. Periods up to SHORT
are found by scans at every lag. Beyond, scale K covers the periods in (K/2, K]: all stretches of K words
are hashed, and a stretch is picked where its hash is the minimum of a window of K/2 stretches. Inside a run, windows q apart are
equal, so they pick the same stretches q apart; and as K words or more of a primitive repetition recur at multiples of
the period only, the last pick with the same hash lies exactly q before. REPEATS periods are enough
words for two such windows, so every run has a pair of picks, which is then extended word by word in both directions.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.arrays import SPACES, Words, _powers_to, byte_class, map_batches, mix, normalised, word_hashes, words_of

SHORT = 16
REPEATS = 4
LEAST = 6
_FIRST_STEP, _LONGEST_STEP = 64, 1 << 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


@dataclass
class Found:
    """Runs in the words of a slice: first word, number of words, period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _primitive(ids: np.ndarray, start: np.ndarray, period: int) -> np.ndarray:
    """Whether the ``period`` words at each start are no power of fewer words."""
    out = np.ones(len(start), bool)
    primes = _primes(period)
    for lo in range(0, len(start), 1 + (1 << 20) // period):
        part = start[lo:lo + 1 + (1 << 20) // period]
        words = ids[part[:, None] + np.arange(period)]
        for p in primes:
            out[lo:lo + len(part)] &= (words != np.roll(words, period // p, axis=1)).any(axis=1)
    return out


def _lag_scan(ids: np.ndarray, bounds: np.ndarray, period: int) -> Found:
    """All runs of one period, by comparing every word with the one ``period`` later in its text."""
    same = ids[period:] == ids[:len(ids) - period]
    across = (bounds[1:-1, None] - np.arange(1, period + 1)).ravel()
    same[across[(across >= 0) & (across < len(same))]] = False
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
    start, end = edges[::2], edges[1::2]
    long = end - start >= max(LEAST, REPEATS * period) - period
    start, end = start[long], end[long]
    own = _primitive(ids, start, period)
    start, end = start[own], end[own]
    return Found(start, end - start + period, np.full(len(start), period))


def _sliding(values: np.ndarray, size: int, combine: np.ufunc, fill: np.uint64) -> np.ndarray:
    """``combine`` over every ``size`` consecutive values, from running results of both directions in blocks."""
    n = len(values)
    padded = np.full(-(-n // size) * size, fill)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = combine.accumulate(blocks, axis=1).ravel()
    behind = combine.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return combine(behind[:n - size + 1], ahead[size - 1:n])


def stretch_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words, from running sums."""
    up, down = _powers_to(len(ids) + 1, 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(ids * up[:len(ids)], out=sums[1:], dtype=np.uint64)
        return mix((sums[size:] - sums[:-size]) * down[:len(ids) - size + 1])


def picks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places whose hash is the minimum of some window of ``size`` hashes that holds them, ties included."""
    least = _sliding(hashes, size, np.minimum, _NONE)
    around = np.concatenate([np.zeros(size - 1, np.uint64), least, np.zeros(size - 1, np.uint64)])
    return np.flatnonzero((_sliding(around, size, np.maximum, np.uint64(0)) == hashes) & (hashes != _NONE))


def _seeds(ids: np.ndarray, bounds: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag), in order of lag and place: picks of one scale whose last equal pick in the text is a lag of the scale before."""
    if len(ids) < scale + scale // 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = stretch_hashes(ids, scale)
    across = (bounds[1:-1, None] - np.arange(1, scale)).ravel()
    hashes[across[(across >= 0) & (across < len(hashes))]] = _NONE
    at = picks(hashes, scale // 2)
    order = np.argsort(hashes[at], kind="stable")
    at, value = at[order], hashes[at][order]
    lag = np.diff(at)
    text = np.searchsorted(bounds, at, side="right")
    fit = (value[1:] == value[:-1]) & (text[1:] == text[:-1]) & (lag > scale // 2) & (lag <= scale)
    at, lag = at[:-1][fit], lag[fit]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values agree."""
    n, at, step = min(len(a), len(b)), 0, _FIRST_STEP
    while at < n:
        differ = a[at:min(at + step, n)] != b[at:min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, min(2 * step, _LONGEST_STEP)
    return n


def _scale_runs(ids: np.ndarray, bounds: np.ndarray, scale: int) -> Found:
    """All runs with a period in (scale / 2, scale], extended from pairs of picks; a pair in a stretch already known is skipped."""
    found, known, until = [], 0, 0
    for at, lag in zip(*(x.tolist() for x in _seeds(ids, bounds, scale))):
        if lag == known and at < until:
            continue
        text = int(np.searchsorted(bounds, at, side="right")) - 1
        low, high = int(bounds[text]), int(bounds[text + 1])
        end = at + _matching(ids[at:high - lag], ids[at + lag:high])
        start = at - _matching(ids[low:at][::-1], ids[low + lag:at + lag][::-1])
        known, until = lag, end
        if end - start + lag >= REPEATS * lag and _primitive(ids, np.array([start]), lag)[0]:
            found.append((start, end - start + lag, lag))
    return Found(*np.array(found, np.int64).reshape(-1, 3).T)


def _longer(bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in texts of at least ``least`` words, and the borders of those texts among them."""
    size = np.diff(bounds)
    kept = size >= least
    return np.repeat(kept, size), np.concatenate([[0], np.cumsum(size[kept])])


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> Found:
    """All runs of texts whose words are numbers ``ids`` (uint64) from ``bounds[i]`` to ``bounds[i + 1]``, by start, then period."""
    parts = [_lag_scan(ids, bounds, q) for q in range(1, min(SHORT, int(np.diff(bounds).max(initial=0)) // REPEATS) + 1)]
    place, scale = np.arange(len(ids)), 2 * SHORT
    while len(ids):
        inside, bounds = _longer(bounds, REPEATS * (scale // 2 + 1))
        ids, place = ids[inside], place[inside]
        if len(ids):
            more = _scale_runs(ids, bounds, scale)
            parts.append(Found(place[more.start], more.length, more.period))
        scale *= 2
    start, length, period = (np.concatenate([np.zeros(0, np.int64), *(getattr(p, k) for p in parts)]) for k in ("start", "length", "period"))
    order = np.lexsort((period, start))
    return Found(start[order], length[order], period[order])


def _exact_ids(said: bytes, at: np.ndarray) -> np.ndarray:
    """Numbers that are equal for equal words only."""
    known: dict[bytes, int] = {}
    edges = at.tolist()
    return np.array([known.setdefault(said[a:b], len(known)) for a, b in zip(edges, edges[1:])], np.uint64)


def _runs_of(words: Words, said: bytes, at: np.ndarray) -> Found:
    """Runs by 64-bit word hashes, each confirmed on the words themselves; words are numbered exactly should two hashes collide."""
    found = find_runs(word_hashes(words), words.bounds)
    for s, n, q in zip(found.start, found.length, found.period):
        if said[at[s]:at[s + n - q]] != said[at[s + q]:at[s + n]]:
            return find_runs(_exact_ids(said, at), words.bounds)
    return found


def _collapsed(said: bytes, at: np.ndarray, bounds: np.ndarray, found: Found) -> list[bytes]:
    """Each text's words joined by one space, without those that a run repeats after its first period."""
    change = np.zeros(len(at), np.int64)
    np.add.at(change, found.start + found.period, 1)
    np.add.at(change, found.start + found.length, -1)
    kept = np.cumsum(change)[:-1] == 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]]).view(np.int8)))
    cut = np.unique(np.concatenate([edge, bounds]))
    out, first = [], np.searchsorted(cut, bounds)
    for a, b in zip(first, first[1:]):
        pieces = [said[at[x]:at[y]] for x, y in zip(cut[a:b], cut[a + 1:b + 1]) if kept[x]]
        out.append(b"".join(pieces)[:-1])
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = byte_class(SPACES, lower=False)
    for batch in batches:
        for words in words_of(batch.column(1), table):
            said, at = normalised(words)
            found = _runs_of(words, said, at)
            texts = len(words.bounds) - 1
            within = found.start - words.bounds[np.searchsorted(words.bounds, found.start, side="right") - 1]
            listed = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (within, found.length, found.period)], ["start", "length", "period"])
            offsets = pa.array(np.searchsorted(found.start, words.bounds).astype(np.int32))
            columns = [
                batch.column(0).slice(words.first, texts), pa.array(np.diff(words.bounds), pa.int64()),
                pa.ListArray.from_arrays(offsets, listed), pa.array(_collapsed(said, at, words.bounds, found), pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of each row of ``docs``.

    Words are the stretches between white space, numbered from 0. ``collapsed`` joins by one space the words that no run contains
    after its first period. Null, empty and blank texts have no words, no runs and an empty ``collapsed``; null and repeated ids
    stay, as do repeated rows; other columns are ignored; an empty table gives an empty result. Each task holds a slice of its texts or
    one text, however long; nothing is shuffled.
    """
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), _scan, SCHEMA)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) where every tenth document by the checksum of its id repeats a stretch of its words to its end.

    With checksum h, g = h div 10 and n words, the words from a = g mod n on repeat the first 1 + (n - a) div (3 + g mod 8) of them. Documents
    without words or id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    marked = marked.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    some = F.col("words").isNotNull() & (n > 0)
    cut = marked.withColumn("a", F.when(some, a)).withColumn("p", F.when(some, p))
    head = F.slice("words", F.lit(1), F.col("a"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    copies = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, copies)), F.lit(1), n - F.col("a"))
    return cut.select("doc_id", F.when(some, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """One row per document: number of runs, the longest (ties: smallest start, then period), digests of all runs and of the collapsed text."""
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.withColumn("best", F.array_max(ranked))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
