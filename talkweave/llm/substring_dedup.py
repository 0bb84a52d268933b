"""Duplicate word spans by relative Lempel-Ziv factors of ``size`` words or more.

Every document is a reference for all later ones (by doc_id, then by row) and, before a word, for itself. References are indexed as
blocks, the chunks of :mod:`talkweave.llm.chunks`: the index gives the first place, document and word, at which a window of ``size`` words stands.
A document is factored greedily, left to right. A factor begins at a window that also starts earlier and goes on while the
first places of the following windows follow each other, so it stands as one run in its source. The next factor begins at the last repeated window that
covers the word at the factor's border or, where none does, at the next repeated window; words in no factor are literals and stay.

A factor is as long as the first places allow; where one text has several earlier copies, another choice of source could be longer, which changes
the number of factors and no removed word. Windows are equal if 128 bits of hash are, as texts are never brought side by side.

Two questions find the places without shuffling all windows. Each window has an anchor, its smallest run of
ANCHOR words by hash, which equal windows share. The first question asks which anchors occur more than once;
only windows with such an anchor can repeat, and the second question asks for the first place of
each of these.
"""

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkweave.llm import arrays, chunks
from talkweave.staging import materialise

WORDS = arrays.byte_class(arrays.SPACES, lower=False)


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``n`` neighbours."""
    out, have = x, 1
    while have * 2 <= n:
        out, have = best(out[:-have], out[have:]), have * 2
    return out if have == n else best(out[:len(out) - (n - have)], out[n - have:])


def anchors(words: arrays.Words, hashes: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of the windows that lie in one text, and each one's smallest hash of ``anchor`` words."""
    starts = arrays.whole_windows(words, size)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    least = _slide(arrays.window_hashes(hashes, anchor), size - anchor + 1, np.minimum)
    return starts, least[starts]


def anchor_places(words: arrays.Words, hashes: np.ndarray, size: int, anchor: int) -> np.ndarray:
    """The hash at each place that is the anchor of some window: places, not windows, so a hash repeats if it stands twice."""
    starts, least = anchors(words, hashes, size, anchor)
    if not len(starts):
        return least
    runs, width = arrays.window_hashes(hashes, anchor), size - anchor + 1
    by_start = np.zeros(len(runs) + width - 1, np.uint64)
    by_start[starts + width - 1] = least
    largest = _slide(by_start, width, np.maximum)
    return runs[(runs == largest) & (largest > 0)]


class _Parts:
    """The windows of a chunk, slice by slice."""

    def __init__(self, chunk: chunks.Chunk, size: int, anchor: int):
        self.chunk, self.size, self.anchor = chunk, size, anchor

    def __iter__(self):
        for words in arrays.words_of(self.chunk.texts, WORDS):
            hashes = arrays.word_hashes(words)
            yield words, hashes


def _distinct_anchors(parts: _Parts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors, and whether each stands at more than one place of the chunk."""
    found = [anchor_places(words, hashes, parts.size, parts.anchor) for words, hashes in parts]
    keys, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
    return keys, count > 1


def _repeated(parts: _Parts, answers: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    keys, many = _distinct_anchors(parts)
    said = np.frombuffer(b"".join(answers or []), np.uint8).astype(bool)
    return keys, said if len(said) else many


def _candidates(parts: _Parts, answers: list[bytes] | None):
    """Windows with a repeated anchor: their two hashes, text and start, each text's words counted from 0."""
    keys, repeated = _repeated(parts, answers)
    out = [[np.zeros(0, k)] for k in (np.uint64, np.uint64, np.int64, np.int64)]
    for words, hashes in parts:
        starts, least = anchors(words, hashes, parts.size, parts.anchor)
        if not len(starts):
            continue
        at = starts[repeated[np.searchsorted(keys, least)]]
        if not len(at):
            continue
        text = np.searchsorted(words.bounds, at, side="right") - 1
        out[0].append(arrays.window_hashes(hashes, parts.size)[at])
        out[1].append(arrays.window_hashes(arrays.word_hashes(words, 1), parts.size, 1)[at])
        out[2].append(text + words.first)
        out[3].append(at - words.bounds[text])
    return [np.concatenate(x) for x in out]


class _Sorted:
    """Candidates of a chunk by hash; the first of each run of equal ones is the earliest in the chunk, whose place is ``places``."""

    def __init__(self, parts: _Parts, answers: list[bytes] | None):
        chunk = parts.chunk
        a, b, text, start = _candidates(parts, answers)
        order = np.lexsort((start, chunk.rank[text] if len(text) else text, b, a))
        a, b, self.text, self.start = a[order], b[order], text[order], start[order]
        self.first = np.ones(len(a), bool)
        self.first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.keys, self.more = a[self.first], b[self.first]
        text, start = self.text[self.first], self.start[self.first]
        ids = chunk.ids[text] if len(a) else text
        self.places = np.stack([ids, np.full(len(ids), chunk.chunk, np.int64), text, start])

    def sources(self, elsewhere: np.ndarray) -> np.ndarray:
        """For each candidate, the place where its window starts first; the chunk is NO_SOURCE if that is the candidate's own."""
        group = np.cumsum(self.first) - 1
        out = np.where(elsewhere[1] != NO_SOURCE, elsewhere, self.places)[:, group]
        out[1, self.first & (elsewhere[1, group] == NO_SOURCE)] = NO_SOURCE
        return out


def _reply_repeated(_, keys: list[np.ndarray], mores: list[bytes]) -> list[bytes]:
    every = np.concatenate(keys)
    many = np.concatenate([np.frombuffer(m, np.uint8) for m in mores])
    distinct, place, count = np.unique(every, return_inverse=True, return_counts=True)
    repeated = count > 1
    repeated[place[many > 0]] = True
    said = repeated[place].astype(np.uint8)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [part.tobytes() for part in np.split(said, cuts)]


def _reply_first(numbers: list[int], keys: list[np.ndarray], mores: list[bytes]) -> list[bytes]:
    """For each window, its first place if that is in another chunk, else NO_SOURCE for the chunk."""
    second, places = [], []
    for k, m in zip(keys, mores):
        n = len(k) * 8
        second.append(np.frombuffer(m[:n], np.uint64))
        places.append(chunks.unpack(m[n:], np.int64).reshape(len(PLACE), -1))
    a, b, places = np.concatenate(keys), np.concatenate(second), np.concatenate(places, axis=1)
    order = np.lexsort((places[1], places[0], b, a))
    first = np.ones(len(a), bool)
    first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    leader = np.empty(len(a), np.int64)
    leader[order] = order[np.flatnonzero(first)][np.cumsum(first) - 1]
    found = places[:, leader]
    found[1, leader == np.arange(len(a))] = NO_SOURCE
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [chunks.pack(part) for part in np.split(found, cuts, axis=1)]


#: A place in the corpus: document, chunk, text of the chunk, word of the text.
PLACE = ("doc_id", "chunk", "text", "start")
NO_SOURCE = np.iinfo(np.int64).min
SPANS = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64()), ("source", pa.int64()), ("at", pa.int64())]))
OUT_SCHEMA = (
    "doc_id long, n_words long, n_removed long, spans array<struct<first:long,n:long,source:long,at:long>>, kept string"
)


def _factors(starts: np.ndarray, places: np.ndarray, size: int) -> list[dict]:
    """Greedy factors of a text from its repeated windows, sorted by start, and the first place of each."""
    breaks = np.ones(len(starts), bool)
    moved = (starts[1:] != starts[:-1] + 1) | (places[3, 1:] != places[3, :-1] + 1)
    breaks[1:] = moved | (places[1, 1:] != places[1, :-1]) | (places[2, 1:] != places[2, :-1])
    ends, begin = [*np.flatnonzero(breaks)[1:].tolist(), len(starts)], starts.tolist()
    out, i = [], 0
    while i < len(begin):
        last = ends[bisect_right(ends, i)] - 1
        border = begin[last] + size
        source = int(places[0, i])
        out.append({
            "first": begin[i], "n": border - begin[i], "source": None if source == chunks.NO_ID else source, "at": int(places[3, i]),
        })
        # The last window over the border, if one begins after this factor's last; else the next one.
        i = max(last + 1, bisect_right(begin, border) - 1)
    return out


def remove_duplicates(docs: DataFrame, size: int = 20, anchor: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, spans and ``kept``, the words left joined by a space.

    A word is removed if a window of ``size`` words that covers it also starts earlier: in a smaller doc_id, in an
    earlier row of the same doc_id, or earlier in the text. Windows are judged on the input. ``spans`` are factors (first word, number of words,
    doc_id of the source, its first word there); they cover the removed words and may overlap at borders. Null and empty texts have no words; rows with a null doc_id come last; of repeated rows the first stays;
    texts shorter than a window stay whole; an empty table gives an empty result; other columns are ignored.
    """
    if not 0 < anchor <= size:
        raise ValueError("anchor must be between 1 and size")
    spark = docs.sparkSession
    stored = chunks.store(docs)
    total = stored.selectExpr("coalesce(sum(n_bytes), 0) AS n").first().n

    def first_question(chunk: chunks.Chunk, _):
        keys, many = _distinct_anchors(_Parts(chunk, size, anchor))
        return keys, lambda lo, hi: many[lo:hi].astype(np.uint8).tobytes()

    def second_question(chunk: chunks.Chunk, answers):
        found = _Sorted(_Parts(chunk, size, anchor), answers)
        return found.keys, lambda lo, hi: found.more[lo:hi].tobytes() + chunks.pack(found.places[:, lo:hi])

    anchored = chunks.answer(chunks.ask(stored, first_question, chunks.buckets_for(total // 30, spark)), _reply_repeated)
    anchored = materialise(anchored, "anchors")
    asked = chunks.ask(chunks.answered(stored, anchored), second_question, chunks.buckets_for(total // 15, spark))
    sourced = materialise(chunks.answer(asked, _reply_first), "sources").withColumnRenamed("answer", "source")
    listed = sourced.selectExpr("chunk", "bucket", "source AS answer")
    both = chunks.answered(chunks.answered(stored, anchored).withColumnRenamed("answers", "repeated"), listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunks.rows_of(batches):
            yield from _kept(_Parts(chunks.Chunk(row["chunk"], row), size, anchor), row["repeated"], row["answers"], size)

    return arrays.map_batches(both, run, OUT_SCHEMA)


def _kept(parts: _Parts, repeated: list[bytes] | None, answers: list[bytes] | None, size: int) -> Iterator[pa.RecordBatch]:
    found = _Sorted(parts, repeated)
    ids = parts.chunk.ids
    told = [chunks.unpack(a, np.int64).reshape(len(PLACE), -1) for a in answers or []]
    source = found.sources(np.concatenate([np.zeros((len(PLACE), 0), np.int64), *told], axis=1))
    again = np.flatnonzero(source[1] != NO_SOURCE)
    again = again[np.lexsort((found.start[again], found.text[again]))]
    text, start, source = found.text[again], found.start[again], source[:, again]
    for words in arrays.words_of(parts.chunk.texts, WORDS):
        n = len(words.bounds) - 1
        cuts = np.searchsorted(text, np.arange(words.first, words.first + n + 1))
        spans = [[] for _ in range(n)]
        cover = np.zeros(len(words) + 1, np.int64)
        for i in np.flatnonzero(np.diff(cuts)):
            spans[i] = _factors(start[cuts[i]:cuts[i + 1]], source[:, cuts[i]:cuts[i + 1]], size)
            at = np.array([f["first"] for f in spans[i]]) + words.bounds[i]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + np.array([f["n"] for f in spans[i]]), -1)
        keep = np.cumsum(cover[:-1]) == 0
        kept_before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(keep, out=kept_before[1:])
        bounds = kept_before[words.bounds]
        left = arrays.Words(words.first, words.data, words.start[keep], words.end[keep], bounds)
        joined, places = arrays.normalised(left)
        kept = [joined[places[a]:max(places[a], places[b] - 1)] for a, b in zip(bounds[:-1], bounds[1:])]
        own = ids[words.first:words.first + n]
        n_words = np.diff(words.bounds)
        yield pa.RecordBatch.from_arrays([
            pa.array(own, mask=own == chunks.NO_ID), pa.array(n_words), pa.array(n_words - np.diff(bounds)),
            pa.array(spans, SPANS), pa.array(kept, pa.binary()).cast(pa.string()),
        ], ["doc_id", "n_words", "n_removed", "spans", "kept"])
