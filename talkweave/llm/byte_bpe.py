"""Byte-level BPE with the tokenizers library: encoding with offsets, and decoding.

A vocabulary file of base64 byte strings and ranks becomes a BPE model: each byte is written as one
printable character, and every way of building a token from two others is a merge, in order of the token's rank.
Texts are cut before single spaces between two characters that are not white space, and between a letter and a
full stop, comma or the like, where the pattern always ends a match, so equal segments are encoded once while a worker keeps them
and a long text never becomes one large Encoding. Under WORD_PATTERN line breaks and more punctuation are cut too, and plain
words, each one match, go to the model by themselves, many in one call; all other segments go through the pattern.
"""

import base64
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from talkweave.llm.arrays import map_batches

#: Segments that a worker keeps; the memory of its cache is bounded by this number.
KEPT_SEGMENTS = 200_000
LONGEST_KEPT = 64
#: Plain words in one call of the model.
WORDS_AT_ONCE = 500
#: The pattern under which a run of letters, with the space before it, is one match, and a line break between words another.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Python's white space holds all of the pattern's, so these cuts are safe for either. After a letter, punctuation
# other than an apostrophe begins a match of its own.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_CUT = re.compile(rf"(?<=\S)(?= \S)|(?<={_LETTER})(?=[.,;:!?])")
_MARK = re.compile(rf"[!-&(-/:-@\[-`{{-~](?<={_LETTER}.)")
_WORD = re.compile(rf" ?{_LETTER}+")


def byte_characters() -> dict[int, str]:
    """Byte -> character: printable Latin-1 stands for itself, the others for code points from 256."""
    shown = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    hidden = [b for b in range(256) if b not in shown]
    return shown | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        chars = byte_characters()
        back = {c: b for b, c in chars.items()}
        self.ranks, self.pattern = ranks, pattern
        self.spelled = {t: "".join(chars[b] for b in t) for t in ranks}
        self.pieces = {i: bytes(back[c] for c in self.spelled[t]) for t, i in ranks.items()}
        self.by_words = pattern == WORD_PATTERN and b"\n" in ranks
        self.shown = np.array([ord(chars[b]) for b in range(256)], "<u2")
        # Segments move from ``older`` to ``kept`` when they are met again; what is not met in time is forgotten.
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The model, made when something is encoded: workers that only decode do without."""
        ranks, spelled = self.ranks, self.spelled
        merges = [
            (spelled[t[:k]], spelled[t[k:]])
            for t in sorted(ranks, key=ranks.get)
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        model = models.BPE(vocab={spelled[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)
        made = Tokenizer(model)
        made.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(self.pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False, trim_offsets=False),
        ])
        return made

    @cached_property
    def word_tokenizer(self) -> Tokenizer:
        """The same model for words already written in its characters, one a line."""
        made = Tokenizer(self.tokenizer.model)
        made.pre_tokenizer = pre_tokenizers.Split(self.spelled[b"\n"], "isolated")
        return made

    @cached_property
    def piece_column(self) -> pa.Array:
        """The piece of each id, null where the vocabulary has none."""
        return pa.array([self.pieces.get(i) for i in range(max(self.pieces, default=-1) + 1)], pa.large_binary())

    def segments(self, text: str) -> list[str]:
        if self.by_words:
            flat = text.replace("\n", " ")
            if " ".join(flat.split()) == flat:
                # All white space is single and between words.
                return _MARK.sub(r"\r\g<0>", text.replace(" ", "\r ").replace("\n", "\r\n\r")).split("\r")
        return _CUT.split(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.segments(t) for t in texts]
        if len(self.kept) > KEPT_SEGMENTS // 2:
            self.older, self.kept = self.kept, {}
        known = self.kept
        own = self._learn(set().union(*cut))
        if own:
            return [b"".join([known[s] if s in known else own[s] for s in parts]) for parts in cut]
        return [b"".join(map(known.__getitem__, parts)) for parts in cut]

    def _learn(self, segments: set[str]) -> dict[str, bytes]:
        """Keeps the ids of all segments; returns those of segments too long to be kept."""
        new = segments.difference(self.kept)
        again = new.intersection(self.older)
        self.kept.update(zip(again, map(self.older.__getitem__, again)))
        new -= again
        plain = list(filter(_WORD.fullmatch, new)) if self.by_words else []
        other = list(new.difference(plain))
        found: dict[str, bytes] = {}
        for lo in range(0, len(plain), WORDS_AT_ONCE):
            part = plain[lo:lo + WORDS_AT_ONCE]
            found.update(zip(part, self._encode_words(part), strict=True))
        for lo in range(0, len(other), 5000):
            part = other[lo:lo + 5000]
            for s, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                found[s] = np.array(e.ids, "<u4").tobytes()
        own = {s: found.pop(s) for s in [s for s in found if len(s) > LONGEST_KEPT]}
        self.kept.update(found)
        return own

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one match each; the id of a line break, which no word holds, parts them."""
        spelled = self.shown[np.frombuffer("\n".join(words).encode(), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.word_tokenizer.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
        breaks = np.flatnonzero(ids == self.ranks[b"\n"])
        packed, starts, ends = ids.tobytes(), [0, *(4 * breaks + 4).tolist()], [*(4 * breaks).tolist(), 4 * len(ids)]
        return [packed[a:b] for a, b in zip(starts, ends)]

    def encode_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and the characters each one covers; ids that split a character cover all of it."""
        ids, spans, at = [], [], 0
        parts = self.segments(text)
        for segment, e in zip(parts, self.tokenizer.encode_batch(parts, add_special_tokens=False)):
            ids += e.ids
            spans += [(a + at, b + at) for a, b in e.offsets]
            at += len(segment)
        return ids, spans

    def decode_bytes(self, ids) -> bytes:
        """The exact bytes; an id outside the vocabulary raises KeyError."""
        return b"".join(map(self.pieces.__getitem__, ids))

    def decode_all(self, packed: list[bytes]) -> pa.Array:
        """The exact bytes of each text's packed ids, as a binary column; an id outside the vocabulary raises KeyError."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        if len(ids) and ids.max() >= len(self.piece_column):
            raise KeyError(int(ids.max()))
        taken = self.piece_column.take(pa.array(ids))
        if taken.null_count:
            raise KeyError(int(ids[taken.is_null().to_numpy(zero_copy_only=False)][0]))
        bounds = np.cumsum([0, *[len(p) // 4 for p in packed]])
        at = np.frombuffer(taken.buffers()[1], np.int64)[bounds] if len(ids) else bounds
        whole = pa.Array.from_buffers(pa.large_binary(), len(packed), [None, pa.py_buffer(at), taken.buffers()[2] or pa.py_buffer(b"")])
        return whole.cast(pa.binary())

    def decode(self, ids) -> str:
        """The text; characters that the ids begin or end in the middle of become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(read_ranks(file.read()), pattern)


def _vocabulary(df: DataFrame, path: str):
    """A function that finds the vocabulary on a worker, to which Spark sends the driver's file."""
    context = df.sparkSession.sparkContext
    context.addFile(path)
    name = path.rsplit("/", 1)[-1]
    return lambda: SparkFiles.get(name)


def encode(
    df: DataFrame, path: str, pattern: str, text_col: str = "text",
    offsets: bool = False, packed: bool = False, decoded: bool = False,
) -> DataFrame:
    """The columns of ``df`` and ``ids``: array<int>, or with ``packed`` little-endian unsigned 32-bit integers as binary.

    With ``decoded`` also ``decoded``, the bytes that the ids decode to, in the same pass. With ``offsets`` also ``starts`` and ``ends`` (array<int>, code points, end exclusive). Null texts count as empty and
    give no ids; repeated rows are kept; an empty table gives an empty result; a column named
    like a new one is replaced. Text that spells a special token is ordinary text.
    """
    new = ["ids", *["starts", "ends"] * offsets, *["decoded"] * decoded]
    df = df.drop(*new)
    find = _vocabulary(df, path)

    def as_column(ids: list[bytes]) -> pa.Array:
        if packed:
            return pa.array(ids, pa.binary())
        at = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(i) // 4 for i in ids], out=at[1:])
        return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(ids), "<i4")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(find(), pattern)
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
                if offsets:
                    found = [own.encode_offsets(t) for t in texts]
                    ids = [np.array(i, "<u4").tobytes() for i, _ in found]
                else:
                    ids = own.encode_all(texts)
                extra = [as_column(ids)]
                if offsets:
                    extra += [pa.array([[s[k] for s in spans] for _, spans in found], pa.list_(pa.int32())) for k in (0, 1)]
                if decoded:
                    extra.append(own.decode_all(ids))
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *new])

    number = ArrayType(IntegerType())
    kinds = [BinaryType() if packed else number, *[number] * (2 * offsets), *[BinaryType()] * decoded]
    return map_batches(df, run, StructType([*df.schema, *map(StructField, new, kinds)]))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The columns of ``df`` and ``decoded`` (binary): the bytes behind ``ids_col``, packed or an array. Null ids give null; a column
    of that name is replaced; an id outside the vocabulary fails the task.

    ``decoded.cast("string")`` is the text where the ids cover whole characters.
    """
    df = df.drop("decoded")
    find = _vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(find(), pattern)
        for batch in batches:
            out = []
            for ids in batch.column(batch.schema.get_field_index(ids_col)):
                value = ids.as_py()
                listed = np.frombuffer(value, "<u4").tolist() if isinstance(value, bytes) else value
                out.append(None if value is None else own.decode_bytes(listed))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return map_batches(df, run, StructType([*df.schema, StructField("decoded", BinaryType())]))


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of packed ``ids`` and ``decoded``."""
    return df.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
