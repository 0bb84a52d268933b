import base64
import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from talkweave.llm import byte_bpe, queries

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(PATH, public.PATTERN)


def test_query_equals_brute_force(spark, sf, documents, reference):
    rows = {r.doc_id: r for r in queries.op10_byte_bpe(spark, sf).collect()}
    for d in documents:
        ids = reference.encode_ordinary(d["text"])
        r = rows[d["doc_id"]]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d["text"].encode()).hexdigest()


def test_random_texts(codec, reference):
    random.seed(3)
    odd = "aábc  \n\t\r'sStT123१２  　\x85\x1c\x1d\x1f​ ﻿é日本😀.,!?×÷;:" + "".join(map(chr, range(0x100, 0x180)))
    texts = ["".join(random.choice(odd) for _ in range(random.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(random.choice(["'s", "'re", " ", "  ", "\n", "the", "ing", "aaaa", "....", ", ", "日本語"]) for _ in range(30)) for _ in range(2000)]
    for text, packed in zip(texts, codec.encode_all(texts)):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert codec.decode_bytes(ids) == text.encode()
        assert codec.decode(ids) == text


def test_offsets_and_split_characters(codec):
    text = "The naïve 😀 of 日本語, it's!"
    ids, spans = codec.encode_offsets(text)
    assert ids == np.frombuffer(codec.encode_all([text])[0], "<u4").tolist()
    covered = set()
    for i, (a, b) in zip(ids, spans):
        piece = codec.pieces[i]
        assert piece in text[a:b].encode() and a < b
        covered.update(range(a, b))
    assert covered == set(range(len(text)))
    emoji = np.frombuffer(codec.encode_all(["😀"])[0], "<u4").tolist()
    if len(emoji) > 1:
        assert "�" in codec.decode(emoji[:1])
    with pytest.raises(KeyError):
        codec.decode_bytes([10**7])


def test_messy(spark, messy, nothing):
    for options in ({}, {"packed": True}, {"offsets": True}):
        assert byte_bpe.encode(nothing, PATH, public.PATTERN, **options).collect() == []
    coded = byte_bpe.encode(messy, PATH, public.PATTERN)
    assert coded.columns == [c for c in messy.columns if c != "ids"] + ["ids"]
    decoded = byte_bpe.decode(coded, PATH, public.PATTERN).select("text", "ids", "decoded", "Key").collect()
    assert len(decoded) == messy.count()
    for r in decoded:
        assert bytes(r.decoded).decode() == (r.text or "") and r.Key == "c"
        assert r.text or r.ids == []


def test_words_are_encoded_together_and_frequent_ones_once(codec, reference, monkeypatch):
    given = []

    class Counted:
        def __init__(self, model):
            self.__dict__["inner"] = Tokenizer(model)

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def __setattr__(self, name, value):
            setattr(self.inner, name, value)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

    monkeypatch.setattr(byte_bpe, "Tokenizer", Counted)
    monkeypatch.setattr(byte_bpe, "KEPT_SEGMENTS", 100)
    random.seed(4)
    own = byte_bpe.Codec(codec.ranks, public.PATTERN)
    for _ in range(8):
        new = ["".join(random.choices("aeioklmé", k=12)) for _ in range(80)]
        text = "oft " + " ".join(f"often {w}" for w in new)
        assert np.frombuffer(own.encode_all([text])[0], "<u4").tolist() == reference.encode_ordinary(text)
    assert sum(t.replace("Ġ", " ").split("Ċ").count(" often") for t in given) == 1
    assert len(given) < 100
    assert len(own.kept) + len(own.older) < 300


def test_lines_of_words(codec, reference):
    random.seed(5)
    words = ["the", "naïve", "Straße", "it's", "'s", "x's", "a.b,c", "end.", "end...", "50%", "(odd)", "-", "'", "日本", "é!", "$$$", "ª", "_", "x" * 70, "é" * 70, "x" * 70 + ","]
    texts = ["".join(random.choice(words) + random.choice(gaps) for _ in range(random.randint(0, 40))) + "end"
             for gaps in ([" "], [" ", "\n"], [" ", " ", "\n", "\n\n", "\r", "\r\n", "\x1c", "\xa0", "  "]) for _ in range(400)]
    texts += ["", " ", "\n", "\r", "a\rb", "a \n b", "a\n", "\na", " a"]
    packed = codec.encode_all(texts)
    for text, ids in zip(texts, packed):
        assert "".join(codec.segments(text)) == text
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert codec.decode_all(packed).to_pylist() == [t.encode() for t in texts]
    assert codec.decode_all([]).to_pylist() == [] and codec.decode_all([b"", b""]).to_pylist() == [b"", b""]


def test_unknown_ids_and_gaps_raise(codec):
    gap = byte_bpe.Codec({t: i for t, i in codec.ranks.items() if i != 300}, public.PATTERN)
    for own, ids in ((codec, [5, 10**7]), (codec, [2**32 - 1]), (gap, [5, 300])):
        with pytest.raises(KeyError):
            own.decode_all([b"", np.array(ids, "<u4").tobytes()])


def test_vocabulary_without_line_break(codec):
    own = byte_bpe.Codec({t: i for t, i in codec.ranks.items() if t != b"\n"}, public.PATTERN)
    assert own.encode_all(["some words, and more"]) == codec.encode_all(["some words, and more"])


def test_other_patterns(codec):
    camel = r"""[^\r\n\p{L}\p{N}]?\p{Lu}*\p{Ll}+|[^\r\n\p{L}\p{N}]?\p{Lu}+\p{Ll}*|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"""
    own = byte_bpe.Codec(codec.ranks, camel)
    known = tiktoken.Encoding("camel", pat_str=camel, mergeable_ranks=codec.ranks, special_tokens={})
    texts = ["someWords inCamelCase, and BIGWords", "a line!\nand (another)\nend.", "wordsTogether"]
    assert [np.frombuffer(i, "<u4").tolist() for i in own.encode_all(texts)] == [known.encode_ordinary(t) for t in texts]
    assert byte_bpe.WORD_PATTERN == public.PATTERN
