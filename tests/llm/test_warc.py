import io
import random
import struct
from hashlib import sha256

import pyarrow.parquet as pq
import pytest
import zstandard

from talkweave.llm import queries, warc
from talkweave.staging import materialise, new_path

SAY = "record_id string, record_type string, source_id long, refers_to string, payload_bytes long, payload_digest string, problems array<string>"


def packed(records, dictionary=None, front=b""):
    packer = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    return front + b"".join(packer.compress(r) for r in records)


def response(payload=b"<p>hello</p>", **fields):
    digest = f"sha256:{sha256(payload).hexdigest()}"
    return warc.record("response", "urn:x:1", {"WARC-Payload-Digest": digest, **fields}, warc.http_block(payload, True), "2020-01-01T00:00:00Z")


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    return [response(" ".join(rng.choices(words, k=400)).encode()) for _ in range(60)]


def test_frames_with_a_dictionary_in_front(samples):
    dictionary = warc.train(samples)
    raw = dictionary.as_bytes()
    for content in (raw, zstandard.compress(raw)):
        front = struct.pack("<II", warc.DICTIONARY_FRAME, len(content)) + content
        other = struct.pack("<II", 0x184D2A51, 3) + b"abc"
        data = front + packed(samples[:2], dictionary) + other + packed(samples[2:], dictionary)
        for chunk in (1, 7, 1 << 20) if content is raw else (1 << 20,):
            part = samples if chunk > 1 else samples[:3]
            data_of = data if chunk > 1 else front + packed(part, dictionary)
            assert list(warc.frames(io.BytesIO(data_of), chunk)) == [(s, None) for s in part]
    assert len(packed(samples, dictionary)) < len(packed(samples))
    with_wrong = list(warc.frames(io.BytesIO(packed(samples, dictionary))))
    assert len(with_wrong) == 1 and with_wrong[0][1].startswith("frame: ")


def test_frames_without_a_dictionary(samples):
    assert list(warc.frames(io.BytesIO(packed(samples)))) == [(s, None) for s in samples]
    assert list(warc.frames(io.BytesIO(b""))) == []
    data = packed(samples[:3])
    contents, problems = zip(*warc.frames(io.BytesIO(data[:-5])))
    assert contents[:2] == tuple(samples[:2]) and problems == (None, None, "frame cut short")
    assert [p for _, p in warc.frames(io.BytesIO(packed(samples[:1]) + b"junk and more"))][1].startswith("frame: ")
    flipped = bytearray(packed(samples[:1]))
    flipped[-1] ^= 1
    assert next(warc.frames(io.BytesIO(bytes(flipped))))[1].startswith("frame: ")
    assert list(warc.frames(io.BytesIO(struct.pack("<II", warc.DICTIONARY_FRAME, 99) + b"x")))[0][1].startswith("dictionary: ")


@pytest.mark.parametrize("whole,problems", [
    (response(), []),
    (response().replace(b"WARC/1.1", b"WARC/9"), ["version"]),
    (response()[:-2], ["content-length"]),
    (response() + b"x", ["content-length"]),
    (response().replace(b"hello", b"jello"), ["warc-block-digest", "warc-payload-digest"]),
    (response().replace(b"WARC-Date", b"X-Date"), ["no warc-date"]),
    (response().replace(b"WARC-Date:", b"WARC-Date"), ["malformed header", "no warc-date"]),
    (response(**{"WARC-Payload-Digest": "sha256:" + "0" * 64}), ["warc-payload-digest"]),
    (response(**{"X-Folded": "a"}).replace(b"X-Folded: a", b"X-Folded: a\r\n  b"), []),
    (b"", ["version", *(f"no {n}" for n in warc.REQUIRED)]),
])
def test_records_are_checked(whole, problems):
    assert warc.parse_record(whole)["problems"] == problems


def test_control_characters_stay_in_their_header():
    got = warc.parse_record(response(**{"WARC-Target-URI": "http://x/ a\r\nWARC-Type: evil"}))
    assert (got["record_type"], got["target_uri"], got["problems"]) == ("response", "http://x/%20a%0D%0AWARC-Type:%20evil", [])


def roles(pages):
    """(id, bytes, digest, type, refers to) by the contract's words."""
    first = {}
    for i, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault((html or "").encode(), i)
    seen, out = set(), []
    for i, html in pages:
        data = (html or "").encode()
        again = len(data) >= 100 and (first[data] != i or data in seen)
        if first[data] == i:
            seen.add(data)
        out.append((i, len(data), sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None, True))
    return sorted(out, key=repr)


def test_query(spark, sf):
    pages = [(r["page_id"], r["html"]) for r in pq.read_table(f"{sf}/pages.parquet").to_pylist()]
    assert sorted(map(tuple, queries.op11_warc(spark, sf).collect()), key=repr) == roles(pages)


@pytest.fixture(scope="module")
def messy_pages(spark):
    long = "".join(f"<p>{i} ünïcode</p>" for i in range(200_000))
    rows = [
        (5, "http://a/", "x" * 100), (3, "http://b/", "x" * 100), (9, None, "x" * 100), (3, "http://b/", "x" * 100), (None, "http://c/", "x" * 100),
        (1, "u", "y" * 99), (2, "u", "y" * 99), (4, "a b\r\nc", None), (6, None, ""), (7, "u", long), (8, "u", long), (None, None, None),
        (-10, "u", "\x00\r\n\r\nWARC/1.1 " + "z" * 100),
    ]
    return spark.createDataFrame([(*r, "c", None) for r in rows], "page_id long, url string, html string, payload string, digest string").repartition(3)


def test_messy_pages(spark, messy_pages):
    got = sorted(map(tuple, warc.report(warc.round_trip(messy_pages)).collect()), key=repr)
    assert got == roles([(r.page_id, r.html) for r in messy_pages.collect()])
    assert warc.report(warc.round_trip(messy_pages.limit(0))).collect() == []


def test_archives_hold_whole_payloads(spark, messy_pages):
    folder = new_path(spark, "warc-test")
    archives = warc.write_archives(messy_pages, folder, archive_bytes=300)
    made = archives.collect()
    assert len(made) > 3 and sum(a.records for a in made) == 13
    listed = warc.archives_in(spark, folder)
    assert {r.path.split("/")[-1] for r in listed.collect()} == {a.path.split("/")[-1] for a in made}
    rows = warc.read_archives(listed).collect()
    assert all(r.problems == [] for r in rows) and sum(r.record_type == "warcinfo" for r in rows) == len(made)
    want = {sha256((r.html or "").encode()).hexdigest() for r in messy_pages.collect()}
    assert {r.payload_digest for r in rows if r.record_type == "response"} == want
    assert all(sha256(r.payload).hexdigest() == r.payload_digest for r in rows if r.record_type == "response")
    assert {r.target_uri for r in rows if r.source_id == 4} == {"a%20b%0D%0Ac"}


def test_what_a_lost_task_leaves_does_not_count(spark, messy_pages):
    folder = new_path(spark, "warc-test")
    archives = warc.write_archives(messy_pages, folder)
    left = warc.write_archives(messy_pages, folder).first().path
    assert warc.archives_in(spark, folder).count() > archives.count()
    assert left not in {a.path for a in archives.collect()}
    assert warc.resolve(materialise(warc.read_archives(archives), "records")).count() == 13


def test_revisits_need_their_response(spark):
    rows = [
        ("a", "response", 1, None, 5, "d", []), ("b", "revisit", 2, "a", 5, "d", []), ("c", "revisit", 3, "gone", 5, "d", []),
        ("e", "revisit", 4, "a", 6, "d", []), ("f", "response", 5, None, 5, "d", ["version"]), ("g", "revisit", 6, "f", 5, "d", []),
        ("h", "response", 7, None, 5, "d", []), ("h", "response", 8, None, 5, "d", []), ("i", "revisit", 9, "h", 5, "d", []),
    ]
    got = warc.resolve(spark.createDataFrame(rows, SAY)).collect()
    assert {(r.source_id, r.source, r.valid) for r in got} == {
        (1, None, True), (2, 1, True), (3, None, False), (4, 1, False), (5, None, False), (6, 5, False), (7, None, True), (8, None, True), (9, 7, False),
    }
