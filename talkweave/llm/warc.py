"""Web archives as WARC files in Zstandard: one frame per record, the dictionary in a skippable frame at the front.

The writer streams the rows of a partition into archives of a bounded size, each with a dictionary trained on its own first
records, and gives a table of the archives it finished; only those are read, so what a lost task left behind never counts.
The reader takes the dictionary from the leading skippable frame, decodes one frame per record and checks the frame, the
headers, the lengths and the digests of each; a faulty record is a row that names its problems.
"""

import re
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import partial
from hashlib import sha256
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.arrays import map_batches
from talkweave.staging import materialise, new_path

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: Payloads of fewer bytes are stored each time they occur.
LEAST_REVISIT = 100
#: Compressed bytes after which a new archive begins.
ARCHIVE_BYTES = 256 << 20
#: Bytes of the first records of an archive that its dictionary is trained on, and its largest size.
SAMPLE_BYTES, DICTIONARY_BYTES = 4 << 20, 110 << 10
SUFFIX = ".warc.zst"

ARCHIVES = "path string, records long, bytes long"
RECORDS = (
    "path string, place long, record_id string, record_type string, source_id long, target_uri string, refers_to string,"
    " payload_bytes long, payload_digest string, payload binary, problems array<string>"
)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system behind a path or address (file, hdfs, s3, gs), and the path in it."""
    local = re.fullmatch(r"file:/*(/.*)", path)
    return fs.FileSystem.from_uri(local[1] if local else path)


# Records

def _field(name: str, value: str) -> str:
    """A header line; control characters of the value are percent-encoded, so it stays one line."""
    return f"{name}: {re.sub(r'[\x00-\x20\x7f]', lambda c: f'%{ord(c[0]):02X}', value)}\r\n"


def record(kind: str, record_id: str, fields: dict[str, str | None], block: bytes, date: str) -> bytes:
    """A whole record: headers, block, two line ends."""
    named = {
        "WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, **fields,
        "WARC-Block-Digest": f"sha256:{sha256(block).hexdigest()}", "Content-Length": str(len(block)),
    }
    lines = "".join(_field(k, v) for k, v in named.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def http_block(payload: bytes, body: bool) -> bytes:
    """A response's status and headers, which state the payload's length, and its body if it is stored."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + (payload if body else b"")


def page_record(row: dict, date: str) -> bytes:
    """The record of one row of ``with_roles``."""
    payload = row["payload"]
    revisit = row["refers_to"] is not None
    return record("revisit" if revisit else "response", row["record_id"], {
        "WARC-Target-URI": row["uri"],
        "WARC-Source-ID": None if row["source_id"] is None else str(row["source_id"]),
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": f"<{row['refers_to']}>" if revisit else None,
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "Content-Type": "application/http;msgtype=response",
    }, http_block(payload, not revisit), date)


# Writing

def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of up to a tenth of the samples' bytes; None where they are too few to train one."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    if len(samples) < 8 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


class Archive:
    """One archive on its way out: dictionary, a warcinfo record, then a frame per record."""

    def __init__(self, path: str, samples: list[bytes], date: str):
        store, inside = open_store(path)
        store.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        self.path, self.out, self.records, self.bytes = path, store.open_output_stream(inside, compression=None), 0, 0
        dictionary = train(samples)
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        if dictionary:
            self._put(dictionary_frame(dictionary))
        about = b"format: WARC File Format 1.1\r\n"
        self.add(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", {"Content-Type": "application/warc-fields"}, about, date))
        self.records = 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, whole: bytes) -> None:
        self._put(self.packer.compress(whole))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Archives of one task; their names hold the attempt, so two attempts never share one."""
    task = TaskContext.get()
    name = f"{folder}/{task.partitionId():06d}-{uuid.uuid4().hex[:12]}"
    done, archive, first, held = [], None, [], 0

    def begin() -> Archive:
        started = Archive(f"{name}-{len(done):05d}{SUFFIX}", first, date)
        for whole in first:
            started.add(whole)
        return started

    for row in _rows(batches):
        whole = page_record(row, date)
        if archive is None:
            first.append(whole)
            held += len(whole)
            if held >= SAMPLE_BYTES:
                archive, first, held = begin(), [], 0
        else:
            archive.add(whole)
        if archive and archive.bytes >= limit:
            done.append(archive.close())
            archive = None
    if first:
        archive = begin()
    if archive:
        done.append(archive.close())
    yield pa.RecordBatch.from_arrays(
        [pa.array([d[k] for d in done], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"]
    )


def with_roles(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, least: int = LEAST_REVISIT) -> DataFrame:
    """source_id, uri, payload, digest, record_id, refers_to (null for responses) of each row, stored.

    Of rows with equal payloads of ``least`` bytes or more, the one with the smallest id is a response (null ids last, then any one); the rest
    name its record. Payloads are shuffled only where those that repeat are too many to be broadcast, which Spark decides by the
    stored size of their digests.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("source_id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    row = F.monotonically_increasing_id()
    rows = materialise(rows.withColumns({"digest": F.sha2("payload", 256), "row": row}), "pages")
    place = F.struct(F.col("source_id").isNull().alias("last"), "source_id", "row")
    found = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    repeated = materialise(found.where("n > 1").select("digest", F.col("first.row").alias("first_row")), "repeated")
    name = lambda c, own=uuid.uuid4(): F.concat(F.lit(f"urn:record:{own}:"), c.cast("string"))
    return rows.join(repeated, "digest", "left").select(
        "source_id", "uri", "payload", "digest", name(F.col("row")).alias("record_id"),
        F.when(F.col("first_row") != F.col("row"), name(F.col("first_row"))).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
    least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row of ``pages`` to archives in ``folder``; gives a stored table (path, records, bytes) of them.

    A null payload counts as empty, a null id or address is left out of the record, repeated rows are records of their own, other columns are ignored;
    an empty table gives no archives. ``folder`` is one that every executor reaches (a shared mount, hdfs, s3 or gs).
    """
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    write = partial(_write, folder=folder, date=date, limit=archive_bytes)
    return materialise(map_batches(with_roles(pages, id_col, uri_col, payload_col, least), write, ARCHIVES), "archives")


# Reading

def load_dictionary(source: BinaryIO) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """The dictionary of the leading skippable frame, and the bytes read beyond it: those of another frame where there is none."""
    head = source.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
        return None, head
    size = struct.unpack("<I", head[4:])[0]
    data = source.read(size)
    if len(data) < size:
        raise ValueError("dictionary cut short")
    if data[:4] == FRAME:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data), b""


def frames(source: BinaryIO, chunk: int = 1 << 20) -> Iterator[tuple[bytes, str | None]]:
    """(content, problem) of each frame in turn; skippable frames are passed over. After a broken frame nothing can be found, so reading ends."""
    try:
        dictionary, left = load_dictionary(source)
    except (ValueError, zstandard.ZstdError) as broken:
        yield b"", f"dictionary: {broken}"
        return
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        left += source.read(8 - len(left)) if len(left) < 8 else b""
        if not left:
            return
        if len(left) >= 8 and struct.unpack("<I", left[:4])[0] in SKIPPABLE:
            size = struct.unpack("<I", left[4:8])[0]
            missing = size - (len(left) - 8)
            if missing > 0 and len(source.read(missing)) < missing:
                yield b"", "skippable frame cut short"
                return
            left = left[8 + size:]
            continue
        frame, parts = unpacker.decompressobj(), []
        try:
            while True:
                parts.append(frame.decompress(left))
                if frame.eof:
                    break
                left = source.read(chunk)
                if not left:
                    yield b"".join(parts), "frame cut short"
                    return
        except zstandard.ZstdError as broken:
            yield b"".join(parts), f"frame: {broken}"
            return
        left = frame.unused_data
        yield b"".join(parts), None


def _headers(block: bytes) -> tuple[str, dict[str, str], list[str]]:
    """First line, fields by lower-case name, problems. Folded lines continue the one before; of a repeated field the first counts."""
    first, *lines = re.sub(rb"\r\n[ \t]+", b" ", block).decode("utf-8", "replace").split("\r\n")
    fields: dict[str, str] = {}
    problems = []
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            problems.append("malformed header")
        else:
            fields.setdefault(name.lower(), value.strip())
    return first, fields, problems


def _digest_problem(fields: dict[str, str], name: str, data: bytes) -> list[str]:
    kind, _, value = fields.get(name, "").partition(":")
    return [name] if kind.lower() == "sha256" and value.lower() != sha256(data).hexdigest() else []


def parse_record(content: bytes) -> dict:
    """The fields of RECORDS that one record holds; ``problems`` lists what its headers, lengths and digests lack."""
    out: dict = {"payload": None, "payload_bytes": None, "payload_digest": None}
    head, blank, rest = content.partition(b"\r\n\r\n")
    version, fields, problems = _headers(head)
    if not blank or not re.fullmatch(r"WARC/1\.[01]", version):
        problems.append("version")
    problems += [f"no {name}" for name in REQUIRED if name not in fields]
    urn = {k: (re.fullmatch("<(.*)>", fields[k]) or [None, fields[k]])[1] for k in ("warc-record-id", "warc-refers-to") if k in fields}
    out |= {"record_id": urn.get("warc-record-id"), "refers_to": urn.get("warc-refers-to")}
    out |= {"record_type": fields.get("warc-type"), "target_uri": fields.get("warc-target-uri")}
    source = fields.get("warc-source-id", "")
    out["source_id"] = int(source) if re.fullmatch(r"-?\d{1,18}", source) else None
    stated = fields.get("content-length", "")
    length = int(stated) if re.fullmatch(r"\d+", stated) else None
    block = rest[:length] if length is not None else rest
    if length is not None and (len(rest) != length + 4 or rest[length:] != b"\r\n\r\n"):
        problems.append("content-length")
    problems += _digest_problem(fields, "warc-block-digest", block)
    if out["record_type"] in ("response", "revisit"):
        problems += _payload(out, fields, block)
    if out["record_type"] == "revisit" and not out["refers_to"]:
        problems.append("no warc-refers-to")
    return out | {"problems": problems}


def _payload(out: dict, fields: dict[str, str], block: bytes) -> list[str]:
    """Fill in the payload of a response; a revisit states the length and digest of the one it repeats."""
    head, blank, body = block.partition(b"\r\n\r\n")
    status, http, problems = _headers(head)
    if not blank or not status.startswith("HTTP/"):
        problems.append("http status")
    stated = http.get("content-length", "")
    size = int(stated) if re.fullmatch(r"\d+", stated) else None
    if out["record_type"] == "revisit":
        kind, _, value = fields.get("warc-payload-digest", "").partition(":")
        out |= {"payload_bytes": size, "payload_digest": value.lower() if kind.lower() == "sha256" else None}
        return problems + ["revisit with a body"] * bool(body)
    out |= {"payload": body, "payload_bytes": len(body), "payload_digest": sha256(body).hexdigest()}
    return problems + ["http content-length"] * (size is not None and size != len(body)) + _digest_problem(fields, "warc-payload-digest", body)


_KINDS = {
    "path": pa.string(), "place": pa.int64(), "record_id": pa.string(), "record_type": pa.string(), "source_id": pa.int64(), "target_uri": pa.string(),
    "refers_to": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(), "problems": pa.list_(pa.string()),
}


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, inside = open_store(path)
            held, size = [], 0
            with store.open_input_stream(inside, compression=None) as source:
                for place, (content, problem) in enumerate(frames(source)):
                    row = {"path": path, "place": place} | parse_record(content)
                    row["problems"] = [problem] * (problem is not None) + row["problems"]
                    row["payload"] = row["payload"] if payloads else None
                    held.append(row)
                    size += len(content) if payloads else 1000
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, pa.schema(_KINDS))
                        held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, pa.schema(_KINDS))


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of all archives in a folder and those below it, whoever wrote them. Their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").option("recursiveFileLookup", True)
    return files.load(folder).select("path")


def read_archives(archives: DataFrame, payloads: bool = True, partitions: int | None = None) -> DataFrame:
    """A row per record (columns RECORDS) of the archives in column ``path``: ``place`` is the frame's number in its archive.

    A task streams one archive after another and holds one record at a time. ``partitions`` deals the archives out (default: one task each for
    up to 10,000). ``problems`` is empty for a sound record. A frame that cannot be decoded ends its archive; without ``payloads`` that column is null.
    No archives give no rows; null paths are ignored.
    """
    named = archives.select("path").where("path IS NOT NULL")
    spread = named.repartition(partitions or max(1, min(named.count(), 10_000)))
    return map_batches(spread, partial(_read, payloads=payloads), RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Responses and revisits with ``source`` (source_id of the response that a revisit repeats, else null) and ``valid``.

    Valid are records without problems; a revisit's response must also be there, be valid itself and have the length and digest that the
    revisit states. ``records`` should be a stored table, as it is read three times. Record ids that occur twice make the revisits of them invalid.
    """
    sound = F.size("problems") == 0
    responses = records.where("record_type = 'response'").groupBy("record_id").agg(
        F.count("*").alias("times"), F.min("source_id").alias("source"), F.bool_and(sound).alias("sound"),
        F.min("payload_bytes").alias("there"), F.min("payload_digest").alias("same"),
    ).withColumnRenamed("record_id", "refers_to")
    own = records.where("record_type = 'response'").select(*records.columns, F.lit(None).cast("long").alias("source"), sound.alias("valid"))
    agrees = (F.col("times") == 1) & F.col("sound") & (F.col("there") == F.col("payload_bytes")) & (F.col("same") == F.col("payload_digest"))
    valid = sound & F.coalesce(agrees, F.lit(False))
    revisits = records.where("record_type = 'revisit'").join(responses, "refers_to", "left")
    return own.union(revisits.select(*records.columns, "source", valid.alias("valid")))


def round_trip(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The resolved records of ``pages`` after they were written to archives and read back, without their payloads."""
    folder = new_path(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, id_col, uri_col, payload_col)
    return resolve(materialise(read_archives(archives, payloads=False).drop("payload"), "records"))


def report(resolved: DataFrame) -> DataFrame:
    """One row per page: length and digest of its full payload, its record's type, and the page that a revisit repeats."""
    return resolved.select(
        F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("source").alias("refers_to"), "valid",
    )
