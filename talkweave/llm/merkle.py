"""Document fingerprints: Merkle trees over sections, paragraphs and phrases.

Sections are separated by blank lines, paragraphs by line ends; a paragraph's leaves are its phrases
(up to and with their punctuation), those over LEAF characters in pieces. Every node above a leaf hashes its children,
the root hashes the sections. Equal roots mean equal texts; where they differ, the walk goes down only into branches
whose hashes differ, so it finds the edited places. The fingerprint is the tree as a string:

    root|section:paragraph:leaf.length,leaf.length;paragraph:...|section:...

Leaf and inner hashes are cut to 40 bits, the root is a whole SHA-256.
"""

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.arrays import map_batches, ship_package

LEAF = 64
SHORT = 10

_SECTION = re.compile(r"(?<=\n)(?=\n)(?<!\n\n)|(?<=\n\n)(?=[^\n])")
_PHRASE = re.compile(r"[^.,;:!?]*[.,;:!?]*\s*|\s+")


def _digest(data: str) -> str:
    return hashlib.sha256(data.encode("utf-8", "surrogatepass")).hexdigest()


def leaves(paragraph: str) -> list[str]:
    out = []
    for phrase in _PHRASE.findall(paragraph):
        if len(phrase) <= LEAF:
            if phrase:
                out.append(phrase)
        else:
            out += [phrase[i:i + LEAF] for i in range(0, len(phrase), LEAF)]
    return out


def fingerprint(text: str) -> str:
    """The tree of a text; the empty text has a root only."""
    sections, roots = [], []
    for section in _SECTION.split(text) if text else ():
        paragraphs, inner = [], []
        for paragraph in section.splitlines(keepends=True):
            parts = leaves(paragraph)
            hashes = [_digest(p) for p in parts]
            node = _digest("P" + "".join(hashes))
            inner.append(node)
            paragraphs.append(node[:SHORT] + ":" + ",".join([f"{h[:SHORT]}.{len(p)}" for h, p in zip(hashes, parts)]))
        node = _digest("S" + "".join(inner))
        roots.append(node)
        sections.append(node[:SHORT] + ":" + ";".join(paragraphs))
    return "|".join([_digest("R" + "".join(roots)), *sections])


def _weights(tree: str) -> Counter:
    """Characters by leaf hash."""
    out: Counter = Counter()
    for section in tree.split("|")[1:]:
        for paragraph in section.split(":", 1)[1].split(";"):
            for leaf in paragraph.split(":", 1)[1].split(","):
                if leaf:
                    name, length = leaf.split(".")
                    out[name] += int(length)
    return out


def likeness(a: str, b: str) -> float:
    """Share of both texts' characters that lie in common leaves, 0 to 1; two empty texts are alike."""
    return _alike(a, b, _weights(a), _weights(b))


def _alike(a: str, b: str, wa: Counter, wb: Counter) -> float:
    if a == b:
        return 1.0
    total = wa.total() + wb.total()
    few, many = (wa, wb) if len(wa) <= len(wb) else (wb, wa)
    return 2 * sum(min(n, many[k]) for k, n in few.items() if k in many) / total if total else 1.0


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """Character ranges of text ``a`` in leaves that text ``b`` has not at their branch, in order and joined."""
    if a.split("|", 1)[0] == b.split("|", 1)[0]:
        return []
    sections = Counter(s.split(":", 1)[0] for s in b.split("|")[1:])
    paragraphs = Counter(p.split(":", 1)[0] for s in b.split("|")[1:] for p in s.split(":", 1)[1].split(";"))
    other, at, out = _leaf_counts(b), 0, []
    for section in a.split("|")[1:]:
        same_section = sections[section.split(":", 1)[0]] > 0
        for paragraph in section.split(":", 1)[1].split(";"):
            name, _, inside = paragraph.partition(":")
            same = same_section or paragraphs[name] > 0
            for leaf in filter(None, inside.split(",")):
                h, n = leaf.split(".")
                end = at + int(n)
                if not same and other[h] <= 0:
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], end)
                    else:
                        out.append((at, end))
                at = end
    return out


def _leaf_counts(tree: str) -> Counter:
    return Counter(
        leaf.split(".")[0]
        for s in tree.split("|")[1:] for p in s.split(":", 1)[1].split(";") for leaf in p.split(":", 1)[1].split(",") if leaf
    )


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``fingerprint``; null counts as empty. A column of that name is replaced."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(fingerprint)

    return docs.withColumn("fingerprint", of(F.col(text_col)))


def half_replaced(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NONE = -(1 << 63)


def with_next(docs: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over batches of (of_range, ghost, key, doc_id, text), sorted so that each document's next one follows it.

    Next is by descending doc_id, and the first after the last; equal ids follow their text, null ids come
    last. Ids are dealt into ranges at quantiles; the first row of each range goes a second time, as ghost, to the end
    of the range before, so one shuffle of the texts is enough and no task holds more than its range.
    Quantiles and first ids are one number per range.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(NONE))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.stat.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n)
    bounds = np.unique(np.array(cuts, np.int64))

    def range_of(keys: pd.Series) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, keys.to_numpy(np.int64), side="left")

    @F.pandas_udf("int")
    def own_range(keys: pd.Series) -> pd.Series:
        return pd.Series(range_of(keys).astype(np.int32))

    firsts = {r.part: r.first for r in ids.select(own_range(key).alias("part"), key.alias("key"))
              .groupBy("part").agg(F.max("key").alias("first")).collect()}
    full = sorted(firsts)
    before = {part: full[i - 1] for i, part in enumerate(full)}

    @F.pandas_udf("array<struct<of_range:int,ghost:boolean>>")
    def places(keys: pd.Series) -> pd.Series:
        return pd.Series([
            [(int(part), False), (before[part], True)] if firsts[part] == k else [(int(part), False)]
            for part, k in zip(range_of(keys).tolist(), keys.tolist())
        ])

    dealt = texts.withColumn("key", key).withColumn("place", F.explode(places("key")))
    rows = dealt.select("place.of_range", "place.ghost", "key", "doc_id", "text")
    return map_batches(
        rows.repartition(n, "of_range").sortWithinPartitions("of_range", "ghost", F.desc("key"), "text"), run, schema
    )


COMPARED = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document.

    Null texts count as empty; equal ids and repeated rows stay and follow each other; one document alone is its own next;
    an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch, out = whole.slice(lo, 500), []
                for part, ghost, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                    if ghost and last is None:
                        continue
                    tree = fingerprint(text)
                    weights = _weights(tree)
                    if last is not None and last[0] == part:
                        _, before_id, before_text, before_tree, before_weights = last
                        edited = half_replaced(before_text, text)
                        edited_tree = fingerprint(edited)
                        out.append((
                            before_id, len(before_text), _digest(edited), before_tree, edited_tree,
                            _alike(before_tree, edited_tree, before_weights, _weights(edited_tree)),
                            _alike(before_tree, tree, before_weights, weights),
                        ))
                    last = None if ghost else (part, doc_id, text, tree, weights)
                columns = list(zip(*out)) or [()] * len(COMPARED)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COMPARED)], schema=COMPARED)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(docs, run, schema)
