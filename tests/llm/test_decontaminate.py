import re
from collections import Counter

import pyarrow.parquet as pq

from talkweave.llm import decontaminate, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(w, n):
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def best(text, item):
    """The highest Dice similarity of an item-sized window."""
    w, i = words(text), words(item)
    n = min(5, len(i))
    if not i or len(w) < n:
        return 0.0
    b = shingles(i, n)
    out = 0.0
    for a in range(max(1, len(w) - len(i) + 1)):
        x = shingles(w[a:a + len(i)], n)
        out = max(out, 2 * (x & b).total() / (x.total() + b.total()))
    return out


def test_query_equals_brute_force(spark, sf, documents):
    items = pq.read_table(f"{sf}/benchmark.parquet").to_pylist()
    any_shingle = {s: i["item_id"] for i in items for s in shingles(words(i["text"]), 5)}
    want = {}
    for d in documents:
        if any(s in any_shingle for s in shingles(words(d["text"]), 5)):
            for i in items:
                like = best(d["text"], i["text"])
                if like >= 0.8:
                    want[d["doc_id"], i["item_id"]] = round(like, 9)
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in queries.op1_decontaminate(spark, sf).collect()}
    assert got == want and want


def test_edited_and_short_passages(spark):
    item = " ".join(f"q{i}" for i in range(40))
    edited = item.replace("q20 ", "other ")
    half = " ".join(f"q{i}" for i in range(20))
    docs = [(1, "before " * 9 + item + " after"), (2, "Before, " + edited.upper()), (3, half + " end"), (4, item[:-8]), (5, "a short item")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "Short item!"), (12, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(frame, bench).collect()}
    assert set(got) == {(d, i) for d, t in docs for i, x in ((10, item), (11, "short item")) if best(t, x) >= 0.8}
    assert got[1, 10].similarity == 1.0 and (got[1, 10].first_word, got[1, 10].n_words) == (9, 40)
    assert (5, 11) in got
    assert [r.doc_id for r in decontaminate.clean(frame, bench).collect()] == [3]


def test_several_blocks_are_one_result(spark, sf, monkeypatch):
    whole = sorted(map(tuple, queries.op1_decontaminate(spark, sf).collect()))
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 300)
    assert sorted(map(tuple, queries.op1_decontaminate(spark, sf).collect())) == whole


def test_messy(spark, messy, nothing):
    bench = spark.createDataFrame(
        [(1, None, "c"), (2, "", "c"), (3, "no id here but words", "c"), (3, "no id here but words", "c"), (None, "negative id", "c")],
        "item_id long, text string, score string",
    )
    got = decontaminate.leaks(messy, bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == [("-3", "None"), ("None", "3")]
    assert decontaminate.leaks(nothing, bench).collect() == []
    assert decontaminate.leaks(messy, bench.limit(0)).collect() == []
    kept = decontaminate.clean(messy, bench)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 2
