import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from talkweave.llm import toxicity
from tests.llm.test_decontaminate import best
from tests.llm.test_simhash_dedup import fingerprint, reachable


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialise(stage(spark, docs, sf), name)
        out[name] = docs, after
        docs = after
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(stages, spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").columns
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == documents, name


def test_toxic_documents_go(stages, spark, sf):
    before, after = stages["toxicity"]
    found = toxicity.toxicity(before, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert set(rows(after)) == {r.doc_id for r in found if not r.predicted}


def test_one_of_each_class_stays(stages):
    before, after = stages["near_duplicates"]
    docs = sorted(rows(before).items())
    label = reachable([fingerprint(r.text, 4) for _, r in docs], [i for i, _ in docs])
    assert set(rows(after)) == set(label)


def test_leaks_go(stages, sf):
    before, after = stages["decontamination"]
    items = [i["text"] for i in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    kept = rows(after)
    for i, r in rows(before).items():
        known = [x for x in items if any(w in r.text for w in [x[:25], x[-25:]])]
        assert (i in kept) == all(best(r.text, x) < 0.8 for x in known)


def test_personal_data_and_ids(stages):
    before, after = stages["personal_data"]
    old, new = rows(before), rows(after)
    assert set(old) == set(new) and any(old[i].text != new[i].text for i in old)
    assert all(r.n_chars == len(r.text) for r in new.values())
    coded = rows(stages["byte_bpe"][1])
    assert set(coded) == set(new) and all(r.round_trip and r.n_tokens == len(r.ids) for r in coded.values())


def test_last_stage_keeps_other_columns(spark, sf):
    docs = spark.createDataFrame([(1, "some text", b"mine", "x", 3)], "doc_id long, text string, decoded binary, Ids string, doc int")
    (got,) = corpus_pipeline.encode(spark, docs, sf).collect()
    assert (got.doc_id, got.text, bytes(got.decoded), got.doc, got.round_trip) == (1, "some text", b"mine", 3, True)
    assert got.n_tokens == len(got.ids) and got.__fields__ == ["doc_id", "text", "decoded", "doc", "ids", "n_tokens", "round_trip"]


def test_run_is_the_stages(stages, spark, sf):
    got = {i: r.n_tokens for i, r in rows(corpus_pipeline.run(spark, sf)).items()}
    assert got == {i: r.n_tokens for i, r in rows(stages["byte_bpe"][1]).items()}


def test_messy(spark, messy, nothing, sf):
    for start in (messy, nothing):
        docs = corpus_pipeline.materialise(start, "messy")
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
            if name != "byte_bpe":
                assert docs.columns == messy.columns
        assert docs.count() == (0 if start is nothing else docs.select("doc_id", "text").distinct().count())
