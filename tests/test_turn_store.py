import pytest
from pyspark.sql import functions as F

from talkweave.sources.turn_store import TurnStore
from talkweave.staging import new_path
from tests.test_chats import make_turns


def batch(spark, chats, file, turns=2):
    rows = [(f"c{i}", f"{file}-{i}-{k}", k, "q", "r", "2026-01-01") for i in chats for k in range(turns)]
    return make_turns(spark, rows).withColumn("source_file", F.lit(file))


def ids(spark, chats):
    return spark.createDataFrame([(f"c{i}",) for i in chats], "chat_id string")


def found(store, chats):
    asked = ids(store.spark, chats)
    return sorted(r.turn_id for r in store.turns_of(asked, store.touched(asked)).collect())


def run_batch(store, chats, file, run, batch_id):
    """What ingest does with a batch, without its summaries."""
    store.recover()
    store.add(batch(store.spark, chats, file), run, batch_id)
    store.pack(store.touched(ids(store.spark, chats)))


def expected(*stored, chats):
    return sorted(f"{file}-{i}-{k}" for file, had in stored for i in had for k in range(2) if i in chats)


def test_buckets_double_and_pack(spark):
    store = TurnStore(spark, new_path(spark, "store"), rows_per_bucket=10, pack_after=1)
    stored = []
    for n, chats in enumerate(([0, 1], range(20), range(10, 40), [0, 39])):
        run_batch(store, chats, f"f{n}", "r", n)
        stored.append((f"f{n}", chats))
    assert [r.depth for r in store.batches().orderBy("batch_id").collect()] == [0, 3, 4, 4]
    assert found(store, range(50)) == expected(*stored, chats=range(50))
    everything = store.read(store.touched(ids(spark, range(50))))
    assert everything.filter("chat_id IN ('c0', 'c39') AND depth < 4").count() == 0
    assert everything.filter("chat_id = 'c39'").select("unit").distinct().count() == 1
    assert everything.select("chat_id", "turn_id").distinct().count() == everything.count()


@pytest.fixture(scope="module")
def sized(spark):
    """Stores of 200 and of 1600 chats, filled by batches."""
    out = {}
    for n in (200, 1600):
        store = TurnStore(spark, new_path(spark, "store"), rows_per_bucket=50, pack_after=2)
        for k in range(4):
            run_batch(store, range(k, n, 4), f"f{k}", "r", k)
        run_batch(store, range(n), "again", "r", 9)  # all buckets at their last depth
        out[n] = store
    return out


def test_a_batch_reads_as_many_files_whatever_the_store(sized):
    read = {}
    for n, store in sized.items():
        asked = ids(store.spark, [5, 77])
        rows = store.turns_of(asked, store.touched(asked))
        read[n] = len(store.read(store.touched(asked)).inputFiles())
        assert sorted(r.chat_id for r in rows.collect()) == sorted(["c5"] * 4 + ["c77"] * 4)
    assert 0 < read[1600] <= read[200] + 2 and sized[1600].depth() == sized[200].depth() + 3


def test_repeated_batches_and_runs(spark):
    store = TurnStore(spark, new_path(spark, "store"), rows_per_bucket=10, pack_after=1)
    for n in (0, 1, 1, 0):
        run_batch(store, range(8), f"f{n}", "r", n)
    assert found(store, range(8)) == expected(("f0", range(8)), ("f1", range(8)), chats=range(8))
    run_batch(store, range(8), "f0", "s", 0)  # a later run stores the same file
    assert found(store, range(8)) == expected(("f0", range(8)), ("f1", range(8)), chats=range(8))
    assert found(store, [99]) == [] and store.touched(ids(spark, [])) == []


@pytest.mark.parametrize("stop", ["packed", "moved", "half"])
def test_a_lost_driver_loses_and_doubles_nothing(spark, monkeypatch, stop):
    store = TurnStore(spark, new_path(spark, "store"), rows_per_bucket=10, pack_after=1)
    for n in range(2):
        store.add(batch(spark, range(12), f"f{n}"), "r", n)

    class Lost(Exception):
        pass

    moves = []

    def moving(self, *args, real=TurnStore._move):
        moves.append(args)
        if stop == "half" and len(moves) == 3:
            raise Lost
        real(self, *args)

    def deleting(self, path, real=TurnStore._delete):
        if stop == "moved":
            raise Lost
        real(self, path)

    def recovering(self):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(TurnStore, "_move", moving)
        patch.setattr(TurnStore, "_delete", deleting)
        if stop == "packed":
            patch.setattr(TurnStore, "recover", recovering)
        with pytest.raises(Lost):
            store.pack(store.touched(ids(spark, range(12))))
    store.recover()
    assert found(store, range(12)) == expected(("f0", range(12)), ("f1", range(12)), chats=range(12))
    rows = store.read(store.touched(ids(spark, range(12))))
    assert {r.depth for r in rows.select("depth").distinct().collect()} == {store.depth()}
    assert rows.filter("unit LIKE 'pack-%'").count() == 24 and not store._names(f"{store.path}/packs")


def test_a_pack_that_was_not_committed_is_dropped(spark):
    store = TurnStore(spark, new_path(spark, "store"), rows_per_bucket=10)
    store.add(batch(spark, range(6), "f"), "r", 0)
    store.read(store.touched(ids(spark, range(6)))).write.parquet(f"{store.path}/packing/pack-x/depth=1")
    store.recover()
    assert store._names(f"{store.path}/packing") == [] and found(store, range(6)) == expected(("f", range(6)), chats=range(6))


def test_turns_of_one_large_file_are_dealt_to_many_tasks(spark):
    store = TurnStore(spark, new_path(spark, "store"))
    run_batch(store, range(40), "f", "r", 0)
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesced, "false")
    try:
        for turns in (store.turns_of(ids(spark, range(40)), store.touched(ids(spark, range(40)))), store.everything()):
            assert turns.select(F.spark_partition_id().alias("task")).distinct().count() > 1
    finally:
        spark.conf.unset(coalesced)
