"""The commit log, versions by commit, keyed tables of base and deltas, and the queries of the jobs that write."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from harness import compare, duck
from ledgerline.plans.write_queries import QUERIES
from ledgerline.sources import commits, files, sinks
from ledgerline.sources.commits import CommitLog
from ledgerline.sources.keyed_table import BUCKET, KeyedTable, by_hash, by_width, delta_merger, reset_links, sync

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TS = dt.datetime(2024, 1, 1)


def scratch():
    return tempfile.mkdtemp(prefix="ledgerline-test-", dir="/tmp")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_what_a_job_wrote_matches_the_oracle(spark, name):
    r = compare(QUERIES[name](spark, SF), E.oracle_sql()[name], duck(SF))
    assert r["ok"], r


def v(spark, *values):
    return spark.createDataFrame([(x,) for x in values], "v int")


def values(df):
    return sorted(r.v for r in df.collect())


def test_a_writer_that_comes_second_looks_again(spark):
    log, seen = CommitLog(spark, scratch()), []

    def second(state, number):
        seen.append(number)
        if len(seen) == 1:  # another writer is first
            log.commit(lambda s, n: {**s, "first": n})
        return {**state, "second": number}

    assert log.commit(second) == (2, {"first": 1, "second": 2})
    assert seen == [1, 2] and log.latest() == (2, {"first": 1, "second": 2})
    assert log.commit(lambda s, n: None) == (2, {"first": 1, "second": 2})
    for _ in range(commits.LOG_KEPT + 5):
        log.commit(lambda s, n: s)
    assert len(os.listdir(os.path.join(log.root, commits.LOG))) <= 2 * commits.LOG_KEPT + 2  # with checksum files
    assert log.latest()[0] == commits.LOG_KEPT + 7


def test_tables_of_a_run_are_seen_together(spark):
    root = scratch()
    sinks.refresh_all(spark, {"a": v(spark, 1), "b": v(spark, 1)}, root, TS)
    before = sinks.read_commit(spark, root)  # a reader in the middle of its work
    sinks.refresh_all(spark, {"a": v(spark, 2), "b": v(spark, 2)}, root, TS)
    sinks.refresh_all(spark, {"c": v(spark, 9)}, root, TS)
    assert [values(before[n]) for n in "ab"] == [[1], [1]]
    now = sinks.read_commit(spark, root)
    assert {n: values(d) for n, d in now.items()} == {"a": [2], "b": [2], "c": [9]}
    assert {n: values(d) for n, d in sinks.read_commit(spark, root, commit=1).items()} == {"a": [1], "b": [1]}
    with pytest.raises(FileNotFoundError):
        sinks.read_commit(spark, root, ["c"], commit=2)
    with pytest.raises(FileNotFoundError):
        sinks.read_commit(spark, root, commit=4)


def test_a_run_that_fails_half_way_changes_no_table(spark):
    root = scratch()
    sinks.refresh_all(spark, {"a": v(spark, 1), "b": v(spark, 1)}, root, TS)
    bad = v(spark, 2).select(F.raise_error(F.lit("no")).cast("int").alias("v"))
    with pytest.raises(Exception):
        sinks.refresh_all(spark, {"a": v(spark, 2), "b": bad}, root, TS)
    assert {n: values(d) for n, d in sinks.read_commit(spark, root).items()} == {"a": [1], "b": [1]}
    assert len(sinks.versions(spark, os.path.join(root, "a"))) == 1 and not CommitLog(spark, root).running()


def test_retention_follows_commits_and_spares_runs_in_progress(spark):
    root = scratch()
    log = CommitLog(spark, root)
    other, dead = os.path.join(root, "a", "v-other"), os.path.join(root, "a", "v-dead")
    with log.run("v-other"):
        for folder in (other, dead):
            v(spark, 7).write.parquet(folder)
        for k in range(4):  # one run time, so names don't follow the order of the runs
            sinks.refresh_all(spark, {"a": v(spark, k), "b": v(spark, k)}, root, TS, keep=2)
        found = sinks.versions(spark, os.path.join(root, "a"))
        assert len(found) == 3 and "v-other" in found and len(sinks.versions(spark, os.path.join(root, "b"))) == 2
        assert values(sinks.read_commit(spark, root, commit=3)["a"]) == [2]
        assert values(sinks.read_current(spark, root, "a")) == [3]
    sinks.refresh_all(spark, {"a": v(spark, 5)}, root, TS, keep=1)
    assert len(sinks.versions(spark, os.path.join(root, "a"))) == 1 and len(sinks.versions(spark, os.path.join(root, "b"))) == 2


SCHEMA = "k int, g string, ts int, v int"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def keyed(spark, bucket=None, order=("ts",)):
    return KeyedTable(spark, scratch(), rows(spark).schema, ["k", "g"], list(order), bucket or by_width("k", 10))


def state(table):
    return table.log.latest()[1]


def test_merges_by_key_and_order_whatever_the_batches(spark):
    r = random.Random(3)
    for order in (("ts",), ()):
        table, want = keyed(spark, by_hash(4), order), {}
        for n in range(6):
            batch = {(r.randint(0, 12), r.choice(["a", None])): (r.randint(0, 9), n) for _ in range(10)}
            table.append(rows(spark, *((*k, *x) for k, x in batch.items())))
            for k, x in batch.items():
                if not order or x[0] >= want.get(k, (-1,))[0]:
                    want[k] = x
            if n in (2, 4):
                table.compact(most_deltas=1)
                table.vacuum(kept=0, grace=dt.timedelta(0))
            got = {(x.k, x.g): (x.ts, x.v) for x in table.read().collect()}
            assert got == want and table.read().count() == len(want)


def test_a_batch_writes_its_buckets_and_compaction_those_that_need_it(spark):
    table = keyed(spark)
    table.append(rows(spark, *((k, "a", 0, 0) for k in range(100)), (None, "a", 0, 0)))
    assert sorted(state(table)["parts"], key=int) == [str(b) for b in range(-1, 10)]
    before = set(state(table)["parts"]["3"][0])
    table.append(rows(spark, (95, "a", 1, 1), (99, "b", 1, 1)))
    parts = state(table)["parts"]
    assert {b for b, p in parts.items() if len(p) > 1} == {"9"}
    folder = parts["9"][1][0]
    assert [n for n in os.listdir(f"{table.path}/{folder}") if n.startswith(BUCKET)] == [f"{BUCKET}=9"]
    assert table.compact(most_deltas=9, share=0.01) == [9] and table.compact() == []
    assert len(state(table)["parts"]["9"]) == 1 and set(state(table)["parts"]["3"][0]) == before
    assert table.read().count() == 102 and table.read().filter("v = 1").count() == 2
    # the plan of a table without deltas has no shuffle
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()


def test_buckets_of_too_many_folders_are_compacted(spark, monkeypatch):
    from ledgerline.sources import keyed_table
    monkeypatch.setattr(keyed_table, "MOST_FOLDERS", 2)
    table = keyed(spark)
    table.append(rows(spark, *((k, "a", 0, 0) for k in range(40))))
    for k in (1, 11, 21):
        table.append(rows(spark, (k, "a", 1, 1)))
    assert table.compact(most_deltas=9, share=10.0) == [0, 1, 2]  # all have their base in the oldest folder
    assert table.read().count() == 40 and table.read().filter("v = 1").count() == 3
    assert table.compact(most_deltas=9, share=10.0) == []


def test_repeated_batches_change_nothing(spark):
    table = keyed(spark)
    merge = delta_merger(table, "stream", compact_every=2)
    merge(rows(spark, (1, "a", 1, 1)), 0)
    merge(rows(spark, (1, "a", 2, 2), (2, "a", 2, 2)), 1)
    number = table.log.latest()[0]
    for epoch in (0, 1):
        merge(rows(spark, (1, "a", 9, 9)), epoch)
    assert table.log.latest()[0] <= number + 1  # a compaction may follow, no rows
    assert sorted((x.k, x.v) for x in table.read().collect()) == [(1, 2), (2, 2)]
    merge(rows(spark), 2)  # an empty batch counts, too
    assert state(table)["writers"]["stream"] == 2


def test_deltas_of_meanwhile_outlive_a_compaction(spark, monkeypatch):
    table = keyed(spark)
    for n in range(3):
        table.append(rows(spark, (1, "a", n, n)))
    write = table._write

    def slow(*a):
        monkeypatch.setattr(table, "_write", write)
        table.append(rows(spark, (2, "a", 5, 5)))
        return write(*a)

    monkeypatch.setattr(table, "_write", slow)
    assert table.compact(most_deltas=1) == [0]
    assert len(state(table)["parts"]["0"]) == 2
    assert sorted((x.k, x.v) for x in table.read().collect()) == [(1, 2), (2, 5)]


def test_vacuum_spares_what_readers_and_runs_need(spark):
    table = keyed(spark)
    for n in range(3):
        table.append(rows(spark, (1, "a", n, n)))
    reader = table.read()
    with table.log.run("d-other"):
        os.makedirs(f"{table.path}/d-other")
        os.makedirs(f"{table.path}/d-dead")
        table.compact(most_deltas=1)
        table.vacuum(kept=2)
        assert reader.count() == 1 and os.path.exists(f"{table.path}/d-other") and not os.path.exists(f"{table.path}/d-dead")
    for _ in range(3):
        table.append(rows(spark, (50, "a", 0, 0)))
    table.vacuum(kept=2)
    folders = files.names(spark, table.path, folders=True)
    assert not os.path.exists(f"{table.path}/d-other") and len([n for n in folders if n[0] in "db"]) == 4
    assert table.read().count() == 2


def test_late_and_repeated_runs_of_the_copy(spark):
    at = lambda m: TS + dt.timedelta(minutes=m)
    src = spark.createDataFrame([(1, at(10)), (2, at(25)), (3, at(50)), (1, at(55)), (4, at(300))], "k int, ts timestamp_ntz")
    table = KeyedTable(spark, scratch(), src.schema, ["k"], ["ts"], by_hash(2))
    assert table.read().count() == 0 and table.high() is None
    five = dt.timedelta(minutes=5)
    assert sync(table, src, "ts", at(15), five) and not sync(table, src, "ts", at(15), five)
    assert sync(table, src, "ts", at(60), five)
    assert sorted((x.k, x.ts) for x in table.read().collect()) == [(1, at(55)), (2, at(25)), (3, at(50))]
    assert sync(table, src, "ts", at(61), five)  # nothing new but the overlap
    assert table.read().count() == 3 and sinks.read_current(spark, *os.path.split(table.path)).count() == 3


def test_a_stream_into_a_keyed_table(spark):
    inbox, ckpt = scratch(), scratch()
    table = keyed(spark)
    for n in range(3):
        rows(spark, (1, "a", n, n), (20 + n, "b", n, n)).write.parquet(f"{inbox}/{n}")
        stream = spark.readStream.schema(table.schema).option("recursiveFileLookup", "true").parquet(inbox)
        q = stream.writeStream.foreachBatch(delta_merger(table, "s")).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    assert sorted((x.k, x.v) for x in table.read().collect()) == [(1, 2), (20, 0), (21, 1), (22, 2)]


def test_a_reset_writes_the_rows_that_change(spark):
    table = KeyedTable(spark, scratch(), rows(spark).schema, ["k"], [], by_width("k", 1))
    table.append(rows(spark, (1, "a", 1, 10), (2, "a", 1, 20), (3, "a", 1, None), (4, "b", 1, 40), (5, None, 1, 50)))
    keep = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert reset_links(table, keep, "k", "id", "v", F.col("g") == "a")
    assert {b for b, p in state(table)["parts"].items() if len(p) > 1} == {"2"}
    assert sorted((x.k, x.v) for x in table.read().collect()) == [(1, 10), (2, None), (3, None), (4, 40), (5, 50)]


def test_another_definition_is_refused(spark):
    table = keyed(spark)
    table.append(rows(spark, (1, "a", 1, 1)))
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, table.schema, ["k"], ["ts"]).append(rows(spark, (1, "a", 1, 1)))
    os.remove(f"{table.path}/{commits.POINTER}")
    with pytest.raises(ValueError):
        table.append(rows(spark, (1, "a", 1, 1)))
    with pytest.raises(FileNotFoundError):
        KeyedTable.open(spark, table.path)
