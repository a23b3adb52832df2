"""Upserts in buckets under a manifest: replays, folding beside a running job, what a lookup reads."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import new_folder
from tidemark.sources import readers, wire
from tidemark.sources.keyed_table import KeyedTable
from tidemark.sources.manifest import Live, Manifest, Version
from tidemark.streaming.billing import BillingStream

ROWS = schemas.table("key string, day int, value bigint")


def table(spark, **how):
    return KeyedTable(new_folder(spark, "keyed"), ROWS, ("key", "day"), buckets=4, **how)


def rows(spark, some):
    return spark.createDataFrame(some, ROWS)


def seen(df):
    return sorted(((r.key, r.day, r.value) for r in df.collect()), key=str)


@pytest.mark.parametrize("fold_after", [None, 1, 3])
def test_batches_and_replays_against_a_dict(spark, fold_after):
    rng, keyed, want = random.Random(4), table(spark, fold_after=fold_after), {}
    for batch in range(6):
        chosen = {(rng.choice(["a", "b", "c", None, "x/y=z"]), rng.choice([1, 2, None])): rng.randrange(100) for _ in range(4)}
        if batch == 3:  # what a failed attempt wrote is replaced, keys that do not come again included
            keyed.write(rows(spark, [("lost", 1, 1), *[(k, d, -1) for k, d in chosen]]), batch)
        keyed.write(rows(spark, [(k, d, v) for (k, d), v in chosen.items()]), batch)
        want.update(chosen)
        assert seen(keyed.view(spark)) == sorted(((k, d, v) for (k, d), v in want.items()), key=str)
    assert keyed.repeated(spark).count() == 0
    keyed.write(rows(spark, []), 6)
    assert len(seen(keyed.view(spark))) == len(want)


def test_before_hides_the_batch_that_is_replayed(spark):
    keyed = table(spark, fold_after=1)
    for batch in range(4):
        keyed.write(rows(spark, [("a", 1, batch)]), batch)
    assert seen(keyed.view(spark, before=3)) == [("a", 1, 2)] and seen(keyed.view(spark)) == [("a", 1, 3)]


def test_lookup_reads_the_touched_parts_alone(spark):
    keyed = table(spark, period="day")
    keyed.write(rows(spark, [(f"k{i}", i % 5, i) for i in range(200)]), 0)
    found = keyed.lookup(rows(spark, [("k7", 2, 0)]))
    files = found.inputFiles()
    assert len(files) == 1 and "part=2." in files[0]
    assert ("k7", 2, 7) in seen(found) and len(seen(found)) < 30
    assert keyed.lookup(rows(spark, [("new", 9, 0)])).count() == 0


def test_folding_meets_a_writer_and_another_folder(spark, monkeypatch):
    keyed = table(spark, fold_after=None)
    for batch in range(3):
        keyed.write(rows(spark, [("a", 1, batch), (f"b{batch}", 1, batch)]), batch)
    real, went = Manifest.commit, []

    def late(self, change, tries=50):
        if not went:  # another batch commits between this one's files and its commit
            went.append(1)
            keyed.write(rows(spark, [("a", 1, 99)]), 3)
        return real(self, change, tries)

    monkeypatch.setattr(Manifest, "commit", late)
    assert keyed.fold(spark)
    assert seen(keyed.view(spark)) == [("a", 1, 99), ("b0", 1, 0), ("b1", 1, 1), ("b2", 1, 2)]
    monkeypatch.setattr(Manifest, "commit", real)
    assert keyed.fold(spark) and not keyed.fold(spark)  # the batch before last, then nothing is left
    assert len(seen(keyed.view(spark))) == 4


def test_two_writers_of_one_version(spark):
    manifest, calls = Manifest(spark, new_folder(spark, "manifest")), []

    def change(now):
        calls.append(now.number)
        if len(calls) == 1:  # somebody else takes the number first
            manifest.commit(lambda v: Version(0, 0, (*v.files, Live("other", "0", 0, 1))))
        return Version(0, 0, (*now.files, Live("mine", "0", 0, 1)))

    manifest.commit(change)
    assert [f.path for f in manifest.latest().files] == ["other", "mine"] and calls == [0, 1]


def test_clean_leaves_what_is_named(spark):
    keyed = table(spark, fold_after=None)
    for batch in range(3):
        keyed.write(rows(spark, [("a", 1, batch), ("b", 1, batch)]), batch)
    keyed.write(rows(spark, [("a", 1, 7)]), 2)
    keyed.fold(spark)
    manifest, now = keyed.manifest(spark), int(time.time() * 1000)
    assert manifest.clean(3_600_000, now + 1000) == 0  # too young to be sure
    assert manifest.clean(0, now + 60_000, versions=1) > 0
    assert seen(keyed.view(spark)) == [("a", 1, 7), ("b", 1, 1)]


def orders(spark, at, money, batch, n=40):
    cut = [(f"c{i % 7}", i % 2, batch * n + i, money(str(i)), at(f"12:{(batch + i) % 50:02d}:00"), batch * n + i) for i in range(n)]
    return spark.createDataFrame(cut, "customer_id string, source_partition int, sequence bigint, fee decimal(19,2), occurred_at timestamp, offset bigint")


def test_a_running_stream_goes_on_across_folding_and_replay(spark, at, money):
    root = new_folder(spark, "running")
    job = BillingStream(root, partitions=2, idle_us=None, lateness_us=10**12)
    wire.encode_orders(orders(spark, at, money, 0)).coalesce(1).write.parquet(f"{root}/landing")
    stream = readers.record_stream(spark, f"{root}/landing", max_files=1)
    query = job.start(stream, f"{root}/checkpoint", every="0 seconds")
    try:
        for batch in range(1, 5):
            query.processAllAvailable()
            for kept in (job.reports, job.audit):  # another job folds beside the stream
                kept.fold(spark)
            wire.encode_orders(orders(spark, at, money, batch)).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        query.processAllAvailable()
    finally:
        query.stop()
    job.process(spark.read.parquet(f"{root}/landing").where("offset >= 160"), 4)  # the last batch again
    totals = job.reports.view(spark).agg(F.sum("event_count"), F.sum("total_fee")).first()
    assert (totals[0], float(totals[1])) == (200, 5 * sum(range(40)))
    assert job.audit.view(spark).count() == 200 and job.audit.repeated(spark).count() == 0
    assert any(f.batch == -1 for f in job.reports.manifest(spark).latest().files)
