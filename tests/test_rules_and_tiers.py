"""Changing rules on a stream, and tiers that move without their files."""

import datetime as dt
import random

from tidemark.operators import layout
from tidemark.session import new_folder
from tidemark.sources.tiered import TieredTable
from tidemark.streaming.rules import ARRIVING, RuledStream


def at(minute):
    return dt.datetime(2026, 1, 1, tzinfo=dt.UTC) + dt.timedelta(minutes=minute)


def brute(arrived):
    versions = {}
    for i, key, t, weight in arrived:
        if i is None and t is not None:
            versions.setdefault(key, {})[t] = max(weight, versions.get(key, {}).get(t, weight))
    out = {}
    for i, key, t, _ in arrived:
        if i is not None:
            held = [v for v in versions.get(key, {}) if t is not None and v <= t]
            out[i] = (versions[key][max(held)], max(held)) if held else (None, None)
    return out


def test_late_versions_judge_earlier_records_again(spark):
    rng, job = random.Random(8), None
    batches, n = [], 0
    for b in range(5):
        rows = []
        for _ in range(30):
            n += 1
            rows.append((n, rng.choice(["k", "l", None]), at(rng.randrange(4000)) if rng.random() > 0.05 else None, None))
        rows += [(None, rng.choice(["k", "l"]), at(rng.randrange(4000)), float(rng.randrange(1, 9))) for _ in range(3)]
        batches.append(rows)
    job, seen = RuledStream(new_folder(spark, "rules")), []
    for b, rows in enumerate(batches):
        seen += rows
        job.process(spark.createDataFrame(rows, ARRIVING), b)
        if b == 3:
            job.process(spark.createDataFrame(rows, ARRIVING), b)  # the batch again
        found = {r.id: (r.weight, r.rule_at and r.rule_at.replace(tzinfo=dt.UTC)) for r in job.judged.view(spark).collect()}
        assert found == brute(seen)
    assert len({w for w, _ in found.values()}) > 3


def test_earlier_records_meet_no_spans_of_their_key(spark):
    """Late versions find their records along the time line: work grows with rows, not with records times versions of a key."""
    job, plans = RuledStream(new_folder(spark, "rules-many")), []
    n = 400
    records = [(i, "k", at(10 * i + 5), None) for i in range(n)]
    versions = [(None, "k", at(10 * i), float(i)) for i in range(n)]
    job.process(spark.createDataFrame(records + versions[::2], ARRIVING), 0)
    real = job.judged.write
    object.__setattr__(job.judged, "write", lambda rows, batch: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), real(rows, batch)))
    job.process(spark.createDataFrame(versions[1::2], ARRIVING), 1)
    assert "array_sort" not in plans[0] and "collect_list" not in plans[0]
    assert {r.id: r.weight for r in job.judged.view(spark).collect()} == {i: float(i) for i in range(n)}
    # Records whose version did not change are not written again.
    assert job.judged.history(spark).where("batch_id = 1").count() == n // 2


def test_moving_a_month_leaves_its_files_alone(spark):
    rows = spark.range(4000).selectExpr("id % 50 user_id", "id order_id", "timestamp'2025-11-01' + make_interval(0, 0, 0, id % 120) event_time", "'S' symbol", "cast(id as decimal(12,2)) amount")
    table = TieredTable(new_folder(spark, "tiers"), rows.schema, layout.USER_FIRST)
    table.append(rows.where("order_id % 2 = 0"), 0, files=4)
    table.append(rows.where("order_id % 2 = 1"), 1, files=4)
    table.append(rows.where("order_id % 2 = 1"), 1, files=4)  # the same batch again
    folder = table.manifest(spark).folder
    before = sorted(folder.files_below("files"))
    table.retier(spark, 202601)
    assert sorted(folder.files_below("files")) == before
    want = {"hot": rows.where("event_time >= timestamp'2026-01-01'").count(), "cold": rows.where("event_time < timestamp'2026-01-01'").count()}
    assert {t: table.read(spark, t).count() for t in want} == want and table.read(spark).count() == 4000
    cold = {f.path for f in table.manifest(spark).latest().files if f.tier == "cold"}
    assert set(table.read(spark, "hot").inputFiles()).isdisjoint(cold)
    number = table.manifest(spark).latest().number
    table.retier(spark, 202601)
    assert table.manifest(spark).latest().number == number  # nothing to change
    table.retier(spark, 202512)
    assert table.read(spark, "cold").agg({"event_time": "max"}).first()[0] < dt.datetime(2025, 12, 1)
