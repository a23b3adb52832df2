"""Differences named row by row, and ordered steps folded in parts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import automaton, digests, quality
from tidemark.operators.behaviour import journeys

ROWS = "day int, customer string, part int, seq int, fee int, note string"


def table(spark, n=300):
    rows = [(i % 5, None if i % 11 == 0 else f"c{i % 7}", i % 4, i, i * 3, None if i % 13 == 0 else f"n{i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, ROWS)


def told(spark, left, right):
    found = digests.differing_rows(left, right, [["day"], ["customer"], ["part"]], ["part", "seq"], ["fee", "note"])
    return sorted((r.part, r.seq, r.fault, r.left_rows, r.right_rows) for r in found.collect())


def test_one_row_lost_doubled_or_changed(spark):
    rows, left = table(spark)
    for number, row in ((17, rows[17]), (22, rows[22]), (26, rows[26])):
        rest = [r for i, r in enumerate(rows) if i != number]
        cases = {
            "missing": (rest, 0),
            "repeated": ([*rows, row], 2),
            "altered": ([*rest, (*row[:4], row[4] + 1, row[5])], 1),
            "extra": None,
        }
        for fault, case in cases.items():
            if case:
                assert told(spark, left, spark.createDataFrame(case[0], ROWS)) == [(row[2], row[3], fault, 1, case[1])]
    moved = [(*r[:5], "other") if r[3] == 13 else r for r in rows]  # a null becomes a value
    assert told(spark, left, spark.createDataFrame(moved, ROWS)) == [(1, 13, "altered", 1, 1)]
    assert told(spark, left, spark.createDataFrame([*rows, (9, "new", 9, 999, 1, "x")], ROWS)) == [(9, 999, "extra", 0, 1)]


def test_equal_tables_are_not_descended(spark, monkeypatch):
    rows, left = table(spark, 60)
    shuffled = random.Random(1).sample(rows, len(rows))
    assert told(spark, left, spark.createDataFrame(shuffled, ROWS)) == []


def test_only_differing_groups_are_looked_at(spark):
    rows, left = table(spark)
    right = spark.createDataFrame([r for r in rows if r[3] != 50], ROWS)
    found = digests.differing_groups(left, right, ["day"], ["day", "customer", "part", "seq", "fee", "note"]).collect()
    assert [(r.day, r.left_rows, r.right_rows) for r in found] == [(0, 60, 59)]


def brute_reached(kinds, steps):
    at = 0
    for kind in kinds:
        at += at < len(steps) and kind == steps[at]
    return at


@pytest.mark.parametrize("most", [2, 3, 50_000])
@pytest.mark.parametrize("steps", ["a", "ab", "abc", "aab", "abcabcabcabcab"])
def test_steps_in_order_against_a_loop(spark, monkeypatch, most, steps):
    monkeypatch.setattr(automaton, "MOST_ROWS", most)
    rng = random.Random(len(steps))
    rows = [(k, rng.randrange(30), i, rng.choice("abcx")) for k in ("u", "v", None) for i in range(rng.choice([1, 9, 70]))]
    df = spark.createDataFrame(rows, "key string, pos bigint, tie bigint, kind string")
    found = automaton.reached(df, ["key"], "pos", "tie", [F.col("kind") == s for s in steps])
    want = {k: brute_reached([r[3] for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3])], steps) for k in ("u", "v", None)}
    assert {r.key: r.reached for r in found.collect()} == {k: n for k, n in want.items() if any(r[0] == k and r[3] in steps for r in rows)}


def test_a_purchase_before_its_page_is_not_converted(spark):
    at = lambda m: dt.datetime(2026, 1, 1, 12, m, tzinfo=dt.UTC)
    rows = [("a", 1, at(0), "buy"), ("a", 2, at(1), "page"), ("b", 3, at(0), "page"), ("b", 4, at(1), "buy"), ("a", 5, at(40), "buy"), ("c", 6, at(0), "x")]
    df = spark.createDataFrame(rows, "user string, id int, at timestamp, kind string")
    kind = F.col("kind")
    found = journeys(df, "user", "at", 600_000_000, {"pages": kind == "page", "buys": kind == "buy"}, "id").orderBy("user", "session_start").collect()
    assert [(r.user, r.pages, r.buys, r.reached, r.converted) for r in found] == [("a", 1, 1, 1, False), ("a", 0, 1, 0, False), ("b", 1, 1, 2, True), ("c", 0, 0, 0, False)]


def test_the_gate_reads_its_input_once(spark, tmp_path):
    rows = [(i, i % 3 or None, i % 40, 10 * i - (200 if i == 30 else 0)) for i in range(100)]
    spark.createDataFrame(rows, "id int, part int, seq int, meter int").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    back = quality.goes_back(df, ["part"], "id", "meter", "back", width=None)
    gated = quality.gate(back, {"went back": F.col("back"), "even": F.col("id") % 2 == 0}, ["part", "seq"], "id", width=None)
    plan = gated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    counts = quality.split_and_count(gated, str(tmp_path / "out"), ["went back", "even", "duplicate"])
    want = {}
    first, last = {}, {}
    for i, part, seq, meter in rows:
        reasons = ["went back"] * (part in last and meter < last[part]) + ["even"] * (i % 2 == 0)
        last[part] = meter
        if part is not None:
            reasons += ["duplicate"] * ((part, seq) in first)
            first[part, seq] = i
        want[i] = reasons
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {r.id: r.reasons for r in out.collect()} == want
    assert {r.id for r in out.where("valid = 1").collect()} == {i for i, r in want.items() if not r}
    assert counts["rows"] == 100 and counts["valid"] == sum(not r for r in want.values())
    assert all(counts[n] == sum(n in r for r in want.values()) for n in ("went back", "even", "duplicate"))
