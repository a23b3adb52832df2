"""Nearest vectors against every pair, and the retrieval within a Hamming radius against all codes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import multi_index
from tidemark.llm.plans import op13_nearest


def brute(rows, k=5, every=50):
    """{query row number: [(score, vec_id), ..]} by all pairs."""
    whole = [(n, i, np.array(v, float)) for n, (i, v) in enumerate(rows) if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = []
    for n, i, q in whole:
        if i % every == 0:
            near = [(-float(q @ v / math.sqrt(q @ q) / math.sqrt(v @ v)), j) for m, j, v in whole if m != n and len(v) == len(q)]
            out.append((i, sorted((round(s, 12), j) for s, j in near)[:k]))
    return out


def lists(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_recall_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found, hit, total = lists(op13_nearest(spark, sf)), 0, 0
    by_id = dict(rows)
    for q, near in brute(rows):
        assert [r for r, _, _ in found[q]] == [1, 2, 3, 4, 5]
        hit += len({j for _, j in near} & {j for _, j, _ in found[q]})
        total += len(near)
        a = np.array(by_id[q], float)
        for _, j, score in found[q]:
            b = np.array(by_id[j], float)
            assert abs(score - a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)) < 1e-14
        assert found[q] == sorted(found[q], key=lambda x: (-x[2], x[1]))
    assert hit / total >= 0.9


ODD = "vec_id bigint, embedding array<double>, row string, node string, hash string, vec string"


def test_ties_copies_and_odd_vectors(spark):
    rng = random.Random(3)
    near = [1.0, 2.0, -1.0]
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(1, 40)]
    rows += [(50 + 50 * (i % 2), near) for i in range(12)] + [(200 + i, [2 * x for x in near]) for i in range(3)]
    rows += [(0, None), (0, []), (50, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (150, [1.0, float("nan"), 2.0]), (150, [float("inf"), 0.0, 0.0]), (None, near)]
    rows += [(250, [1e200, 1e200, -1e200]), (300, [1e-300, 0.0, 1e-300]), (350, [1.0]), (400, [1.0, 2.0]), (401, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, "r", "n", "h", "v") for i, v in rows], ODD).repartition(4)
    found = multi_index.nearest(df, 5)
    shown = {}
    for r in found.collect():
        shown.setdefault((r.query_id, r.rank), []).append((r.vec_id, round(r.score, 9)))
    want = {}
    for q, best in brute([(i, [x / max(map(abs, v)) for x in v] if v and None not in v and any(v) and np.isfinite(v).all() else v) for i, v in rows]):
        for rank, (s, j) in enumerate(best):
            want.setdefault((q, rank + 1), []).append((j, round(-s, 9)))
    # Codes are approximate: complete lists where the angle is small or the candidates few.
    for q in (50, 100, 400):
        for rank in range(1, 6):
            assert sorted(shown.get((q, rank), [])) == sorted(want.get((q, rank), []))
    assert {q for q, _ in shown} == {q for q, _ in want} and 350 not in {q for q, _ in shown}
    assert all(len([1 for q, rank in shown if q == x]) == len([1 for q, rank in want if q == x]) for x in {q for q, _ in want})


@pytest.mark.parametrize("splits", [4, 8, 16])
def test_probes_find_every_code_within_the_radius(spark, monkeypatch, splits):
    monkeypatch.setattr(multi_index, "BUCKET", 3)
    rng = random.Random(splits)
    base = [rng.getrandbits(64) for _ in range(6)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 14))) for b in base for _ in range(25)] + [rng.getrandbits(64) for _ in range(20)] + [base[0]] * 9
    everyone = spark.createDataFrame([(i, 64, multi_index._signed(c)) for i, c in enumerate(near)], "node bigint, dim int, code bigint")
    asked = spark.createDataFrame([(i, 64, multi_index._signed(c), 11) for i, c in enumerate(base)], "query bigint, dim int, code bigint, most int")
    pairs = []
    upto = 11 // splits
    for distance in range(upto + 1):
        pairs += [(r.query, r.node) for r in multi_index.retrieved(asked, everyone, splits, distance).collect()]
    want = sorted((q, n) for q, a in enumerate(base) for n, b in enumerate(near) if (a ^ b).bit_count() <= 11)
    assert sorted(pairs) == want  # each once


def test_few_and_none(spark):
    empty = spark.createDataFrame([], ODD)
    assert multi_index.nearest(empty).columns == ["query_id", "rank", "vec_id", "score"] and multi_index.nearest(empty).count() == 0
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]
    found = multi_index.nearest(empty.sparkSession.createDataFrame([(i, v, "", "", "", "") for i, v in rows], ODD))
    assert [(r.rank, r.vec_id, round(r.score, 12)) for r in found.orderBy("rank").collect()] == [(1, 1, 0.0), (2, 2, -1.0)]


def test_similar_vectors_need_few_rounds(spark, monkeypatch):
    """In tight groups the radius is small: deep probes are never reached."""
    seen = []
    real = multi_index.retrieved
    monkeypatch.setattr(multi_index, "retrieved", lambda a, c, s, d: (seen.append(d), real(a, c, s, d))[1])
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 32))
    rows = [(i, (centres[i % 30] + 0.05 * rng.standard_normal(32)).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = lists(multi_index.nearest(df, split=8))
    hits = [len({j for _, j in near} & {j for _, j, _ in found[q]}) for q, near in brute(rows)]
    assert max(seen) <= 1 and sum(hits) >= 0.9 * 5 * len(hits)
    assert df.where(F.col("vec_id") % 50 == 0).count() == len(found)


def test_probes_are_bounded_and_never_broadcast(spark):
    """Far neighbours among many vectors: few substrings would need tens of thousands of probes a query."""
    rng = np.random.default_rng(2)
    far = rng.standard_normal((600, 64)).tolist()
    _, (margin, _), splits = multi_index.learn(far, 5, 5_000_000)
    assert splits >= 8
    near = [(np.eye(64)[i % 20] + 0.01 * rng.standard_normal(64)).tolist() for i in range(600)]
    assert multi_index.learn(near, 5, 5_000_000)[2] == 4
    asked = spark.createDataFrame([(0, 64, 5, 11)], "query bigint, dim int, code bigint, most int")
    coded = spark.createDataFrame([(i, 64, i) for i in range(50)], "node bigint, dim int, code bigint")
    found = multi_index.retrieved(asked, coded, 8, 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
    assert found.count() == sum((5 ^ i).bit_count() <= 11 for i in range(50))
