"""op1 and op9 against brute force, with the awkward cases."""

import math
import random

import pytest
import xxhash

from tidemark.llm import simhash, topk

VECTORS = "vec_id bigint, embedding array<float>, score string, rank int"


def brute_topk(rows, every, k, scale=1024):
    ok = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for row, (q, qv) in enumerate(ok):
        if q % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(qv, cv, strict=True)), c) for other, (c, cv) in enumerate(ok) if other != row and len(cv) == len(qv))[:k]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.125, 2.0]) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # one very common vector: ties by id
    rows += [(7, rows[3][1]), (7, rows[3][1])]  # repeated candidate rows
    rows += [(50, rows[50][1]), (50, rows[51][1]), (50, [9.0] * 6), (60, [8.0] * 6), (60, [8.0] * 6)]  # repeated query ids
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6), (310, [1.0, 2.0]), (320, [3.0, 1.0]), (330, [])]
    return rows


@pytest.mark.parametrize("block, shard", [(16384, 131072), (3, 20)])
def test_topk(spark, vectors, block, shard):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], VECTORS)
    whole = topk.quantised(df, "vec_id", "embedding", 1024)
    got = topk.top_k(whole.where("vec_id % 10 = 0"), whole, 10, block, shard).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute_topk(vectors, 10, 10)


def test_topk_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], "", 0), (3, [0.5], "", 0)], VECTORS)
    assert [tuple(r) for r in topk.self_search(df).collect()] == [(0, 1, 3, 1024 * 512)]
    assert topk.self_search(df.limit(0)).count() == 0


def test_topk_large_values_are_exact(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**12, 1.0]), (2, [2.0**12, 2.0])]
    df = spark.createDataFrame([(i, v, "", 0) for i, v in rows], VECTORS)
    got = topk.self_search(df, scale=1).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 2**52 + 2), (1, 2**52 + 1)]


def brute_print(text, words):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] if len(tokens) >= words else [b" ".join(tokens)] * bool(tokens)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


DOCS = "doc_id bigint, text string, fingerprint string, component_id int"


def texts():
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)) for n in (300, 300, 40, 12, 5, 2, 1)]
    out = [*base, *base, None, "", " \t\n", "A B\x0bc", "a b c", "é È É", "x " * 20000]
    for n in range(25):  # near copies that differ in a word near the end
        words = base[0].split()
        words[-1 - n % 5] = f"w{n}"
        out.append(" ".join(words))
    return out


def test_fingerprints_and_components(spark):
    rows = list(enumerate(texts()))
    rows.append(rows[0])
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in rows], DOCS)
    got = simhash.near_duplicates(df).collect()
    prints = [brute_print(t, 3) for _, t in rows]
    expect = brute_components(prints, 2)
    least = {r: min(rows[i][0] for i, x in enumerate(expect) if x == r) for r in expect}
    want = sorted((rows[i][0], prints[i], least[expect[i]]) for i in range(len(rows)))
    assert sorted((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got) == want
    assert len({w[2] for w in want}) < len({w[1] for w in want}), "near copies must be linked, not only equal ones"


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
@pytest.mark.parametrize("small", [2, 32])
def test_links_keep_components(spark, monkeypatch, radius, small):
    """Crowded buckets (here: of three) must connect what all pairs would."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(radius)
    prints = []
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(6 if radius > 2 else 25):
            for _ in range(rng.randint(0, radius + 1)):
                x ^= 1 << rng.randrange(64)
            prints.append(x)
    prints = sorted({p - 2**64 * (p >> 63) for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    found = {r.node: r.root for r in simhash.smallest_reachable(simhash.links(df, radius)).collect()}
    expect = brute_components([p % 2**64 for p in prints], radius)
    least = {r: min(p for p, x in zip(prints, expect, strict=True) if x == r) for r in expect}
    assert [found.get(p, p) for p in prints] == [least[r] for r in expect]


def test_masks_cover_every_difference():
    for radius in (1, 2):
        masks = simhash.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for i in range(64):
            for j in range(64 if radius > 1 else 1):
                gone = 1 << i | (1 << j if radius > 1 else 0)
                assert any(not m & gone for m in masks)


def test_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a bigint, b bigint")
    found = {r.node: r.root for r in simhash.smallest_reachable(edges).collect()}
    assert found == dict.fromkeys(range(n + 1), 0)
    assert simhash.smallest_reachable(edges.limit(0)).count() == 0


def test_one_of_each(spark):
    rows = [(5, "a b c d"), (3, "A B C D"), (3, "A B C D"), (None, "a b c d"), (8, "other words here now"), (None, "no id at all"), (9, None), (10, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, "A B C D"), (8, "other words here now"), (None, "no id at all"), (9, None)], key=str)
    assert simhash.one_of_each(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.limit(0).select("doc_id", "text")).count() == 0
