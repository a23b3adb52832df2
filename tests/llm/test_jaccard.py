"""Near copies of the pipeline against brute force over all pairs."""

import random

import corpus_pipeline
import pytest

from tidemark.llm import jaccard

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_kept(rows, words=5, least=0.8):
    """The smallest id of each component over all pairs of sets."""
    def cut(text):
        tokens = (text or "").encode().lower().split()
        return frozenset(tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))) if tokens else frozenset()

    sets = {}
    for i, text in rows:
        sets.setdefault(cut(text), []).append(i)
    nodes = list(sets)
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    linked = 0
    for i, a in enumerate(nodes):
        for j in range(i):
            if a and nodes[j] and len(a & nodes[j]) >= least * len(a | nodes[j]):
                root[find(i)] = find(j)
                linked += 1
    groups = {}
    for i, a in enumerate(nodes):
        groups.setdefault(find(i), []).extend(sets[a])
    return {min(g) for g in groups.values()}, linked


def texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    out = [None, "", " \n", "Few words", "few WORDS", "one two three four five", "one two three four six"]
    for n in (60, 200, 400):
        base = [word() for _ in range(n)]
        for _ in range(30):  # about one in 50 words changed: on both sides of the limit
            out.append(" ".join(w if rng.random() > 0.02 else word() for w in base))
    chain = [word() for _ in range(200)]
    for n in range(20):  # neighbours are near copies, ends are not
        chain[n * 10] = word()
        out.append(" ".join(chain))
    return out


@pytest.mark.parametrize("small", [2, 16])
def test_stage_against_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    rows = list(enumerate(texts()))
    random.Random(1).shuffle(rows)
    rows.append(rows[0])
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = corpus_pipeline.near_copies(spark, df, "").select("doc_id").collect()
    want, linked = brute_kept(rows)
    assert linked > 100 and len(want) < len(rows) - 50
    assert sorted(r.doc_id for r in kept) == sorted(want)


def test_fingerprints_find_near_copies_by_themselves(spark, monkeypatch):
    """With bands that never meet, pairs within the radius are still found, and checked by their exact sets."""
    rng = random.Random(3)
    base = [[f"w{rng.randint(0, 10**6)}" for _ in range(3000)] for _ in range(6)]
    rows = [(10 * i + j, " ".join([*words, *["end"] * (j > 0), *["more"] * (j > 1)])) for i, words in enumerate(base) for j in range(3)]
    monkeypatch.setattr(jaccard, "band_keys", lambda hashes, factors: [])
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    prints = {r.doc_id: r["print"] for r in jaccard.with_sets(df, "text", 5, True).collect()}
    assert all((prints[10 * i] ^ prints[10 * i + 1]).bit_count() <= jaccard.RADIUS for i in range(6))
    kept = corpus_pipeline.near_copies(spark, df, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(brute_kept(rows)[0]) == [10 * i for i in range(6)]


def test_no_documents(spark):
    df = spark.createDataFrame([], DOCS)
    assert corpus_pipeline.near_copies(spark, df, "").count() == 0


@pytest.mark.parametrize("changed", [0.06, 0.012])
def test_compared_pairs_do_not_grow_with_the_square_of_a_group(spark, monkeypatch, changed):
    """Texts of one base share most bands: far ones never become pairs, copies meet at a few of them."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(300)]
    rows = [(i, " ".join(w if rng.random() > changed else word() for w in base)) for i in range(120)]
    compared, similar = [], jaccard.similar
    monkeypatch.setattr(jaccard, "similar", lambda pairs, *rest: (compared.append(pairs.count()), similar(pairs, *rest))[1])
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = corpus_pipeline.near_copies(spark, df, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(brute_kept(rows)[0])
    assert sum(compared) < 15 * len(rows)  # of 7,140 pairs


def test_parities_rule_out_no_similar_pair(spark):
    """Sets at exactly the similarity pass, whatever their size; far ones do not."""
    rng = random.Random(9)
    rows, far = [], []
    for n in (10, 90, 900, 9000):
        shared = [rng.getrandbits(64) for _ in range(n * 8 // 9)]
        more = [rng.getrandbits(64) for _ in range(n * 2 // 9)]
        rows.append((shared + more[: len(more) // 2], shared + more[len(more) // 2 :]))
        far.append((more, shared))

    def passes(pairs):
        import numpy as np

        words = lambda x: [int(p) for p in jaccard.parities(np.unique(np.array(x, "<u8")))]
        df = spark.createDataFrame([(words(a), words(b), len(a), len(b)) for a, b in pairs], "a array<bigint>, b array<bigint>, m bigint, n bigint")
        return [r.x for r in df.select(jaccard.alike_in_parity(df.a, df.b, df.m, df.n, 0.8).alias("x")).collect()]

    assert passes(rows) == [True] * 4
    assert passes(far[1:3]) == [False] * 2
