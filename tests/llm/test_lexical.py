"""Ranked lists against plain loops over every document."""

import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm import lexical

DOCS = "doc_id bigint, text string, m string, words string, row string, item string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(docs, items, k=20):
    cut = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    cut = [c for c in cut if c[2]]
    n_docs, n_terms = len(cut), sum(c[2] for c in cut)
    df = Counter(t for c in cut for t in c[1])
    out = []
    for item, text in items:
        scored = []
        for i, counts, n in cut:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m)) for t in terms(text) if t in counts)
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "m", "w", "r", "i") for i, t in rows], DOCS).repartition(3)


def rows_of(found):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=str)


def corpus(n=400):
    rng = random.Random(5)
    words = [*"abcdefghijklmnopqrst", "Été", "naïve", "x1", "日本", "NULL", "Ⅷ"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 2, 3, 8, 8, 8, 20, 60, 300]))) for _ in range(n)]
    docs = [*enumerate(texts), *[(n + i, texts[7]) for i in range(60)], (3, texts[7]), (None, texts[9]), (None, None), (9, ""), (10, "-- !"), (11, "a " * 5000)]
    items = [(0, "a b B c"), (1, "été É Été naïve"), (2, None), (3, "nowhere"), (4, texts[7]), (5, texts[20] + " " + texts[40]), (5, "日本,x1"), (None, "t s r"), (6, "{}[]"), (0, "a b B c")]
    return docs, items


@pytest.mark.parametrize(("block", "asked", "first", "growth", "k"), [(400_000, 1_000_000, 4, 8, 20), (30, 10, 1, 2, 3), (200, 1_000, 2, 3, 1000)])
def test_against_every_document(spark, monkeypatch, block, asked, first, growth, k):
    monkeypatch.setattr(lexical, "FIRST_VISITS", first)
    monkeypatch.setattr(lexical, "GROWTH", growth)
    docs, items = corpus()
    blocks = lexical.index(frame(spark, docs), block_postings=block)
    assert blocks.agg({"n_docs": "sum"}).first()[0] == sum(bool(terms(t)) for _, t in docs)
    found = lexical.search(blocks, frame(spark, items).withColumnRenamed("doc_id", "item_id"), k, asked=asked)
    assert rows_of(found) == brute(docs, items, k)


def test_blocks_are_bounded(spark):
    docs = [(i, "same words here") for i in range(500)]
    sizes = [r.n_docs for r in lexical.index(frame(spark, docs), block_postings=60).collect()]
    assert sum(sizes) == 500 and max(sizes) < 60


def test_nothing(spark):
    none, some = frame(spark, []), frame(spark, [(1, "a b")])
    for docs, items in ((none, some), (some, none), (none, none), (frame(spark, [(1, None), (2, ".")]), some)):
        found = lexical.search(lexical.index(docs), items.withColumnRenamed("doc_id", "item_id"))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
