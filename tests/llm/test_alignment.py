"""Aligned tokens against plain loops with the libraries' own encoders on whole texts."""

import hashlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.plans import aligners

DOCS = "doc_id bigint, text string, pairs string, row string, n_a string, rest string"


def brute(rows):
    """The contract's columns by whole-text encoding and sets of byte ends."""
    import public_tokenizers as P
    import sentencepiece

    a_tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    entry = {i: e for e, i in a_tok.get_vocab().items()}
    back = {c: b for c, b in alignment._byte_alphabet().items()}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([b_tok.id_to_piece(i).startswith("<0x") and int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        groups = []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            ab, bb = [bytes(back[c] for c in entry[i]) for i in a], [b_bytes(i) for i in b]
            if b"".join(ab) == b"".join(bb) == (" " + text).encode():
                ends = [{sum(map(len, x[: k + 1])) for k in range(len(x))} for x in (ab, bb)] if len(ab) < 400 else None
                if ends is None:
                    ends = []
                    for x in (ab, bb):
                        at, seen = 0, set()
                        for t in x:
                            at += len(t)
                            seen.add(at)
                        ends.append(seen)
                common = ends[0] & ends[1]
                for ids, parts, side in ((a, ab, 0), (b, bb, 1)):
                    at, g = 0, 0
                    for i, t in zip(ids, parts, strict=True):
                        while len(groups) <= g:
                            groups.append(([], []))
                        groups[g][side].append(i)
                        at += len(t)
                        g += at in common
        docs.append((doc_id, groups))
    count = Counter(p for _, groups in docs for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for doc_id, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), digest))
    return out


ODD = [None, "", " ", "  ", "a", "a ", " a", "a  b", "a \n b", "\n", "x▁y", "▁", "it's we'll 'd", "<|endoftext|> and <|endoftext|>", "a<|endoftext|>b",
       "\x00 nul \x1c fs \x85 nel", "naïve déjà vu", "日本語のテキスト と English 混在", "🙂👩‍👩‍👧 emoji", "1234567890 12 3", "tab\tand\r\nline", "　wide　 space", "é é",
       "𝔘𝔫𝔦 ﻿ bom", "<0x41> <s> </s> <unk>", "x" * 3000, "日本" * 2000, "ab " * 5000, " " * 400 + "end", "== " * 300 + "\n\n\n   \t z"]


def rows_of(found):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found.collect()), key=str)


@pytest.mark.parametrize(("table", "lane", "links"), [(2_000_000, 128, 2_000_000), (50, 3, 7), (0, 1, 100)])
def test_odd_texts(spark, monkeypatch, table, lane, links):
    monkeypatch.setattr(alignment, "LANE_WORDS", lane)
    monkeypatch.setattr(alignment, "LINKS", links)
    rows = [*enumerate(ODD), (3, "repeated id"), (None, "no id"), (4, "a"), (4, "a")]
    df = spark.createDataFrame([(i, t, "p", "r", "n", "x") for i, t in rows], DOCS).repartition(3)
    assert rows_of(alignment.aligned_documents(df, aligners(), table_pairs=table)) == sorted(brute(rows), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = alignment.aligned_documents(docs, aligners(), table_pairs=2_000)
    assert rows_of(found) == sorted(brute(rows), key=str)


def test_group_of_many_links():
    import numpy as np

    a_ids, b_ids = np.array([1, 2, 1, 3]), np.array([5, 5, 6])
    one = [np.array([x]) for x in (0, 0, 4, 0, 3)]
    want = Counter((a, b) for a in a_ids.tolist() for b in b_ids.tolist())
    for most in (1, 2, 100):
        alignment.LINKS, before = most, alignment.LINKS
        keys, times = alignment._pairs(one[0], a_ids, b_ids, *one[1:])
        alignment.LINKS = before
        assert {(int(k) >> alignment.B_BITS, int(k) & 0x7FFF): int(n) for k, n in zip(keys, times, strict=True)} == want


def test_no_documents(spark):
    assert alignment.aligned_documents(spark.createDataFrame([], DOCS), aligners()).count() == 0
