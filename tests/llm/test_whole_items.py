"""op2: items whose windows hold more values than words, names at starts, repeated values, unspaced scripts."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate

APPLES = "Alice has 5 apples. Bob has 3 apples. How many apples do they have?"
SUM = "What is 12 + 34 + 56 + 78 + 90?"


def held(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {r.doc_id: r.item_ids for r in decontaminate.marked(docs, bench).collect()}
    return [found[i] for i in range(len(texts))]


def test_number_dense_items(spark):
    texts = ["So: " + SUM + " Well", SUM.replace("12", "7").replace("90", "4"), "What is 1 + 2?", "rows 1 2 3 4 5 6 7 8 9", "x 11 12 13 14 15 16 17 y"]
    assert held(spark, texts, [SUM, "11 12 13 14 15 16"]) == [[0], [0], [], [], [1]]


@pytest.mark.parametrize("lead", ["", "so ", "It begins.\n", "Q: "])
def test_names_at_starts(spark, lead):
    other = APPLES.replace("Alice", "Zoe").replace("Bob", "Ivan").replace("5", "41").replace("3", "8")
    same = APPLES.replace("5", "4").replace("3", "4")  # two values become one
    two = APPLES.replace("Alice", "Bob", 1)
    split = "Alice has 5 apples. Alice has 5 pears and 5 plums, how many does Alice have"
    torn = split.replace("5 pears", "6 pears")
    texts = [lead + other, lead + same, lead + two, lead + torn, lead + APPLES.lower()]
    assert held(spark, texts, [APPLES, split]) == [[0], [0], [0], [], [0]]


def test_unspaced_scripts(spark):
    item = "小明有五个苹果他吃了两个还剩几个"
    assert held(spark, ["前面的话" + item + "后面的话", "小明去学校", "ก" + "ประเทศไทยมีกี่จังหวัด"], [item, "ประเทศไทยมีกี่จังหวัด"]) == [[0], [], [1]]
    tokens = spark.range(1).select(decontaminate.surface_tokens(F.lit("日本のTokyo 12")).alias("t")).first().t
    assert [t.strip(decontaminate.START) for t in tokens] == ["日", "本", "の", "Tokyo", "12"]


FRUIT = "A farmer sold 3 apples and walked 60 km to the town before he bought 5 new hens for his old barn"


@pytest.mark.parametrize(
    "said",
    [
        FRUIT.replace("3 apples", "three apples"),
        FRUIT.replace("60 km", "60 kilometres"),
        FRUIT.replace("60 km", "1 000 km"),
        FRUIT.replace("60 km", "70 kilometers").replace("5 new", "nine new"),
        FRUIT.upper().replace("KM", "km").lower(),
    ],
)
def test_number_words_and_unit_spellings(spark, said):
    filler = "Some other words that stand before and after it are here"
    assert held(spark, [f"{filler}. {said}. {filler}", filler], [FRUIT]) == [[0], []]


SAID = {**decontaminate.NUMBER_WORDS, **{w: u for w, u in decontaminate.UNIT_OF.items() if len(w) > 1}}


def seen(token):
    """(value, kind, may be a name) of a surface token."""
    bare = token.strip("\ue000\ue001\ue002").lower()
    kind = {decontaminate.NAME: "name", decontaminate.UNIT: "unit"}.get(token[0])
    kind = kind or ("unit" if token in "%$€£°" else "number" if token[0].isdecimal() or bare in decontaminate.NUMBER_WORDS else None)
    return SAID.get(bare, bare), kind, token[0] in "\ue000\ue002"


def brute_templates(doc, items, least=13):
    """Items with a run of ``least`` tokens in line (or all) that match one by one, slots by kind and one value for each."""
    out = []
    for i, item in items:
        need = min(least, len(item))
        hit = False
        for shift in range(need - len(item), len(doc) - need + 1) if len(item) >= 5 else ():
            run = []
            for k in range(max(0, -shift), len(item) + 1):
                a, b = (item[k], doc[k + shift]) if k < len(item) and k + shift < len(doc) else (None, None)
                if a and (a[0] == b[0] or (a[2] and b[2]) or (a[1] and a[1] == b[1])):
                    run.append((a[0], b[0], a[1] is None and a[0] == b[0]))
                    continue
                if len(run) >= need:
                    slots = {(x, y) for x, y, word in run if not word}
                    hit |= len({x for x, _ in slots}) == len(slots) and (any(w for _, _, w in run) or all(x == y for x, y, _ in run))
                if not b:
                    break
                run = []
        if hit:
            out.append(i)
    return out


def test_every_document_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r.text and len(r.text) < 4000][:40]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    cut = [t.split() for _, t in items]
    # Templates of the items with other values, around words of the documents.
    docs += [" ".join([*docs[i].split()[:9], *(w if not w[:1].isupper() else "Zora" + w[0].lower() * (len(w) % 3) for w in c[: 13 + i]), *docs[i + 1].split()[:9]]) for i, c in enumerate(cut[:25])]
    texts = sorted({*docs, *(t for _, t in items)})
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", decontaminate.surface_tokens(F.col("text")).alias("t"))
    tokens_of = {r.text: [seen(t) for t in r.t] for r in frame.collect()}
    numbered = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    found = {r.doc_id: r.item_ids for r in decontaminate.marked(numbered, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = {i: brute_templates(tokens_of[t], [(i, tokens_of[x]) for i, x in items]) for i, t in enumerate(docs)}
    assert sum(map(bool, want.values())) > 10
    assert found == want
