"""Every stage against what its operator finds, and the contract of the entry."""

import os
import sys

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.llm import decontaminate, secrets, simhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_jaccard import brute_kept  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(50_001, None, "en", "s", 0), (50_002, "12 !", "en", "s", 4), (50_003, "", None, None, None)]
    start = docs.unionByName(spark.createDataFrame(extra, docs.schema)).cache()
    kept = {"start": start}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[list(kept)[-1]], SF)
        out.write.parquet(str(tmp_path / name))
        kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packed":
            assert kept[name].columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_copies", "benchmark_free", "without_secrets", "packed"]
    ids = {n: {r.doc_id for r in f.select("doc_id").distinct().collect()} for n, f in kept.items()}
    # Only the texts without a letter go for their language.
    assert ids["start"] - ids["language_id"] == {50_001, 50_002, 50_003}
    rows = [(r.doc_id, r.text) for r in kept["language_id"].collect()]
    assert ids["near_copies"] == brute_kept(rows)[0] and len(ids["near_copies"]) < len(ids["language_id"])
    leaks = decontaminate.marked(kept["near_copies"], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids["near_copies"] - ids["benchmark_free"] == {r.doc_id for r in leaks.where(F.size("item_ids") > 0).collect()}
    assert ids["without_secrets"] == ids["benchmark_free"] == ids["packed"]
    before = {r.doc_id: r.text for r in kept["benchmark_free"].collect()}
    for r in kept["without_secrets"].collect():
        assert r.text == secrets.masked(before[r.doc_id], secrets.spans(before[r.doc_id]))
        assert not any(s[0] in ("access", "hex") for s in secrets.spans(r.text))


CLASHING = [
    "_hash", "_length", "_row", "_node", "_raw_text", "_bands", "_secrets", "_clean", "score", "accepted", "lang_pred", "languages", "item_ids",
    "row", "node", "size", "text_", "_text", "language", "held_items", "found_secrets", "masked_text", "near_row", "near_node", "hash", "length", "id", "print", "_print",
]


def test_stages_leave_other_columns_alone(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        assert found.columns == docs.columns
        rows = found.collect()
        assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHING)
        docs = found
    assert corpus_pipeline.packed(spark, docs, SF).count() > 0
    again = simhash.one_of_each(docs).collect()
    assert again and all(r[c] == f"{c}-{r.doc_id}" for r in again for c in CLASHING)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = docs if "sequence_id" in out.columns else out


def test_contract():
    queries = contract.queries()
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} <= {"pipeline"} | {q.split("_")[0] for q in queries if q.startswith("op")}
    assert set(contract.oracle_sql()) <= set(queries)
