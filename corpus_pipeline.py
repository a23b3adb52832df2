"""A cleaning pipeline over ``documents``: each stage works on what its predecessor kept, stored as Parquet.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, languages, packing, secrets
from tidemark.llm.common import learnable, table, unused
from tidemark.llm.plans import tokenizer
from tidemark.session import keep


def _with(df: DataFrame, columns: list[str], changed: dict | None = None) -> DataFrame:
    """The columns of a stage's input, some of them changed; what the stage added beside them goes."""
    return df.select(*((changed or {}).get(c, F.col(f"`{c}`")).alias(c) for c in columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay and carry the language found.

    Null texts, texts without a letter, and texts less likely in every known language than letters at random go. Where
    nothing could be learned, texts with a letter stay with the language they have.
    """
    model = languages.learn(docs.where(learnable(F.col("doc_id"), 4)))
    if not model[0]:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    into = unused(docs.columns, "language")
    found = languages.identified(docs, model, into=into).where(F.col(into)["accepted"])
    return _with(found, docs.columns, {"lang": F.col(into)["lang_pred"]})


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word Jaccard 0.8) stays, that with the smallest doc_id.

    Pairs come from SimHash fingerprints under covering masks, and from MinHash bands where those differ in too many bits.
    """
    return jaccard.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    name = unused(docs.columns, "held_items")
    marked = decontaminate.marked(docs, table(spark, sf_dir, "benchmark"), name=name)
    return _with(marked.where(F.size(name) == 0), docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets are masked in their texts, and n_chars follows."""
    spans, clean = unused(docs.columns, "found_secrets"), unused(docs.columns, "masked_text")
    found = secrets.with_secrets(docs, found=spans, clean=clean)
    n_chars = F.when(F.size(spans) > 0, F.length(clean).cast("long")).otherwise(F.col("n_chars"))
    return _with(found, docs.columns, {"text": F.col(clean), "n_chars": n_chars})


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences, with their token ids."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("benchmark_free", benchmark_free),
    ("without_secrets", without_secrets),
    ("packed", packed),
]

# The stages predict, hash, lex and pack in ways that SQL does not express; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
