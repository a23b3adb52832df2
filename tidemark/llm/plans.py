"""The registered queries of this package, each with its checking SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, decontaminate, languages, lexical, licences, mixing, multi_index, packing, pii, secrets, simhash, topk, urls
from tidemark.llm.common import held_out, learnable, table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.self_search(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids")


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"), licences.known_digests(spark))
    return found.select("doc_id", "text_licence", F.array_join("line_licences", ",").alias("line_licences"), "digest")


def _canonical_sql(text: str) -> str:
    """``licences.canonical`` as DuckDB SQL."""
    out = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"regexp_replace({out}, '{licences.COPYRIGHT}', ' ', 'g')"
    out = f"trim(regexp_replace(replace({out}, '&', ' and '), '{licences.NOT_WORD}', ' ', 'g'))"
    for old, new in licences.SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return out


def _known_sql() -> str:
    texts = [(name, wording) for name, title, words in licences.KNOWN for wording in (f"{title}\n{words}", words)]
    rows = ", ".join(f"({i}, '{name}', '{words.replace(chr(39), chr(39) * 2)}')" for i, (name, words) in enumerate(texts))
    return f"SELECT sha256({_canonical_sql('wording')}) AS digest, arg_min(licence, pos) AS licence FROM (VALUES {rows}) k(pos, licence, wording) GROUP BY 1"


OP3_SQL = f"""
WITH known AS ({_known_sql()}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs),
named AS (
  SELECT rid, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences
  FROM (SELECT rid, sha256({_canonical_sql("line")}) AS digest FROM lines WHERE line <> '') l JOIN known USING (digest) GROUP BY rid
), whole AS (SELECT rid, doc_id, sha256({_canonical_sql("text")}) AS digest FROM docs)
SELECT doc_id, licence AS text_licence, coalesce(line_licences, '') AS line_licences, digest
FROM whole LEFT JOIN known USING (digest) LEFT JOIN named USING (rid)
"""


def op4_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = languages.learn(docs.where(learnable(F.col("doc_id"), 4)))
    found = languages.identified(docs.select("doc_id", "text"), model)
    mixed = F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x.lang, F.round(x.share, 4).cast("string"))), ",")
    return found.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", "score", mixed.alias("mixture"), "accepted")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed by the session's ``tidemark.surrogateKey``; where that is unset, by a key good for trials alone."""
    key = spark.conf.get("tidemark.surrogateKey", "only for trials")
    found = pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    kinds = [(F.size("pii_kinds") - F.size(F.array_remove("pii_kinds", n))).cast("long").alias(f"n_{n}") for n in pii.KINDS]
    return found.select("doc_id", *kinds, "clean_text")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.scored(docs.select("doc_id", "text", held_out(F.col("doc_id"), 7).alias("held_out"), learnable(F.col("doc_id"), 7).alias("learn")))


def tokenizer(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """Arguments of ``packing.encoder``: files of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS_SQL} AS terms FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS_SQL} AS terms FROM benchmark),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY ALL),
postings AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, size GROUP BY term
), placed AS (SELECT d, doc_id, 75 + (25 * len(terms)::BIGINT * n_docs) // n_terms AS m FROM docs, size),
scored AS (
  SELECT i, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN placed USING (d) GROUP BY i, d
), ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored JOIN docs USING (d) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 20
"""


def aligners(first: str = "byte_bpe_50k", second: str = "piece_bpe_32k") -> tuple[str, str, str, str]:
    """Arguments of ``alignment.Pair``: files of the installed public vocabularies."""
    import public_tokenizers

    return (*tokenizer(first), public_tokenizers.path(f"{second}.model"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, sf_dir, "documents"), aligners())


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_topk": (op1_topk, OP1_SQL),
    "op2_decontaminate": (op2_decontaminate, None),
    "op3_licences": (op3_licences, OP3_SQL),
    "op4_languages": (op4_languages, None),
    "op5_pii": (op5_pii, None),
    "op6_secrets": (op6_secrets, None),
    "op7_mixing": (op7_mixing, None),
    "op8_packing": (op8_packing, None),
    "op9_simhash": (op9_simhash, None),
    "op10_urls": (op10_urls, None),
    "op11_lexical": (op11_lexical, OP11_SQL),
    "op12_alignment": (op12_alignment, None),
    "op13_nearest": (op13_nearest, None),
}
