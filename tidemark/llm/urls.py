"""URL filter: longest-rule verdicts, and gradient-boosted trees on lexical features for URLs that no rule covers."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii
from tidemark.session import keep

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

LEAST = 1_000  # different URLs of a verdict that training sees, if there are so many
SAMPLE = 20_000  # labelled URLs that train the trees, expected
SUFFIXES = 4096  # hashed host suffixes with statistics


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at > 0, F.lit(False)), F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def ruled(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        rule = F.when(fits, F.lit(domain + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    letters = F.array_distinct(F.split(text, ""))
    bits = F.aggregate(
        letters,
        F.lit(0.0),
        lambda total, c: total + F.when(c == "", 0.0).otherwise((size - F.length(F.replace(text, c, F.lit("")))) / size * F.log2(size / (size - F.length(F.replace(text, c, F.lit("")))))),
    )
    return F.when(size > 0, bits).otherwise(0.0)


FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens",
    "host_entropy", "path_entropy", "parameters", "query_length", "has_fragment", "secure", "suffix_rate", "suffix_weight",
)


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def with_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with all lexical features but the suffix statistics, and the suffix bucket."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = lambda c: F.length(c).cast("double")
    suffix = F.concat_ws(".", F.slice(F.split(host, r"\."), -1, 1), F.get(F.split(path, "/"), F.lit(1)))
    return urls.select(
        "*",
        size(url).alias("url_length"),
        size(host).alias("host_length"),
        size(path).alias("path_length"),
        _count(path, "/").cast("double").alias("depth"),
        (_count(host, ".") + 1).cast("double").alias("labels"),
        F.when(F.length(url) > 0, _count(url, "0123456789") / F.length(url)).otherwise(0.0).alias("digit_ratio"),
        _count(host, "0123456789").cast("double").alias("host_digits"),
        _count(url, "-").cast("double").alias("hyphens"),
        entropy(host).alias("host_entropy"),
        entropy(path).alias("path_entropy"),
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0).alias("parameters"),
        size(query).alias("query_length"),
        F.contains(url, F.lit("#")).cast("double").alias("has_fragment"),
        url.startswith("https").cast("double").alias("secure"),
        F.pmod(F.xxhash64(F.coalesce(suffix, F.lit(""))), F.lit(SUFFIXES)).cast("int").alias("suffix"),
    )


def judge(pages: DataFrame, url: str = "url", row_id: str = "page_id", rules=RULES, sample: int = SAMPLE, trees: int = 12, depth: int = 4, seed: int = 42) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) for every row.

    URLs that a rule covers are the labelled ones. The trees learn from about ``sample`` different labelled URLs, chosen by
    hash before anything is shuffled, each verdict in its share but with ``LEAST`` URLs or all it has; suffix statistics
    count all labelled rows, in a fixed number of hashed buckets, less the learned row's own URL while learning. A URL without a rule is blocked
    at a score over one half. Without labelled URLs of both kinds there is nothing to learn: all such URLs get the only
    kind there is, or ``allow``. Null URLs count as empty. Repeated rows are judged each.
    """
    rows = pages.select(F.col(f"`{row_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = ruled(rules, F.col("host"), F.col("path"))
    rows = keep(with_features(rows.withColumns({"rule": rule, "given": verdict})), "urls")

    labelled = rows.where("given is not null").withColumn("label", (F.col("given") == "block").cast("double"))
    suffixes = labelled.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))
    suffixes = keep(suffixes, "url-suffixes")  # SUFFIXES rows at most
    totals = suffixes.agg(F.sum("n"), F.sum("blocked")).first()
    seen, blocked = totals[0] or 0, totals[1] or 0.0
    prior = blocked / seen if seen else 0.0

    def whole(frame, own_n=F.lit(0), own_blocked=F.lit(0.0)):
        joined = frame.join(F.broadcast(suffixes), "suffix", "left")
        n, hits = F.coalesce("n", F.lit(0)) - own_n, F.coalesce("blocked", F.lit(0.0)) - own_blocked
        return joined.select(*frame.columns, ((hits + 10 * prior) / (n + 10)).alias("suffix_rate"), F.log1p(n.cast("double")).alias("suffix_weight"))

    score = F.lit(1.0 if blocked else 0.0)
    judged = rows
    if 0 < blocked < seen:
        parts = 1 << 40
        different = {r.label: r.n for r in labelled.groupBy("label").agg(F.approx_count_distinct("url").alias("n")).collect()}  # two rows
        shares = {x: max(sample / sum(different.values()), LEAST / n) for x, n in different.items()}
        limit = {x: int(min(1.0, share) * parts) for x, share in shares.items()}
        bar = F.when(F.col("label") == 1.0, F.lit(limit[1.0])).otherwise(F.lit(limit[0.0]))
        some = labelled.where(F.pmod(F.xxhash64("url"), F.lit(parts)) < bar)
        chosen = some.groupBy("url").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("suffix", "label", *FEATURES[:-2])))
        chosen = keep(whole(chosen, F.col("copies"), F.col("copies") * F.col("label")).orderBy("url").coalesce(4), "url-sample")
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
        learner = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.3, cacheNodeIds=False)
        if chosen.select("label").distinct().count() == 2:
            model = learner.fit(vectors.transform(chosen).select("features", "label"))
            model.setProbabilityCol("probability")
            judged = model.transform(vectors.transform(whole(rows)))
            score = vector_to_array("probability")[1]
        else:
            score = F.lit(prior)
    decided = F.coalesce("given", F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))
    return judged.withColumn("block_score", score).select("page_id", "host", "path", "rule", decided.alias("verdict"), "block_score")
