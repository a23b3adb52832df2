"""Language identification of mixed texts: expectation-maximisation over n-gram likelihoods.

A word is a bag of letter trigrams; each language gives it a likelihood. The document is a mixture of languages whose
proportions maximise the likelihood of its words. The set of languages grows while a further language gains more
likelihood than its penalty.
"""

from __future__ import annotations

import math
import re
from unicodedata import category
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import unused

BUCKETS = 1 << 15  # hashed trigrams of the model
SAMPLE = 2000  # labelled documents that teach one language, expected
MOST = 500  # languages, the commonest first
STEPS = 12
WORDS_KEPT = 50_000
MISC = "und"

# Signs that Python counts among the letters of words and Unicode among the numbers: superscripts, fractions, Roman numerals.
_NUMERALS = frozenset(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isdecimal() and not category(c).startswith("L"))
_AS_SPACES = dict.fromkeys(map(ord, _NUMERALS), " ")
_WORD = re.compile(r"[^\W\d_]+")

RESULT = "lang_pred string, score double, accepted boolean, languages array<struct<lang:string,share:double>>"


def letters(text: str | None) -> list[str]:
    lower = (text or "").lower()
    if not lower.isascii() and not _NUMERALS.isdisjoint(lower):
        lower = lower.translate(_AS_SPACES)
    return _WORD.findall(lower)


def grams(word: str) -> list[int]:
    """Buckets of the word's trigrams, ends marked."""
    padded = f"^{word}$"
    return [crc32(padded[i : i + 3].encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(padded) - 2)]


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE):
    """(languages, log likelihood of each bucket by language) from rows with a text and a language.

    Counts come from the whole texts of about ``sample`` rows a language, chosen by hash, for at most ``MOST`` languages,
    so the model has a fixed size; everything after it covers all rows.
    """
    import numpy as np

    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST).collect()
    if not sizes:
        return [], np.zeros((0, BUCKETS), np.float32)
    parts = 1 << 30
    shares = {r.lang: min(parts, math.ceil(parts * sample / r.n)) for r in sizes}
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    # Repeated texts have one hash and would come or go together: the row's own place is hashed too.
    mark = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(parts))
    chosen = rows.where(mark < share)

    def count(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [g for w in letters(text) for g in grams(w)]
                if found:
                    into = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                    into += np.bincount(found, minlength=BUCKETS)
        for name, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used])], names=["lang", "bucket", "n"])

    totals = chosen.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = totals.collect()  # at most BUCKETS rows a language
    languages = sorted({r.lang for r in found})
    counts = np.zeros((len(languages), BUCKETS))
    for r in found:
        counts[languages.index(r.lang), r.bucket] = r.n
    smooth = counts + 0.5
    return languages, np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32) if languages else counts


def mixture(likelihood, counts, shares, steps: int = STEPS):
    """Proportions after ``steps`` rounds, and the log likelihood of words (rows) that occur ``counts`` times."""
    import numpy as np

    peak = likelihood.max(1, keepdims=True)
    scaled = np.exp(likelihood - peak)
    for _ in range(steps):
        parts = scaled * shares
        total = parts.sum(1)
        shares = (counts / total) @ parts / counts.sum()
    return shares, float(counts @ (np.log(scaled @ shares) + peak[:, 0]))


def best_set(likelihood, counts, penalty: float):
    """(members, proportions, log likelihood) of the language set chosen by penalised likelihood, one at a time."""
    import numpy as np

    alone = counts @ likelihood
    members = [int(alone.argmax())]
    shares, value = np.ones(1), float(alone[members[0]])
    while len(members) < likelihood.shape[1]:
        # The newcomer that most words would gain from, judged by its own likelihood above the present mixture's.
        peak = likelihood.max(1)
        now = np.log(np.exp(likelihood[:, members] - peak[:, None]) @ shares + 1e-300) + peak
        gain = counts @ np.maximum(likelihood - now[:, None], 0)
        gain[members] = -1
        new = int(gain.argmax())
        if gain[new] <= penalty:  # an upper bound of what it can add
            break
        trial = [*members, new]
        found, better = mixture(likelihood[:, trial], counts, np.append(shares * 0.9, 0.1))
        if better - value <= penalty:
            break
        members, shares, value = trial, found, better
    return members, shares, value


def predictor(languages, table):
    """text -> (language, score, accepted, [(language, share), ...])."""
    import numpy as np

    known: dict[str, int] = {}
    rows = np.zeros((1024, len(languages) + 1), np.float32)

    def learn_words(words):
        nonlocal rows
        flat, sizes = [], []
        for w in words:
            g = grams(w)
            flat += g
            sizes.append(len(g))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        sums = np.add.reduceat(table[:, flat], starts, axis=1).T
        at = len(known)
        while len(rows) < at + len(words):
            rows = np.concatenate((rows, np.zeros_like(rows)))
        rows[at : at + len(words), :-1] = sums
        rows[at : at + len(words), -1] = sizes
        known.update(zip(words, range(at, at + len(words)), strict=True))

    def predict(texts):
        if len(known) > WORDS_KEPT:
            known.clear()
        split = [letters(t) for t in texts]
        missing = list(set().union(*split).difference(known)) if languages else []
        if missing:
            learn_words(missing)
        for words in split:
            if not words or not languages:
                yield MISC, 0.0, False, []
                continue
            which, counts = np.unique(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), return_counts=True)
            found = rows[which].astype(float)
            counts = counts.astype(float)
            total = float(counts @ found[:, -1])
            members, shares, value = best_set(found[:, :-1], counts, 3.0 + 0.5 * math.log(total))
            order = np.argsort(-shares, kind="stable")
            listed = [(languages[members[i]], float(shares[i])) for i in order]
            # No language: less likely than letters at random, by more than chance allows in a short text.
            accepted = value > -total * math.log(BUCKETS) - 10.0
            yield listed[0][0], min(1.0, max(0.0, listed[0][1])), accepted, listed

    return predict


def identified(docs: DataFrame, model, text: str = "text", into: str | None = None) -> DataFrame:
    """All columns of ``docs`` with lang_pred, score, accepted and the mixture ``languages``.

    ``score`` is the share of the first language. A null text or one without a letter is ``und`` with score 0 and not
    accepted; so is every text when nothing could be learned. Equal shares go to the language chosen first. Only the text
    is looked at; each row is judged by itself, whole. Columns of ``docs`` with the names of results are replaced, unless
    ``into`` names one struct column for all results.
    """
    names, table = model
    extra = T.StructType.fromDDL(RESULT)
    clash = {into} if into else {f.name for f in extra.fields}
    kept = [c for c in docs.columns if c not in clash]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias(unused(kept, "text")))
    added = [T.StructField(into, extra)] if into else extra.fields
    schema = T.StructType([*source.schema.fields[:-1], *added])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        predict = predictor(names, table)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                found = list(predict(some.column(len(kept)).to_pylist()))
                mixed = [[{"lang": a, "share": b} for a, b in f[3]] for f in found]
                columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_()), pa.array(mixed, to_arrow_type(extra["languages"].dataType))]
                if into:
                    columns = [pa.StructArray.from_arrays(columns, names=extra.names)]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], *columns], names=schema.names)

    return source.mapInArrow(run, schema)
