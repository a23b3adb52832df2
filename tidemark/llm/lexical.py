"""Ranked lexical search over a length-stratified index.

Documents of one length normaliser m form a stratum. A stratum is stored as blocks of bounded size; a block holds its
documents' ids and, for each term and number of occurrences tf, the documents that have it so often. Inside a stratum the
contribution of a term depends on tf alone, so it is worked out once for each (term, tf) and added to all its documents.

The greatest tf of each term gives every stratum an upper bound for every item. Strata are visited in the order of their
bounds, in rounds; after a round each item knows its k-th best score so far, and a stratum whose bound is below it is never
read for that item. The last round visits every stratum that is left and can still matter, so the result is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table_within
from tidemark.session import keep, new_folder

BLOCK_POSTINGS = 100_000  # of one block, as expected; a document with more of them is a block by itself
BLOCKS_A_FILE = 32  # readers take a file's blocks together
ASKED = 1_000_000  # (item, term) rows searched at once, as expected; more items are searched in further passes
FIRST_VISITS, GROWTH = 4, 8  # strata of the first round, and how much further each next round goes

TERMS = "doc_id bigint, n bigint, words binary, counts binary"
BLOCK = (
    "m bigint, block int, n_docs bigint, n_terms bigint, docs array<bigint>, terms array<string>, "
    "of_term array<int>, tf array<int>, size array<int>, members array<int>"
)
HITS = "item bigint, score bigint, doc_id bigint"


def _term_bytes() -> bytes:
    """Every byte that is no ASCII letter or digit and below 0x80 becomes a space; A-Z are lower-cased."""
    inside = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
    return bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in inside else 0x20 for b in range(256))


def _terms(batches):
    """(doc_id, n, different terms, their counts) of texts that have a term."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    to = _term_bytes()
    names = ["doc_id", "n", "words", "counts"]
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            ids, out = [], []
            for i, x in enumerate(some.column(1)):
                found = Counter((x.as_py() or b"").translate(to).split())
                if found:
                    ids.append(i)
                    out.append((found.total(), b" ".join(found), np.fromiter(found.values(), "<u4", len(found)).tobytes()))
            columns = [some.column(0).take(pa.array(ids, pa.int64()))]
            columns += [pa.array([r[c] for r in out], k) for c, k in enumerate([pa.int64(), pa.binary(), pa.binary()])]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _inverted(table):
    """One block: documents of a stratum turned into postings by term and tf."""
    import numpy as np
    import pyarrow as pa

    words = [w.as_py().split(b" ") for w in table.column("words")]
    per_doc = np.fromiter(map(len, words), np.int64, len(words))
    coded = pa.array([w for some in words for w in some], pa.binary()).dictionary_encode()
    tf = np.concatenate([np.frombuffer(c.as_py(), "<u4") for c in table.column("counts")]).astype(np.int64)
    term = coded.indices.to_numpy().astype(np.int64)
    member = np.repeat(np.arange(len(words)), per_doc)
    order = np.lexsort((tf, term))
    term, tf, member = term[order], tf[order], member[order]
    first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])))
    size = np.diff(np.append(first, len(term)))

    def listed(values, kind):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    docs = table.column("doc_id").combine_chunks()
    columns = [
        table.column("m").slice(0, 1).combine_chunks(),
        table.column("block").slice(0, 1).combine_chunks(),
        pa.array([len(words)], pa.int64()),
        pa.array([int(np.asarray(table.column("n")).sum())], pa.int64()),
        listed(docs, pa.int64()),
        listed(coded.dictionary.cast(pa.string()), pa.string()),
        listed(term[first], pa.int32()),
        listed(tf[first], pa.int32()),
        listed(size, pa.int32()),
        listed(member, pa.int32()),
    ]
    return pa.Table.from_arrays(columns, names=["m", "block", "n_docs", "n_terms", "docs", "terms", "of_term", "tf", "size", "members"])


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The index of all documents that have a term, a table of blocks, see ``BLOCK``; each file holds blocks in the order of m.

    Repeated rows and ids are documents of their own, a null id stays null, other columns are ignored. A stratum of many
    documents is dealt to as many blocks as its postings need, so no length is hot.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    found = keep(rows.mapInArrow(_terms, TERMS), "lexical-terms")
    n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"75 + (25 * n * {n_docs}L) div {max(1, n_terms)}L")
    placed = found.select("doc_id", "n", "words", "counts", m.alias("m"), F.monotonically_increasing_id().alias("row"))
    postings = F.sum((F.octet_length("counts") / 4).cast("long"))
    # The lengths of all documents add up to L, so there are no more than sqrt(50 N) + 1 strata.
    strata = keep(placed.groupBy("m").agg(F.ceil(postings / block_postings).cast("int").alias("parts")), "lexical-strata")
    dealt = placed.join(table_within(strata, 16), "m").select("doc_id", "n", "words", "counts", "m", F.pmod(F.xxhash64("row"), "parts").cast("int").alias("block"))
    blocks = dealt.groupBy("m", "block").applyInArrow(_inverted, BLOCK)
    path = new_folder(docs.sparkSession, "lexical-index")
    blocks.write.option("maxRecordsPerFile", BLOCKS_A_FILE).parquet(path)
    return docs.sparkSession.read.schema(blocks.schema).parquet(path)


def _occurring(vocabulary):
    """(m, term, df, most) of the asked terms of each block; ``term`` is a position in ``vocabulary``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        asked = pa.array(vocabulary, pa.string())
        for batch in batches:
            for r in range(batch.num_rows):
                at = pc.index_in(batch.column("terms")[r].values, asked).fill_null(-1).to_numpy(zero_copy_only=False)
                of_term, tf, size = (np.asarray(batch.column(c)[r].values) for c in ("of_term", "tf", "size"))
                df, most = np.bincount(of_term, size, len(at)).astype(np.int64), np.zeros(len(at), np.int64)
                most[of_term] = tf  # by ascending tf, so the last is the greatest
                here = np.flatnonzero(at >= 0)
                m = np.full(len(here), batch.column("m")[r].as_py(), np.int64)
                columns = [pa.array(x, pa.int64()) for x in (m, at[here], df[here], most[here])]
                yield pa.RecordBatch.from_arrays(columns, names=["m", "term", "df", "most"])

    return run


def _bounded(items, terms, weights):
    """(m, item, bound): no document of the stratum scores more for the item. ``weights`` hold the items' repeats."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n_items, n_terms = int(items.max(initial=-1)) + 1, int(terms.max(initial=-1)) + 1
        for batch in batches:
            for r in range(batch.num_rows):
                m = batch.column("m")[r].as_py()
                here = batch.column("seen")[r].values
                term, most = np.asarray(here.field("term")), np.asarray(here.field("most"))
                best = np.zeros(n_terms, np.int64)
                best[term] = 1_000_000_000 * most // (1000 * most + 12 * m)
                bound = np.zeros(n_items, np.int64)
                np.add.at(bound, items, weights * best[terms])
                at = np.flatnonzero(bound > 0)
                columns = [pa.array(x, pa.int64()) for x in (np.full(len(at), m), at, bound[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["m", "item", "bound"])

    return run


def _scored(vocabulary, items, terms, weights, k):
    """The k best documents of each item among the blocks of a task, of those that reach the item's least score."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        asked = pa.array(vocabulary, pa.string())
        starts = np.searchsorted(items, np.arange(int(items.max(initial=-1)) + 2))
        best: dict[int, tuple] = {}  # item -> scores, ids, null ids
        least: dict[int, int] = {}

        def merged(item, score, ids, none):
            if item in best:
                score, ids, none = (np.concatenate(x) for x in zip(best[item], (score, ids, none), strict=True))
            order = np.lexsort((ids, none, -score))[:k]
            best[item] = score[order], ids[order], none[order]
            if len(order) == k:
                least[item] = max(least.get(item, 1), int(score[order[-1]]))

        for batch in batches:
            for r in range(batch.num_rows):
                m = batch.column("m")[r].as_py()
                docs = batch.column("docs")[r].values
                none, ids = np.asarray(docs.is_null()), docs.fill_null(0).to_numpy()
                at = pc.index_in(batch.column("terms")[r].values, asked).fill_null(-1).to_numpy(zero_copy_only=False)
                of_term, tf, size, members = (np.asarray(batch.column(c)[r].values) for c in ("of_term", "tf", "size", "members"))
                tf = tf.astype(np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m)  # once for each term and tf
                ends = np.append(0, np.cumsum(size))
                group = np.searchsorted(of_term, np.arange(len(at) + 1))  # a term's groups are neighbours
                spans = {}
                top = np.zeros(len(vocabulary), np.int64)
                for t in np.flatnonzero(at >= 0).tolist():
                    a, b = int(group[t]), int(group[t + 1])
                    spans[int(at[t])] = members[ends[a] : ends[b]], np.repeat(impact[a:b], size[a:b])
                    top[at[t]] = impact[b - 1]
                for ask in batch.column("asks")[r].as_py():
                    item = ask["item"]
                    bar = max(least.get(item, 1), ask["least"])
                    own = slice(int(starts[item]), int(starts[item + 1]))
                    if int((weights[own] * top[terms[own]]).sum()) < bar:
                        continue  # no document of this block can get in
                    total = np.zeros(len(ids), np.int64)
                    for t, w in zip(terms[own].tolist(), weights[own].tolist(), strict=True):
                        if t in spans and w:
                            where, value = spans[t]
                            total[where] += w * value
                    hit = np.flatnonzero(total >= bar)
                    if len(hit) > k:  # equal scores stay until ids decide
                        cut = np.partition(total[hit], len(hit) - k)[len(hit) - k]
                        hit = hit[total[hit] >= cut]
                    if len(hit):
                        merged(item, total[hit], ids[hit], none[hit])
        for item, (score, ids, none) in best.items():
            columns = [pa.array([item] * len(score), pa.int64()), pa.array(score, pa.int64()), pa.array(ids, pa.int64(), mask=none)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "score", "doc_id"])

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(blocks: DataFrame, asked, n_docs: int, k: int) -> DataFrame:
    """(item, score, doc_id, rank) for a bounded set of items; ``asked`` has their (item, term, times) in memory."""
    import numpy as np

    spark = blocks.sparkSession
    coded = asked.column("term").combine_chunks().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    item, term = np.asarray(asked.column("item")), coded.indices.to_numpy().astype(np.int64)
    order = np.argsort(item, kind="stable")
    item, term, times = item[order], term[order], np.asarray(asked.column("times"))[order]

    seen = blocks.select("m", "terms", "of_term", "tf", "size").mapInArrow(_occurring(vocabulary), "m bigint, term bigint, df bigint, most bigint")
    seen = keep(seen.groupBy("m", "term").agg(F.sum("df").alias("df"), F.max("most").alias("most")), "lexical-seen")
    counted = seen.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[np.asarray(counted.column("term"))] = np.asarray(counted.column("df"))
    ask = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
    weight = np.array(ask, np.int64)[term] * times

    strata = seen.groupBy("m").agg(F.collect_list(F.struct("term", "most")).alias("seen"))
    bounds = strata.mapInArrow(_bounded(item, term, weight), "m bigint, item bigint, bound bigint")
    visit = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "m"))
    visits = keep(bounds.withColumn("visit", visit), "lexical-visits")

    best, done, upto = spark.createDataFrame([], f"{HITS}, rank int"), 0, FIRST_VISITS
    while True:
        bars = best.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("item", "least")
        now = visits.where((F.col("visit") > done) & (F.col("visit") <= upto)).join(bars, "item", "left")
        now = now.withColumn("least", F.coalesce("least", F.lit(1))).where("bound >= least")
        asks = keep(now.groupBy("m").agg(F.collect_list(F.struct("item", "least")).alias("asks")), "lexical-asks")
        low, high = asks.agg(F.min("m"), F.max("m")).first()
        if low is None:  # an item's bounds fall with its visits: what comes later cannot matter either
            return best
        # Files lie in the order of m: many hold none of these strata and are skipped by their bounds.
        found = blocks.where(F.col("m").between(low, high)).join(table_within(asks, 64), "m")
        found = found.select("m", "docs", "terms", "of_term", "tf", "size", "members", "asks").mapInArrow(_scored(vocabulary, item, term, weight, k), HITS)
        best = keep(_best(best.select("item", "score", "doc_id").unionByName(found), k), "lexical-best")
        done, upto = upto, upto * GROWTH


def search(blocks: DataFrame, items: DataFrame, k: int = 20, item_id: str = "item_id", text: str = "text", asked: int = ASKED) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item in an ``index``, those above score 0.

    A document's score sums w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included. Equal scores go
    to the smaller doc_id, null ids last. Items without a term, or whose terms occur nowhere, have no rows; a repeated item
    row has its result again under the same id. Items are searched in parts of about ``asked`` (item, term) pairs.
    """
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    found = keep(rows.mapInArrow(_terms, TERMS).withColumn("row", F.monotonically_increasing_id()), "lexical-items")
    n_docs = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    pairs = found.agg(F.coalesce(F.sum(F.octet_length("counts") / 4), F.lit(0))).first()[0]
    parts = max(1, math.ceil(pairs / asked))
    results = []
    for part in range(parts):
        some = found.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).select("doc_id", "row", "words", "counts").toArrow()
        named, asking = _spread(some)
        names = blocks.sparkSession.createDataFrame(named, "item bigint, item_id bigint")
        hits = _search(blocks, asking, n_docs, k) if len(asking) else blocks.sparkSession.createDataFrame([], f"{HITS}, rank int")
        results.append(hits.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _spread(some):
    """Items numbered from 0 as (number, id) rows, and their (item, term, times) as an Arrow table."""
    import numpy as np
    import pyarrow as pa

    terms, times, item = [], [], []
    for i, (words, counts) in enumerate(zip(some.column("words"), some.column("counts"), strict=True)):
        own = words.as_py().split(b" ")
        terms += own
        times.append(np.frombuffer(counts.as_py(), "<u4").astype(np.int64))
        item += [i] * len(own)
    table = pa.table({"item": pa.array(item, pa.int64()), "term": pa.array(terms, pa.binary()).cast(pa.string()), "times": np.concatenate(times) if times else pa.array([], pa.int64())})
    return list(enumerate(some.column("doc_id").to_pylist())), table
