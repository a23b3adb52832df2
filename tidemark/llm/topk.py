"""Exact top-k by inner product: query blocks times shards, partial lists per tile, merged as a tree."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import keep

BLOCK = 16_384  # queries held by one task
SHARD = 131_072  # candidates of one grid column
FAN_IN = 16  # lists merged in one step

TOP = "array<struct<score:bigint,vec_id:bigint,same:boolean>>"


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) as doubles; rows without an id, null, or with null or non-finite parts go."""
    x = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda e: F.floor(F.lit(float(scale)) * e).cast("double"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("raw"), x.alias("v"))
    whole = F.forall("raw", lambda e: F.coalesce((F.abs(e) < F.lit(float("inf"))), F.lit(False)) & ~F.isnan(e))
    return rows.where(F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & F.coalesce(whole, F.lit(False))).select("vec_id", "v")


def _tile(ids, block, own, vectors, k):
    """The k best candidates of each query of a block in one tile: exact integer products, and which rows equal the query."""
    import numpy as np

    top = max(1.0, float(np.abs(block).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, block.shape[1]))
    if top < 2**53:
        scores = (block @ vectors.T).astype(np.int64)  # every partial sum is an exact double
    else:
        wide = np.array(block.tolist(), object).astype(object) if block.size else block
        exact = [[sum(int(a) * int(b) for a, b in zip(q, c, strict=True)) for c in vectors] for q in wide]
        scores = np.clip(np.array(exact, object).reshape(len(block), len(vectors)), -(2**63) + 1, 2**63 - 1).astype(np.int64)
    for i in range(len(block)):
        other, row = np.arange(len(ids)), scores[i]
        if len(row) > k:  # all scores tied with the k-th stay until ids decide
            bar = np.partition(row, len(row) - k)[len(row) - k]
            other, row = other[row >= bar], row[row >= bar]
        best = np.lexsort((ids[other], -row))[:k]
        chosen = other[best]
        same = (ids[chosen] == own[i]) & (vectors[chosen] == block[i]).all(1)
        yield i, row[best], ids[chosen], same


def _merged(old, scores, ids, same, k):
    both = sorted([*old, *zip((-scores).tolist(), ids.tolist(), same.tolist(), strict=True)])
    return both[:k]


def _tiles(k):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def matrix(batch, mask):
            lists = batch.column("v").filter(mask)
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), float)
            return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))

        cell, held, lists = None, [], {}

        def finish():
            out = [(q, cell[1], [(-s, i, e) for s, i, e in v]) for q, v in lists.items() if v]
            kind = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64()), ("same", pa.bool_())]))
            tops = pa.array([[{"score": s, "vec_id": i, "same": e} for s, i, e in r[2]] for r in out], kind)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), tops], names=["query", "node", "top"])

        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in ("row", "col", "dim")], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
                if a == b:
                    continue
                if cell != tuple(keys[a].tolist()):
                    if lists:
                        yield finish()
                    cell, held, lists = tuple(keys[a].tolist()), [], {}
                part = batch.slice(a, b - a)
                asks = pa.array(np.asarray(part.column("query")) >= 0)
                if pa.compute.any(asks).as_py():  # a cell's queries come before its candidates
                    held.append((np.asarray(part.column("query").filter(asks)), np.asarray(part.column("vec_id").filter(asks)), matrix(part, asks)))
                given = pa.compute.invert(asks)
                vectors, ids = matrix(part, given), np.asarray(part.column("vec_id").filter(given))
                for at in range(0, len(ids), 4096):
                    for names, own, block in held:
                        for start in range(0, len(names), 1024):
                            piece = slice(start, start + 1024)
                            for i, scores, found, same in _tile(ids[at : at + 4096], block[piece], own[piece], vectors[at : at + 4096], k):
                                q = int(names[start + i])
                                lists[q] = _merged(lists.get(q, []), scores, found, same, k)
        if lists:
            yield finish()

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, block: int = BLOCK, shard: int = SHARD, own: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` best candidates of the same length.

    Both inputs are (vec_id, v) from ``quantised``. With ``own``, the queries are rows of the candidates, and each leaves
    out one candidate row equal to it in id and vector: its own. Rows that share an id find each other, and each gives its
    own ranks under that ``query_id``. Ties go to the smaller id; fewer candidates give fewer ranks; repeated candidate
    rows rank each for itself. Scores beyond a long are held at its
    ends. Queries are laid out as grid rows and candidates as grid columns; every cell is one bounded piece of work, and a
    task holds one block of queries while candidates stream past. No query or candidate set is ever in one place.
    """
    asked = keep(queries.select("vec_id", "v", F.monotonically_increasing_id().alias("query")), "topk-queries")
    n_queries, n_candidates = asked.count(), candidates.count()
    rows, cols = max(1, math.ceil(n_queries / block)), max(1, math.ceil(n_candidates / shard))
    cols = max(cols, math.ceil(candidates.sparkSession.sparkContext.defaultParallelism / rows)) if n_candidates > 4 * FAN_IN else cols
    spread = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # The number of a row, not its id, chooses its cell: a repeated id or vector does not heat one.
    left = asked.select("query", "vec_id", "v", spread(rows, "query").alias("row")).withColumn("col", every(cols))
    right = candidates.select(F.lit(-1).cast("long").alias("query"), "vec_id", "v", spread(cols, F.monotonically_increasing_id()).alias("col")).withColumn("row", every(rows))
    both = left.unionByName(right).withColumn("dim", F.size("v"))
    cells = both.repartition(rows * cols, "row", "col", "dim").sortWithinPartitions("row", "col", "dim", F.col("query") < 0)
    lists = cells.select("row", "col", "dim", "query", "vec_id", "v").mapInArrow(_tiles(k + own), f"query bigint, node int, top {TOP}")
    order = lambda a, b: F.when(a.score != b.score, F.when(a.score > b.score, -1).otherwise(1)).when(a.vec_id < b.vec_id, -1).when(a.vec_id > b.vec_id, 1).otherwise(0)
    while True:
        lists = lists.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int"))
        best = F.slice(F.array_sort(F.flatten(F.collect_list("top")), order), 1, k + own)
        lists = lists.groupBy("query", "node").agg(best.alias("top"))
        cols = math.ceil(cols / FAN_IN)
        if cols <= 1:
            break
    names = asked.select("query", F.col("vec_id").alias("query_id"))
    ranked = lists.join(names, "query")
    if own:
        # Among equal ids and scores it does not matter which row goes: the others read alike.
        at = F.array_position(F.transform("top", lambda x: x.same & (x.vec_id == F.col("query_id"))), F.lit(True))
        ranked = ranked.withColumn("own", at).withColumn("top", F.slice(F.filter("top", lambda x, i: i + 1 != F.col("own")), 1, k))
    ranked = ranked.select("query_id", F.posexplode("top").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def self_search(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 100, scale: int = 1024, k: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` searched against all rows; nulls and non-finite vectors take no part."""
    whole = quantised(vectors, vec_id, vector, scale)
    return top_k(whole.where(F.col("vec_id") % every == 0), whole, k)
