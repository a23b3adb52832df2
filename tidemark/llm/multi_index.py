"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Rotations fitted on a bounded sample turn each vector into a code of four 64-bit words whose differences follow the angle
between vectors. The first word is cut into s substrings, and each substring is an index of its own. Two codes within s (t + 1) - 1 bits have a
substring within t bits, so probing every substring's neighbours at distance 0, 1, .., t retrieves every code within that
radius. The other words of the retrieved codes have a radius of their own, which is narrower for its length and is asked
for inside the same join; codes within both are reranked by the cosine of the original vectors.

The radius is each query's own: after every round it follows from the angle of the query's k-th best vector so far, as the
distance that a vector at this angle exceeds in only ``MISS`` of all cases. Near neighbours end a search early; no number
of candidates is set anywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table_within
from tidemark.session import keep

BITS = 64  # of a word; the first is indexed
WIDE = 3  # further words
SAMPLE = 4096  # different vectors that the rotations, the margin and the number of substrings are learned from
MISS = 0.05  # share of vectors at a query's last angle whose codes lie beyond the radius
SPLITS = (16, 8, 4)  # numbers of substrings to choose from
PROBES = 2048  # of a query in all rounds: as many as substrings of 8 bits have keys, so that 8 and more substrings always may be chosen
BUCKET = 4096  # codes of one bucket part
QUERIES = 16_384  # queries of one grid row, as expected
SHARD = 131_072  # vectors of one grid column, as expected
WORDS = ["code", *(f"wide{i}" for i in range(WIDE))]
FOUND = "query bigint, score double, vec_id bigint, row bigint"


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(row, vec_id, vec) of rows with an id and a vector that is neither zero nor holds null or non-finite parts."""
    vec = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").cast("long").alias("vec_id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False)))
    some = F.exists("vec", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(some, F.lit(False)))


def unit(x):
    """Rows of length 1; scaled by powers of two first, which is exact, so that no square overflows."""
    import numpy as np

    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def rotation(x, dim: int, rounds: int = 30):
    """A (dim, BITS * (1 + WIDE)) matrix whose signs are a vector's code: blocks of at most ``dim`` bits, each the main directions of the
    sample turned so that its members lie near the corners of a cube. Directions at random where there is no sample.
    """
    import numpy as np

    rng, parts, done = np.random.default_rng(dim), [], 0
    while done < BITS * (1 + WIDE):
        c = min(dim, BITS - done % BITS)
        turned = np.linalg.qr(rng.standard_normal((c, c)))[0]
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :c] if len(x) else np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, :c]
        low = x @ axes
        for _ in range(rounds if len(x) else 0):
            u, _, vt = np.linalg.svd(np.where(low @ turned > 0, 1.0, -1.0).T @ low)
            turned = (u @ vt).T
        parts.append(axes @ turned)
        done += c
    return np.concatenate(parts, 1)


def codes(x, turned):
    """Codes of unit rows, a signed long for each word."""
    import numpy as np

    return np.packbits(x @ turned > 0, axis=1, bitorder="little").view("<i8")


def learn(sample, k: int, total: int):
    """(rotations by dimension, margins of the first word and of the others, substrings) from a list of sample vectors, ``total`` being the number of all."""
    import numpy as np

    by_dim: dict[int, list] = {}
    for v in sample:
        by_dim.setdefault(len(v), []).append(v)
    turned, over, radii = {}, ([], []), []
    for dim, some in by_dim.items():
        x = unit(np.array(some, float))
        turned[dim] = rotation(x, dim)
        if len(x) <= k:
            continue
        own = codes(x, turned[dim]).astype("<u8")
        for at in range(min(len(x), 256)):
            cos = np.clip(x @ x[at], -1, 1)
            cos[at] = -2
            near = np.argpartition(-cos, k - 1)[:k]
            p = np.clip(np.arccos(cos[near]) / math.pi, 1 / BITS, 1 - 1 / BITS)
            apart = np.bitwise_count(own[near] ^ own[at])
            for found, bits, counts in zip(over, (BITS, BITS * WIDE), (apart[:, 0], apart[:, 1:].sum(1)), strict=True):
                found.append((counts - bits * p) / np.sqrt(bits * p * (1 - p)))
            radii.append(cos[near].min())
    margin, wide = (max(1.3, float(np.quantile(np.concatenate(found), 1 - MISS))) if found else 2.0 for found in over)
    p = math.acos(float(np.median(radii))) / math.pi if radii else 0.5
    farthest = math.acos(float(np.clip(min(radii), -1, 1))) / math.pi if radii else 0.5

    def probes(s, p):
        b, radius = BITS // s, int(BITS * p + margin * math.sqrt(BITS * p * (1 - p)))
        deep = min(b, math.ceil((radius + 1) / s) - 1)
        return sum(s * math.comb(b, t) for t in range(deep + 1))

    # Rounds go on for the queries without near neighbours, and a round's probes are shuffled.
    bounded = [s for s in SPLITS if probes(s, farthest) <= PROBES]
    return turned, (margin, wide), min(bounded, key=lambda s: probes(s, p) * (1 + total / 2.0 ** (BITS // s)))


def _radius(cosine: Column, margin: float, bits: int = BITS) -> Column:
    """The number of differing bits that a vector at this cosine exceeds in MISS of all cases; all bits for null."""
    p = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) / math.pi
    # A null must be asked for by name: least and greatest pass over it.
    return F.when(cosine.isNull(), bits).otherwise(F.floor(bits * p + margin * F.sqrt(bits * p * (1 - p))).cast("int"))


def _coded(turned):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = dict(turned)
        for batch in batches:
            vecs = batch.column("vec")
            sizes = np.asarray(vecs.value_lengths())
            out = np.zeros((len(sizes), 1 + WIDE), np.int64)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                x = np.asarray(vecs.take(pa.array(at)).flatten()).reshape(len(at), dim)
                if dim not in known:
                    known[dim] = rotation(np.zeros((0, dim)), dim)
                out[at] = codes(unit(x), known[dim])
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sizes, pa.int32()), *(pa.array(w) for w in out.T.copy())], names=["node", "dim", *WORDS])

    return run


def _bars(sample, k):
    """(query, last): the ``k``-th best cosine of a query among the sample; null where the sample has fewer."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known: dict[int, list] = {}
        for v in sample:
            known.setdefault(len(v), []).append(v)
        blocks = {dim: unit(np.array(some, float)) for dim, some in known.items() if len(some) >= k}
        for batch in batches:
            vecs = batch.column("vec")
            sizes = np.asarray(vecs.value_lengths())
            last = np.full(len(sizes), np.nan)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                for some in np.split(at, range(512, len(at), 512)) if dim in blocks else ():
                    x = np.asarray(vecs.take(pa.array(some)).flatten()).reshape(len(some), dim)
                    # A hair lower, as sums are not added up in the same order everywhere.
                    last[some] = np.partition(unit(x) @ blocks[dim].T, -k, axis=1)[:, -k] - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("query"), pa.array(last, pa.float64(), mask=np.isnan(last))], names=["query", "last"])

    return run


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _substrings(code: Column, splits: int) -> Column:
    """array<struct<sub, key>> of a code."""
    width = BITS // splits
    return F.array(*[F.struct(F.lit(i).alias("sub"), F.shiftright(code, i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("key")) for i in range(splits)])


def retrieved(asked: DataFrame, coded: DataFrame, splits: int, distance: int) -> DataFrame:
    """(query, node): codes within ``most`` bits whose nearest substring lies at exactly ``distance`` bits, each pair once.

    ``asked`` has (query, dim, code, most), ``coded`` (node, dim, code); both may have further words, which ``most_wide``
    then bounds. Buckets of more than BUCKET codes are dealt to
    parts, and their probes go to every part.
    """
    from itertools import combinations

    width = BITS // splits
    flips = ",".join(f"{sum(1 << i for i in c)}L" for c in combinations(range(width), distance))
    wide = [w for w in WORDS[1:] if w in coded.columns]
    cut = coded.select("node", "dim", "code", *wide, F.inline(_substrings(F.col("code"), splits)))
    # At most one bucket in BUCKET codes is crowded, so this table stays small; it is looked at before it is broadcast.
    crowded = keep(cut.groupBy("dim", "sub", "key").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("parts")).where("parts > 1"), "codes-crowded")
    crowded = table_within(crowded, 64)
    at = ["dim", "sub", "key"]
    part = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int")
    listed = cut.join(crowded, at, "left").select("node", *at, *[F.col(w).alias(f"their_{w}") for w in ("code", *wide)], part.alias("part"))
    probes = asked.select("query", "dim", "code", "most", *(["most_wide", *wide] if wide else []), F.inline(_substrings(F.col("code"), splits)))
    probes = probes.withColumn("flip", F.explode(F.expr(f"array({flips})"))).withColumn("key", F.col("key").bitwiseXOR(F.col("flip"))).drop("flip")
    probes = probes.join(crowded, at, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    # The planner takes the probes for as many as the queries, and would send all of them to the driver and to every task.
    found = probes.hint("merge").join(listed, [*at, "part"]).withColumn("apart", F.col("code").bitwiseXOR(F.col("their_code")))
    first = F.lit(True)
    for i in range(splits):
        here = F.bit_count(F.shiftright("apart", i * width).bitwiseAND(F.lit((1 << width) - 1)))
        first = first & F.when(F.col("sub") > i, here > distance).otherwise(here >= distance)
    near = F.bit_count("apart") <= F.col("most")
    if wide:
        near = near & (sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"their_{w}"))) for w in wide), F.lit(0)) <= F.col("most_wide"))
    return found.where(near & first).select("query", "node")


def _reranked(k):
    """The k best owners of candidate vectors for each query of a grid cell; a cell's queries come first."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cell, state = None, {}

        def finish():
            out = [(int(q), s, v, r) for ids, _, _, lists in state.values() for q, tops in zip(ids, lists, strict=True) for s, v, r in tops]
            kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            columns = [pa.array([(o[0], -o[1], o[2], o[3])[c] for o in out], kind) for c, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["query", "score", "vec_id", "row"])

        waiting: dict[int, list] = {}

        def ready(dim):
            """Queries of a dimension: ids in order, unit vectors, the scores to reach, their lists."""
            if waiting.get(dim):
                named = sorted(waiting.pop(dim), key=lambda w: w[0])
                state[dim] = [np.array([n for n, _ in named]), unit(np.array([v for _, v in named])), np.full(len(named), -np.inf), [[] for _ in named]]
            return state[dim]

        for batch in batches:
            cells = np.stack([np.asarray(batch.column("qblock")), np.asarray(batch.column("shard"))], 1).tolist()
            queries, vecs = np.asarray(batch.column("query")), batch.column("vec")
            for r, now in enumerate(cells):
                if now != cell:
                    if state:
                        yield finish()
                    cell, state, waiting = now, {}, {}
                v = np.asarray(vecs[r].values)
                if queries[r] >= 0:
                    waiting.setdefault(len(v), []).append((int(queries[r]), v))
                    continue
                ids, block, bars, lists = ready(len(v))
                at = np.searchsorted(ids, np.asarray(batch.column("asks")[r].values))
                scores = (block[at] * unit(v[None, :])).sum(1)
                good = scores >= bars[at]
                if not good.any():
                    continue
                owners = [(o["vec_id"], o["row"]) for o in batch.column("owners")[r].as_py()]
                for q, score in zip(at[good].tolist(), scores[good].tolist(), strict=True):
                    lists[q] = sorted([*lists[q], *((-score, v, row) for v, row in owners)])[:k]
                    if len(lists[q]) == k:
                        bars[q] = -lists[q][-1][0]
        if state:
            yield finish()

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def nearest(vectors: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", every: int = 50, sample: int = SAMPLE, split: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose id is divisible by ``every``.

    Candidates are all rows but the query's own. Score is the cosine in double precision; equal scores go to the smaller
    id. Vectors of different lengths are never compared. Null, zero and non-finite vectors and rows without an id take no
    part. Repeated query rows have a result each; repeated ids and vectors are candidates of their own. With fewer than
    ``k`` candidates all are found, since the probes then go on to every key. An empty table gives no rows.

    Equal vectors are searched once, as queries and as candidates: of each vector the k + 1 smallest ids are kept, more
    can never be in a list. ``split`` sets the number of substrings instead of the one that the sample suggests.
    """
    rows = keep(usable(vectors, vec_id, vector).withColumn("hash", F.xxhash64("vec")), "codes-rows")
    by_vector = Window.partitionBy("hash", "vec").orderBy("vec_id", "row")
    owned = rows.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
    owned = owned.groupBy("hash", "vec").agg(F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("owners"))
    nodes = keep(owned.withColumn("node", F.monotonically_increasing_id()), "codes-vectors")
    asking = keep(rows.where(F.col("vec_id") % every == 0).join(nodes.select("hash", "vec", "node"), ["hash", "vec"]).select("vec_id", "row", "node"), "codes-queries")
    total, n_asking = nodes.count(), asking.select("node").distinct().count()

    some = nodes.orderBy("hash", "vec").limit(sample).select("vec").toArrow().column("vec").to_pylist()
    turned, (margin, margin_wide), best_split = learn(some, k, total)
    splits = split or best_split
    coded = keep(nodes.select("node", "vec").mapInArrow(_coded(turned), f"node bigint, dim int, {', '.join(f'{w} bigint' for w in WORDS)}"), "codes")
    asked = keep(coded.join(asking.select("node").distinct(), "node").select(F.col("node").alias("query"), "dim", *WORDS), "codes-asked")
    grid = max(1, math.ceil(n_asking / QUERIES))
    shards = max(math.ceil(total / SHARD), math.ceil(vectors.sparkSession.sparkContext.defaultParallelism / grid))
    blocks = nodes.select(F.col("node").alias("query"), "vec").join(asked.select("query"), "query")

    def limited(last: DataFrame) -> DataFrame:
        """The queries with the radii that follow from their last cosine."""
        radii = {"most": _radius(F.col("last"), margin), "most_wide": _radius(F.col("last"), margin_wide, BITS * WIDE)}
        return asked.join(last, "query", "left").withColumns(radii).drop("last")

    # The sample is part of the table: no query's last vector can be farther than its last one there.
    best, active = None, keep(limited(blocks.mapInArrow(_bars(some, k + 1), "query bigint, last double")), "codes-active")
    for distance in range(BITS // splits + 1):
        pairs = retrieved(active, coded, splits, distance).withColumn("qblock", F.pmod(F.xxhash64("query"), F.lit(grid)).cast("int"))
        # At most the queries of one grid row in a list.
        wanted = pairs.groupBy("qblock", "node").agg(F.collect_list("query").alias("asks"))
        shard = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
        right = wanted.join(nodes, "node").select("qblock", shard.alias("shard"), F.lit(-1).cast("long").alias("query"), "vec", "asks", "owners")
        every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
        left = blocks.join(active.select("query"), "query").select("query", "vec", F.pmod(F.xxhash64("query"), F.lit(grid)).cast("int").alias("qblock"))
        both = left.withColumn("shard", every_shard).unionByName(right, allowMissingColumns=True)
        cells = both.repartition(grid * shards, "qblock", "shard").sortWithinPartitions("qblock", "shard", F.col("query") < 0)
        found = cells.select("qblock", "shard", "query", "vec", "asks", "owners").mapInArrow(_reranked(k + 1), FOUND)
        best = keep(_best(found if best is None else best.unionByName(found), k + 1), "codes-best")
        last = best.groupBy("query").agg(F.when(F.count("*") > k, F.min("score")).alias("last"))
        reached = splits * (distance + 1) - 1
        active = limited(last).where(F.col("most") > reached)
        active = keep(active, "codes-active")
        if not active.count():
            break
    own = asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), F.col("node").alias("query"))
    mine = best.join(own, "query").where(F.col("row") != F.col("own"))
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "row"))
    return mine.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
