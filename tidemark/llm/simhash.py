"""Near-duplicate documents: SimHash fingerprints linked by covering locality-sensitive hashing.

Every pair of fingerprints within the radius agrees on all bits kept by at least one mask, so it meets in
that mask's bucket and none is lost. Buckets of more than ``SMALL`` different fingerprints are not compared
inside; their fingerprints meet at a common neighbour instead, which costs a fixed number of keys each.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unused
from tidemark.session import keep

BITS = 64
SMALL = 32  # largest bucket compared inside


def _fingerprint(text: bytes | None, words: int):
    import numpy as np
    import xxhash

    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), 42)]
    else:
        joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[: len(tokens) - words] + 1))
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)]
    return majority(hashes)


def majority(hashes) -> int:
    """The bits that are set in over half of the hashes, as a signed long."""
    import numpy as np

    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for very long texts
        block = np.array(hashes[at : at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = 3, name: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` and a 64-bit fingerprint (a signed long).

    The text is split at ASCII white space and A-Z is lower-cased; shingles of ``words`` words count as often as they
    occur. Fewer words make one shingle; a null, empty or blank text has fingerprint zero.
    """
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    raw = unused([*docs.columns, name], "raw_text")
    source = docs.withColumn(raw, F.col(f"`{text}`").cast("binary"))
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    position = len(docs.columns)
    assert isinstance(source.schema[position].dataType, BinaryType)

    def add(batches):
        import pyarrow as pa

        names = [f.name for f in schema.fields]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                marks = pa.array((_fingerprint(x.as_py(), words) for x in some.column(position)), pa.int64())
                yield pa.RecordBatch.from_arrays([*some.columns[:position], marks], names=names)

    return source.mapInArrow(add, schema)


def masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 bit masks, one for each non-zero vector v of radius + 1 bits.

    Bit i has a vector of its own; a mask keeps the bits whose vector has an odd inner product with v. The vectors of
    ``radius`` differing bits cannot span the whole space, so some v is orthogonal to all of them: its mask drops them.
    """
    vectors = range(1, 2 ** (radius + 1))
    own = [1 + i % len(vectors) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (own[i] & v).bit_count() % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(prints: DataFrame, radius: int = 2, name: str = "fingerprint") -> DataFrame:
    """Links (a, b) between different fingerprints at ``radius`` or fewer differing bits.

    ``prints`` holds different fingerprints. The links connect exactly what all pairs within the radius connect; pairs
    inside a crowded bucket are replaced by a star around a member of a common neighbourhood.
    """
    if not 0 <= radius <= 4:
        raise ValueError("radius must be 0 to 4: the number of masks doubles with each bit")
    mask_list = F.array(*[F.lit(_signed(m)) for m in masks(radius)])
    keyed = prints.select(F.col(name).alias("fp"), F.posexplode(mask_list).alias("mask", "bits"))
    keyed = keyed.select("fp", "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keep(keyed.join(sizes, ["mask", "key"]), "simhash-buckets")

    small = shared.where(F.col("n") <= SMALL).groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
    small = small.select(F.explode("members").alias("a"), "members")
    near = F.filter("members", lambda y: (y > F.col("a")) & (F.bit_count(y.bitwiseXOR(F.col("a"))) <= radius))
    found = small.select("a", F.explode(near).alias("b"))

    crowded = shared.where(F.col("n") > SMALL).select("fp").distinct()
    low, high = radius // 2, radius - radius // 2
    flips = [
        F.struct(F.lit(_signed(sum(1 << i for i in c))).alias("flip"), F.lit(d).alias("distance"))
        for d in range(high + 1)
        for c in combinations(range(BITS), d)
    ]
    around = crowded.select("fp", F.explode(F.array(*flips)).alias("step"))
    around = around.select("fp", F.col("fp").bitwiseXOR(F.col("step.flip")).alias("near"), F.col("step.distance").alias("distance"))
    # At most one ball of fingerprints can share a neighbour, so the lists are bounded.
    groups = around.groupBy("near").agg(F.collect_list("fp").alias("members"), F.min(F.struct("distance", "fp")).alias("centre"))
    groups = groups.where((F.size("members") > 1) & (F.col("centre.distance") <= low))
    stars = groups.select(F.col("centre.fp").alias("a"), F.explode("members").alias("b")).where("a <> b")
    return found.unionByName(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): the smallest node of its component.

    Alternating large-star and small-star steps, each a minimum per node and a join; every round is stored in the shared
    folder, so its plan stays short and survives lost executors. Ends when a round changes nothing.
    """
    now, before = keep(edges.where("a <> b").select("a", "b"), "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root"))
            ).distinct()
        before = state
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
        large = both.where("b > a").join(least, "a").select("root", F.col("b").alias("node"))
        large = large.where("root <> node").distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").select(F.explode(F.array(F.struct(F.col("least").alias("a"), F.col("root").alias("b")), F.struct(F.col("least").alias("a"), F.col("node").alias("b")))).alias("e"))
        now = keep(small.select("e.a", "e.b").where("a <> b").distinct(), "links")


def components(marked: DataFrame, doc_id: str = "doc_id", radius: int = 2, name: str = "fingerprint") -> DataFrame:
    """(fingerprint, component_id): the smallest id among documents reachable over links, for each fingerprint.

    Rows with a null id take part in links; a component of such rows alone has a null component_id. ``marked`` is read
    several times and should be stored.
    """
    prints = keep(marked.groupBy(name).agg(F.min(doc_id).alias("least")), "fingerprints")
    roots = smallest_reachable(links(prints, radius, name))
    rooted = prints.join(roots.withColumnRenamed("node", name), name, "left")
    rooted = rooted.select(name, "least", F.coalesce("root", name).alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select(name, "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``; other columns are ignored.

    Repeated rows and repeated ids stay rows of their own. An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = keep(with_fingerprints(rows, "text", words).select("doc_id", "fingerprint"), "simhash")
    found = components(marked, "doc_id", radius)
    return marked.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest doc_id stays, all columns kept.

    Rows with one id and equal text stand for each other: one of them stays. Rows without an id come last.
    """
    columns = docs.columns
    print_, row = unused(columns, "print"), unused(columns, "row")
    marked = with_fingerprints(docs, "text", words, print_).withColumn(row, F.monotonically_increasing_id())
    marked = keep(marked, "simhash-docs")  # row numbers are fixed once stored
    prints = marked.select("doc_id", F.col(print_).alias("_print"), F.col(row).alias("_row"))
    found = components(prints, "doc_id", radius, "_print")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")
    # First inside each fingerprint, then across: only one row of each fingerprint is moved by component.
    firsts = prints.groupBy("_print").agg(F.min(order).alias("first")).join(found, "_print")
    # A null component id stands for one component per root, never for all of them together.
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("p"), F.col("_print").cast("string")))
    stay = firsts.groupBy(group.alias("_group")).agg(F.min("first").alias("first")).select(F.col("first._row").alias("_row"))
    return marked.join(stay.withColumnRenamed("_row", row), row, "left_semi").select(*(F.col(f"`{c}`") for c in columns))
