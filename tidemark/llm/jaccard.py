"""Near copies by the Jaccard similarity of word shingles: SimHash links and MinHash bands find candidates, exact sets decide.

Equal sets are one node. Fingerprints of the sets are linked by covering masks as in ``simhash``, which loses no pair within
``RADIUS`` bits. Most pairs at 0.8 differ in more bits (about ten of 64), so bands find the others. Two sets at
similarity 0.8 share no band in (1 - 0.8^4)^28, 4 of 10 million cases.

Sets whose sizes or parities rule the similarity out never become pairs: a set has ``PARITY`` bits, each telling whether an
odd number of its hashes falls on it, and two sets differ in at least as many hashes as in bits. First one set of each band is compared with the others. Bands that then hold several components go on, those of up to
``SMALL`` sets with all pairs, larger ones with a growing number of their sets at a time; sets of one component are not
compared, so a large group of copies costs a fixed number of pairs a member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_or_plain, table_within, unused
from tidemark.llm.simhash import links as print_links
from tidemark.llm.simhash import majority, smallest_reachable
from tidemark.session import keep

BANDS, ROWS = 28, 4
RADIUS = 2  # bits in which linked fingerprints differ at most
SMALL = 16  # sets of a band that are all compared
PIVOTS = 1024  # most sets of a larger band that are compared with all others in one round
PARITY = 1024  # bits
SPREAD = 64  # a set with many candidates is compared in so many tasks


def shingles(text: bytes | None, words: int):
    """The different hashes of a text's shingles in order; words as in ``simhash``, fewer make one shingle."""
    import numpy as np
    import xxhash

    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, "<u8")
    last = max(1, len(tokens) - words + 1)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words]), 42) for i in range(last)), "<u8", last))


def _factors():
    import numpy as np

    made = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS), "<u8", endpoint=False)
    return made[0] | np.uint64(1), made[1]


def band_keys(hashes, factors) -> list[int]:
    """A hash for each band of its number and ``ROWS`` minima; an empty set has none."""
    import numpy as np
    import xxhash

    if not len(hashes):
        return []
    odd, plus = factors
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, "<u8")
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        mixed = hashes[at : at + 4096, None] * odd + plus
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, mixed.min(0))
    raw = least.tobytes()
    size = 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[i * size : (i + 1) * size], i) for i in range(BANDS)]


def parities(hashes):
    """``PARITY`` bits in words of 64: each tells whether an odd number of the hashes falls on it."""
    import numpy as np

    odd = np.bincount((hashes % np.uint64(PARITY)).view(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


NAMES = ("node", "size", "print", "set", "parity")


def with_sets(docs: DataFrame, text: str, words: int, bands: bool, names: tuple[str, ...] = NAMES) -> DataFrame:
    """All columns of ``docs`` and, under ``names``, a digest of the text's shingles, their number, their SimHash fingerprint, the bands or the set, and its parities."""
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    added = [T.StructField(n, k) for n, k in zip(names, (long, long, long, longs, longs), strict=True)]
    schema = T.StructType([*docs.schema.fields, *added])
    source, position = docs.withColumn(unused([*docs.columns, *names], "raw_text"), F.col(f"`{text}`").cast("binary")), len(docs.columns)

    def add(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        factors = _factors()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                nodes, sizes, prints, lists, odd = [], [], [], [], []
                for raw in some.column(position):
                    own = shingles(raw.as_py(), words)
                    nodes.append(_signed(xxhash.xxh64_intdigest(own.tobytes(), 7)))
                    sizes.append(len(own))
                    prints.append(majority(own) if bands else None)
                    lists.append([_signed(x) for x in band_keys(own, factors)] if bands else own.view(np.int64))
                    odd.append(parities(own) if bands else None)
                longs = pa.list_(pa.int64())
                columns = [*some.columns[:position], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(lists, longs), pa.array(odd, longs)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(add, schema)


def alike_in_size(a, b, least: float):
    """False where the smaller set is too small to reach the similarity, even if it lies in the larger."""
    return F.least(a, b) >= F.lit(least) * F.greatest(a, b) - 1e-9


def alike_in_parity(a, b, size_a, size_b, least: float):
    """False where more parities differ than hashes may differ at the similarity."""
    differing = sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(1, PARITY // 64)), F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))
    return differing <= F.lit((1 - least) / (1 + least)) * (size_a + size_b) + 1e-6


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sets have a similarity of ``least`` or more; ``sets`` is stored (node, set)."""
    spread = pairs.withColumn("part", F.pmod(F.hash("b"), F.lit(SPREAD)))
    left = spread.select("a", "part").distinct().join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    right = spread.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    enough = both >= F.lit(least) * (F.size("set_a") + F.size("set_b") - both) - 1e-9
    return right.join(left, ["a", "part"]).where(enough).select("a", "b")


def near_prints(nodes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, size, print; stored) whose fingerprints are equal or linked by covering masks.

    Nodes of one fingerprint meet at its smallest node, which also stands for them in links to other fingerprints.
    """
    centres = keep(nodes.groupBy("print").agg(F.min(F.struct("node", "size")).alias("centre")), "jaccard-centres")
    ends = centres.select("print", F.col("centre.node").alias("node"), F.col("centre.size").alias("size"))
    same = nodes.join(centres, "print").select(F.col("centre.node").alias("a"), F.col("centre.size").alias("size_a"), F.col("node").alias("b"), F.col("size").alias("size_b"))
    linked = keep(print_links(centres.select("print"), RADIUS, "print"), "jaccard-print-links")
    linked = linked.join(ends.toDF("a", "node_a", "size_a"), "a").join(ends.toDF("b", "node_b", "size_b"), "b")
    pairs = same.where("a <> b").unionByName(linked.select(F.col("node_a").alias("a"), "size_a", F.col("node_b").alias("b"), "size_b"))
    pairs = pairs.where(alike_in_size(F.col("size_a"), F.col("size_b"), least))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def rooted(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """``rows`` and, as ``root``, the root of their ``node``: the node itself where it has none in ``roots`` (node, root)."""
    return rows.join(roots.toDF(node, "found_root"), node, "left").withColumn(root, F.coalesce("found_root", node)).drop("found_root")


def grown(roots: DataFrame, found: DataFrame) -> DataFrame:
    """The stored (node, root) of components that the links ``found`` (a, b) are added to; only roots that meet are moved."""
    roots = small_or_plain(roots)
    meeting = rooted(rooted(found, roots, "a", "root_a"), roots, "b", "root_b").where("root_a <> root_b")
    moved = keep(smallest_reachable(meeting.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()), "jaccard-moved")
    after = rooted(roots.select(F.col("node").alias("member"), F.col("root").alias("node")), small_or_plain(moved), "node", "root")
    new = moved.join(roots.select("node"), "node", "left_anti")
    return keep(after.select(F.col("member").alias("node"), "root").unionByName(new), "jaccard-roots")


def components(marked: DataFrame, words: int, least: float) -> DataFrame:
    """(node, root): the smallest node of its component over all pairs at ``least`` or more, for each node that has a link.

    ``marked`` (node, size, print, bands, parity, text) is stored. Empty sets take no part.
    """
    nodes = marked.where("size > 0").groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "print", "bands", "parity")])
    nodes = keep(nodes, "jaccard-nodes")
    close = keep(near_prints(nodes.select("node", "size", "print"), least), "jaccard-close")
    each = nodes.select("node", "size", F.explode("bands").alias("key"))
    sizes = keep(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "jaccard-sizes")
    shared = keep(each.join(small_or_plain(sizes), "key"), "jaccard-shared")
    wanted = shared.select("node").unionByName(close.select(F.col("a").alias("node"))).unionByName(close.select(F.col("b").alias("node")))
    wanted = small_or_plain(keep(wanted.distinct(), "jaccard-wanted"))
    texts = marked.join(wanted, "node", "left_semi").dropDuplicates(["node"]).select("text")
    sets = keep(with_sets(texts, "text", words, False).select("node", "set"), "jaccard-sets")

    roots = grown(close.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0), keep(similar(close, sets, least), "jaccard-links"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("node"))
    left = shared.join(nodes.select("node", "parity"), "node").withColumn("rank", rank)
    tried, done, pivots = close, 0, 1
    while True:
        left = keep(rooted(left, small_or_plain(roots), "node", "root"), "jaccard-left")
        # A band inside one component is done.
        several = left.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        open_ = keep(several.select("key"), "jaccard-open")
        if open_.isEmpty():
            return roots
        left = left.join(small_or_plain(open_), "key", "left_semi")
        # The smallest nodes of each band against its larger ones; they need no further comparison then.
        last = F.lit(pivots) if done == 0 else F.when(F.col("n") <= SMALL, F.col("n")).otherwise(done + pivots)
        chosen = left.where(F.col("rank") <= last).select("key", *[F.col(c).alias(f"{c}_a") for c in ("node", "size", "parity", "root")])
        chosen = table_within(keep(chosen, "jaccard-pivots"), 16)
        against = left.join(chosen, "key").where("node > node_a and root <> root_a").where(alike_in_size(F.col("size"), F.col("size_a"), least))
        against = against.where(alike_in_parity(F.col("parity"), F.col("parity_a"), F.col("size"), F.col("size_a"), least))
        new = against.select(F.col("node_a").alias("a"), F.col("node").alias("b")).distinct()
        new = keep(new.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
        tried = tried.unionByName(new)
        roots = grown(roots, keep(similar(new, sets, least), "jaccard-links"))
        left = left.where(F.col("rank") > last).drop("root")
        done, pivots = done + pivots, min(PIVOTS, 2 * pivots)


def one_of_each(docs: DataFrame, words: int = 5, least: float = 0.8, text: str = "text") -> DataFrame:
    """Of each group connected by pairs at ``least`` or more the row with the smallest doc_id stays, all columns kept.

    Texts without a word are copies of each other. Rows without an id come last.
    """
    columns = docs.columns
    *names, row = (unused(columns, n) for n in ("near_node", "near_size", "near_print", "near_bands", "near_parity", "near_row"))
    marked = with_sets(docs, text, words, True, tuple(names)).withColumn(row, F.monotonically_increasing_id())
    marked = keep(marked, "jaccard-docs")  # row numbers are fixed once stored
    own = marked.select("doc_id", F.col(f"`{text}`").alias("text"), *[F.col(n).alias(a) for n, a in zip([*names, row], ("node", "size", "print", "bands", "parity", "row"), strict=True)])
    roots = components(own, words, least)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    # First inside each node, then across: only one row of each node is moved by component.
    firsts = own.groupBy("node").agg(F.min(order).alias("first")).join(small_or_plain(roots), "node", "left")
    stay = firsts.groupBy(F.coalesce("root", "node").alias("group")).agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return marked.join(stay, row, "left_semi").select(*(F.col(f"`{c}`") for c in columns))
