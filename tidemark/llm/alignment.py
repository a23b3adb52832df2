"""Alignment of two tokenizers over the same texts, by lockstep merging.

The tokens of a batch of documents lie in two flat arrays. A state vector holds, for each lane, how many tokens of either
side are taken and the bytes they end at; every step advances the side that is behind, in all lanes at once. Where both
ends meet, the lane has a cut: the tokens taken since its last cut are a group. Finished lanes leave the vector. A lane is
a stretch of words of one document, so a long document is many lanes and costs no more steps than a short one: both
tokenizers end a token wherever a space follows something else.

What a pair of ids is worth is counted over the whole corpus: each document gives its different pairs once, batches add
them up before the shuffle, and the counts come back to the documents as a bounded table of the commonest pairs in every
task plus a join for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import keep

LANE_WORDS = 128  # words of one lane
SLICE_BYTES = 2_000_000  # text aligned at once; a longer document is a slice by itself
CACHE_WORDS, CACHE_BYTES = 150_000, 20_000_000  # words kept with their ids, and as many of those before
LINKS = 2_000_000  # links spelled out at once
TABLE_PAIRS = 2_000_000  # id pairs whose counts every task holds: 12 bytes each
B_BITS = 15  # ids of the second tokenizer are below 2^15, a pair fits 32 bits

ALIGNED = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"
SHOWN = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers over words, with the byte length of every id."""

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None, piece_path: str):
        import base64
        import re

        import numpy as np
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(json_path)
        special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.plain.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.fast = None
        if ranks_path:  # the same vocabulary for a faster encoder, for words of Latin letters, digits and ASCII signs
            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("alignment", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.simple = re.compile("[!-~\u00a1-\u017f]+").fullmatch
        self.line_end = self.plain.encode("\n", add_special_tokens=False).ids[0]
        alphabet = _byte_alphabet()
        self.a_bytes = [b""] * self.plain.get_vocab_size()
        for entry, i in self.plain.get_vocab().items():
            self.a_bytes[i] = bytes(map(alphabet.__getitem__, entry)) if entry not in special else entry.encode()
        named = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        self.b_bytes = [bytes.fromhex(m[1]) if (m := byte(p)) else p.replace("▁", " ").encode() for p in named]
        self.blank = self.pieces.piece_to_id("▁")
        self.a_sizes = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.before: dict[str, tuple[bytes, bytes] | None] = {}
        self.held = 0

    def _first(self, words: list[str]):
        """Ids of A for a space and each word: flat, and how many each word has."""
        import numpy as np

        if self.fast and all(map(self.simple, words)):
            # One call for many: a line end is a token of its own between words, and no word has one.
            flat = np.array(self.fast.encode_ordinary(" " + "\n ".join(words)), np.int64)
            marks = np.flatnonzero(flat == self.line_end)
            return np.delete(flat, marks), np.diff(np.concatenate(([-1], marks, [len(flat)]))) - 1
        found = [e.ids for e in self.plain.encode_batch([" " + w for w in words], add_special_tokens=False)]
        return np.fromiter((i for ids in found for i in ids), np.int64), np.fromiter(map(len, found), np.int64, len(found))

    def _learn(self, words: list[str]) -> None:
        from itertools import chain

        import numpy as np

        a, a_counts = self._first(words)
        found = self.pieces.encode(words, num_threads=1)
        found = found if all(words) else [ids if w else [self.blank] for w, ids in zip(words, found, strict=True)]
        b, b_counts = np.fromiter(chain.from_iterable(found), np.int64), np.fromiter(map(len, found), np.int64, len(found))
        spoken = [b" " + w.encode() for w in words]
        sizes = np.fromiter(map(len, spoken), np.int64, len(spoken))
        a_ends, b_ends = np.append(0, np.cumsum(a_counts)), np.append(0, np.cumsum(b_counts))
        said = b"".join(spoken)
        whole = True
        for ids, ends, table, lengths in ((a, a_ends, self.a_bytes, self.a_sizes), (b, b_ends, self.b_bytes, self.b_sizes)):
            upto = np.append(0, np.cumsum(lengths[ids]))
            whole &= bool((np.diff(upto[ends]) == sizes).all()) and b"".join(map(table.__getitem__, ids.tolist())) == said
        a_raw, b_raw = a.astype("<u2").tobytes(), b.astype("<u2").tobytes()
        a_cut, b_cut = (2 * a_ends).tolist(), (2 * b_ends).tolist()
        pairs = list(zip(map(a_raw.__getitem__, map(slice, a_cut, a_cut[1:])), map(b_raw.__getitem__, map(slice, b_cut, b_cut[1:])), strict=True))
        if not whole:  # some word is not spelled by its ids
            for i, word in enumerate(spoken):
                parts = ((a, a_ends, self.a_bytes), (b, b_ends, self.b_bytes))
                if any(b"".join(map(table.__getitem__, ids[ends[i] : ends[i + 1]].tolist())) != word for ids, ends, table in parts):
                    pairs[i] = None
        self.known.update(zip(words, pairs, strict=True))
        self.held += len(said) + len(a_raw) + len(b_raw)

    def words_of(self, lists: list[list[str]]) -> None:
        """Make every word of these documents known; words not met for a while are forgotten."""
        if len(self.known) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.known, self.before, self.held = {}, self.known, 0
        missing = set().union(*lists).difference(self.known)
        again = missing.intersection(self.before)
        self.known.update(zip(again, map(self.before.__getitem__, again), strict=True))
        missing = list(missing.difference(again))
        simple = [w for w in missing if self.simple(w)]
        for some in (simple, [w for w in missing if not self.simple(w)]):
            for at in range(0, len(some), 20_000):
                self._learn(some[at : at + 20_000])


def splitter():
    """text -> its words: the stretches that begin at a space which follows something other than white space."""
    import re

    odd = re.compile(r"\s |\A | \Z").search
    cut = re.compile(r"(?<=\S)(?= )").split
    return lambda text: text.split(" ") if not odd(text) else [w[1:] for w in cut(" " + text)]


def lockstep(a_lens, b_lens, a_from, a_to, b_from):
    """Cuts of all lanes: (lane, tokens of A before the cut, tokens of B), as positions in the flat arrays, in any order.

    ``a_lens`` and ``b_lens`` are byte lengths of the tokens; lane i has A's tokens ``a_from[i]`` to ``a_to[i]`` and
    B's from ``b_from[i]``, over the same bytes.
    """
    import numpy as np

    lane = np.flatnonzero(a_to > a_from)
    a, b, stop = a_from[lane], b_from[lane], a_to[lane]
    a_end, b_end = a_lens[a], b_lens[b]
    a, b = a + 1, b + 1
    out = []
    while len(lane):
        gap = a_end - b_end
        met = gap == 0
        if met.any():
            out.append((lane[met], a[met], b[met]))
            done = met & (a == stop)
            if done.any():  # finished lanes leave
                stay = ~done
                lane, a, b, stop, a_end, b_end, gap = (x[stay] for x in (lane, a, b, stop, a_end, b_end, gap))
        behind, ahead = np.flatnonzero(gap <= 0), np.flatnonzero(gap >= 0)
        at = a[behind]
        a_end[behind] += a_lens[at]
        a[behind] = at + 1
        at = b[ahead]
        b_end[ahead] += b_lens[at]
        b[ahead] = at + 1
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _pairs(doc, a_ids, b_ids, a0, a1, b0, b1):
    """(document << 32 | pair, times) of all links of the groups, each different pair of a document once."""
    import numpy as np

    parts = []

    def add(keys, times=None):
        if times is None:
            parts.append(np.unique(keys, return_counts=True))
        else:
            parts.append((keys, times))

    sizes = (a1 - a0) * (b1 - b0)
    small = np.flatnonzero(sizes <= LINKS)
    ends = np.cumsum(sizes[small])
    at = 0
    while at < len(small):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LINKS, "right")))
        g = small[at:upto]
        n = sizes[g]
        group = np.repeat(g, n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[group]
        add(doc[group] << 32 | a_ids[a0[group] + k // width] << B_BITS | b_ids[b0[group] + k % width])
        at = upto
    for g in np.flatnonzero(sizes > LINKS).tolist():  # a stretch where the two hardly ever meet: by different ids
        ua, na = np.unique(a_ids[a0[g] : a1[g]], return_counts=True)
        ub, nb = np.unique(b_ids[b0[g] : b1[g]], return_counts=True)
        step = max(1, LINKS // len(ub))
        for i in range(0, len(ua), step):
            keys = (int(doc[g]) << 32 | ua[i : i + step, None] << B_BITS | ub[None, :]).ravel()
            add(keys, (na[i : i + step, None] * nb[None, :]).ravel())
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def align(texts: list[str | None], pair: Pair, spelled: list[bytes], split) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, digest, pairs, times) of each text; ``spelled`` holds every id with ``,``, ``|`` and ``;``."""
    import hashlib

    import numpy as np

    words = [split(t) if t else [] for t in texts]
    pair.words_of(words)
    known = pair.known
    lanes_a, lanes_b, lane_doc = [], [], []
    for d, some in enumerate(words):
        found = list(map(known.__getitem__, some))
        if None in found:
            continue  # bytes differ somewhere: the document has no tokens
        for at in range(0, len(found), LANE_WORDS):
            run = found[at : at + LANE_WORDS]
            lanes_a.append(b"".join([x[0] for x in run]))
            lanes_b.append(b"".join([x[1] for x in run]))
            lane_doc.append(d)
    empty = (0, 0, 0, 0, "", b"", b"")
    if not lane_doc:
        return [empty] * len(texts)
    a_ids = np.frombuffer(b"".join(lanes_a), "<u2").astype(np.int64)
    b_ids = np.frombuffer(b"".join(lanes_b), "<u2").astype(np.int64)
    a_to = np.cumsum([len(x) // 2 for x in lanes_a])
    b_to = np.cumsum([len(x) // 2 for x in lanes_b])
    a_from, b_from = np.append(0, a_to[:-1]), np.append(0, b_to[:-1])
    lane, a1, b1 = lockstep(pair.a_sizes[a_ids], pair.b_sizes[b_ids], a_from, a_to, b_from)
    order = np.argsort(a1)  # groups in the order of their tokens
    doc, a1, b1 = np.array(lane_doc)[lane[order]], a1[order], b1[order]
    a0, b0 = np.append(0, a1[:-1]), np.append(0, b1[:-1])  # a document's tokens follow the one before
    keys, times = _pairs(doc, a_ids, b_ids, a0, a1, b0, b1)

    # The ids in the order of the spelling, each with the sign that follows it.
    group_a, group_b = np.repeat(np.arange(len(a1)), a1 - a0), np.repeat(np.arange(len(b1)), b1 - b0)
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    last_a, last_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    last_a[a1 - 1], last_b[b1 - 1] = 1, 2
    codes[np.arange(len(a_ids)) + b0[group_a]] = a_ids * 3 + last_a
    codes[np.arange(len(b_ids)) + a1[group_b]] = b_ids * 3 + last_b

    n = len(texts)
    docs = np.arange(n + 1)
    bounds = np.searchsorted(doc, docs)
    pair_bounds = np.searchsorted(keys, docs << 32)
    ids32, times32 = (keys & 0xFFFFFFFF).astype("<u4"), times.astype("<u4")
    links = np.append(0, np.cumsum((a1 - a0) * (b1 - b0)))
    out = []
    for d in range(n):
        g0, g1 = int(bounds[d]), int(bounds[d + 1])
        if g0 == g1:
            out.append(empty)
            continue
        x0, x1, y0, y1 = int(a0[g0]), int(a1[g1 - 1]), int(b0[g0]), int(b1[g1 - 1])
        text = b"".join(map(spelled.__getitem__, codes[x0 + y0 : x1 + y1].tolist()))
        p = slice(int(pair_bounds[d]), int(pair_bounds[d + 1]))
        digest = hashlib.sha256(memoryview(text)[:-1]).hexdigest()
        out.append((x1 - x0, y1 - y0, g1 - g0, int(links[g1] - links[g0]), digest, ids32[p].tobytes(), times32[p].tobytes()))
    return out


def _aligned(names):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        pair, split = Pair(*names), splitter()
        spelled = [b"%d%c" % (i, s) for i in range(max(len(pair.a_bytes), len(pair.b_bytes))) for s in b",|;"]
        kinds = [pa.int64(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
        columns = [c.split()[0] for c in ALIGNED.split(", ")]
        for batch in batches:
            texts = batch.column(2)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            at = 0
            while at < len(sizes):
                upto, held = at, 0
                while upto < len(sizes) and (upto == at or held + sizes[upto] <= SLICE_BYTES):
                    held += sizes[upto]
                    upto += 1
                some = batch.slice(at, upto - at)
                found = align(some.column(2).to_pylist(), pair, spelled, split)
                arrays = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *arrays], names=columns)
                at = upto

    return run


def _counted(batches):
    """(pair, documents that hold it) of some hundreds of documents at a time."""
    import numpy as np
    import pyarrow as pa

    held, size = [], 0

    def out():
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts, pa.int64())], names=["pair", "n"])

    for batch in batches:
        for x in batch.column(0):
            held.append(np.frombuffer(x.as_py() or b"", "<u4"))
            size += len(held[-1])
            if size > 2_000_000:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each linked id pair occurs, and whether no pair of its A id occurs in more."""
    parts = aligned.select("pairs").mapInArrow(_counted, "pair bigint, n bigint")
    counts = keep(parts.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    a = F.shiftright("pair", B_BITS)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _valued(pairs, counts, best):
    """n_best and count_sum over the commonest pairs, and every other pair of a document by itself."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                n_best, sums, rest = [], [], []
                for p, t in zip(some.column("pairs"), some.column("times"), strict=True):
                    keys, times = np.frombuffer(p.as_py(), "<u4"), np.frombuffer(t.as_py(), "<u4").astype(np.int64)
                    at = np.searchsorted(pairs, keys)
                    at[at == len(pairs)] = 0
                    here = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                    at, own = at[here], times[here]
                    n_best.append(int(own[best[at]].sum()))
                    sums.append(int((own * counts[at]).sum()))
                    other = np.flatnonzero(~here)
                    rest.append([{"pair": int(k), "times": int(n)} for k, n in zip(keys[other], times[other], strict=True)])
                columns = [*[some.column(c) for c in SHOWN], pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=[*SHOWN, "n_best", "count_sum", "rest"])

    return run


def aligned_documents(docs: DataFrame, tokenizers: tuple, doc_id: str = "doc_id", text: str = "text", table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    ``tokenizers`` holds the arguments of ``Pair``. Tokenizer A reads a space and the text, B the text. Null and empty
    texts and texts whose tokens do not spell them (those with U+2581) have zeros and an empty digest. Repeated rows and
    ids are documents of their own; a null id stays null; other columns are ignored; an empty table gives no rows.

    Every task holds the counts of the ``table_pairs`` commonest pairs at most. Pairs beyond them are joined: each occurs
    in no more documents than the rarest pair of the table, so none is hot.
    """
    import numpy as np

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = keep(rows.mapInArrow(_aligned(tokenizers), ALIGNED), "alignment")
    counts = keep(pair_counts(found), "alignment-pairs")
    common, total = counts, counts.count()
    if total > table_pairs:
        common = counts.orderBy(F.col("n").desc(), "pair").limit(table_pairs)
    table = common.toArrow().sort_by("pair")
    pairs, sizes, best = (np.asarray(table.column(c)) for c in ("pair", "n", "best"))
    narrow = (pairs.astype(np.uint32), sizes.astype(np.int64), best.astype(bool))
    value = ALIGNED.removesuffix(", pairs binary, times binary") + ", n_best bigint, count_sum bigint, rest array<struct<pair:bigint,times:bigint>>"
    valued = found.mapInArrow(_valued(*narrow), value)
    if total > table_pairs:
        valued = keep(valued, "alignment-values")
        rest = valued.select("row", F.explode("rest").alias("x")).select("row", "x.pair", "x.times").join(counts, "pair")
        more = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        valued = valued.join(more, "row", "left").withColumns(
            {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
        )
    return valued.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
