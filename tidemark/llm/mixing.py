"""Text scores from online logistic mixing of hashed-context bit predictors, beside an add-one word model.

A text is a row of lower-cased words and an end mark. Frequent words have Huffman codes of their own; one more code, the
escape, stands for any other word, which is then spelled in bytes with a blank behind it, bytes again in bits of Huffman
codes. For every bit several predictors look up the counts of zeros and ones seen after their context in hashed tables.
Bits of a word's code have the code so far, alone and behind the word before; bits of a spelled word have one context for
each length inside the word. Log odds are mixed by weights, chosen by how often the longest known context was seen;
weights go on learning inside each text, and a last table corrects the mixed odds by what the text has shown.

Counts come from the whole training corpus: words are counted by Spark, and the bit tables are sums over the counted
words and over the texts' pairs of words. Texts are scored in chunks: a chunk carries its texts as word numbers and its
different words once, joined to their counts, so what is shuffled for counting are different words, not texts.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from functools import cached_property
from itertools import count as counting, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import keep

ORDERS = (1, 2, 3, 5, 16)  # context lengths in bytes, inside the word
SLOTS = (16, 20)  # each predictor has 2^16 to 2^20 hashed contexts, by the bytes of the different words; that over words twice as many
CHUNK_TOKENS = 1_500_000
CHUNK_SPELLED = 3_000_000  # bytes of a chunk's different words: scoring holds about 75 bytes for each of those outside the vocabulary
END = b"\n"  # no word holds white space
PRIOR = 0.05  # added to both counts of a context
GRADES = 4  # of a context's count
BUCKETS = 33  # of mixed odds in the last correction
SCALE = 1024  # scoring holds log odds as whole numbers of 1 / SCALE
BLOCKS = (8, 128)  # words after which weights are renewed: first, and at most
STEP = 0.1  # most that a block changes a weight
LANES = 64  # texts that advance together
VOCABULARY = 1 << 18  # at most so many words have codes; all others are spelled, as are words that occur once or are longer than
LONGEST = 64  # bytes
GRADE_BITS = 4
GRADES_BEHIND = 1 << GRADE_BITS  # of the count of a step behind a word
BEHIND_SCALE = 64  # log odds behind a word are whole numbers of 1 / BEHIND_SCALE: with the grade they take 16 bits

TEXTS = "doc_id array<bigint>, held_out array<boolean>, learn array<boolean>, bytes array<bigint>, tokens array<bigint>, ids binary, words binary"
CHUNKS = f"chunk bigint, {TEXTS}"


def chunked(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """A row for each chunk: its texts as word numbers, and its words in the order of their numbers.

    ``docs`` is (doc_id, text, held_out, learn). A chunk is filled inside one task and closed after ``chunk_tokens`` or
    ``CHUNK_SPELLED``; a text that goes beyond them is a chunk's last.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        press = zstandard.ZstdCompressor(level=1)
        chunk = TaskContext.get().partitionId() << 32
        kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]

        def closed(rows, ids, numbers):
            # The four bytes of the numbers lie apart: the upper ones are nearly all zero.
            planes = np.concatenate(ids).view(np.uint8).reshape(-1, 4).T.tobytes()
            columns = [pa.array([chunk], pa.int64()), *(pa.array([[r[i] for r in rows]], pa.list_(k)) for i, k in enumerate(kinds))]
            columns += [pa.array([press.compress(planes)], pa.binary()), pa.array([press.compress(b" ".join(numbers))], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", *(f.split()[0] for f in TEXTS.split(", "))])

        rows, texts, numbers, held, spelled = [], [], defaultdict(counting().__next__), 0, 0
        for batch in batches:
            for name, text, out, learn in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = (text.as_py() or b"").lower().split()
                size = sum(map(len, words)) + len(words)
                words.append(END)
                known = len(numbers)
                ids = np.fromiter(map(numbers.__getitem__, words), "<u4", len(words))
                fresh = len(numbers) - known
                spelled += sum(map(len, islice(reversed(numbers), fresh))) + fresh
                rows.append((name.as_py(), out.as_py(), learn.as_py(), size, len(ids)))
                texts.append(ids)
                held += len(ids)
                if held >= chunk_tokens or spelled >= CHUNK_SPELLED:
                    yield closed(rows, texts, numbers)
                    rows, texts, numbers, held, spelled, chunk = [], [], defaultdict(counting().__next__), 0, 0, chunk + 1
        if rows:
            yield closed(rows, texts, numbers)

    return docs.mapInArrow(run, CHUNKS)


def opened(ids: bytes, words: bytes, tokens):
    """A chunk's words, the word numbers of its texts, and before each the number of the word before (the end mark's at a text's begin)."""
    import numpy as np
    import zstandard

    press = zstandard.ZstdDecompressor()
    numbers = np.frombuffer(press.decompress(ids), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    spelling = press.decompress(words).split(b" ")
    before = np.concatenate(([0], numbers[:-1]))
    before[np.cumsum(tokens) - tokens] = spelling.index(END)
    return spelling, numbers, before


def learned_counts(ids, tokens, learn, kinds: int):
    """How often each of a chunk's words occurs in its texts to learn."""
    import numpy as np

    return np.bincount(ids[np.repeat(np.array(learn, bool), tokens)], minlength=kinds)


def words_of(chunks: DataFrame, outside: Vocabulary | None = None) -> DataFrame:
    """(chunk, place, word) for each different word of a chunk, or for those outside a vocabulary; its count in texts to learn stands above the 32 bits of its number."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                tokens = np.array(row["tokens"])
                words, ids, _ = opened(row["ids"], row["words"], tokens)
                place = (learned_counts(ids, tokens, row["learn"], len(words)) << 32) + np.arange(len(words))
                if outside:
                    place = place[outside.numbers(words) == outside.escape]
                    words = list(map(words.__getitem__, (place & 0xFFFFFFFF).tolist()))
                for at in range(0, len(words), 20_000):
                    some = words[at : at + 20_000]
                    columns = [pa.array(np.full(len(some), row["chunk"])), pa.array(place[at : at + 20_000]), pa.array(some, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["chunk", "place", "word"])

    return chunks.select("chunk", "learn", "tokens", "ids", "words").mapInArrow(run, "chunk bigint, place bigint, word binary")


def huffman(counts) -> list[list[tuple[int, int]]]:
    """For each byte its (inner node, bit) steps from the root; every byte has a code."""
    heap = [(int(n) + 1, i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    children, number = {}, len(counts)
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        children[number] = (x, y)
        heapq.heappush(heap, (a + b, number, number))
        number += 1
    codes, ahead = [[] for _ in counts], [(number - 1, [])]
    while ahead:
        node, path = ahead.pop()
        if node in children:
            for bit, child in enumerate(children[node]):
                ahead.append((child, [*path, (node - len(counts), bit)]))
        else:
            codes[node] = path
    return codes


class Speller:
    """Bits of words, and where each predictor looks them up."""

    def __init__(self, codes, orders=ORDERS, slots: int = SLOTS):
        import numpy as np

        self.orders, self.slots = orders, slots
        self.sizes = np.array([len(c) for c in codes])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        flat = np.array([step for c in codes for step in c], np.uint32).reshape(-1, 2)
        self.nodes, self.bits = flat[:, 0], flat[:, 1].astype(np.int8)

    def bits_of(self, words):
        """The number of bits of each word."""
        import numpy as np

        data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        ends = np.flatnonzero(data == 32)
        return np.add.reduceat(self.sizes[data], np.concatenate(([0], ends[:-1] + 1)))

    def spelled(self, words):
        """(bits of each word, bit values, lookup slots: a row for each predictor)."""
        import numpy as np

        data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        ends = np.flatnonzero(data == 32)
        begins = np.concatenate(([0], ends[:-1] + 1))
        place = np.arange(len(data)) - np.repeat(begins, ends - begins + 1)
        sizes = self.sizes[data]
        which = np.repeat(np.arange(len(data)), sizes)
        step = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.starts[data][which]
        salt, bit = self.nodes[step] * np.uint32(0xC2B2AE35), self.bits[step]
        slots = np.empty((len(self.orders), len(which)), np.int32)
        context, done = np.full(len(data), 0x9E3779B1, np.uint32), 0
        for row, order in enumerate(self.orders):
            for back in range(done + 1, order + 1):
                before = np.zeros(len(data), np.uint32)
                before[back:] = data[:-back]
                before = np.where(place >= back, before + 1, 0).astype(np.uint32)
                context = (context ^ before) * np.uint32(0x85EBCA6B)
                context ^= context >> np.uint32(13)
            done = order
            mixed = (context[which] + salt) * np.uint32(0x27D4EB2F)
            slots[row] = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(32 - self.slots)
        return np.add.reduceat(sizes, begins), bit, slots


def evidence_tables(counts, left_out: bool = False):
    """(odds, gates), a row for each predictor: log odds of a one, times SCALE, and the gate that each slot stands for, 0 if unknown.

    The gate of a bit is that of its longest known context, with four grades of the context's count. With ``left_out``
    rows are twice as long: each slot without one zero, then without one one. They say what the counts would have said of
    a bit's occurrence before it was counted.
    """
    import numpy as np

    odds, gates = [], []
    for row, (zeros, ones) in enumerate(counts):
        if left_out:
            zeros, ones = np.concatenate((np.maximum(zeros - 1, 0), zeros)), np.concatenate((ones, np.maximum(ones - 1, 0)))
        n = ones + zeros
        grade = np.minimum(GRADES - 1, np.log2(np.maximum(n, 1)).astype(np.int64) // 2)
        odds.append(np.rint(np.log((ones + PRIOR) / (zeros + PRIOR)) * SCALE).astype(np.int16))
        gates.append(np.where(n > 0, 1 + GRADES * row + grade, 0).astype(np.int8))
    return np.array(odds), np.array(gates)


def evidence(tables, slots):
    """(log odds of a one, times SCALE, a row for each predictor; gate of each bit)."""
    import numpy as np

    odds, gate = np.empty(slots.shape, tables[0].dtype), np.zeros(slots.shape[1], np.int8)
    for row, where in enumerate(slots):
        tables[0][row].take(where, out=odds[row], mode="clip")
        own = tables[1][row].take(where)
        np.copyto(gate, own, where=own > 0)
    return odds, gate


def _summed(per_task: DataFrame, size: int):
    """Element-wise sums of packed doubles, (block, packed) -> {block: array}; blocks meet in as many tasks as there are."""
    import numpy as np

    def add(table):
        import numpy as np
        import pyarrow as pa

        import zstandard

        total, open_ = np.zeros(size), zstandard.ZstdDecompressor()
        for packed in table.column("packed"):
            total += np.frombuffer(open_.decompress(packed.as_py()))
        return pa.table({"block": table.column("block")[:1], "packed": pa.array([total.tobytes()], pa.binary())})

    rows = per_task.groupBy("block").applyInArrow(add, "block int, packed binary").collect()
    return {r.block: np.frombuffer(r.packed) for r in rows}


def _packed(batch_of):
    def run(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for block, values in batch_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([press.compress(values.tobytes())], pa.binary())], names=["block", "packed"])

    return run


def byte_counts(counted: DataFrame):
    import numpy as np

    def count(batches):
        total = np.zeros(256)
        for batch in batches:
            words, n = batch.column(0).to_pylist(), np.array(batch.column(1), float)
            data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
            sizes = np.array([len(w) + 1 for w in words])
            total += np.bincount(data, np.repeat(n, sizes), 256)
        yield 0, total

    return _summed(counted.select("word", "n").mapInArrow(_packed(count), "block int, packed binary"), 256).get(0, np.zeros(256))


def bit_counts(counted: DataFrame, speller: Speller):
    """Array (predictor, bit, slot): zeros and ones after each hashed context in the counted words."""
    import numpy as np

    predictors, slots, part = len(speller.orders), 1 << speller.slots, 1 << 14

    def count(batches):
        total = np.zeros((predictors, 2 * slots), np.float32)
        for batch in batches:
            words, n = batch.column(0).to_pylist(), np.array(batch.column(1), float)
            for at in range(0, len(words), 10_000):
                sizes, bit, where = speller.spelled(words[at : at + 10_000])
                weight = np.repeat(n[at : at + 10_000], sizes).astype(np.float32)
                side = bit.astype(np.int64) * slots
                for row in range(predictors):
                    np.add.at(total[row], where[row] + side, weight)
        yield from _blocks(total.ravel(), part)

    return _table(counted.select("word", "n").mapInArrow(_packed(count), "block int, packed binary"), predictors * 2 * slots, part).reshape(predictors, 2, slots)


def _blocks(flat, part):
    for block in range(len(flat) // part):
        piece = flat[block * part : (block + 1) * part]
        if piece.any():
            yield block, piece.astype(float)


def _table(per_task: DataFrame, size: int, part: int):
    import numpy as np

    flat = np.zeros(size, np.float32)
    for block, values in _summed(per_task, part).items():
        flat[block * part : (block + 1) * part] = values
    return flat


class Vocabulary:
    """Frequent words, each with a code of bits, and one more code, ``ESCAPE``, for all other words.

    Codes are canonical: the commoner symbols come first, and the symbols below an inner node lie side by side. Tasks get
    the words, their counts and the lengths of their codes; the rest is made there, once a task.
    """

    def __init__(self, words, counts, others: int):
        """``others`` is how often words outside the vocabulary occur."""
        import numpy as np
        import zstandard

        weights = np.concatenate((np.array(counts, np.int64), [others]))
        order = np.argsort(-weights, kind="stable")
        listed = [*words, b""]
        self.escape, self.counts = int(np.flatnonzero(order == len(words))[0]), weights[order]
        self.words = zstandard.ZstdCompressor().compress(b" ".join(map(listed.__getitem__, order.tolist())))
        self._sizes = np.sort(code_sizes(self.counts + 1)).astype(np.uint8)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("escape", "counts", "words", "_sizes")}

    @cached_property
    def sizes(self):
        """The number of bits of each symbol."""
        return self._sizes.astype(int)

    @cached_property
    def starts(self):
        """Where the steps of each symbol begin in ``rows``."""
        import numpy as np

        return np.cumsum(self.sizes) - self.sizes

    @cached_property
    def rows(self):
        """Rows of four 16-bit numbers for the steps of all codes: log odds of a one, times SCALE, whatever the word before; bit; node.

        A node is a hash of the four, eight or more bits that all have, with the place among the next four in its lowest four
        bits. Steps are made depth by depth, so nothing else grows with them.
        """
        import numpy as np

        codes, weight, one = self._codes(), self.counts + 0.5, np.uint64(1)
        rows = np.empty((int(self.sizes.sum()), 4), np.int16)
        nodes = rows.view(np.uint32)[:, 1]
        for depth in range(int(self.sizes[-1])):
            first = int(np.searchsorted(self.sizes, depth, "right"))  # codes that end before are no part of a node here
            left = (self.sizes[first:] - depth).astype(np.uint64)
            prefix, bit = codes[first:] >> left, codes[first:] >> (left - one) & one
            begins = np.concatenate(([0], np.flatnonzero(np.diff(prefix)) + 1))
            ones, every = np.add.reduceat(weight[first:] * bit, begins), np.add.reduceat(weight[first:], begins)
            odds = np.rint(np.log(ones / (every - ones)) * SCALE).astype(np.int16)
            since = np.uint64(depth % 4)
            group = (prefix >> since | one << np.uint64(depth - depth % 4)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
            place = prefix & ((one << since) - one) | one << since
            where = self.starts[first:] + depth
            rows[where, 0], rows[where, 1] = np.repeat(odds, np.diff(np.append(begins, len(prefix)))), bit
            nodes[where] = group & np.uint64(0xFFFFFFF0) | place
        return rows

    @cached_property
    def fetched(self):
        """``rows`` as one number each, to be taken at once."""
        import numpy as np

        return self.rows.view(np.int64).ravel()

    def _codes(self):
        """Numbers spelled by the codes' bits."""
        import numpy as np

        codes, code, last = np.zeros(len(self.sizes), np.uint64), 0, int(self.sizes[0])
        for size in range(last, int(self.sizes[-1]) + 1):
            first, end = np.searchsorted(self.sizes, [size, size + 1])
            code <<= size - last
            codes[first:end] = np.arange(code, code + end - first, dtype=np.uint64)
            code, last = code + int(end - first), size
        return codes

    @cached_property
    def _numbers(self):
        import zstandard

        listed = zstandard.ZstdDecompressor().decompress(self.words).split(b" ")
        return {w: i for i, w in enumerate(listed) if i != self.escape}

    def numbers(self, words):
        """The symbol of each word; ``escape`` for those outside."""
        import numpy as np

        return np.fromiter((self._numbers.get(w, self.escape) for w in words), np.int64, len(words))


def code_sizes(weights):
    """Lengths of Huffman codes for descending weights; one symbol alone gets no bit."""
    import numpy as np

    n = len(weights)
    made, parent, leaf, inner = [*weights[::-1].tolist(), *[0] * (n - 1)], np.zeros(2 * n - 1, np.int64), 0, n
    for new in range(n, 2 * n - 1):
        for _ in range(2):
            if leaf < n and (inner >= new or made[leaf] <= made[inner]):
                least, leaf = leaf, leaf + 1
            else:
                least, inner = inner, inner + 1
            parent[least] = new
            made[new] += made[least]
    up, depth = parent.tolist(), [0] * (2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[up[node]] + 1
    return np.array(depth[:n][::-1])


def marks_of(words):
    """A hash of each word, as the word before another."""
    import zlib

    import numpy as np

    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) * np.uint32(0x9E3779B1)


def behind_slots(nodes, mark, slots: int):
    """Lookup slots of steps (their nodes) behind a word (its hash, for each step); four steps have theirs in one stretch of 16."""
    import numpy as np

    mixed = nodes | np.uint32(15)
    mixed ^= mark
    mixed *= np.uint32(0x27D4EB2F)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x9E3779B1)
    mixed >>= np.uint32(32 - slots)
    mixed ^= nodes & np.uint32(15)
    return mixed


def learned_pairs(row, vocabulary: Vocabulary):
    """(hash of the word before, symbol, how often) for each different pair in a chunk's texts to learn."""
    import numpy as np

    tokens = np.array(row["tokens"])
    words, ids, before = opened(row["ids"], row["words"], tokens)
    learned, kinds = np.repeat(np.array(row["learn"], bool), tokens), len(vocabulary.sizes)
    pairs, times = np.unique((before * kinds + vocabulary.numbers(words)[ids])[learned], return_counts=True)
    first, symbol = np.divmod(pairs, kinds)
    return marks_of(words)[first], symbol, times


def counts_behind(chunks: DataFrame, vocabulary: Vocabulary, slots: int):
    """Array (bit, slot): zeros and ones at each step of a code after each word, over all pairs of words of the texts to learn."""
    import numpy as np

    part = 1 << 14

    def count(batches):
        total = np.zeros(2 << slots, np.float32)
        for batch in batches:
            for row in batch.to_pylist():
                marks, symbols, times = learned_pairs(row, vocabulary)
                for at in range(0, len(times), 20_000):
                    symbol = symbols[at : at + 20_000]
                    n = vocabulary.sizes[symbol]
                    found = vocabulary.fetched.take(ranges(vocabulary.starts[symbol], n))
                    slot = behind_slots(found.view(np.uint32)[1::2], np.repeat(marks[at : at + 20_000], n), slots)
                    slot = slot + (found.view(np.int16)[1::4].astype(np.int64) << slots)
                    np.add.at(total, slot, np.repeat(times[at : at + 20_000].astype(np.float32), n))
        yield from _blocks(total, part)

    rows = chunks.select("learn", "tokens", "ids", "words")
    return _table(rows.mapInArrow(_packed(count), "block int, packed binary"), 2 << slots, part).reshape(2, 1 << slots)


def odds_behind(counts, left_out=None):
    """Log odds of a one, times BEHIND_SCALE, above ``GRADE_BITS`` for the grade of the count: 0 unknown, 1 once, then by powers of two.

    ``left_out`` is a bit that the counts hold and that is taken out first.
    """
    import numpy as np

    zeros, ones = counts
    if left_out is not None:
        zeros, ones = np.maximum(zeros - (left_out == 0), 0), np.maximum(ones - (left_out == 1), 0)
    n = zeros + ones
    grade = np.where(n > 0, 1 + np.minimum(np.log2(np.maximum(n, 1)).astype(np.int16), GRADES_BEHIND - 2), 0)
    return np.rint(np.log((ones + PRIOR) / (zeros + PRIOR)) * BEHIND_SCALE).astype(np.int16) * np.int16(GRADES_BEHIND) + grade.astype(np.int16)


def weights_behind(chunks: DataFrame, vocabulary: Vocabulary, counts):
    """Weights (grade; all words, word before) that texts start from: Newton steps over all pairs of words, block by block, averaged over tasks.

    Each pair is taken out of the counts before its bits are predicted.
    """
    import numpy as np
    import zstandard

    slots, size = counts.shape[1].bit_length() - 1, GRADES_BEHIND
    # Without one zero, then without one one: what the counts would have said before a bit was counted.
    pressed = zstandard.ZstdCompressor(level=1).compress(np.concatenate([odds_behind(counts, bit) for bit in (0, 1)]).tobytes())
    first = np.tile([1.0, 0.0], (size, 1))

    def fit(batches):
        import zstandard

        tables = np.frombuffer(zstandard.ZstdDecompressor().decompress(pressed), np.int16)
        weights, curve, seen = first.copy(), np.tile(np.eye(2), (size, 1, 1)), np.zeros(size)
        for batch in batches:
            for row in batch.to_pylist():
                marks, symbols, times = learned_pairs(row, vocabulary)
                mixed = np.random.default_rng(0).permutation(len(times))  # pairs lie by words, of which the frequent come first
                for at in range(0, len(times), 20_000):
                    some = mixed[at : at + 20_000]
                    n = vocabulary.sizes[symbols[some]]
                    found = vocabulary.fetched.take(ranges(vocabulary.starts[symbols[some]], n))
                    y = found.view(np.int16)[1::4]
                    slot = behind_slots(found.view(np.uint32)[1::2], np.repeat(marks[some], n), slots)
                    packed = tables.take(slot + (y.astype(np.int64) << slots))
                    grade, often = packed & (size - 1), np.repeat(times[some].astype(float), n)
                    x = found.view(np.int16)[::4] / SCALE, (packed >> GRADE_BITS) / BEHIND_SCALE
                    before, bent = weights.copy(), curve
                    for _ in range(6):
                        own = weights.take(grade, axis=0)
                        p = 1 / (1 + np.exp(-np.clip(x[0] * own[:, 0] + x[1] * own[:, 1], -30, 30)))
                        missed, bend = often * (y - p), often * p * (1 - p)
                        slope = np.stack([np.bincount(grade, missed * v, size) for v in x], 1)
                        a, b, c = (np.bincount(grade, bend * v * w, size) for v, w in ((x[0], x[0]), (x[0], x[1]), (x[1], x[1])))
                        curve = bent + np.stack((a, b, b, c), 1).reshape(size, 2, 2)
                        left = slope - (bent @ (weights - before)[:, :, None])[:, :, 0]
                        step = np.clip(np.linalg.solve(curve, left[:, :, None])[:, :, 0], -1, 1)
                        weights += step
                        if np.abs(step).max() < 0.01:  # after the first pairs, one step is enough
                            break
                    seen += np.bincount(grade, often, size)
        yield 0, np.concatenate((seen, (weights * seen[:, None]).ravel()))

    rows = chunks.select("learn", "tokens", "ids", "words")
    total = _summed(rows.mapInArrow(_packed(fit), "block int, packed binary"), 3 * size).get(0, np.zeros(3 * size))
    seen = total[:size, None]
    return np.where(seen > 0, total[size:].reshape(size, 2) / np.maximum(seen, 1), first).astype(np.float32)


def ranges(starts, sizes):
    """The numbers start to start + size of each pair, one after the other."""
    import numpy as np

    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def first_weights(counted: DataFrame, speller: Speller, counts):
    """Mixing weights (gate, predictor) that texts start from: online Newton steps over all counted words, averaged.

    Each occurrence is taken out before it is predicted, so long contexts are trusted as on new text.
    """
    import numpy as np

    predictors, slots = len(speller.orders), 1 << speller.slots
    gates = 1 + GRADES * predictors
    tables = evidence_tables(counts, left_out=True)

    def fit(batches):
        weights = np.full((gates, predictors), 1.0 / predictors)
        curve = np.tile(np.eye(predictors) * 50.0, (gates, 1, 1))
        seen = np.zeros(gates)
        for batch in batches:
            words, n = batch.column(0).to_pylist(), np.array(batch.column(1), float)
            for at in range(0, len(words), 5000):
                sizes, bit, where = speller.spelled(words[at : at + 5000])
                root = np.repeat(np.sqrt(n[at : at + 5000]).astype(np.float32), sizes)
                x, gate = evidence(tables, where + bit.astype(np.int32) * slots)
                by_gate = np.argsort(gate, kind="stable")
                for mine in np.split(by_gate, np.flatnonzero(np.diff(gate[by_gate])) + 1):
                    g = gate[mine[0]]
                    own, y, w = (x[:, mine] * np.float32(1 / SCALE)).T, bit[mine], root[mine]
                    p = 1 / (1 + np.exp(-own @ weights[g].astype(np.float32)))
                    curve[g] += (own * (w * p * (1 - p))[:, None]).T @ own
                    weights[g] += np.linalg.solve(curve[g], own.T @ (w * (y - p)))
                    seen[g] += w.sum()
        yield 0, np.concatenate((seen, (weights * seen[:, None]).ravel()))

    size = gates * (predictors + 1)
    total = _summed(counted.select("word", "n").mapInArrow(_packed(fit), "block int, packed binary"), size).get(0, np.zeros(size))
    seen = total[:gates]
    weights = total[gates:].reshape(gates, predictors) / np.maximum(seen, 1)[:, None]
    weights[seen == 0] = 1.0 / predictors
    return weights.astype(np.float32)


def bit_rows(speller: Speller, words, tables):
    """(bits of each word, rows of eight 16-bit numbers): log odds of up to five predictors, and at the sixth place gate and bit.

    One row of 16 bytes is fetched at once. The arrays have their size from the start, so nothing is held twice.
    """
    import numpy as np

    if not words:
        return np.zeros(0, np.int64), np.zeros((0, 8), np.int16)
    sizes = np.concatenate([speller.bits_of(words[at : at + 10_000]) for at in range(0, len(words), 10_000)])
    rows, done = np.zeros((int(sizes.sum()), 8), np.int16), 0
    for at in range(0, len(words), 10_000):
        _, bit, where = speller.spelled(words[at : at + 10_000])
        odds, gate = evidence(tables, where)
        own = rows[done : done + len(bit)]
        own[:, : len(odds)], own[:, 5] = odds.T, gate * 2 + bit
        done += len(bit)
    return sizes, rows


def text_bits(ids, tokens, sizes, rows, weights, marks=None, behind=None, rate: float = 0.02):
    """Bits that the mixture spends on each text, learning block by block from what it has coded of that text.

    Texts of like length advance together, each with weights and corrections of its own. ``rows`` are those of the
    words: log odds first, then gate and bit. With ``behind``, a table of slots, they are rows of a vocabulary, ``marks``
    are the hashes of the words before, and the slot's log odds and grade are the last predictor and the gate.
    """
    import numpy as np

    gates, predictors = weights.shape
    slots = behind is not None and len(behind).bit_length() - 1
    fetched = rows.view(np.int64 if rows.shape[1] == 4 else np.complex128).ravel()
    starts, order, total = np.cumsum(tokens) - tokens, np.argsort(-tokens, kind="stable"), np.zeros(len(tokens))
    offsets = np.cumsum(sizes) - sizes
    start = np.ascontiguousarray(weights.T / SCALE, np.float32)  # log odds are multiples of 1 / SCALE
    for first in range(0, len(order), LANES):
        lanes = order[first : first + LANES]
        own = np.tile(start, (1, len(lanes)))
        shift = np.zeros(len(lanes) * gates * BUCKETS, np.float32)
        at, step = 0, BLOCKS[0]
        while at < tokens[lanes[0]]:
            lanes = lanes[tokens[lanes] > at]  # the shorter ones come last and are done first
            n = np.minimum(tokens[lanes] - at, step)
            place = ranges(starts[lanes] + at, n)
            words = ids[place]
            long = sizes[words]
            ends = np.cumsum(n) - n
            per_lane = np.add.reduceat(long, ends)
            found = fetched.take(ranges(offsets[words], long)).view(np.int16).reshape(-1, rows.shape[1])
            g = np.repeat(np.arange(len(lanes)) * gates, per_lane)
            if slots:
                slot = behind_slots(found.view(np.uint32)[:, 1], np.repeat(marks[place], long), slots)
                packed = behind.take(slot)
                f = [found[:, 0].astype(np.float32), (packed >> GRADE_BITS) * np.float32(SCALE / BEHIND_SCALE)]
                g += packed & (GRADES_BEHIND - 1)
                s = found[:, 1]
            else:
                f = [found[:, j].astype(np.float32) for j in range(predictors)]
                g += found[:, 5] >> 1
                s = found[:, 5] & 1
            s = (s * 2 - 1).astype(np.float32)
            z = f[0] * own[0].take(g)
            for j in range(1, predictors):
                z += f[j] * own[j].take(g)
            np.clip(z, -30, 30, out=z)
            bucket = z * ((BUCKETS - 1) / 16)
            bucket += BUCKETS / 2
            bucket = np.clip(bucket, 0, BUCKETS - 0.5, out=bucket).astype(np.intp)
            bucket += g * BUCKETS
            likely = 1 / (1 + np.exp((z + shift.take(bucket)) * -s))  # of the bit that came
            lanes_at = np.cumsum(per_lane) - per_lane
            total[lanes] -= np.add.reduceat(np.log(np.maximum(likely, 1e-12)), lanes_at, dtype=np.float64)
            at += step
            if at >= tokens[lanes[0]]:
                break
            step = min(2 * step, BLOCKS[1])
            error = s / (1 + np.exp(z * s))
            scale = rate / np.sqrt(1 + np.bincount(g, minlength=own.shape[1])) / SCALE
            for j in range(predictors):
                own[j] += np.clip(scale * np.bincount(g, error * f[j], own.shape[1]), -STEP, STEP) / SCALE
            missed = 1 - likely
            left = np.bincount(bucket, s * missed, len(shift))
            room = np.bincount(bucket, likely * missed, len(shift))
            shift += np.clip(left / (room + 20.0), -1, 1).astype(np.float32)
    return total / float(np.log(2.0))


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"


def slots_for(spelled: int) -> int:
    """Binary digits of a table's slots for ``spelled`` bytes of different words, each of about four bits."""
    return min(SLOTS[1], max(SLOTS[0], (4 * spelled).bit_length()))


def least_count(counted: DataFrame) -> int:
    """The least count, 2 or more, that so many words reach that they are at most ``VOCABULARY``."""
    by_count = counted.where((F.col("n") > 1) & (F.octet_length("word") <= LONGEST)).groupBy("n").count().collect()
    words, least = 0, 2
    for n, more in sorted(((r["n"], r["count"]) for r in by_count), reverse=True):
        words += more
        if words > VOCABULARY:
            least = n + 1
            break
    return least


def vocabulary_of(listed: DataFrame, tokens: int) -> Vocabulary:
    """The vocabulary of (word, n), a bounded table, out of ``tokens`` words in all."""
    found = listed.select("word", "n").toArrow().sort_by("word")
    counts = found.column("n").to_numpy()
    return Vocabulary(found.column("word").to_pylist(), counts, tokens - int(counts.sum()))


def scored(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS, orders=ORDERS, slots: int | None = None) -> DataFrame:
    """One row for each of ``docs`` (doc_id, text, held_out, learn): base_score and score are log10 probabilities.

    Rows with ``learn`` teach both models. A null text is empty: its only token is the end. Repeated rows are scored
    each, and count as often as they occur. Without training rows every word is unknown and every bit costs one bit.
    """
    import numpy as np

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), "held_out", "learn")
    chunks = keep(chunked(rows, chunk_tokens), "lm-chunks")
    words, n = words_of(chunks), F.shiftright("place", 32)
    counted = keep(words.where(n > 0).groupBy("word").agg(F.sum(n).alias("n")), "lm-words")
    tokens, kinds, spelled = counted.agg(F.sum("n"), F.count("*"), F.sum(F.octet_length("word") + 1)).first()
    tokens, slots = tokens or 0, slots or slots_for(spelled or 0)
    listed = (F.octet_length("word") <= LONGEST) & (F.col("n") >= least_count(counted))
    vocabulary = vocabulary_of(counted.where(listed), tokens)
    # Words outside the vocabulary are spelled as often as they occur; those in it show once how words look.
    counted = counted.withColumn("spelled", F.when(listed, 1).otherwise(F.col("n")))
    teaching = counted.select("word", F.col("spelled").alias("n"))
    speller = Speller(huffman(byte_counts(teaching)), orders, slots)
    counts = bit_counts(teaching, speller)
    weights = first_weights(teaching, speller, counts)
    tables = evidence_tables(counts)
    after = counts_behind(chunks, vocabulary, slots + 1)
    weights_after, behind = weights_behind(chunks, vocabulary, after), odds_behind(after)

    def score(texts, listed):
        import pyarrow as pa

        row = texts.to_pylist()[0]
        tokens_of = np.array(row["tokens"])
        spelling, ids, before = opened(row["ids"], row["words"], tokens_of)
        # A word that no other chunk has learned has no row: its count is that of this chunk.
        c = learned_counts(ids, tokens_of, row["learn"], len(spelling)).astype(float)
        c[np.asarray(listed.column("at"))] = np.asarray(listed.column("c"))
        symbols = vocabulary.numbers(spelling)
        coded = symbols != vocabulary.escape
        c[coded] = vocabulary.counts[symbols[coded]]
        spent = np.zeros(len(tokens_of))
        if len(vocabulary.sizes) > 1:
            spent += text_bits(symbols[ids], tokens_of, vocabulary.sizes, vocabulary.rows, weights_after, marks_of(spelling)[before], behind)
        outside, at = np.flatnonzero(~coded), np.cumsum(~coded) - 1
        sizes, rows = bit_rows(speller, [spelling[i] for i in outside], tables)
        del spelling
        is_spelled = ~coded[ids]
        lengths = np.add.reduceat(is_spelled, np.cumsum(tokens_of) - tokens_of, dtype=np.int64)
        spent += text_bits(at[ids[is_spelled]], lengths, sizes, rows, weights)
        text_of = np.repeat(np.arange(len(tokens_of)), tokens_of)
        base = np.bincount(text_of, np.log10(c + 1.0)[ids], len(tokens_of)) - tokens_of * float(np.log10(tokens + kinds + 1))
        known = np.bincount(text_of, c[ids] > 0, len(tokens_of)).astype(np.int64)
        columns = [
            pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(tokens_of), pa.array(known),
            pa.array(np.full(len(tokens_of), tokens)), pa.array(base), pa.array(-spent * float(np.log10(2.0))),
            pa.array(spent / np.maximum(1, np.array(row["bytes"]))),
        ]
        return pa.Table.from_arrays(columns, names=[f.split()[0] for f in RESULT.split(", ")])

    # Only counts travel back to the chunks, and only those that a chunk does not know by itself.
    outside = counted.where(~listed).select("word", F.col("n").alias("c"))
    joined = words_of(chunks, vocabulary).join(outside, "word").where(n != F.col("c"))
    joined = joined.select(F.col("chunk").alias("piece"), F.col("place").bitwiseAND((1 << 32) - 1).cast("int").alias("at"), "c")
    return chunks.groupBy("chunk").cogroup(joined.groupBy("piece")).applyInArrow(score, RESULT)
