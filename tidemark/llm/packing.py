"""Token packing: non-negative least squares over window fillings, then greedy packing of what is left.

Documents are cut into whole windows and one remainder each. Shallow combinations of two or three remainder lengths that
fill a window exactly are enumerated; non-negative least squares finds how often each is repeated so that the histogram
of remainders is used up; the counts are rounded down to what is there. Remainders left over are laid end to end,
longest first, and cut at window ends. The last open window is cut into powers of two, which need no padding.

A run of documents of ``RUN_TOKENS`` tokens is packed by itself, as it streams through a task: no shuffle, no table of
the corpus, memory bounded by the run and the longest text. Padding is zero, so a wider view could not save any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 1024
RUN_TOKENS = 1_000_000
CACHE_WORDS = 150_000  # more than the different words of ``AT_ONCE`` texts, so that words outlive a call
AT_ONCE = 250  # texts encoded in one call

# Unicode White_Space, as the tokenizer's own splitting pattern counts it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    """texts -> ids of each as little-endian unsigned 32-bit bytes, equal to the JSON tokenizer's ids.

    A space before a word starts a token, so each different word is encoded once and kept; ``ranks_path`` names the
    same vocabulary for a faster encoder, which gets words of Latin letters, digits and ASCII signs. Anything else, and
    texts with the vocabulary's special strings, go through the JSON tokenizer itself.
    """
    import base64
    import re

    import numpy as np
    from tokenizers import Tokenizer

    main = Tokenizer.from_file(json_path)
    special = [t.content for t in main.get_added_tokens_decoder().values()]
    chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
    wide = re.compile(f" [{SPACE}]| \\Z").search
    latin = re.compile("[ -~\u00a1-\u017f]*").fullmatch
    fast = None
    if ranks_path:
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    newline = main.encode("\n", add_special_tokens=False).ids[0]
    after_space: dict[str, bytes] = {}  # ids of a space and the word
    bare: dict[str, bytes] = {}

    def learn(known, words, lead):
        simple, other = [], []
        for word in words:
            if not (fast and (word.isascii() or latin(word))) or word.isspace():
                other.append(word)
            elif "\n" in word:
                known[word] = np.array(fast.encode_ordinary(lead + word), "<u4").tobytes()
            else:
                simple.append(word)
        for at in range(0, len(simple), 20_000):
            # One call for many: a line end is a token of its own between words, and no word has one.
            some = simple[at : at + 20_000]
            flat = np.array(fast.encode_ordinary(lead + f"\n{lead}".join(some)), "<u4")
            marks, raw = (np.flatnonzero(flat == newline) * 4).tolist(), flat.tobytes()
            known.update(zip(some, map(raw.__getitem__, map(slice, [0, *(m + 4 for m in marks)], [*marks, len(raw)])), strict=True))
        for word in other:  # one by one: a call for many starts threads of its own, which cost a task more than they save
            known[word] = np.array(main.encode(lead + word, add_special_tokens=False).ids, "<u4").tobytes()

    def joined(known, lists, lead):
        if len(known) > CACHE_WORDS:
            known.clear()
        missing = set().union(*lists).difference(known)
        if missing:
            learn(known, missing, lead)
        return [b"".join(map(known.__getitem__, w)) for w in lists]

    def encode(texts: list[str]) -> list[bytes]:
        heads, tails, odd = [], [], {}
        for i, text in enumerate(texts):
            if any(s in text for s in special):
                odd[i] = np.array(main.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                head, tail = [], []
            elif wide(text):
                head, tail = chunks(text), []
            else:  # every space is followed by a word and starts a token
                head, *tail = text.split(" ")
                head = [head] if head else []
            heads.append(head)
            tails.append(tail)
        starts, ends = joined(bare, heads, ""), joined(after_space, tails, " ")
        return [odd.get(i, a + b) for i, (a, b) in enumerate(zip(starts, ends, strict=True))]

    return encode


def fillings(lengths, window: int = WINDOW, most: int = 64):
    """Combinations of two or three lengths that fill the window, as index triples (-1: none).

    All pairs; triples whose two longer parts are among the ``most`` commonest lengths, given first.
    """
    at = {int(x): i for i, x in enumerate(lengths)}
    out = {(i, at[window - x], -1) for x, i in at.items() if x * 2 >= window and window - x in at}
    common = [int(x) for x in lengths[:most]]
    for x in common:
        for y in common:
            z = window - x - y
            if x >= y and z > 0 and z in at:
                out.add((*sorted((at[x], at[y], at[z])),))
    return sorted(out)


def non_negative_counts(columns, have, rounds: int = 200):
    """x >= 0 that brings columns @ x near ``have`` in the least-squares sense, by multiplicative steps."""
    import numpy as np

    if not len(columns):
        return np.zeros(0)
    parts = np.array(columns)
    used, weights = np.where(parts < 0, len(have), parts), (parts >= 0).astype(float)
    have = np.append(have, 0.0)

    def gathered(y):
        return (y[used] * weights).sum(1)

    x = np.ones(len(parts)) * have.sum() / max(1.0, weights.sum())
    want = gathered(have)
    for _ in range(rounds):
        made = np.bincount(used.ravel(), (x[:, None] * weights).ravel(), len(have))
        x *= want / np.maximum(gathered(made), 1e-12)
    return x


def layout(remainders, window: int = WINDOW):
    """Pieces (document, start in the remainder, length, sequence, offset) that hold every remainder's tokens once."""
    import numpy as np

    values, counts = np.unique(remainders[remainders > 0], return_counts=True)
    order = np.argsort(-counts, kind="stable")
    values, counts = values[order], counts[order]
    columns = fillings(values, window)
    repeats = non_negative_counts(columns, counts.astype(float))
    waiting = {int(v): np.flatnonzero(remainders == v).tolist()[::-1] for v in values}
    pieces, sequence = [], 0
    for j in np.argsort(-repeats, kind="stable"):
        sizes = [int(values[i]) for i in columns[j] if i >= 0]
        need = {s: sizes.count(s) for s in sizes}
        for _ in range(min(int(repeats[j] + 0.5), *(len(waiting[s]) // n for s, n in need.items()))):
            offset = 0
            for s in sizes:
                pieces.append((waiting[s].pop(), 0, s, sequence, offset))
                offset += s
            sequence += 1
    offset = 0
    for s in sorted(waiting, reverse=True):
        for doc in waiting[s]:
            at = 0
            while at < s:
                length = min(s - at, window - offset)
                pieces.append((doc, at, length, sequence, offset))
                at, offset = at + length, offset + length
                if offset == window:
                    sequence, offset = sequence + 1, 0
    return _powers(pieces, sequence, offset), sequence + max(0, bin(offset).count("1"))


def _powers(pieces, last: int, filled: int):
    """Cut the open window ``last`` into sequences whose lengths are powers of two."""
    if not filled:
        return pieces
    bounds, at = [], 0
    for bit in range(filled.bit_length() - 1, -1, -1):
        if filled >> bit & 1:
            bounds.append((at, at + (1 << bit)))
            at += 1 << bit
    out = [p for p in pieces if p[3] != last]
    for doc, start, length, _, offset in (p for p in pieces if p[3] == last):
        for n, (low, high) in enumerate(bounds):
            a, b = max(low, offset), min(high, offset + length)
            if a < b:
                out.append((doc, start + a - offset, b - a, last + n, a - low))
    return out


def pack(docs: DataFrame, encode_with: tuple, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    ``encode_with`` holds the arguments of ``encoder``. Each document's ids are followed by ``end_id``; a null text is
    empty, so it has that id alone. Every row is packed, repeated and null ids included. ``ids`` holds little-endian
    unsigned 32-bit ids. All sequences are full or as long as a power of two. An empty table has no pieces.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, closing = encoder(*encode_with), np.array([end_id], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 40

        def packed(names, texts):
            nonlocal first
            sizes = np.array([len(t) // 4 for t in texts], np.int64)
            rest = sizes % window
            pieces, used = layout(rest, window)
            parts = [(d, int(sizes[d] - rest[d]) + start, n, first + s, o) for d, start, n, s, o in pieces]
            first += used
            for d in np.flatnonzero(sizes >= window).tolist():
                for at in range(0, int(sizes[d] - rest[d]), window):
                    parts.append((d, at, window, first, 0))
                    first += 1
            for at in range(0, len(parts), 2048):
                some = parts[at : at + 2048]
                columns = [
                    pa.array([names[p[0]] for p in some], pa.int64()),
                    pa.array([p[1] for p in some], pa.int64()),
                    pa.array([p[2] for p in some], pa.int64()),
                    pa.array([texts[p[0]][4 * p[1] : 4 * (p[1] + p[2])] for p in some], pa.binary()),
                    pa.array([int(sizes[p[0]]) for p in some], pa.int64()),
                    pa.array([p[3] for p in some], pa.int64()),
                    pa.array([p[4] for p in some], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=PIECES.names)

        names, texts, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(at, AT_ONCE)
                texts += [ids + closing for ids in encode([t or "" for t in some.column(1).to_pylist()])]
                names += some.column(0).to_pylist()
                held += sum(map(len, texts[-some.num_rows :])) // 4
                if held >= RUN_TOKENS:
                    yield from packed(names, texts)
                    names, texts, held = [], [], 0
                    pa.default_memory_pool().release_unused()
        if names:
            yield from packed(names, texts)

    return rows.mapInArrow(run, PIECES)
