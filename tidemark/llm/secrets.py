"""Secrets in text: fixed base patterns and assignment-aware lexing.

The lexer turns source and configuration lines into (name, literal) pairs, carries literals through assignments of one
name to another, and scores a literal by how sensitive the names it reaches are and how random it looks.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import unused

KINDS = ("assign", "access", "hex", "literal")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of [0-9a-f]+ with 24 characters or more
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

# How sensitive a part of a name is; a name takes its most sensitive part.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "signingkey": 1.0,
    "encryptionkey": 1.0, "authkey": 0.9, "auth": 0.6, "bearer": 0.8, "salt": 0.6, "key": 0.5, "pin": 0.5, "dsn": 0.5,
}
THRESHOLD = 1.0  # of sensitivity plus randomness

_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
# A name is looked for at the start of a run of its characters alone, which keeps the search linear in the text.
_OPEN = rf"(?P<quote>[\"']?)(?<![A-Za-z0-9_.\-])[-.0-9]*+(?P<name>{_NAME})(?P=quote)[\x20\t]*(?::=|=>|[:=])[\x20\t]*"
_QUOTED = r"\"(?P<double>(?:[^\"\n\\]|\\[\s\S])++)\"|'(?P<single>(?:[^'\n\\]|\\[\s\S])++)'"
# Literals to their real end. Possessive repeats keep the search linear in the text.
PAIR = re.compile(
    rf"{_OPEN}(?:\"\"\"(?P<triple>(?:[^\"\\]|\\[\s\S]|\"(?!\"\"))*+)\"\"\"|'''(?P<triple1>(?:[^'\\]|\\[\s\S]|'(?!''))*+)'''"
    rf"|{_QUOTED}"
    r"|(?P<pem>-----BEGIN[\x20][^\n-]+-----)"
    r"|[|>][+-]?[0-9]?[\x20\t]*\n(?P<block>(?P<indent>[\x20\t]+)[^\n]+(?:\n(?:(?P=indent)[^\n]*|[\x20\t]*(?=\n)))*)"
    rf"|(?P<other>{_NAME})(?![^\s;,)#}}\]])|(?P<bare>[^\s\"',;#(){{}}\[\]]++))",
    re.ASCII,
)
PEM_END = re.compile(r"-----END[\x20][^\n-]+-----")
# What may follow a value: more literals or names, joined to it.
JOINED = re.compile(rf"[\x20\t]*[+.][\x20\t]*(?:{_QUOTED}|(?P<other>{_NAME}))", re.ASCII)
TAGGED = re.compile(rf"<(?P<name>{_NAME})(?:[\x20\t][^<>]*+)?>(?P<value>[^<>]++)</(?P=name)>", re.ASCII)
_NAMES = re.compile(rf"[\x20\t]*(?P<name>{_NAME})[\x20\t]*(?P<next>,|=(?!=))", re.ASCII)
_VALUE = re.compile(rf"[\x20\t]*(?:{_QUOTED}|(?P<other>{_NAME})|(?P<bare>[^\s\"',;#(){{}}\[\]]++))[\x20\t]*(?:,|(?=[\n;#)])|\Z)", re.ASCII)
LITERALS = ("triple", "triple1", "double", "single", "pem", "block", "bare")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value_start", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)


@lru_cache(maxsize=4096)
def sensitivity(name: str) -> float:
    parts = [p.lower() for p in _CAMEL.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)


def randomness(value: str) -> float:
    """0 to 1 from length, bits per character and mixed character classes."""
    if len(value) < 6 or value.isspace():
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in value)
    return min(1.0, 0.5 * min(bits, 4.0) / 4.0 + 0.3 * min(len(value), 24) / 24 + 0.1 * (classes - 1))


def base_spans(text: str) -> list[tuple]:
    found = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                found.append(("assign", m.start(), m.end(), m.start(2), m[1], 1.0))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                found.append(("access", m.start(), m.end(), m.start(), None, 1.0))
    found += [("hex", m.start(), m.end(), m.start(), None, 1.0) for m in HEX.finditer(text)]
    return found


def _tuples(text: str):
    """(name, match of its value) of assignments of several values: ``user, password = "u", "p"``."""
    at = 0
    while (cut := text.find("=", at)) >= 0:
        line = text.rfind("\n", 0, cut) + 1
        end = text.find("\n", cut)
        at = len(text) if end < 0 else end  # one look at each line
        if text.find(",", line, cut) < 0:
            continue
        names, pos = [], line
        while m := _NAMES.match(text, pos, at):
            names.append(m["name"])
            pos = m.end()
            if m["next"] == "=":
                break
        else:
            continue
        for name in names:
            m = _VALUE.match(text, pos, at)
            if not m:
                break
            yield name, m
            pos = m.end()


def _assigned(text: str):
    """(name, start, end, other): a literal's place, or the other name that is assigned; both for a word that may be either."""
    ends = None  # where PEM blocks end, looked up once
    pos = 0
    while m := PAIR.search(text, pos):
        name, pos = m["name"], m.end()
        kind = "other" if m["other"] else next(k for k in LITERALS if m[k] is not None)
        start, end = m.start(kind), m.end(kind)
        if kind == "pem":
            if ends is None:
                ends = [e.end() for e in PEM_END.finditer(text)]
            after = bisect_right(ends, end)
            # Without an end it is a word like others.
            end = pos = ends[after] if after < len(ends) else start + len("-----BEGIN")
        yield name, start, end, m["other"]
        if kind in ("other", "double", "single"):
            while more := JOINED.match(text, pos):
                which = next(k for k in ("double", "single", "other") if more[k] is not None)
                yield name, more.start(which), more.end(which), more["other"]
                pos = more.end()
    for m in TAGGED.finditer(text):
        yield m["name"], m.start("value"), m.end("value"), None
    for name, m in _tuples(text):
        which = next(k for k in ("double", "single", "other", "bare") if m[k] is not None)
        yield name, m.start(which), m.end(which), m["other"]


def _better(a: str, b: str | None) -> str:
    return a if b is None or (-sensitivity(a), a) <= (-sensitivity(b), b) else b


def reachable(aliases: dict[str, set[str]]) -> dict[str, str]:
    """For each name in lower case the most sensitive name that its value is carried to; names that reach none are missing.

    Names are taken from the most sensitive down, each backwards over the assignments, and no name is passed twice.
    """
    sources: dict[str, list[str]] = {}  # target -> names assigned to it
    for name, targets in aliases.items():
        for target in targets:
            sources.setdefault(target, []).append(name)
    into: dict[str, list[str]] = {}
    for target, names in sources.items():
        into.setdefault(target.lower(), []).extend(names)
    best: dict[str, str] = {}
    for target in sorted((t for t in sources if sensitivity(t)), key=lambda t: (-sensitivity(t), t)):
        ahead = list(sources[target])
        while ahead:
            name = ahead.pop()
            if name not in best:
                best[name] = target
                ahead += into.get(name, ())
    return best


def literal_spans(text: str) -> list[tuple]:
    """Literals that reach a sensitive name directly or over other names: ``a = "x"; password = a`` marks "x"."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    literals, aliases = {}, {}
    for name, start, end, other in _assigned(text):
        if other:
            aliases.setdefault(other.lower(), set()).add(name)
        # A bare word may be a value as well as another name; only values that look random pass later.
        if not other or any(c.isdigit() for c in other):
            literals[start, end] = _better(name, literals.get((start, end)))
    carried, found = reachable(aliases), []
    for (start, end), name in literals.items():
        target = _better(name, carried.get(name.lower()))
        weight = sensitivity(target)
        value = text[start:end]
        if weight and not value.startswith(("http://", "https://", "${")):
            random = randomness(value)
            if weight + random > THRESHOLD and random >= 0.45:
                found.append(("literal", start, end, start, target, round(weight + random, 6)))
    return found


def spans(text: str | None) -> list[tuple]:
    """All spans by start, then kind; a literal inside a base span adds nothing and is left out."""
    text = text or ""
    base = base_spans(text)
    covered = sorted((s, e) for _, s, e, *_ in base)
    added, at, reach = [], 0, -1
    for span in sorted(literal_spans(text), key=lambda s: s[1]):
        while at < len(covered) and covered[at][0] <= span[1]:
            reach, at = max(reach, covered[at][1]), at + 1
        if reach < span[2]:
            added.append(span)
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def listed(found: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in found)


def masked(text: str, found: list[tuple], mask: str = "<secret>") -> str:
    """The text with each secret's value replaced; overlapping values are replaced together."""
    out, at = [], 0
    for start, end in sorted((s[3], s[2]) for s in found):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def with_secrets(docs: DataFrame, text: str = "text", found: str = "secrets", clean: str = "clean_text") -> DataFrame:
    """All columns of ``docs``, an array of secrets and the masked text.

    Spans count code points, ends exclusive. A null text has no secrets and stays null; an empty table stays empty.
    Repeated rows are scanned each. Columns of ``docs`` named ``found`` or ``clean`` are replaced.
    """
    kept = [c for c in docs.columns if c not in (found, clean)]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias(unused(kept, "text")))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(found, FOUND), T.StructField(clean, T.StringType())])
    position = len(kept)

    def scan(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(FOUND)
        fields = [f.name for f in FOUND.elementType.fields]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):  # few texts at a time as Python objects
                some = batch.slice(at, 1000)
                texts = some.column(position).to_pylist()
                each = [spans(t) for t in texts]
                rows = pa.array([[dict(zip(fields, s, strict=True)) for s in e] for e in each], kind)
                texts = [masked(t, e) if e else t for t, e in zip(texts, each, strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns[:position], rows, pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(scan, schema)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal) for every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = with_secrets(rows).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long")
    text_of = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    base = F.array_join(F.transform(F.filter("secrets", lambda s: s.kind != "literal"), text_of), ",")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(base, 256).alias("base_sha256"),
        F.array_join(F.transform("secrets", text_of), ",").alias("spans"),
        count("literal").alias("n_literal"),
    )


def base_digest(text: str | None) -> str:
    found = sorted(base_spans(text or ""), key=lambda s: (s[1], KINDS.index(s[0])))
    return hashlib.sha256(listed(found).encode()).hexdigest()
