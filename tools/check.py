"""Compare every query with its SQL in DuckDB: ``check.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import ENTRIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return f"{value:.9g}" if value == value else "null"
    return "null" if value is None else str(value)


def canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


# Python types the two engines may give for one logical type.
def _kinds(columns, rows) -> dict[str, set]:
    return {c: {type(r[i]).__name__ for r in rows[:2000] if r[i] is not None} for i, c in enumerate(columns)}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    entry = ENTRIES[name]
    started = time.perf_counter()
    df = entry.build(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.perf_counter() - started
    if entry.sql is None:
        return True, f"{seconds:6.2f}s {len(got)} rows, no SQL"
    result = con.execute(entry.sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds_got, kinds_want = _kinds(df.columns, got), _kinds(names, want)
    if kinds_got != {c: kinds_want[c] for c in kinds_got}:
        return False, f"types {kinds_got} against {kinds_want}"
    a, b = canonical(df.columns, got), canonical(names, want)
    if a != b:
        extra, missing = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
        return False, f"{len(a)} rows against {len(b)}; only here {extra}; only there {missing}"
    return True, f"{seconds:6.2f}s {len(a)} rows"


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:] or list(ENTRIES)
    spark, con, bad = local_session(8, "check"), connect(sf_dir), []
    for name in names:
        try:
            ok, text = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {text}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
