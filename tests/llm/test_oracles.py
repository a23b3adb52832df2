"""Queries of this package that SQL can express, against DuckDB over whole tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import check  # noqa: E402

from tidemark.llm.plans import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query(spark, name):
    build, sql = QUERIES[name]
    df = build(spark, SF)
    result = check.connect(SF).execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert check.canonical(df.columns, [tuple(r) for r in df.collect()]) == check.canonical(names, result.fetchall())
