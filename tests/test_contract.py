"""Every query with SQL equals it on the smallest tables."""

import ast
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from jobstrata.plans import catalog  # noqa: E402


def view(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def shown(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(map(repr, df.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, small, name):
    got = shown(catalog.QUERIES[name](spark, small).toPandas())
    assert got == shown(view(small).execute(catalog.SQL[name]).df())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_entry(spark, small):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_nothing_else_imports_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    for folder, _, files in os.walk(os.path.join(root, "jobstrata")):
        if "llm" in folder.split(os.sep):
            continue
        for f in files:
            if f.endswith(".py"):
                for node in ast.walk(ast.parse(open(os.path.join(folder, f)).read())):
                    names = [a.name for a in node.names] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
                    names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                    found += [(f, n) for n in names if "llm" in n.split(".")]
    assert not found
