"""The subpackage's queries: SQL where there is one, else that they run on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from jobstrata.llm import catalog  # noqa: E402


COLUMNS = {
    "p3_found": ("detail_id",), "p4_found": ("name_a", "name_b"), "p4_groups": ("name", "entity"), "p5_found": ("detail_id", "line_no"),
    "p6_ids": ("doc_id", "ids"), "p7_found": ("doc_id", "item_id"), "p8_found": ("doc_id",), "p8_shares": ("source", "texts", "cut_texts", "share"),
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, small, name):
    got = catalog.QUERIES[name](spark, small).toPandas()
    if name not in catalog.SQL:
        assert tuple(got.columns) == COLUMNS[name] and len(got) > 0 and not got.astype(str).duplicated().any()
        return
    con = duckdb.connect()
    for table in os.listdir(small):
        con.execute(f"CREATE VIEW {table[:-8]} AS SELECT * FROM '{small}/{table}'")
    want = con.execute(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(map(repr, got[columns].itertuples(index=False))) == sorted(map(repr, want[columns].itertuples(index=False)))
