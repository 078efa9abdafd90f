"""New batches against all history."""

import random

import pytest
from pyspark.sql import functions as F

from jobstrata.llm import history as history_module
from jobstrata.llm.history import History, identities
from jobstrata.session import scratch_path

SCHEMA = "row_id long, id string, url string, extra string, ident long"


def brute(rows):
    """Union-find over ids and requisition addresses written in one way."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    def tie(a, b):
        a, b = find(a), find(b)
        parent[max(a, b, key=str)] = min(a, b, key=str)

    for n, i, u, *_ in rows:
        i = (i or "").strip(" {}\t").lower()
        if i:
            tie(("r", n), ("i", i))
        u = (u or "").strip().lower().split("?")[0].rstrip("/")
        if u and any(c.isdigit() for c in u):
            tie(("r", n), ("u", u))
    groups = {}
    for n, *_ in rows:
        groups.setdefault(find(("r", n)), []).append(n)
    return {(min(g), n) for g in groups.values() for n in g if n != min(g)}


def run(spark, rows, batches):
    df = spark.createDataFrame(rows, SCHEMA)
    history = History(spark, scratch_path(spark, "test-history"))
    step = max(r[0] for r in rows) // batches + 1
    for k in range(batches):
        history.accept(k, df.where((F.col("row_id") >= k * step) & (F.col("row_id") < (k + 1) * step)))
    return history, {(r.first_row_id, r.row_id) for r in history.repeats().collect()}


@pytest.mark.parametrize("batches", [1, 3])
def test_against_brute_force(spark, batches):
    rng = random.Random(batches)
    rows = []
    for n in range(120):
        i = rng.choice([None, "", " ", f"{rng.randrange(40):012d}", f" {{AB{rng.randrange(40)}}} "])
        u = rng.choice([None, "", "https://x.test/careers", f"https://b.test/acme/jobs/{1000000 + rng.randrange(40)}" + rng.choice(["", "/", "?ref=1"])])
        rows.append((n, i, u, "x", 7))
    _, got = run(spark, rows, batches)
    assert got == brute(rows)


def test_a_later_row_ties_two_postings(spark):
    rows = [(1, "a", None, None, None), (2, "b", "https://b.test/acme/jobs/1234567", None, None), (3, "A ", "https://b.test/acme/jobs/1234567/", None, None)]
    _, got = run(spark, rows, 3)
    assert got == {(1, 2), (1, 3)}


def test_a_batch_can_be_repeated(spark):
    rows = [(n, f"{n % 3}abc", None, None, None) for n in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    history = History(spark, scratch_path(spark, "test-history"))
    for k in (0, 1, 1, 0, 1):
        history.accept(k, df.where(f"row_id >= {k * 5} and row_id < {(k + 1) * 5}"))
    assert {(r.first_row_id, r.row_id) for r in history.repeats().collect()} == brute(rows)


def test_nulls_empty_tables_and_long_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    history = History(spark, scratch_path(spark, "test-history"))
    assert history.accept(0, empty).count() == 0 and history.repeats().count() == 0
    rows = [(1, "z" * 50_000, "https://b.test/" + "y" * 50_000 + "/1234567", None, None), (2, "Z" * 50_000, None, None, None), (3, None, None, None, None), (4, None, "", None, None)]
    _, got = run(spark, rows, 1)
    assert got == {(1, 2)}
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.row_id for r in identities(df).collect()} == {1, 2}


def test_hot_identity(spark):
    rows = [(n, "same", f"https://b.test/acme/jobs/{1000000 + n}", None, None) for n in range(200)]
    _, got = run(spark, rows, 2)
    assert got == {(0, n) for n in range(1, 200)}


def test_small_batches_probe_like_large_ones_and_after_merging(spark, monkeypatch):
    rows = [(n, f"{n % 7}abc", f"https://b.test/acme/jobs/{1000000 + n % 11}", None, None) for n in range(40)]
    for probe in (0, 10_000):
        monkeypatch.setattr(history_module, "PROBE", probe)
        df = spark.createDataFrame(rows, SCHEMA)
        history = History(spark, scratch_path(spark, "test-history"), buckets=3)
        for k in range(5):
            history.accept(k, df.where(f"row_id >= {k * 8} and row_id < {(k + 1) * 8}"))
            if k == 3:
                history.compact(2)
        assert {(r.first_row_id, r.row_id) for r in history.repeats().collect()} == brute(rows)
    with pytest.raises(ValueError):
        history.accept(1, df)


def test_ties_are_merged_over_batches(spark):
    url = "https://b.test/acme/jobs/{}"
    rows = [(n, f"id{n}", url.format(1234000 + n), None, None) for n in range(8)]
    rows += [(8, "id6", url.format(1234007), None, None), (9, "id7", url.format(1234005), None, None), (10, "id5", url.format(1234001), None, None), (11, "id1", url.format(1234000), None, None)]
    for batches in (1, 6, 12):
        _, got = run(spark, rows, batches)
        assert got == brute(rows)


def test_the_index_stays_in_place(spark):
    history = History(spark, scratch_path(spark, "test-history"), buckets=4)
    df = spark.createDataFrame([(n, f"{n}abc", None, None, None) for n in range(50)], SCHEMA)
    history.accept(0, df)
    own = identities(df).groupBy("key").agg(F.min("row_id").alias("_own")).hint("shuffle_hash")
    with history.index.table(1) as stored:
        plan = own.join(stored, "key", "left")._jdf.queryExecution().executedPlan().toString()
        few = stored.where(F.col("key").isin([r.key for r in identities(df.where("row_id < 2")).collect()]))
        some = own.join(few, "key", "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan, plan
    assert "SelectedBucketsCount: 1 out of 4" in some or "SelectedBucketsCount: 2 out of 4" in some, some
