"""Relational operators against small models."""

import random

import pytest
from pyspark.sql import functions as F

from jobstrata.functions.urls import url_match_keys
from jobstrata.operators import incremental, ledger, predicates, review, workqueue
from jobstrata.operators.components import components
from jobstrata.operators.firstseen import first_sighting, insert_if_absent
from jobstrata.operators.urlmatch import known_urls
from jobstrata.sources.buckets import BucketStore
from jobstrata.sources.files import excluded_ids, last_wins
from jobstrata.sources.snapshots import chunks, stride


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("places, nyc, remote", [
    (["NYC"], True, False), (["New York, NY"], True, False), (["West New York, NJ"], True, False), (["Remote"], False, True),
    (["Remote", "Boston"], False, False), (["Remote, NYC"], True, True), ([], False, False), (None, False, False), ([None, "nyc"], True, False),
])
def test_location_classes(spark, places, nyc, remote):
    df = spark.createDataFrame([(places,)], "l array<string>")
    assert tuple(df.select(predicates.is_nyc(F.col("l")), predicates.is_remote(F.col("l"))).first()) == (nyc, remote)


@pytest.mark.parametrize("n, step", [(0, 10), (1, 10), (10, 10), (11, 10), (25, 10), (7, 1)])
def test_stride(spark, n, step):
    df = spark.createDataFrame([(i, str(i)) for i in range(n)], "seq long, sha string")
    assert [r.seq for r in stride(df, step).orderBy("seq").collect()] == sorted({*range(0, n, step), *([n - 1] if n else [])})
    assert sorted(r.chunk for r in chunks(df, 4).collect()) == [i // 4 for i in range(n)]


def test_first_sighting_against_a_loop(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", "c", "", None]), s, p, f"{s}.{p}") for s in range(20) for p in range(3)]
    rng.shuffle(data)
    seen = {}
    for k, s, p, v in sorted(data, key=lambda r: (r[1], r[2])):
        if k:
            seen.setdefault(k, v)
    df = spark.createDataFrame(data, "id string, seq long, pos long, v string")
    assert {r.id: r.v for r in first_sighting(df).collect()} == seen
    stored = spark.createDataFrame([("a", "old")], "id string, v string")
    assert {r.id: r.v for r in insert_if_absent(stored, df).collect()} == {**seen, "a": "old"}
    empty = df.where("false")
    assert first_sighting(empty).count() == 0 and rows_of(insert_if_absent(stored, empty)) == [("a", "old")]


def test_ledger(spark):
    d = spark.createDataFrame([("1", "x", "", 0), ("2", None, "b", 1), ("1", "y", "c", 2), (None, "z", "d", 3), ("", "w", "e", 4)], "id string, category string, raw_text string, pos long")
    assert rows_of(last_wins(d).select("id", "category", "pos")) == [("1", "y", 0), ("2", None, 1)]
    x = spark.createDataFrame([(" 1 ",), ("",), (None,), ("1",)], "id string")
    assert rows_of(excluded_ids(x)) == [("1",)]
    assert len(rows_of(ledger.without(d, excluded_ids(x)))) == 3
    assert [r.excluded for r in ledger.flagged(d, excluded_ids(x)).orderBy("pos").collect()] == [True, False, True, False, False]
    texts = spark.createDataFrame([("1", "T"), ("1", "S"), ("2", ""), ("2", "U")], "id string, raw_text string")
    assert [r.raw_text for r in ledger.restore_text(d, texts).orderBy("pos").collect()] == ["T", "b", "c", "d", "e"]
    edits = spark.createDataFrame([("2", ""), ("1", None)], "id string, category string")
    assert [r.category for r in ledger.apply_edits(d, edits, "category").orderBy("pos").collect()] == [None, "", None, "z", "w"]
    stored = spark.createDataFrame([("1", "a", "k"), ("2", "b", "l")], "id string, v string, extra string")
    new = spark.createDataFrame([("2", "B"), ("3", "C")], "id string, v string")
    assert rows_of(ledger.upsert(stored, new, keep=("extra",))) == [("1", "a", "k"), ("2", "B", "l"), ("3", "C", None)]
    known = ledger.keep_known(new, stored, {"extra": "none"})
    assert rows_of(known.select("id", "extra")) == [("2", "l"), ("3", "none")]
    more = spark.createDataFrame([("2", "z"), ("9", "q"), ("9", "p"), ("", "r"), (None, "s")], "id string, v string")
    assert rows_of(ledger.append_exclusions(stored.select("id", "v"), more)) == [("1", "a"), ("2", "b"), ("9", "p")]


def test_running_mark_and_fold(spark, monkeypatch):
    monkeypatch.setattr(workqueue, "CHUNK", 7)
    rng = random.Random(2)
    data = [(i, f"{rng.randrange(40):03d}", rng.choice("abcdefgh")) for i in range(60)]
    df = spark.createDataFrame(data, "o long, d string, k string")
    got = {r.o: r.mark for r in workqueue.running_mark(df, "o", "d", "010").collect()}
    mark = "010"
    for o, d, _ in data:
        assert got[o] == mark
        mark = max(mark, d)
    taken, mark, want = set(), "005", []
    for o, d, k in data:
        if k not in taken and d >= mark:
            taken.add(k)
            mark = d
            want.append(o)
    assert sorted(r.o for r in workqueue.fold_mark(df, "o", "d", "k", "005").collect()) == want
    assert workqueue.high_water(df.where("false"), "d").first().mark == ""


def test_greedy_urls_and_known(spark):
    rng = random.Random(3)
    urls = [f"https://x{rng.randrange(3)}.test/jobs/{rng.randrange(12)}/apply{rng.randrange(4)}" + "/" * rng.randrange(2) for _ in range(50)] + ["", None]
    df = spark.createDataFrame(list(enumerate(urls)), "o long, url string").withColumn("keys", url_match_keys(F.col("url")))
    keys = {r.o: r["keys"] for r in df.collect()}
    taken, want = set(), []
    for o in sorted(keys):
        if not set(keys[o]) & taken:
            taken |= set(keys[o])
            want.append(o)
    assert sorted(r.o for r in workqueue.greedy_urls(df, "o", "keys").collect()) == want
    stored = spark.createDataFrame([(urls[0],), (urls[7],), (None,), ("",)], "url string")
    hit = {k for o in (0, 7) for k in keys[o]}
    assert sorted(r.o for r in known_urls(df, stored).collect()) == [o for o in sorted(keys) if set(keys[o]) & hit]
    assert sorted(r.o for r in known_urls(df, stored, anti=True).collect()) == [o for o in sorted(keys) if not set(keys[o]) & hit]


def test_queue(spark):
    q = spark.createDataFrame([("a", "0", 0), ("b", "2", 1), ("c", None, 2)], "id string, archive_attempts string, pos long")
    failed = spark.createDataFrame([("b",), ("c",), ("c",)], "id string")
    assert rows_of(workqueue.retried(q, failed).select("id", "archive_attempts")) == [("a", 0), ("c", 1)]
    new = spark.createDataFrame([("d", 5, 1), ("e", 5, 0)], "id string, seq long, pos long")
    got = workqueue.enqueue(q, new.select("id", "seq", F.col("pos").alias("at")), ("seq", "at"))
    assert [(r.id, r.pos) for r in got.orderBy("pos").collect()] == [("a", 0), ("b", 1), ("c", 2), ("e", 3), ("d", 4)]
    first = workqueue.head(q, 2, "pos")
    assert rows_of(workqueue.rest(q, first, "id").select("id")) == [("c",)]
    a = spark.createDataFrame([(True, None, "u"), (False, True, "u"), (None, False, None)], "l boolean, w boolean, u string")
    got = a.select(workqueue.first_success([("live", F.col("l"), F.lit("")), ("w", F.col("w"), F.col("u"))]).alias("r")).select("r.*")
    assert [tuple(r) for r in got.collect()] == [("live", "success", ""), ("w", "success", "u"), ("none", "failed", "")]


def test_review(spark):
    d = spark.createDataFrame([
        (1, None, "failed", "", None, "Law Clerk", False), (2, "", "success", "u", "Acme", None, True), (3, "Other", "success", "u", "acme (x)", "t", False),
    ], "n int, category string, archive_status string, archive_url string, company_name string, title string, excluded boolean")
    assert tuple(review.kpis(d).first()) == (3, 1, 1, 0, 2)
    pick = lambda **k: sorted(r.n for r in review.review(d, **k).collect())
    assert pick() == [1, 3] and pick(exclusion="all") == [1, 2, 3] and pick(exclusion="only") == [2]
    assert pick(category="Unclassified") == [1] and pick(category="Other") == [3] and pick(archive="failed") == [1]
    assert pick(text="ACME|law") == [1, 3] and pick(text=r"acme \(") == [3]
    with pytest.raises(Exception):
        review.search("(")
    assert [r.n for r in review.failed_tail(d, 5, "n").collect()] == [1]


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = {n: find(n) for n in parent if find(n) != n}
    got = components(spark.createDataFrame(edges, "u int, v int"))
    assert {r.node: r.root for r in got.collect()} == want
    assert components(spark.createDataFrame([], "u int, v int")).count() == 0


def test_changed_rows_against_a_loop(spark, monkeypatch):
    monkeypatch.setattr(incremental, "BLOCK", 4)
    rng = random.Random(5)
    data = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randrange(5), rng.choice(["x", "y"])) for i in range(80)]
    last, want = {}, set()
    for i, k, s, v in sorted(data, key=lambda r: (r[2], r[0])):
        if k is not None:
            if last.get(k) != v:
                want.add(i)
            last[k] = v
    df = spark.createDataFrame(data, "row_id long, k string, seq long, v string")
    got = incremental.changed_rows(df, F.col("k"), ("seq", "row_id"), F.col("v"))
    assert {r.row_id for r in got.collect()} == want


def test_resolve_shas(spark):
    full = ["a" * 40, "b" * 39 + "c", "b" * 39 + "d", "0123456789" + "e" * 30]
    h = spark.createDataFrame([(s,) for s in full], "sha string")
    named = [" " + "A" * 40 + "\n", "b" * 12, "012345678", "0123456789", None, "", "f" * 40, "a" * 40]
    d = spark.createDataFrame([(s,) for s in named], "sha string")
    assert {r.unit for r in incremental.resolve_shas(d, h).collect()} == {full[0], full[3]}


def test_runs_survive_a_crash_and_repeat_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("one")
    (folder / "b.txt").write_text("two")
    out, manifest = f"file://{tmp_path}/out", f"file://{tmp_path}/manifest"
    listing = lambda: incremental.list_files(spark, f"file://{folder}")

    def process(pending):
        return pending.select("unit")

    def broken(pending):
        process(pending).write.mode("overwrite").parquet(f"{out}/batch={incremental.batch_id(pending)}")
        raise RuntimeError("lost")

    seen = lambda: sorted(r.unit[-5:] for r in incremental.read_batches(spark, out, manifest, "unit string").collect())
    with pytest.raises(RuntimeError):
        incremental.run_incremental(spark, listing(), broken, out, manifest)
    assert seen() == []
    first = incremental.run_incremental(spark, listing(), process, out, manifest)
    assert seen() == ["a.txt", "b.txt"]
    assert incremental.run_incremental(spark, listing(), process, out, manifest) is None
    (folder / "b.txt").write_text("changed")
    (folder / "c.txt").write_text("three")
    second = incremental.run_incremental(spark, listing(), process, out, manifest)
    assert first != second and seen() == ["a.txt", "b.txt", "c.txt"]  # the older b.txt is superseded


def test_next_run_reads_new_files_only(spark, tmp_path):
    folder, home = tmp_path / "jobs.parquet", f"file://{tmp_path}/home"
    folder.mkdir()
    history = spark.createDataFrame([(i, f"{i:040x}", f"2025-01-0{i + 1}T00:00:00Z") for i in range(5)], "seq long, sha string, commit_date string")
    done = spark.createDataFrame([(f"{1:040x}",)], "sha string")
    schema = "row_id long, id string, company_name string, title string, terms string, date_posted string, url string, first_seen_date string, first_seen_commit string"

    def put(name, *rows):
        full = [(n, i, "c", t, None, None, "", None, f"{s:040x}") for n, i, t, s in rows]
        pd = spark.createDataFrame(full, schema).toPandas()
        pd.to_parquet(folder / name)

    run = lambda: incremental.next_run(spark, f"file://{folder}", history, done, home, content=True)
    seen = lambda: sorted(r.row_id for r in incremental.taken(spark, home).collect())
    put("a b.parquet", (1, "x", "one", 0), (2, "x", "one", 1), (3, "y", "one", 1), (4, "x", "one", 2), (5, "x", "two", 3), (6, None, "n", 3))
    assert run() and seen() == [1, 5]  # 3 is of a done commit, 6 of no record
    assert run() is None
    put("b.parquet", (7, "x", "two", 4), (8, "y", "new", 4), (9, "z", "one", 4), (10, "x", "two", 9))
    assert run() and seen() == [1, 5, 8, 9]
    assert spark.read.parquet(f"{home}/state").where("run = 1").count() == 4  # the first file wasn't read again
    put("b.parquet", (8, "y", "one", 4), (9, "z", "one", 4), (11, "Z ", "two", 4))
    assert run() and seen() == [1, 5, 9, 11]  # the older rows of the file are gone
    put("c.parquet", (12, "y", "one", 4))
    assert run() and seen() == [1, 5, 9, 11]  # compared with row 8 as the changed file has it


def test_bucket_store(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/s", "key long, v string", 3)
    for k in range(4):
        rows = spark.createDataFrame([(i, f"{k}.{i}", int(i != 9)) for i in range(k, 10)], "key long, v string, live int")
        store.write(k, rows)
    store.write(1, spark.createDataFrame([(5, "again", 1)], "key long, v string, live int"))

    def held(below):
        with store.table(below) as t:
            return sorted(map(tuple, t.collect()))

    want = sorted([(i, f"{k}.{i}") for k in (0, 2, 3) for i in range(k, 9)] + [(5, "again")])
    assert held(4) == want and held(0) == []
    store.compact(2)
    assert held(4) == want and len(store.parts(4)) == 2 and BucketStore(spark, f"file://{tmp_path}/s", "key long, v string").buckets == 3
    with store.table(4) as t:
        plan = spark.createDataFrame([(1,)], "key long").repartition(3, "key").hint("merge").join(t, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan  # only the other side is moved
    with pytest.raises(ValueError):
        store.write(1, spark.createDataFrame([], "key long, v string, live int"))


def test_long_chains_are_matched_greedily(spark, monkeypatch):
    monkeypatch.setattr(workqueue, "ROUNDS", 3)
    data = [(i, [f"k{i}", f"k{i + 1}"]) for i in range(40)] + [(100 + i, ["hot", f"k{i * 3}"]) for i in range(30)] + [(200, []), (201, None)]
    taken, want = set(), []
    for o, keys in data:
        if not set(keys or []) & taken:
            taken |= set(keys or [])
            want.append(o)
    df = spark.createDataFrame(data, "o long, keys array<string>")
    assert sorted(r.o for r in workqueue.greedy_urls(df, "o", "keys").collect()) == want


@pytest.mark.parametrize("seed", range(3))
def test_fold_in_any_order(spark, seed):
    rng = random.Random(seed)
    data = [(i, f"{max(0, i // 3 + rng.randrange(-6, 6)):03d}" if rng.random() < 0.9 else None, rng.choice("abcdefghijklmnopqrstuvwxyz") + str(i // 40)) for i in range(120)]
    taken, mark, want = set(), "", []
    for o, d, k in data:
        if k not in taken and (d or "") >= mark:
            taken.add(k)
            mark = d or ""
            want.append(o)
    df = spark.createDataFrame(data, "o long, d string, k string")
    assert sorted(r.o for r in workqueue.fold_mark(df, "o", "d", "k").collect()) == want


def test_ranks_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("o")).repartition(6)
    assert sorted((r.o, r.n) for r in workqueue.ranked(df, "n", "o").collect()) == [(i, i) for i in range(1000)]
    assert workqueue.ranked(df.where("false"), "n", "o").count() == 0
