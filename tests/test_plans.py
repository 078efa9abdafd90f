"""Whole plans: build, update, backfill, streaming, files."""

import json
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from jobstrata.plans.build import empty_jobs, full_build, pending_commits
from jobstrata.plans.store import load_state, save_run
from jobstrata.plans.update import backfill, purge_queue, update
from jobstrata.run import main as cli
from jobstrata.schemas import EXCLUDED_JOBS, JOB_DETAILS, JOBS_CSV_8, JOBS_FULL, PENDING_ARCHIVE, strings
from jobstrata.sources import sinks
from jobstrata.sources.files import numbered, read_csv, read_jsonl
from jobstrata.sources.snapshots import parse_payload, read_payloads, recent
from jobstrata.streaming.stream import TABLES, sighting_stream, stored_jobs


def posting(id_, locations, **more):
    return {"id": id_, "company_name": " Acme ", "title": "Dev", "locations": locations, "terms": ["Summer", "Fall"],
            "date_posted": 1700000000, "url": f"https://x.test/jobs/{id_}00000", "source": "S", **more}


HISTORY = [
    [posting("1", ["Boston"]), posting("2", ["Remote"]), posting("", ["NYC"])],
    [posting("1", ["NYC"]), posting("2", ["Remote"]), posting("3", ["Remote, NYC"])],
    "not json",
    [posting("1", ["NYC"], title="late"), posting("4", ["Remote", "Boston"]), posting("5", ["nyc"]), posting("5", ["nyc"], title="twice")],
    None,
    [],
]


@pytest.fixture
def world(spark, tmp_path):
    folder = tmp_path / "snap"
    folder.mkdir()
    manifest = []
    for i, payload in enumerate(HISTORY):
        sha = f"{i:040x}"
        manifest.append((i, sha, f"2025-01-0{i + 1}T00:00:00Z"))
        if payload is not None:
            (folder / f"{sha}.json").write_text(payload if isinstance(payload, str) else json.dumps(payload))
    return spark.createDataFrame(manifest, "seq long, sha string, commit_date string"), str(folder)


def ids(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("payload, ok, n", [
    ('[{"id": "1"}]', True, 1), (' \n[{"id": "1"}] ', True, 1), ("[]", True, 0), ('{"id": "1"}', False, None), ('[{"id": "1"}] x', False, None),
    ("[1, 2", False, None), ("", False, None), (None, False, None), ('[{"id": "1", "terms": 7}]', True, 1),
])
def test_payloads(spark, payload, ok, n):
    r = parse_payload(spark.createDataFrame([(payload,)], "payload string")).first()
    assert r.parse_ok == ok and (len(r.postings) if r.postings is not None else None) == n


def test_full_build_is_idempotent(spark, world):
    manifest, folder = world
    payloads = read_payloads(spark, folder)
    stored = {t: empty_jobs(spark) for t in TABLES}
    none = spark.createDataFrame([], "sha string")
    new = full_build(manifest, payloads, stored, none, step=1)
    assert ids(new["nyc_jobs"], "id", "first_seen_date", "title") == [
        ("1", "2025-01-02T00:00:00Z", "Dev"), ("3", "2025-01-02T00:00:00Z", "Dev"), ("5", "2025-01-04T00:00:00Z", "Dev")]
    assert ids(new["remote_jobs"], "id", "terms", "date_posted") == [("2", '["Summer","Fall"]', "1700000000"), ("3", '["Summer","Fall"]', "1700000000")]
    assert len(ids(new["done_commits"], "sha")) == 4  # neither the broken payload nor the missing one
    again = full_build(manifest, payloads, {t: new[t] for t in TABLES}, new["done_commits"], step=1)
    assert all(ids(again[t], *JOBS_FULL) == ids(new[t], *JOBS_FULL) for t in TABLES)
    assert len(ids(full_build(manifest, payloads, stored, none, step=1, faithful=True)["done_commits"], "sha")) == 6
    assert [r.seq for r in pending_commits(manifest, new["done_commits"], 1).orderBy("seq").collect()] == [2, 4]
    assert [r.seq for r in recent(manifest, 2).collect()] == [4, 5]


def test_stream_equals_batch(spark, world, tmp_path):
    manifest, folder = world
    new = full_build(manifest, read_payloads(spark, folder), {t: empty_jobs(spark) for t in TABLES}, spark.createDataFrame([], "sha string"), step=1)
    home = f"file://{tmp_path}/home"
    for _ in range(2):
        sighting_stream(spark, folder, manifest, home, files=100).awaitTermination()
    for t in TABLES:
        assert ids(stored_jobs(spark, home, t), *JOBS_FULL) == ids(new[t], *JOBS_FULL)


def state_of(spark):
    return {
        "nyc_jobs": spark.createDataFrame([], strings(JOBS_CSV_8)), "remote_jobs": spark.createDataFrame([], strings(JOBS_CSV_8)),
        "job_details": spark.createDataFrame([], strings(JOB_DETAILS)),
        "pending_archive": numbered(spark.createDataFrame([], strings(PENDING_ARCHIVE))),
        "excluded_jobs": spark.createDataFrame([(" 3 ",) + ("",) * 7], strings(EXCLUDED_JOBS)),
    }


def test_update_run(spark, world):
    manifest, folder = world
    outcomes = spark.createDataFrame([("1", "wayback", "success", "u1", "t"), ("2", "none", "failed", "", "")], "id string, archive_source string, archive_status string, archive_url string, raw_text string")
    new = update(state_of(spark), manifest, read_payloads(spark, folder), outcomes, commits=6, source="L", now="2025-02-01T00:00:00Z")
    assert ids(new["nyc_jobs"], "id", "company_name", "recruiting_season") == [("1", "Acme", "Summer | Fall"), ("5", "Acme", "Summer | Fall")]
    assert ids(new["remote_jobs"], "id", "source") == [("2", "L")]
    details = {r.id: r for r in new["job_details"].collect()}
    assert details["1"].archive_status == "success" and details["1"].archive_url == "u1" and details["1"].status == "unreviewed"
    assert details["2"].archive_status == "failed" and details["5"].archive_status == "failed"  # at every attempt
    assert ids(new["job_details_text"], "id", "raw_text") == [("1", "t")]
    assert ids(new["pending_archive"], "id", "archive_attempts") == [("2", "1"), ("5", "1")]
    again = update(new, manifest, read_payloads(spark, folder), outcomes, commits=6, source="L", now="2025-02-02T00:00:00Z")
    assert ids(again["nyc_jobs"], "id") == ids(new["nyc_jobs"], "id")
    assert ids(again["pending_archive"], "id", "archive_attempts") == [("2", "2"), ("5", "2")]
    third = update(again, manifest, read_payloads(spark, folder), outcomes, commits=6, source="L", now="2025-02-03T00:00:00Z")
    assert ids(third["pending_archive"], "id") == [] and {r.archive_status for r in third["job_details"].collect()} == {"success", "failed"}
    q = spark.createDataFrame([("2",)], "id string")
    d = spark.createDataFrame([("2", "pending")], "id string, archive_status string")
    none = spark.createDataFrame([], "id string")
    assert purge_queue(q, d, none).count() == 1 and purge_queue(q, d, none, faithful=True).count() == 0


def model_run(state, commits, outcomes, now):
    """The sequential rule of a run; items that failed stay queued until their third attempt."""
    out = {x.strip() for x in state["excluded"]} - {""}
    nyc, remote = ({k: v for k, v in state[t].items() if k not in out} for t in ("nyc", "remote"))
    details = dict(state["details"])
    queue = [q for q in state["queue"] if q["id"] not in out and details.get(q["id"], {}).get("archive_status") != "success"]
    texts, queued = dict(state["texts"]), {q["id"] for q in queue}
    mark = max((d["first_seen_date"] for d in details.values()), default="")
    for date, listing in commits:
        for job in listing:
            jid, url = job["id"], job["url"]
            if not jid or jid in out:
                continue
            new = False
            if jid not in nyc and any("nyc" in x.lower() for x in job["locations"]):
                nyc[jid], new = (job["title"], date), True
            if jid not in remote and job["locations"] and all("remote" in x.lower() for x in job["locations"]):
                remote[jid], new = (job["title"], date), True
            if new and jid not in details and jid not in queued and date >= mark:
                queue.append({"id": jid, "title": job["title"], "url": url, "date": date, "attempts": 0})
                queued.add(jid)
                mark = max(mark, date)
                if url and any(d["job_url"] == url for d in details.values()):
                    continue
                details[jid] = {"title": job["title"], "job_url": url, "archive_url": "", "archive_source": "", "archive_status": "pending", "category": "",
                                "date_archived": "", "status": "unreviewed", "source": "L", "first_seen_date": date, "class_year": ""}
    left = []
    for n, q in enumerate(queue):
        if n >= 5:
            left.append(q)
            continue
        ok = q["id"] in outcomes
        old = details.get(q["id"], {})
        details[q["id"]] = {
            "title": q["title"], "job_url": q["url"], "archive_url": outcomes[q["id"]][0] if ok else "", "archive_source": outcomes[q["id"]][1] if ok else "none",
            "archive_status": "success" if ok else "failed", "category": old.get("category", ""), "date_archived": now, "status": old.get("status", "unreviewed"),
            "source": old.get("source", "L"), "first_seen_date": old.get("first_seen_date", q["date"]), "class_year": old.get("class_year", ""),
        }
        if ok and outcomes[q["id"]][2].strip():
            texts[q["id"]] = outcomes[q["id"]][2]
        if not ok and q["attempts"] + 1 < 3:
            left.append({**q, "attempts": q["attempts"] + 1})
    return {"nyc": nyc, "remote": remote, "details": details, "queue": left, "texts": texts, "excluded": state["excluded"]}


@pytest.mark.parametrize("seed", [1, 2])
def test_three_runs_equal_the_sequential_rule(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, home = tmp_path / "snap", f"file://{tmp_path}/home"
    folder.mkdir()
    model = {"nyc": {}, "remote": {}, "details": {}, "queue": [], "texts": {}, "excluded": [" j3 "]}
    sinks.write_csv(spark.createDataFrame([(" j3 ",) + ("",) * 7], strings(EXCLUDED_JOBS)), f"{home}/excluded_jobs")
    fields = ("title", "job_url", "archive_url", "archive_source", "archive_status", "category", "date_archived", "status", "source", "first_seen_date", "class_year")
    for run in range(3):
        manifest, commits = [], []
        for k in range(4):
            seq = run * 4 + k
            sha, date = f"{seq:040x}", f"2025-01-{10 + seq + rng.randrange(-3, 4):02d}T00:00:00Z"
            listing = [posting(rng.choice(["", *(f"j{n}" for n in range(14))]), rng.choice([["NYC"], ["Remote"], ["Remote, NYC"], ["Boston"]]), title=f"t{seq}",
                               url=rng.choice(["", f"https://x.test/post{rng.randrange(9)}"])) for _ in range(5)]
            (folder / f"{sha}.json").write_text(json.dumps(listing))
            manifest.append((str(seq), sha, date))
            commits.append((date, listing))
        path = sinks.write_csv(spark.createDataFrame(manifest, "seq string, sha string, commit_date string"), f"{home}/manifest")
        got = {f"j{n}": (rng.choice(["", "u"]), rng.choice(["live", "wayback"]), rng.choice(["", " ", "text"])) for n in range(14) if rng.random() < 0.5}
        lines = [json.dumps({"id": k, "archive_url": u, "archive_source": s, "archive_status": "success", "raw_text": t}) for k, (u, s, t) in got.items()]
        (tmp_path / "outcomes.jsonl").write_text("\n".join(lines) + "\n")
        now = f"2025-03-0{run + 1}T00:00:00Z"
        counts = cli(["update", "--home", home, "--snapshots", str(folder), "--manifest", path, "--commits", "4", "--source", "L", "--now", now,
                      "--outcomes", f"file://{tmp_path}/outcomes.jsonl"], spark)
        before, model = model, model_run(model, commits, got, now)
        state = load_state(spark, home)
        for name, key in (("nyc_jobs", "nyc"), ("remote_jobs", "remote")):
            assert {r.id: (r.title, r.first_seen_date) for r in state[name].collect()} == model[key]
        assert counts["new_nyc"] == len(model["nyc"]) - len(before["nyc"]) and counts["queued"] == len(model["queue"])
        assert {r.id: {f: r[f] for f in fields} for r in state["job_details"].collect()} == model["details"]
        assert [(r.id, int(r.archive_attempts)) for r in state["pending_archive"].orderBy("pos").collect()] == [(q["id"], q["attempts"]) for q in model["queue"]]
        assert {r.id: r.raw_text for r in state["job_details_text"].collect()} == model["texts"]


def test_command_line_build_and_backfill(spark, world, tmp_path):
    manifest, folder = world
    home = f"file://{tmp_path}/home"
    path = sinks.write_csv(manifest, f"{home}/manifest")
    args = ["build", "--home", home, "--snapshots", folder, "--manifest", path, "--step", "1", "--now", "2025-01-01T00:00:00Z"]
    assert cli(args, spark) == {"nyc_jobs": 3, "remote_jobs": 2, "done_commits": 4} == cli(args, spark)
    sinks.write_csv(spark.createDataFrame([("1",) + ("u",) * 15], strings(JOB_DETAILS)), f"{home}/job_details")
    (tmp_path / "f.jsonl").write_text('{"id": "1", "raw_text": "found"}\n')
    assert cli(["backfill", "--home", home, "--fetched", f"file://{tmp_path}/f.jsonl"], spark) == {"filled": 1, "remaining": 0}
    assert ids(load_state(spark, home)["job_details_text"], "id", "raw_text") == [("1", "found")]


def test_what_a_run_writes(spark, tmp_path):
    def saved(name, **counts):
        report = spark.createDataFrame([{"new_nyc": 0, "new_remote": 0, "removed": 0, "archive": False, **counts}], "new_nyc int, new_remote int, removed int, archive boolean")
        details = spark.createDataFrame([("1",) + ("",) * 15], strings(JOB_DETAILS))
        texts = spark.createDataFrame([], "id string, raw_text string")
        return set(save_run({**state_of(spark), "job_details": details, "job_details_text": texts, "report": report}, f"file://{tmp_path}/{name}"))

    jobs, texts = {"nyc_jobs", "remote_jobs"}, {"job_details", "job_details_text"}
    assert saved("a") == {"pending_archive"} and saved("b", new_remote=1) == {"pending_archive"} | jobs | texts
    assert saved("c", removed=2) == {"pending_archive", "excluded_jobs"} | jobs and saved("d", archive=True) == {"pending_archive"} | texts
    queue = list((tmp_path / "a" / "pending_archive" / "v000001").glob("*.csv"))
    assert "".join(f.read_text() for f in queue).strip() == ",".join(PENDING_ARCHIVE)  # an empty queue still has its header


def test_backfill(spark):
    details = spark.createDataFrame([(str(i), "u" if i != 3 else "") for i in range(6)], "id string, archive_url string")
    texts = spark.createDataFrame([("0", "have"), ("1", " ")], "id string, raw_text string")
    fetched = spark.createDataFrame([("1", "one"), ("2", ""), ("4", "four")], "id string, raw_text string")
    out = backfill(details, texts, fetched, 3)
    assert ids(out["batch"], "id") == [("1",), ("2",), ("4",)]
    assert ids(out["texts"], "id", "raw_text") == [("0", "have"), ("1", "one"), ("4", "four")]
    assert tuple(out["counts"].first()) == (2, 2)


def test_csv_round_trip(spark, tmp_path):
    hard = [("a, \"b\"", " lead ", "x\ny", ""), ("", "é", "0012", "tail "), ("n", "", "", "")]
    df = spark.createDataFrame(hard, "id string, title string, url string, source string")
    path = sinks.write_csv(df.coalesce(1), f"file://{tmp_path}/csv")
    got = read_csv(spark, path, ("id", "title", "url", "source", "extra"))
    assert ids(got, "id", "title", "url", "source", "extra") == sorted((*r, "") for r in hard)
    assert read_csv(spark, f"file://{tmp_path}/none", ("id",)).count() == 0
    assert sinks.latest_version(spark, f"file://{tmp_path}/csv") == path and sinks.next_version(spark, f"file://{tmp_path}/csv") != path


def test_jsonl_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("1", "u", "t\nx"), ("2", "", "t"), ("3", "u", " "), ("4", "u", None)], "id string, archive_url string, raw_text string")
    path = sinks.write_jsonl(sinks.text_rows(d), f"file://{tmp_path}/jsonl")
    assert ids(read_jsonl(spark, path, ("id", "raw_text")), "id", "raw_text") == [("1", "t\nx")]
    (tmp_path / "bad.jsonl").write_text('{"id": "1", "raw_text": "a"}\n\nnot json\n{"id": "2", "raw_text": "b"}\n')
    assert [i for i, in ids(read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", ("id", "raw_text")).where(F.col("id").isNotNull()), "id")] == ["1", "2"]


def test_sql_dump_loads(spark, tmp_path):
    row = ("1", "O'Neil", None, "[]", "d", "2025", "u", "s", "c\nd")
    jobs = spark.createDataFrame([row, ("2",) + row[1:]], strings(JOBS_FULL))
    lines = sinks.sql_dump({"nyc_jobs": jobs, "remote_jobs": empty_jobs(spark)}, JOBS_FULL, "postings", "2025-01-01").orderBy("part").collect()
    assert "-- 2 rows in nyc_jobs" in [r.line for r in lines]
    db = sqlite3.connect(":memory:")
    db.executescript("\n".join(r.line for r in lines))
    assert sorted(db.execute("SELECT * FROM nyc_jobs").fetchall()) == [row, ("2",) + row[1:]]
    assert sinks.write_lines(sinks.sql_dump({"nyc_jobs": jobs}, JOBS_FULL, "postings", "2025-01-01"), f"file://{tmp_path}/sql").endswith("v000001")


def test_exports_are_ordered(spark):
    jobs = spark.createDataFrame([("2", "B", "t", '["S", "F"]', "d", "x", "u", "s", "c"), ("1", "A", "t", "Summer", "d", "x", "u", "s", "c"), ("3", "A", "t", None, "d", "w", "u", "s", "c")], strings(JOBS_FULL))
    assert [(r.id, r.recruiting_season) for r in sinks.job_export(jobs).collect()] == [("3", None), ("1", "Summer"), ("2", "S | F")]
    df = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2)], "d string, pos int")
    assert [r.pos for r in sinks.newest_first(df, "d", "pos").collect()] == [1, 0, 2]
