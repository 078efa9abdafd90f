"""Main bodies of pages, residue and error pages."""

import random

import pytest

from jobstrata.llm import pages, residue

SCHEMA = "detail_id long, raw_text string, title string, company_name string, job_url string, keys string, kept int"
NAV = ["Home", "About us", "Search jobs", "Our teams", "Blog", "Newsroom"]
FOOT = ["Cookie settings", "Privacy notice", "Follow us", "Back to top", "Imprint"]
HEADS = ["Requirements", "Who you are", "About the role", "What you do", "Why join", "How we hire", "The role", "Nice to have", "Your first months", "Qualifications", "Responsibilities", "About the team"]
NOUNS = ["dashboards", "pipelines", "indexes", "feeds", "plans", "reports", "queues", "maps", "models", "screens"]
PLACES = ["Queens", "Harlem", "Midtown", "Brooklyn", "Jersey City", "the Bronx", "Staten Island", "Manhattan", "Chelsea", "Hoboken", "Newark", "Inwood"]
WORDS = ("Spark", "Rust", "Java", "Scala", "Bash", "Swift", "Ruby", "Kotlin", "Go", "Linux", "Redis", "Excel")
ITEMS = [f"{a} {w}" for w in WORDS for a in ("Working knowledge of", "Some months of", "Comfort with", "Interest in", "Courses in", "Talks about")]
TITLES = ["Data Engineer", "Risk Analyst", "Test Engineer", "Product Manager"]


def page(rng, n, company):
    title = rng.choice(TITLES)
    nav, foot = NAV[: 3 + company % 3], FOOT[: 3 + company % 2] + [f"Copyright 2025, Company{company} and its affiliates"]
    body = [title, f"Location: {rng.choice(PLACES)}"]
    for h in rng.sample(HEADS, 2):
        body += [h, *(rng.choice(["- ", ""]) + x for x in rng.sample(ITEMS, 3)),
                 f"The team of {rng.randrange(90)} builds {' and '.join(rng.sample(NOUNS, 3))} and reviews {' or '.join(rng.sample(NOUNS, 3))} every {rng.randrange(9)} days."]
        if rng.random() < 0.5:
            body.append("Save job")
    lines = nav + ["Home / Careers / " + title] + body + foot
    start = len(nav) + 1
    keep = [start + 1 + k for k, x in enumerate(body) if x != "Save job"]
    return (n, "\n".join(lines), title, f"Company{company}", f"https://boards.x.example/company{company}/jobs/{10_000_000 + n}", "", 0), keep


@pytest.fixture(scope="module")
def world():
    rng = random.Random(41)
    rows, want = [], {}
    for n in range(240):
        row, keep = page(rng, n, n % 12)
        if n % 24 == 5:
            c = n % 12
            row = (n, "\n".join(NAV[: 3 + c % 3] + ["Page not found", f"The link is broken, code {n}."] + FOOT[: 3 + c % 2]), *row[2:])
            keep = []
        rows.append(row)
        want[n] = keep
    return rows, want


def test_bodies(spark, world):
    rows, want = world
    got = {r.detail_id: list(r.kept) for r in pages.body_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    hit = sum(len(set(got[n]) & set(want[n])) for n in want)
    assert hit / sum(map(len, want.values())) > 0.95 and hit / sum(map(len, got.values())) > 0.98
    assert all(got[n] == [] for n in want if not want[n])


def test_neighbours_of_two_sites_on_one_host(spark, world):
    rows, want = world
    rows = list(rows)
    rare = "Nebalis House at Mill Lane keeps the servers of this page warm and dry."
    for n in (228, 1):  # the last page of one company, the first of the next
        rows[n] = (n, rows[n][1] + "\n" + rare, *rows[n][2:])
    got = {r.detail_id: list(r.kept) for r in pages.body_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert want[228] and want[1]
    assert all(len(rows[n][1].split("\n")) not in got[n] for n in (228, 1))


def test_residue(spark, world):
    rows, want = world
    rows = list(rows)
    bad = {n for n in want if not want[n]}
    marks = ["{{job_title}}", "[INSERT CITY]", "<company>", "${pay_min}", "__BENEFITS__", "@@years@@", "%POSTING_CITY%", "(enter location)", "XX team name XX", "#START_DATE#"]
    for k, m in enumerate(marks):
        n = 10 + k
        r = rows[n]
        rows[n] = (n, r[1].replace("builds", f"builds {m} and"), *r[2:])
        bad.add(n)
    for n, extra in ((100, "TBC: team blurb from HR"), (101, "Lorem ipsum dolor sit amet consectetur adipiscing elit."), (102, "Delete this paragraph before you publish."), (103, "(HR: add the skills here)"), (104, "Write two or three sentences about the team in this space.")):
        r = rows[n]
        rows[n] = (n, r[1].replace("Save job", extra) if "Save job" in r[1] else r[1] + "\n" + extra, *r[2:])
        bad.add(n)
    for n in range(150, 158):  # a posting that speaks of templates
        r = rows[n]
        if want[n]:
            rows[n] = (n, r[1].replace("builds", "extends the ${VARIABLE} expansion and builds"), *r[2:])
    rows[160] = (160, rows[160][1].replace("builds", 'writes messages such as "page not found" and replaces all lorem ipsum, and builds'), *rows[160][2:])
    got = {r.detail_id for r in residue.find_residue(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == bad


def test_slot_left_open_alike_on_many_pages(spark, world):
    rows, want = world
    rows = list(rows)
    bad = {n for n in want if not want[n]}

    def change(numbers, edit):
        for n in numbers:
            if want[n]:
                rows[n] = (n, edit(rows[n][1]), *rows[n][2:])

    own_line, city, one_site = range(30, 37), range(50, 56), range(63, 240, 12)
    change(own_line, lambda t: t + "\n[Paste the duties here]")
    change(city, lambda t: "\n".join("Location: #CITY#" if x.startswith("Location: ") else x for x in t.split("\n")))
    change(one_site, lambda t: t + "\nReference {{ref}} of this site")
    bad |= {n for k in (own_line, city, one_site) for n in k if want[n]}
    change(range(150, 158), lambda t: t.replace("builds", "extends the ${VARIABLE} expansion and builds"))  # text
    got = {r.detail_id for r in residue.find_residue(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == bad | {n for n in range(150, 158) if n in one_site}


def test_unmarked_names_and_blanks_are_slots_where_others_have_fillings(spark, world):
    rows, want = world
    rows = list(rows)
    bad = {n for n in want if not want[n]}
    names, blanks, talk = (30, 31), (64, 65, 66), range(150, 200)

    def change(numbers, edit):
        for n in numbers:
            rows[n] = (n, edit(rows[n][1]), *rows[n][2:])

    at = lambda t, new: "\n".join(new if x.startswith("Location: ") else x for x in t.split("\n"))
    change(names, lambda t: at(t, "Location: posting_city"))
    change(blanks, lambda t: at(t, "Location:"))
    # What every record holds in its place is no slot, and a line that ends in a colon is a label only where others are filled.
    change(talk, lambda t: t.replace("builds", "reads user_id and builds") + "\nWhat we ask:")
    bad |= {n for k in (names, blanks) for n in k if want[n]}
    assert {r.detail_id for r in residue.find_residue(spark.createDataFrame(rows, SCHEMA)).collect()} == bad


@pytest.mark.parametrize("note", [
    "[Insert two or three sentences about what the team does and whom it serves]", "{{one paragraph on the team, its work and the people and firms it serves}}",
    "{Short paragraph on the team, its work and the people}", "<Short paragraph on the team and the people it serves>", "(add two or three sentences about what the team does and whom it serves)",
])
def test_long_marks(spark, note):
    text = f"Data Engineer\nThe team builds maps.\n{note}"
    got = residue.fragments(spark.createDataFrame([(1, text, "Data Engineer", "c", "https://a.test/1", "", 0)], SCHEMA)).collect()
    assert [(r.detail_id, r.fill) for r in got] == [(1, note)]


def test_nulls_blanks_and_empty_tables(spark):
    rows = [(1, None, None, None, None, "", 0), (2, "", "t", "c", "", "", 0), (3, " \n ", "t", "c", "u", "", 0), (4, "One line", None, None, None, "", 0), (4, "One line", None, None, None, "", 0),
            (5, "\n".join(["x y z"] * 3000), "x y z", "c", "https://a.test/1", "", 0), (None, "Data Engineer\nWe need {{x}}.", "Data Engineer", "c", "https://a.test/2", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pages.body_lines(df).collect()
    assert sorted((r.detail_id is None, r.detail_id or 0) for r in got) == [(False, 4), (False, 4), (False, 5), (True, 0)]
    assert None in {r.detail_id for r in residue.find_residue(df).collect()}
    empty = df.where("false")
    assert pages.body_lines(empty).count() == 0 and residue.find_residue(empty).count() == 0


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("table", [1 << 31, 200])
def test_alignment_is_longest(monkeypatch, table):
    monkeypatch.setattr(pages, "TABLE", table)
    rng = random.Random(51)
    for n in range(300):
        kinds = 1 + n % 6
        a = [rng.randrange(kinds) for _ in range(rng.randrange(15 if n % 20 else 300))]
        b = [rng.randrange(kinds) for _ in range(rng.randrange(15 if n % 20 else 300))]
        left, right = pages.shared_lines(a, b)
        assert len(left) == len(right) == brute_lcs(a, b)
        assert [a[i] for i in left] == [b[j] for j in right] and left == sorted(set(left)) and right == sorted(set(right))


def test_alignment_of_long_pages():
    assert len(pages.shared_lines([1] * 50_000, [1] * 40_000 + [2])[0]) == 40_000


def test_rare_wordings_are_judged_like_hot_ones(spark, world, monkeypatch):
    rows, _ = world
    df = spark.createDataFrame(rows, SCHEMA)
    whole = lambda: sorted((r.detail_id, tuple(r.kept)) for r in pages.body_lines(df).collect())
    hot = whole()
    monkeypatch.setattr(pages, "HOT", 2.0)
    assert whole() == hot
