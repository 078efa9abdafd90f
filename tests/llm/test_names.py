"""Spellings of organisation names."""

import random

import pytest

from jobstrata.llm import names

KINDS = ["Capital", "Robotics", "Health", "Analytics", "Law Offices", "Financial Group", "Realty", "Medical Center"]


def corpus():
    """Many organisations, so that kinds of business are frequent words."""
    rng = random.Random(21)
    part = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randrange(3, 5)))
    return [f"{part().title()} {part().title()} {KINDS[i % len(KINDS)]}" for i in range(160)]


def groups(spark, extra):
    df = spark.createDataFrame([(n,) for n in corpus() + extra], "name string")
    return {r.name: r.entity for r in names.link_names(df).collect()}


SAME = [
    ["Sumanza Tellami Capital", " Sumanza  Tellami Capital", "SUMANZA TELLAMI CAPITAL Inc.", "Sumanza-Tellami Capital, LLC", "Súmanza Tellami Capital",
     "SumanzaTellami Capital", "Jobs at Sumanza Tellami Capital", "Sumanza Tellami Capital / University Hiring", "Sumanza Tellami Capital (New York)",
     "Capital of Sumanza Tellami", "Tellami Sumanza Capital", "Sumanza Telalmi Capital", "Sumanz Tellami Capital", "Sumanza Tellami Cap.", "The Sumanza Tellami Capital L.L.C. - NYC",
     "sUMANZA tELLAMI cAPITAL"],
    ["Sumanza Tellami Robotics", "Sumanza Tellami Robotics GmbH"],
    ["Patricia Meranvan Law Offices", "Trish Meranvan Law Offices", "P. Meranvan Law Offices", "Meranvan, Patty Law Ofcs"],
    ["Margaret Meranvan Law Offices", "Peggy Meranvan Law Offices LLC"],
    ["Vankurito Financial Group", "Vankurito PLC", "Vankurito Fin. Grp"],
    ["Zuzide Porfanni Medical Center", "Zuzide Porfanni Med Ctr", "Zuzide Porfanni Med. Centre"],
]


def test_variants_are_linked_and_others_are_not(spark):
    got = groups(spark, [n for g in SAME for n in g])
    roots = []
    for g in SAME:
        assert len({got[n] for n in g}) == 1, {n: got[n] for n in g}
        roots.append(got[g[0]])
    assert len(set(roots)) == len(SAME)


def test_an_initial_with_two_meanings_stays_apart(spark):
    got = groups(spark, ["Daniel Medelreman Realty", "Dorothy Medelreman Realty", "D. Medelreman Realty", "Dan Medelreman Realty"])
    assert got["Daniel Medelreman Realty"] == got["Dan Medelreman Realty"] != got["Dorothy Medelreman Realty"]
    assert got["D. Medelreman Realty"] not in (got["Daniel Medelreman Realty"], got["Dorothy Medelreman Realty"])


def test_merging_decides_what_one_spelling_cannot(spark):
    """The initial fits two spellings, which a slip makes look like two people until they are merged."""
    got = groups(spark, ["Theodore Kalumbro Realty", "Theodoer Kalumbro Realty", "Ted Kalumbro Realty", "T. Kalumbro Realty"])
    assert len({got[n] for n in ("Theodore Kalumbro Realty", "Theodoer Kalumbro Realty", "Ted Kalumbro Realty", "T. Kalumbro Realty")}) == 1


def test_pairs_are_complete_and_split_alike(spark, monkeypatch):
    linked = spark.createDataFrame([(f"n{i:02d}", "e") for i in range(30)] + [("x", "f")], "name string, entity string")
    whole = {tuple(r) for r in names.name_pairs(linked).collect()}
    monkeypatch.setattr(names, "PAIR_BLOCK", 4)
    assert whole == {tuple(r) for r in names.name_pairs(linked).collect()} == {(f"n{i:02d}", f"n{j:02d}") for i in range(30) for j in range(i + 1, 30)}


def test_nulls_blanks_repeats_and_odd_names(spark):
    odd = [None, "", "  ", " ", "Inc.", "LLC", "???", "東京 株式会社", "a", "x" * 5000, "The", "(New York)", "Jobs at", "A A A A A A A A"]
    df = spark.createDataFrame([(n, 1) for n in odd + odd], "name string, plain int").select("name")
    got = {r.name: r.entity for r in names.link_names(df).collect()}
    assert set(got) == {n for n in odd if n and n.strip("  ")}
    assert names.link_names(df.where("false")).count() == 0
    assert names.name_pairs(names.link_names(df.where("false"))).count() == 0


@pytest.mark.parametrize("short, word, yes", [
    ("lgstcs", "logistics", True), ("svc", "services", True), ("hldgs", "holdings", True), ("analyt", "analytics", True), ("mgmt", "management", True),
    ("ctr", "center", True), ("centre", "center", True), ("sw", "software", True), ("capital", "robotics", False), ("tidelma", "technologies", False),
])
def test_short_forms(short, word, yes):
    assert names.shortens(short, word) == yes


def test_merged_spellings_are_completed_by_their_kind(spark):
    profiles = spark.createDataFrame([(1, "realty", "kalumbro ted"), (2, "", "kalumbro theodore"), (3, "", "porfa"), (4, "law", "porfa"), (5, "realty", "porfa"), (6, "", "alone")], "pid long, kind string, words string")
    entity = spark.createDataFrame([(2, 1), (4, 3), (5, 3)], "node long, root long")
    assert [tuple(r) for r in names._completed(profiles, entity).collect()] == [(2, "realty", "kalumbro theodore")]
    keyed = {(r.role, r.key) for r in names._keyed(names._completed(profiles, entity), "oa").collect()}
    assert keyed and {r for r, _ in keyed} == {"o"}
    assert keyed & {(r.role, r.key) for r in names._keyed(spark.createDataFrame([(9, "realty", "kalumbro theodore")], profiles.schema), "oa").collect()}


def test_groups_hold_every_spelling_once(spark, small):
    got = names.p4_groups(spark, small)
    assert got.count() == got.select("name").distinct().count() > 0
    assert got.join(got.select(got["entity"].alias("e")).distinct(), got["name"] == names.F.col("e"), "left_semi").count() == got.select("entity").distinct().count()
