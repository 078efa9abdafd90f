"""Texts that were cut."""

import random

from jobstrata.llm import truncation

DOCS = "doc_id long, source string, text string, line int, cut string"
SENTENCES = ["We build pricing models every day.", "The team is looking for a patient engineer in Queens.", "Knowledge of Spark is welcome; we teach the rest.",
             "You will review order books with two other traders.", "Pay is reviewed each March, and last time it rose.", "Travel may be needed to meet mentors in other offices."]


def body(rng, least):
    out = ""
    while len(out) < least:
        out += (" " if out else "") + rng.choice(SENTENCES)
    return out


def corpus():
    rng = random.Random(31)
    rows, cut = [], set()
    for n in range(600):
        source = ("limited", "bytes", "marked", "free", None)[n % 5]
        text = body(rng, rng.randrange(60, 700))
        if n % 10 >= 8 and source == "free":
            text = text + "\n" + rng.choice(["Team: Storage", "* Python and pandas", "Thanks, the Spark team", "https://x.test/a", "Queens, NY", "Good luck…", "See you 🙂", "#hiring #Fall2025"])
        whole = text
        if source == "limited":
            text = text[:400]
        elif source == "bytes":
            text = (text.replace("a", "é")).encode()[:400].decode("utf-8", "ignore")
            whole = whole.replace("a", "é")
        elif source == "marked" and len(text) > 397:
            text = text[:397] + "..."
        if text != whole and not text.rstrip().endswith(".") or text.endswith("..."):
            cut.add(n)
        rows.append((n, source, text, 0, ""))
    return rows, cut


def judged(spark, rows):
    got = truncation.judge(spark.createDataFrame(rows, DOCS))
    return {r.doc_id for r in got.where("cut").collect()}, got


def test_limits_are_found_and_endings_told_apart(spark):
    rows, cut = corpus()
    got, _ = judged(spark, rows)
    assert len(got ^ cut) <= 0.02 * len(cut) + 1, (sorted(got - cut)[:5], sorted(cut - got)[:5])
    sure = truncation.significant_lengths(truncation.endings(spark.createDataFrame(rows, DOCS).select("doc_id", "source", "text")))
    found = {(r.source, r.kind, r["at"]) for r in sure.collect()}
    assert {("limited", "chars", 400), ("bytes", "bytes", 400), ("marked", "core", 397)} <= found
    assert "free" not in {s for s, *_ in found}


def test_texts_lost_on_the_way(spark):
    rows, _ = corpus()
    torn = ["We build pric", "We build pricing models and", "Some text wro\\u00", "Some text in Kube<br", "Some text L%E", "* Comfo", "The offic�", "Some text [read more]", "人を募集してい"]
    fine = ["We build pricing models.", "Team: Storage", "Done.\nQueens, NY", "We wait to hear from you 🙂", "So much more...", "See https://x.test/abc", "x = [1, 2]", "完了しました。"]
    more = [(1000 + i, "free", t, 0, "") for i, t in enumerate(torn + fine)]
    # Words of labels and lists occur elsewhere in the corpus.
    more += [(2000 + i, "free", f"Our teams are Storage, Routing.\nStorage\nPart {i}.", 0, "") for i in range(30)]
    got, _ = judged(spark, rows + more)
    assert {i for i in range(len(torn + fine)) if 1000 + i in got} == set(range(len(torn)))


def test_nulls_blanks_repeats_and_empty_tables(spark):
    rows = [(1, "s", None, 0, ""), (2, "s", "", 0, ""), (3, None, " \n ", 0, ""), (4, None, "We build pric", 0, ""), (4, None, "We build pric", 0, ""), (None, "s", "Ends here.", 0, ""),
            (5, "s", "word " * 40_000 + "end.", 0, "")]
    got, all_ = judged(spark, rows)
    assert got == {4} and all_.count() == 4
    shares = {r.source: (r.texts, r.cut_texts, r.share) for r in truncation.cut_shares(all_).collect()}
    assert shares == {None: (2, 2, 1.0), "s": (2, 0, 0.0)}
    assert judged(spark, [])[1].count() == 0


def test_copies_make_no_limit(spark):
    rows, _ = corpus()
    copies = [(5000 + i, "free", "We build pricing models and ship them to Queens every single day of the week.", 0, "") for i in range(300)]
    got, _ = judged(spark, rows + copies)
    assert not {d for d in got if d >= 5000}
