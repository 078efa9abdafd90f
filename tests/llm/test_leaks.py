"""Evaluation items in training texts."""

import random
import re

import pytest

from jobstrata.llm import leaks

WORDS = [f"{a}{b}" for a in ("kor", "vel", "tan", "mip", "dra", "sul") for b in ("an", "ex", "or", "ik", "um", "et", "os", "ay")]
DOCS = "doc_id long, text string, item long"
ITEMS = "item_id long, text string, pos int"


def brute(docs, items):
    """Longest run of whole words, or word edit distance of the best stretch."""
    norm = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    out = set()
    for d, text, *_ in docs:
        w = norm(text)
        for i, item, *_ in items:
            x = norm(item)
            if not x:
                continue
            best, prev = 0, [0] * (len(w) + 1)
            for a in x:
                row = [0] * (len(w) + 1)
                for j, b in enumerate(w, 1):
                    if a == b:
                        row[j] = prev[j - 1] + 1
                        best = max(best, row[j])
                prev = row
            dist = list(range(1))
            line = [0] * (len(w) + 1)
            for k, a in enumerate(x, 1):
                new = [k]
                for j, b in enumerate(w, 1):
                    new.append(min(line[j - 1] + (a != b), line[j] + 1, new[-1] + 1))
                line = new
            if best >= leaks.RUN or min(line) <= len(x) // leaks.CHANGED:
                out.add((d, i))
            del dist
    return out


def found(spark, docs, items):
    got = leaks.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return {(r.doc_id, r.item_id) for r in got.collect()}


def test_against_brute_force(spark):
    rng = random.Random(11)
    say = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, " ".join(say(rng.randrange(16, 60))), 0) for i in range(12)]
    docs = []
    for d in range(60):
        body = say(40)
        kind = d % 6
        item = rng.choice(items)[1].split()
        if kind == 1:
            n = rng.randrange(10, min(20, len(item)) + 1)
            at = rng.randrange(len(item) - n + 1)
            body += item[at:at + n]
        elif kind in (2, 3):
            copy = list(item)
            for k in rng.sample(range(len(copy)), rng.randrange(0, len(copy) // 8 + 2)):
                if kind == 2:
                    copy[k] = "zzz"
                else:
                    copy[k] = None
            body += [c for c in copy if c]
        docs.append((d, " ".join(body + say(20)), 0))
    assert found(spark, docs, items) == brute(docs, items)


ITEM = 'The memo by Bordiro dated December 15, 2028 orders teachers to build 57,500 test harnesses at 14.0% within 79 hours, and no "later" than Queen\'s Day.'


@pytest.mark.parametrize("text", [
    ITEM, ITEM.upper(), ITEM.replace(" ", "\n> "), ITEM.replace("Bordiro", "<b>Bórdirò</b>"), "x " + ITEM.replace(",", "").replace("14.0", "14 0").replace('"', "“") + " y",
    "".join(c for c in ITEM if c not in ",.%\"'"), ITEM.replace("o", "o​"),
])
def test_what_does_not_count(spark, text):
    assert found(spark, [(1, text, 0)], [(9, ITEM, 0)]) == {(1, 9)}


def test_short_quotations_are_no_cases(spark):
    words = ITEM.split()
    docs = [(n, "before " + " ".join(words[3:3 + n]) + " after", 0) for n in range(8, 20)]
    assert found(spark, docs, [(9, ITEM, 0)]) == {(n, 9) for n in range(15, 20)}


def test_nulls_repeats_empty_and_long(spark):
    docs = [(1, None, 0), (2, "", 0), (3, " ", 0), (4, ITEM, 0), (4, ITEM, 0), (5, ITEM, 0), (6, "word " * 30_000 + ITEM, 0), (None, ITEM, 0)]
    items = [(9, ITEM, 0), (8, None, 0), (7, "", 0), (6, "...", 0), (9, ITEM, 0)]
    assert found(spark, docs, items) == {(4, 9), (5, 9), (6, 9), (None, 9)}
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()


def test_words_of_many_parts(spark):
    rng = random.Random(12)
    item = " ".join("-".join(rng.choice(WORDS) + str(10 * k + j) for j in range(4)) if k % 2 else rng.choice(WORDS) + f"x{k}" for k in range(32))
    words = item.split()
    parts = leaks.segments(leaks.item_words(spark.createDataFrame([(9, item, 0)], ITEMS)))
    joined = [len(re.findall("[a-z]+|[0-9]", w)) for w in words]
    borders = {sum(joined[:k]) for k in range(len(joined))}
    firsts = {r.at for r in parts.groupBy("seg").agg({"at": "min"}).withColumnRenamed("min(at)", "at").collect()}
    assert firsts <= borders and len(firsts) == 32 // leaks.CHANGED + 1
    docs = []
    for n in range(18):  # runs of 15 stored words are leaks, wherever they begin; 14 are none
        docs += [(n, "before " + " ".join(words[n:n + 15]) + " after", 0), (100 + n, "before " + " ".join(words[n:n + 14]) + " after", 0)]
    for n, some in ((200, (1, 9, 17, 25)), (201, (1, 9, 17, 25, 29))):  # four of 32 may be changed
        docs.append((n, " ".join("changed" if k in some else w for k, w in enumerate(words)), 0))
    got = found(spark, docs, [(9, item, 0)])
    assert {d for d, _ in got if d < 200} == set(range(18))
    assert (200, 9) in got and (201, 9) not in got


@pytest.mark.parametrize("outer, inner", [("-", " "), ("/", " "), (" ", "-"), ("-", "-"), ("/", "-")])
def test_every_run_of_fifteen_is_found(spark, outer, inner):
    """Items whose words partly have several parts, or numbers that punctuation parts."""
    rng = random.Random(hash((outer, inner)) % 1000)
    word = lambda k, join: f"{rng.choice(WORDS)}a{k}" + (f"{join}{rng.choice(WORDS)}b{k}" if join != " " else "")
    words = [word(k, outer if k < 3 or k >= 18 else inner) for k in range(23)]
    words[1], words[9], words[20] = "57,500", "x9", "14.0%"
    item = " ".join(words)
    docs = [(n, "before it " + " ".join(words[n:n + 15]) + " after it", 0) for n in range(9)]
    docs += [(100 + n, "before it " + " ".join(words[n:n + 14]) + " after it", 0) for n in range(10)]
    assert found(spark, docs, [(9, item, 0)]) == {(n, 9) for n in range(9)}
