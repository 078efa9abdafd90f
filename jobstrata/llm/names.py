"""Spellings of organisation names that mean the same organisation.

Distinct spellings are read into profiles: what kind of business the name
states, and its own words.  Profiles that share a block (all words but one
equal, that one within a letter or a swap) are merged at once.  A merged entity
unions the spellings, first names, initials and kind of business of its
members, and re-enters blocking with them for what a single spelling can't
decide: an initial, an ambiguous nickname or a name without its kind of
business belongs to an entity only if it is the only one it can mean.  Rounds
repeat until nothing merges any more.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.operators.components import components
from jobstrata.session import materialize, release
from jobstrata.sources.tables import job_rows

#: A word in at least this share of all spellings states a kind of business;
#: there can't be more than (words per name) / KIND_SHARE of them.
KIND_SHARE, KIND_LEAST = 0.006, 7
#: Members of a group up to which its pairs are made in one task.
PAIR_BLOCK = 512

# Legal forms, hiring labels, places and link words that name no organisation.
LEGAL = (
    "inc incorporated corp corporation co company llc llp lp ltd limited plc gmbh ag sa sas srl bv nv pty kg oy ab"
).split()
LABELS = (
    "jobs at|jobs with|jobs|careers at|careers with|careers|career|work at|hiring at|early careers|early talent|"
    "university hiring|university recruiting|campus hiring|campus recruiting|hiring|recruiting|recruitment|internships|talent|team|the"
).split("|")
PLACES = (
    "new york city|new york|nyc|ny|new york office|usa|us|united states|americas|north america|brooklyn|manhattan|"
    "queens|jersey city|remote|global|worldwide"
).split("|")
LINKS = {"by", "of", "the", "and", "at", "office"}

# Short forms of first names.
SHORT = {
    "alexander": "alex alec sandy xander sasha", "anthony": "tony", "benjamin": "ben benny", "catherine": "cathy cate",
    "charles": "charlie chuck", "christopher": "chris topher kit", "daniel": "dan danny", "david": "dave davy",
    "deborah": "deb debbie", "dorothy": "dot dottie dolly", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty eliza libby lizzie betsy",
    "frances": "fran", "francis": "frank", "frederick": "fred freddie", "gregory": "greg", "henry": "harry hank",
    "james": "jim jimmy jamie", "jennifer": "jen jenny", "jonathan": "jon", "joseph": "joe joey", "joshua": "josh",
    "katherine": "kate kathy katie kitty kay kat", "kenneth": "ken kenny", "lawrence": "larry", "leonard": "leo len lenny",
    "margaret": "peggy maggie meg marge", "matthew": "matt", "michael": "mike mick mickey", "nathaniel": "nate",
    "nicholas": "nick", "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "pat paddy", "philip": "phil",
    "rebecca": "becky", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie", "samuel": "sam", "sandra": "sandy",
    "stephen": "steve", "susan": "sue susie suzie", "theodore": "theo ted teddy", "thomas": "tom tommy", "timothy": "tim",
    "victoria": "vicky", "vincent": "vince", "virginia": "ginny", "walter": "walt", "william": "bill will billy liam willie",
}
_MEANT: dict[str, list[str]] = {}
for _full, _shorts in SHORT.items():
    for _s in (_full, *_shorts.split()):
        _MEANT.setdefault(_s, []).append(_full)

_LABEL = re.compile(r"^(?:(?:%s)\s+)+" % "|".join(LABELS))
_TAIL = re.compile(r"(?:\s+(?:%s|%s|office|\w+ office))+$" % ("|".join(LABELS), "|".join(PLACES)))


def plain(name: str) -> str:
    """Lower-case letters and digits in single-spaced words, without accents, brackets' content, labels, places and legal forms."""
    s = re.sub(r"[(\[][^)\]]*[)\]]", " ", name)
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    apart = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", s)
    s = re.sub(r"['’`´]", "", apart.lower())
    s = re.sub(r"\b([a-z])\.\s?([a-z])\.\s?([a-z])\b\.?", r"\1\2\3", s)
    s = re.sub(r"\b([a-z])\.([a-z])\b\.?", r"\1\2", s)
    s = " ".join(re.findall(r"[^\W_]+", s))
    before = None
    while s != before:
        before = s
        s = _LABEL.sub("", s + " ").strip() or s
        s = _TAIL.sub("", " " + s).strip() or s
        words = s.split()
        while len(words) > 1 and words[-1] in LEGAL:
            words.pop()
        s = " ".join(words)
    kept = [w for w in s.split() if w not in LEGAL and w not in LINKS]
    return " ".join(kept) or s


def _vowels(w: str) -> int:
    return sum(c in "aeiou" for c in w)


def shortens(short: str, word: str) -> bool:
    """Whether ``short`` is a usual way to shorten ``word`` (or the word with one slip)."""
    if short == word:
        return True
    if len(short) < 2 or short[0] != word[0] or len(short) > len(word) + 1:
        return False
    stem = short[:-1] if len(short) > 3 and short[-1] == "s" else short
    if len(stem) >= 3 and word.startswith(stem) and len(stem) < len(word):
        return True
    if len(short) >= 5 and (deletions(short) & deletions(word)):
        return True
    if len(short) < len(word) - 1 and _vowels(short) <= max(1, len(short) // 4):
        rest = iter(word)
        return all(c in rest for c in short)
    return len(short) == len(word) and sorted(short) == sorted(word)


def deletions(word: str) -> set[str]:
    """The word, and the word without any one of its letters."""
    return {word, *(word[:i] + word[i + 1:] for i in range(len(word)))}


def read_name(words: list[str], kinds: dict[frozenset, int]) -> tuple[str, list[str]]:
    """Kind of business and own words of a plain name.

    ``kinds`` counts the sets of kind words that occur spelled out.
    """
    best = None
    for kind, n in kinds.items():
        if len(kind) >= len(words):
            continue
        left, exact = list(words), 0
        for k in sorted(kind):
            if k in left:
                left.remove(k)
                exact += 1
            else:  # capitals inside a word part it
                two = next((i for i in range(len(left) - 1) if left[i] + left[i + 1] == k), None)
                if two is not None:
                    left[two:two + 2] = [k]
        missing = [k for k in kind if k not in words]
        for k in sorted(missing, key=len, reverse=True):
            hit = next((w for w in left if w not in _MEANT and shortens(w, k)), None)
            if hit is None:
                break
            left.remove(hit)
        else:
            rank = (exact, len(kind), n)
            if best is None or rank > best[0]:
                best = (rank, kind, left)
    return (" ".join(sorted(best[1])), sorted(best[2])) if best else ("", sorted(words))


def profile_keys(kind: str, words: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Keys of a profile: sure ones, those it offers to weaker names, and those it asks by as a weaker name."""
    sure, offers, asks = set(), set(), set()
    known = [i for i, w in enumerate(words) if w in _MEANT]
    initial = [i for i, w in enumerate(words) if len(w) == 1]
    vague = [i for i in known if len(_MEANT[words[i]]) > 1]
    full = [_MEANT[w][0] if w in _MEANT and len(_MEANT[w]) == 1 else w for w in words]
    whole = " ".join(sorted(full))
    sure.add(f"{kind}|{whole}")
    if len(words) == 1:
        sure.update(f"{kind}|~{d}" for d in (deletions(full[0]) if len(full[0]) >= 6 else {full[0]}))
    else:
        for i, w in enumerate(full):
            rest = " ".join(sorted(full[:i] + full[i + 1:]))
            if len(w) >= 5:
                sure.update(f"{kind}|{rest}|{d}" for d in deletions(w))
        if len(words) == 2:
            sure.update((f"{kind}|~{full[0]}{full[1]}", f"{kind}|~{full[1]}{full[0]}"))
    strong = not initial and not vague
    # A first name may stand as an initial (of the full name) or as a short form of several names.
    for i, w in enumerate(words):
        rest = full[:i] + full[i + 1:]
        if len(rest) != 1 or len(rest[0]) < 4 or rest[0] in _MEANT:
            continue
        around = deletions(rest[0])
        if i in initial:
            asks.update(f"{kind}|{d}|.{w}" for d in around)
        elif i in vague:
            asks.update(f"{kind}|{d}|={m}" for d in around for m in _MEANT[w])
        elif strong and (i in known or len(w) >= 3):
            offers.update(f"{kind}|{d}|.{full[i][0]}" for d in around)
            if i in known:
                offers.update(f"{kind}|{d}|={full[i]}" for d in around)
    # The kind of business may be left out.
    if strong:
        bare = {"|".join(("", whole))} | ({f"|~{d}" for d in deletions(full[0])} if len(words) == 1 and len(full[0]) >= 6 else set())
        (offers if kind else asks).update(bare)
    return sorted(sure), sorted(offers), sorted(asks)


def distinct_names(rows: DataFrame, column: str = "company_name") -> DataFrame:
    """``name``: the distinct stored spellings that aren't null or blank."""
    return rows.select(F.col(column).alias("name")).where(F.col("name").rlike(r"[^\s\u00a0]")).distinct()


@F.pandas_udf(T.StringType())
def _plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for names in batches:
        yield names.map(plain)


def kind_sets(plains: DataFrame) -> dict[frozenset, int]:
    """Sets of frequent words that occur together in names, with counts.

    Frequent words are at most (words per name) / KIND_SHARE, and sets rarer
    than that share are left out, so what comes to the driver is bounded.
    """
    total = plains.count()
    least = max(KIND_LEAST, math.ceil(total * KIND_SHARE))
    words = plains.select(F.explode(F.array_distinct(F.split("plain", " "))).alias("w")).groupBy("w").count().where(F.col("count") >= least)
    frequent = sorted(r.w for r in words.collect() if r.w not in _MEANT and len(r.w) > 2)
    if not frequent:
        return {}
    found = F.array_sort(F.array_intersect(F.split("plain", " "), F.array(*map(F.lit, frequent))))
    sets = plains.select(found.alias("k")).where("size(k) > 0").groupBy("k").count().where(F.col("count") >= least)
    rows = {frozenset(r.k): r["count"] for r in sets.collect()}
    # Half of a kind ("group" of "financial group") is no kind of its own unless it often stands alone.
    return {k: n for k, n in rows.items() if not any(k < o and n < rows[o] / 4 for o in rows)}


def _pid():
    """A profile's number."""
    return F.xxhash64("kind", "words").alias("pid")


def _keyed(profiles: DataFrame, roles: str) -> DataFrame:
    """``pid, role, key`` of ``pid, kind, words`` for the roles asked: sure, offering, asking."""
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for pid, kind, words in zip(b["pid"], b["kind"], b["words"]):
                for role, own in zip("soa", profile_keys(kind, words.split())):
                    rows += [(pid, role, k) for k in own if role in roles]
            yield pd.DataFrame(rows, columns=["pid", "role", "text"]).astype({"pid": "int64"})

    return profiles.select("pid", "kind", "words").mapInPandas(keys, "pid long, role string, text string").select("pid", "role", F.xxhash64("text").alias("key"))


def _completed(profiles: DataFrame, entity: DataFrame) -> DataFrame:
    """``pid, kind, words``: spellings without a kind of business, completed by the only kind their entity has.

    So a merged entity re-enters blocking with keys that none of its spellings has by itself.
    """
    placed = profiles.join(entity, F.col("pid") == F.col("node")).select("pid", "root", "kind", "words")
    roots = profiles.join(entity.select(F.col("root").alias("pid")).distinct(), "pid").select("pid", F.col("pid").alias("root"), "kind", "words")
    members = placed.unionByName(roots)
    only = members.where("kind != ''").groupBy("root").agg(F.min("kind").alias("kind"), F.max("kind").alias("_k")).where("kind = _k").select("root", "kind")
    return members.where("kind = ''").drop("kind").join(only, "root").select("pid", "kind", "words")


def link_names(names: DataFrame) -> DataFrame:
    """``name, entity``: the entity of each spelling, named by its first spelling.

    ``names(name)`` may hold nulls, blanks and repeats, which are ignored.  A
    spelling that means no other is an entity of its own.  An empty table gives
    an empty table.
    """
    spellings = materialize(distinct_names(names, "name").withColumn("plain", _plain("name")), "spellings")
    kinds = kind_sets(spellings.select("plain").distinct())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [read_name(p.split(), kinds) for p in b["plain"]]
            yield pd.DataFrame({"plain": b["plain"], "kind": [k for k, _ in out], "words": [" ".join(w) for _, w in out]})

    # A few bytes a name make small inputs, which would be read by one task.
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_plain = materialize(spellings.select("plain").distinct().repartition(spread).mapInPandas(read, "plain string, kind string, words string"), "read")
    profiles = materialize(of_plain.select("kind", "words").distinct().select(_pid(), "kind", "words"), "profiles")
    blocks = materialize(_keyed(profiles.repartition(spread, "pid"), "soa"), "blocks")
    sure = blocks.where("role = 's'").select("pid", "key")
    hubs = sure.groupBy("key").agg(F.min("pid").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub")
    edges = materialize(sure.join(hubs, "key").where("pid != hub").select(F.col("pid").alias("u"), F.col("hub").alias("v")).distinct(), "sure")
    # Spellings of one profile differ only in what doesn't count.
    entity = components(edges)
    while True:
        richer = materialize(_keyed(_completed(profiles, entity).repartition(spread, "pid"), "oa"), "richer")
        weak = blocks.where("role != 's'").unionByName(richer).distinct()
        placed = weak.join(entity, F.col("pid") == F.col("node"), "left").select("key", "role", "pid", F.coalesce("root", "pid").alias("root"))
        only = placed.where("role = 'o'").groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo = hi").select("key", "lo")
        meant = placed.where("role = 'a'").join(only, "key", "left").groupBy("pid", "root").agg(
            F.min("lo").alias("lo"), F.max("lo").alias("hi")
        ).where("lo = hi and lo != root").select(F.col("pid").alias("u"), F.col("lo").alias("v"))
        fresh = materialize(meant, "meant")
        release(richer)
        if fresh.isEmpty():
            release(fresh, blocks, edges)
            break
        both = materialize(edges.unionByName(fresh).unionByName(entity.select(F.col("node").alias("u"), F.col("root").alias("v"))).distinct(), "sure")
        release(edges, fresh, entity)
        edges, entity = both, components(both)
    rooted = (
        spellings.join(of_plain.select("plain", _pid()), "plain")
        .join(entity, F.col("pid") == F.col("node"), "left").select("name", F.coalesce("root", "pid").alias("root"))
    )
    placed = materialize(rooted, "placed")
    first = placed.groupBy("root").agg(F.min("name").alias("entity"))
    return placed.join(first, "root").select("name", "entity")


def name_pairs(linked: DataFrame) -> DataFrame:
    """``name_a, name_b``: all pairs of spellings of each entity, the smaller first.

    Large groups are split: each spelling meets blocks of at most about
    PAIR_BLOCK others, so the pairs of one group are spread over many tasks.
    """
    sizes = linked.groupBy("entity").agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / PAIR_BLOCK).cast("int")
    )
    known = linked.join(sizes, "entity")
    mine = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    left = known.select("entity", F.col("name").alias("name_a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = known.select("entity", F.col("name").alias("name_b"), mine.alias("block"))
    return left.join(right, ["entity", "block"]).where("name_a < name_b").select("name_a", "name_b")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    names = job_rows(spark, folder, "company_name").select(F.col("company_name").alias("name"))
    return name_pairs(link_names(names))


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    """``name, entity``: every spelling with the representative of its organisation."""
    return link_names(job_rows(spark, folder, "company_name").select(F.col("company_name").alias("name")))
