"""Evaluation items that leak into a training corpus.

A positional inverted index of the corpus is stored once: a row per word with
its document and position.  Each test item is cut into so many segments that a
leak must hold at least one of them unchanged.  For each segment the posting
lists of its rarest words are intersected at adjusted offsets; what survives is
compared word by word with the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobstrata.llm.normal import plain_words
from jobstrata.session import materialize, release
from jobstrata.sources.tables import table

#: So many consecutive words of an item are a leak.
RUN = 15
#: Of the whole item, one word in so many may be changed.
CHANGED = 8
#: Rarest words of a segment whose lists are intersected.
LISTS = 3


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings ``term, doc, pos`` of all words of all documents (no shuffle).

    ``doc`` is a hash of id and text, so that rows sharing an id stay apart.
    """
    return docs.select(
        F.xxhash64(doc_id, text).alias("doc"), F.posexplode(plain_words(F.col(text))).alias("pos", "word")
    ).select(F.hash("word").alias("term"), "doc", "pos")


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, words, spans``: the compared words, and how many whole stored words end with each.

    A stored word is a stretch between white space that holds a letter or digit.
    """
    marked = F.transform(F.split(F.col(text), r"[\s\u00a0]+"), lambda w: w)
    stored = F.filter(marked, lambda w: w.rlike(r"[\p{L}\p{N}]"))
    parts = items.select(F.col(item_id).alias("item"), plain_words(F.col(text)).alias("words"), stored.alias("stored"))
    # Length of the plain letters up to the end of each stored word, against that of the compared words.
    joined = parts.select(
        "item", "words",
        F.transform("stored", lambda w: F.length(F.array_join(plain_words(w), ""))).alias("sl"),
        F.transform("words", lambda w: F.length(w)).alias("wl"),
    )
    ends = joined.select("item", "words", _running("sl").alias("se"), _running("wl").alias("we"))
    # Markup with spaces inside gives no stored words; each compared word then counts as one.
    se = F.when(F.element_at("se", -1) == F.element_at("we", -1), F.col("se")).otherwise(F.col("we"))
    return ends.where(F.size("words") > 0).select("item", "words", se.alias("se"), "we")


def _running(c: str):
    return F.transform(
        F.sequence(F.lit(1), F.size(c)), lambda i: F.aggregate(F.slice(F.col(c), F.lit(1), i), F.lit(0), lambda a, x: a + x)
    )


def units(se: list[int], we: list[int]) -> list[tuple[int, int]]:
    """Compared and stored words of each least stretch that holds whole ones of both."""
    out, i, k = [], 0, 0
    for border in sorted(set(se) & set(we)):
        i0, k0 = i, k
        while i < len(we) and we[i] <= border:
            i += 1
        while k < len(se) and se[k] <= border:
            k += 1
        out.append((i - i0, k - k0))
    return out


def segments(items: DataFrame) -> DataFrame:
    """``item, seg, at, term``: one row per word of each segment.

    An item of n stored words has at least ``n // CHANGED + 1`` segments of up
    to CHANGED whole stored words each: that many changes can't touch all of
    them, and RUN consecutive words always hold one.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for item, words, se, we in zip(b["item"], b["words"], b["se"], b["we"]):
                parts = units(list(se), list(we))
                # A stretch of several stored words may reach beyond its segment's share.
                parts_of = len(se) // max(1, CHANGED + 1 - max(n for _, n in parts)) + 1
                at = before = 0
                for size, stored in parts:
                    rows += [(item, before * parts_of // len(se), k, words[k]) for k in range(at, at + size)]
                    at, before = at + size, before + stored
            yield pd.DataFrame(rows, columns=["item", "seg", "at", "word"])

    flat = items.mapInPandas(cut, f"item {dict(items.dtypes)['item']}, seg int, at int, word string")
    return flat.select("item", "seg", "at", F.hash("word").alias("term"))


def candidates(index: DataFrame, items: DataFrame) -> DataFrame:
    """``doc, item, start, segs``: where an item would start for segments whose rarest words all fit."""
    terms = segments(items)
    wanted = terms.select("term").distinct()
    freq = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    ranked = terms.join(freq, "term", "left").withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("item", "seg").orderBy(F.coalesce("n", F.lit(0)), "at")),
    ).where(F.col("rank") <= LISTS)
    anchors = materialize(
        ranked.groupBy("item", "seg").agg(
            *[F.max(F.when(F.col("rank") == k, F.col(c))).alias(f"{c}{k}") for k in range(1, LISTS + 1) for c in ("term", "at")]
        ).join(terms.groupBy("item", "seg").agg(F.min("at").alias("lo"), F.count("*").cast("int").alias("len")), ["item", "seg"]), "anchors",
    )
    # The lists that are intersected, read from the index once.
    used = anchors.select(F.explode(F.array_compact(F.array(*[f"term{k}" for k in range(1, LISTS + 1)]))).alias("term")).distinct()
    read = materialize(index.join(used, "term", "left_semi"), "lists")
    found = read.join(anchors, F.col("term") == F.col("term1")).withColumn("start", F.col("pos") - F.col("at1")).drop("term", "pos")
    for k in range(2, LISTS + 1):
        lists = read.join(anchors.select(F.col(f"term{k}").alias("term")).distinct(), "term", "left_semi").select(
            F.col("doc").alias("d"), F.col("term").alias("t"), F.col("pos").alias("p")
        )
        fits = (
            (F.col("doc") == F.col("d"))
            & (F.col(f"term{k}") == F.col("t"))
            & (F.col("start") + F.col(f"at{k}") == F.col("p"))
        )
        lone = found.where(F.col(f"term{k}").isNull())
        found = found.where(F.col(f"term{k}").isNotNull()).join(lists, fits, "left_semi").unionByName(lone)
    # An item has few segments, so these sets are small.
    out = materialize(found.groupBy("doc", "item", "start").agg(F.collect_set(F.struct("lo", "len")).alias("segs")), "candidates")
    release(read, anchors)
    return out


def _is_leak(words: list[str], item: list[str], se: list[int], we: list[int], start: int) -> bool:
    """Whether ``words`` leak the item, looking around the place where it would start."""
    n, whole = len(item), len(se)
    # 1. Consecutive equal words around every equal stretch on this diagonal.
    i, best = 0, 0
    first = max(0, -start)
    last = min(n, len(words) - start)
    i = first
    while i < last:
        if words[start + i] != item[i]:
            i += 1
            continue
        j = i
        while j < last and words[start + j] == item[j]:
            j += 1
        lo = we[i - 1] if i else 0
        hi = we[j - 1]
        # Stored words that lie wholly inside letters lo..hi.
        inside = sum(1 for k in range(whole) if (se[k - 1] if k else 0) >= lo and se[k] <= hi)
        best = max(best, inside)
        i = j
    if best >= RUN:
        return True
    # 2. The whole item with few changed words: banded edit distance, free ends in the document.
    # A stored word is changed once, however many compared words it makes.
    most = whole // CHANGED
    sizes = [size for size, _ in units(se, we)]
    slack = max(most, sum(sorted(sizes)[len(sizes) - most:])) if most else 0
    lo, hi = max(0, start - slack), min(len(words), start + n + slack)
    part = words[lo:hi]
    if len(part) < n - slack:
        return False
    row = [0] * (len(part) + 1)
    at = 0
    for size in sizes:
        x = item[at:at + size]
        at += size
        new = [row[0] + 1]
        if size == 1:
            for j, y in enumerate(part, 1):
                new.append(min(row[j - 1] + (x[0] != y), row[j] + 1, new[-1] + 1))
        else:
            for j in range(1, len(part) + 1):
                cost = min(min(row[max(0, j - size - 1):j + 1]), new[-1]) + 1
                new.append(min(cost, row[j - size]) if j >= size and part[j - size:j] == x else cost)
        row = new
        if min(row) > most:
            return False
    return min(row) <= most


def verify(found: DataFrame, docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact comparison of each candidate; ``doc_id, item_id`` of the leaks."""
    # Only documents with a candidate are read into words.
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("doc"), F.col(text).alias("text"))
    body = own.join(found.select("doc").distinct(), "doc", "left_semi").select("doc_id", "doc", plain_words(F.col("text")).alias("words"))
    room = F.size("item_words") + F.size("item_words")
    lo = F.greatest(F.lit(0), F.col("start") - F.size("item_words"))
    def whole(seg):
        here = F.slice("words", (F.col("start") + seg["lo"] + 1).cast("int"), seg["len"])
        return (F.col("start") + seg["lo"] >= 0) & (here == F.slice("item_words", seg["lo"] + 1, seg["len"]))

    # Candidates meet their documents first, a few numbers each; the items' words come after that.
    tests = items.select("item", F.col("words").alias("item_words"), "se", "we")
    near = body.join(found, "doc").join(tests, "item").where(F.exists("segs", whole)).select(
        "doc_id", "item", "item_words", "se", "we",
        (F.col("start") - lo).alias("start"),
        F.slice("words", (lo + 1).cast("int"), (room + F.size("item_words")).cast("int")).alias("words"),
    )

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = [
                _is_leak(list(w), list(i), list(s), list(e), int(a))
                for w, i, s, e, a in zip(b["words"], b["item_words"], b["se"], b["we"], b["start"])
            ]
            yield b.loc[keep, ["doc_id", "item"]].rename(columns={"item": "item_id"})

    schema = f"doc_id {dict(docs.dtypes)[doc_id]}, item_id {dict(items.dtypes)['item']}"
    return near.mapInPandas(check, schema).distinct()


def find_leaks(docs: DataFrame, items: DataFrame, *, index: DataFrame | None = None) -> DataFrame:
    """``doc_id, item_id`` of each document that holds at least RUN consecutive words of
    an item, or the whole item with at most one word in CHANGED changed.

    ``docs(doc_id, text)``, ``items(item_id, text)``; further columns are
    ignored.  Null, empty and wordless texts on either side give no row; a
    repeated document is reported under each of its ids, a repeated row once.
    ``index`` is a stored :func:`build_index` of the same documents.
    """
    own = materialize(build_index(docs), "postings") if index is None else index
    parsed = materialize(item_words(items), "items")
    found = candidates(own, parsed)
    if index is None:
        release(own)
    return verify(found, docs, parsed)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "eval_items").select("item_id", "text")
    )
