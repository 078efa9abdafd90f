"""The main body of each web page: page differencing along neighbouring URLs.

Pages are laid out by host and path, so that a page's neighbour is the page of
the nearest URL; the lines of the two are aligned by a longest common
subsequence, and what they share is suspected to be furniture of the site.  One
pair says little (section headings repeat too, and many sites have one page),
so the verdicts on a line's wording are pooled over all pairs, and joined with
where the wording stands: nothing of a posting stands above its title, and
pages without a posting hold nothing but furniture.  Shared wording is then
deleted from every page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm.addresses import url_parts
from jobstrata.session import materialize, release
from jobstrata.sources.tables import table

#: Words with a capital on at least this share of all sites are common; there
#: can't be more than (words per site) / COMMON of them.
COMMON, COMMON_LEAST = 0.004, 4
#: Lines of a wording from which on it is judged; rarer ones go by their own page's neighbours.
LEAST = 3
#: Wordings on at least this share of all pages are hot: there can't be more than (lines per page) / HOT of them.
HOT = 0.001
#: Words of titles that make up at least this share of all title words.
TITLE_SHARE = 0.0003
#: Pages that share more than this part of their lines are copies and aren't compared.
COPY = 0.7
#: Lines a task remembers as read.
CACHED = 50_000
#: Cells of an alignment whose rows are kept at once; larger ones are halved.
TABLE = 1 << 31

# Bits of a line's features.
# PAIRED and SHARED: with the page before; NEAR: shared with the page before or after.
PAIRED, SHARED, ABOVE, BARE, CAPITAL, BULLET, OWN, TITLE, PLACE, PROSE, SHORT, NEAR, BARE_WORDS = (1 << k for k in range(13))

_BULLET = re.compile(r"^(?:[-*•◦▪‣·–—]|\d{1,2}[.)])\s+")
_NUMBER = re.compile(r"\b[A-Za-z]{0,3}[-#]?\d[\d.,:/-]*\w*")
_WORD = re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"¤(?:[\s,.&'’-]*¤)+")
_NAMES = re.compile(r"(?<=\S )[A-ZÀ-Þ][\w'’-]*(?:[ .&-]+[A-ZÀ-Þ][\w'’-]*)+")
_STOP = re.compile(r"¤[.,]+")
_LEGAL = re.compile(r"¤[\s,.]*(?:inc|llc|l\.l\.c|corp|corporation|co|ltd|limited|incorporated|gmbh|plc)\b\.?", re.I)
_PLACE = re.compile(r"^(?:the )?[^\W\d_][\w.' -]{1,40}, [A-Z]{2}$")
_PARTS = re.compile(r"\s+[·|•]\s+|\s{2,}|\t+")
_SPACES = re.compile(r"[\s\u00a0\u200b-\u200d\u2060\ufeff]+")


def _bare(s: str) -> str:
    return "".join(_WORD.findall(s.casefold())) if s else ""


def wording(line: str, own: frozenset, common: frozenset) -> str:
    """A line without its numbers, bullet, case and names, so that variants of one wording are equal."""
    s = _BULLET.sub("", _SPACES.sub(" ", line).strip())
    s = _NUMBER.sub("9", s if s.upper() != s else s.lower())
    s = _NAMES.sub("¤", s)
    s = _WORD.sub(lambda m: "¤" if m[0] in own or (m[0][0].isupper() and m[0] not in common and m[0].capitalize() not in common) else m[0], s)
    s = _LEGAL.sub("¤", _GAP.sub("¤", s))
    return _STOP.sub("¤", _GAP.sub("¤", s)).casefold()


def _hash(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s) - (1 << 63)


def shared_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions of a longest common subsequence of two sequences of line keys, however long or repetitive.

    A row of the table is one integer, a bit for each line of ``b``, so that a
    line of ``a`` costs a few operations on it.
    """
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    pairs = _aligned(a[lo:ea], b[lo:eb])
    left = [*range(lo), *(lo + i for i, _ in pairs), *range(ea, len(a))]
    return left, [*range(lo), *(lo + j for _, j in pairs), *range(eb, len(b))]


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """For each line of ``a``: bit j is nought where the subsequence of the lines so far grows at line j of ``b``."""
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the subsequence of ``a`` with each beginning of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > TABLE:
        # Too many rows to keep: halve, at the place where the halves' lengths add up to the most.
        mid = len(a) // 2
        at = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
        return _aligned(a[:mid], b[:at]) + [(mid + i, at + j) for i, j in _aligned(a[mid:], b[at:])]
    rows = [(1 << len(b)) - 1, *_rows(a, b)]
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def common_words(pages: DataFrame) -> list[str]:
    """Capitalised words that stand on many sites (a list of bounded length)."""
    least = max(COMMON_LEAST, math.ceil(pages.select("site").distinct().count() * COMMON))
    words = pages.select("site", F.explode(F.array_distinct(F.regexp_extract_all("raw_text", F.lit(r"(?<!\p{L})\p{Lu}\p{L}*"), F.lit(0)))).alias("w")).distinct()
    found = words.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return [r.w for r in found.collect()]


def title_words(pages: DataFrame) -> list[str]:
    """Words that job titles are made of (a list of bounded length)."""
    words = pages.select(F.explode(F.regexp_extract_all(F.lower("title"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    total = words.count()
    least = max(2, math.ceil(total * TITLE_SHARE))
    return [r.w for r in words.groupBy("w").count().where(F.col("count") >= least).collect()]


def laid_out(details: DataFrame) -> DataFrame:
    """Pages with a text, with the parts of their URL.  Null and blank texts drop out."""
    own = details.where(F.col("raw_text").rlike(r"[^\s\u00a0]")).select(
        "detail_id", "raw_text", F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("company_name", F.lit("")).alias("company"), "job_url",
    )
    parts = url_parts(own, "job_url")
    return parts.select(
        "detail_id", "raw_text", "title", "company", F.col("_host").alias("host"),
        F.concat_ws("?", "_path", F.nullif("_query", F.lit(""))).alias("path"),
        F.concat("_host", F.lit("/"), F.regexp_extract("_path", r"^/([^/]+)", 1)).alias("site"),
    )


def _cut(line: str) -> list[str]:
    """The entries of a line that holds several beside each other, else nothing."""
    cut = [p for p in _PARTS.split(line.strip()) if p.strip()]
    return cut if len(cut) > 1 else []


def _read_line(line: str, titles: frozenset, known: frozenset) -> tuple:
    """Words, bare letters, features, first word before a dot (else None), and keys of a line and its entries, on nobody's page."""
    s = _SPACES.sub(" ", line).strip()
    if not s:
        return frozenset(), "", 0, None, 0, []
    words = _WORD.findall(s)
    f = BULLET if _BULLET.match(s) else 0
    if len(s) > 3 and s.upper() == s and s.lower() != s:
        f |= CAPITAL
    if 2 <= len(words) <= 10 and all(w.lower() in titles for w in words) and not s.endswith("."):
        f |= TITLE
    if _PLACE.match(s):
        f |= PLACE
    if len(words) >= 8 and s[-1] in ".!?;:":
        f |= PROSE
    if len(words) <= 5:
        f |= SHORT
        if not any(c.isdigit() or c in ":·|$" for c in s):
            f |= BARE_WORDS
    first = words[0] if s.count(" · ") == 1 and words else None
    none = frozenset()
    return frozenset(words), _bare(s), f, first, _hash(wording(s, none, known)), [_hash(wording(p, none, known)) for p in _cut(line)]


def _read_pages(common: list[str], titles: list[str]):
    """Lines of each page as keys and features, compared with the page before in URL order."""
    known, title_vocab = frozenset(common), frozenset(titles)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # host, site, path, keys, features, output row
        seen: dict[str, tuple] = {}  # lines, which many pages repeat
        done: list = []
        for b in batches:
            for did, text, title, company, host, site, path in zip(b["detail_id"], b["raw_text"], b["title"], b["company"], b["host"], b["site"], b["path"]):
                own = frozenset(w for w in _WORD.findall(company) if w[0].isupper() and len(w) > 1)
                heading = _bare(title)
                lines = text.split("\n")
                keys, bits, parts, of = [], [], [], []
                head = -1
                for k, line in enumerate(lines):
                    r = seen.get(line)
                    if r is None:
                        r = _read_line(line, title_vocab, known)
                        if len(seen) >= CACHED:
                            seen.clear()
                        seen[line] = r
                    words, bare, f, first, key, cut = r
                    if not words and not f:
                        keys.append(key)
                        bits.append(f)
                        continue
                    if heading and bare == heading:
                        f |= OWN
                        head = k if head < 0 else head
                    if first in own:
                        f |= PLACE
                    if not own.isdisjoint(words):
                        # Its wording depends on whose page it is.
                        key = _hash(wording(_SPACES.sub(" ", line).strip(), own, known))
                        cut = [_hash(wording(p, own, known)) for p in _cut(line)] if cut else cut
                    parts += cut
                    of += [k] * len(cut)
                    keys.append(key)
                    bits.append(f)
                for k in range(len(lines)):
                    if keys[k]:
                        bits[k] |= ABOVE if k < head else BARE if head < 0 else 0
                full = [k for k in range(len(keys)) if keys[k]]
                if before and before[0] == host and before[2] != path and before[3] != keys:
                    _, old_site, _, old, old_bits, old_full = before
                    left, right = shared_lines([old[k] for k in old_full], [keys[k] for k in full])
                    if len(left) <= COPY * max(len(old_full), len(full)):  # else a copy under another address
                        # Sites of one host needn't show the same furniture, so such a pair says nothing of what it doesn't share.
                        for k in full:
                            bits[k] |= PAIRED if old_site == site else 0
                        for p in right:
                            bits[full[p]] |= SHARED | NEAR if old_site == site else NEAR
                        for p in left:
                            old_bits[old_full[p]] |= NEAR
                if before is None or before[3] != keys:
                    before = (host, site, path, keys, bits, full)
                done.append((did, keys, bits, parts, of, head))
                if len(done) >= 2000:
                    keep = done.pop()
                    yield pd.DataFrame(done, columns=["detail_id", "keys", "bits", "parts", "of", "head"])
                    done = [keep]  # the next page may still add to it
        if done:
            yield pd.DataFrame(done, columns=["detail_id", "keys", "bits", "parts", "of", "head"])

    return look


def read_pages(details: DataFrame) -> DataFrame:
    """``detail_id, keys, bits, parts, of, head`` of every page with a text.

    Rows are spread by ranges of host, path and id, so a host with a third of
    all pages, or one page archived that often, lies in many tasks; only pages
    at the borders of ranges lack one neighbour.
    """
    pages = materialize(laid_out(details), "pages")
    look = _read_pages(common_words(pages), title_words(pages))
    ordered = pages.repartitionByRange("host", "path", "detail_id").sortWithinPartitions("host", "path", "detail_id")
    schema = f"detail_id {dict(details.dtypes)['detail_id']}, keys array<long>, bits array<int>, parts array<long>, of array<int>, head int"
    out = materialize(ordered.mapInPandas(look, schema), "read-pages")
    release(pages)
    return out


def line_evidence(read: DataFrame) -> DataFrame:
    """``key`` and counts of every wording: in all, above titles, on bare pages, compared, shared, in capitals, with bullets, bare words."""
    lines = read.select(F.explode(F.arrays_zip("keys", "bits")).alias("l")).select(F.col("l.keys").alias("key"), F.col("l.bits").alias("bits")).where("key != 0")

    def on(bit: int):
        return F.count_if(F.col("bits").bitwiseAND(bit) != 0)

    return lines.groupBy("key").agg(
        F.count("*").alias("n"), on(ABOVE).alias("above"), on(BARE).alias("bare"), on(PAIRED).alias("paired"),
        on(SHARED).alias("shared"), on(CAPITAL).alias("capital"), on(BULLET).alias("bullet"), on(BARE_WORDS).alias("bare_words"),
    )


def page_capital_rate(evidence: DataFrame) -> float:
    """Share of capitals in the few-word headings that are written both ways."""
    mixed = evidence.where("bare_words >= 0.5 * n and capital > 0 and capital < 0.5 * n and bullet < 0.1 * n")
    return mixed.agg(F.coalesce(F.sum("capital") / F.sum("n"), F.lit(0.0))).first()[0]


def scored(rows: pd.DataFrame, rate: float) -> pd.DataFrame:
    """``key, score, heading`` of the wordings of :func:`line_evidence`.

    A score above nought speaks for furniture: the log of how much likelier the
    counts are for furniture than for text of a posting.
    """
    n = rows["n"].to_numpy(float)

    def scaled(k: str, of: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
        hits = rows[k].to_numpy(float)
        size = np.minimum(of, most)
        return hits / np.maximum(of, 1) * size, size

    paired = rows["paired"].to_numpy(float)
    s, m = scaled("shared", paired, 60)
    score = s * math.log(0.4 / 0.08) + (m - s) * math.log(0.6 / 0.92)
    a, size = scaled("above", n, 40)
    # Some furniture never stands above the title, so its absence there says little.
    score += np.where(a > 0, a * math.log(0.4 / 0.004) + (size - a) * math.log(0.9 / 0.996), -np.minimum(size, 10.0) * 0.1)
    # What makes up the pages without a posting: furniture stands on them at its usual rate, postings never.
    bare = rows["bare"].to_numpy(float)
    score += np.where(bare >= 0.2 * n, 6.0, 0.0) + np.where((bare < 0.01 * n) & (n >= 100), -1.0, 0.0)
    bullets, capitals = rows["bullet"].to_numpy(float), rows["capital"].to_numpy(float)
    score -= np.where(bullets >= 0.1 * n, 30.0, 0.0)
    # A few words that many pages repeat, but never as a list item or in a heading's capitals, are rather a
    # control: so much less likely is a heading, at the corpus's own rate of capitals in headings.
    plain = (rows["bare_words"].to_numpy(float) >= 0.9 * n) & (bullets == 0) & (capitals == 0) & (n >= 25)
    score += np.where(plain, np.minimum(6.0, -math.log1p(-rate) * n), 0.0)
    heading = (capitals >= 0.02 * n) & (capitals < 0.9 * n) & (bullets < 0.1 * n) & (n >= 10)
    return pd.DataFrame({"key": rows["key"], "score": score.astype(np.float32), "heading": heading})


def with_verdicts(read: DataFrame, evidence: DataFrame, pages: int) -> tuple[DataFrame, pd.DataFrame]:
    """Pages with the verdicts on their wordings that aren't hot, and the verdicts on the hot ones.

    Every wording on LEAST lines or more is judged, however large the corpus.
    Those on a share HOT of the pages are a list of bounded length, which is
    sent along; the others are joined by wording, so no hot key takes part, and
    come as arrays ``seen, scores, heads``.
    """
    rate = page_capital_rate(evidence)
    known = evidence.where(F.col("n") >= LEAST)
    hot = scored(known.where(F.col("n") >= pages * HOT).toPandas(), rate).sort_values("key", ignore_index=True)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield scored(b, rate)

    rare = known.where(F.col("n") < pages * HOT).mapInPandas(judge, "key long, score float, heading boolean")
    hot_keys = read.sparkSession.createDataFrame(hot[["key"]], "key long")
    named = read.withColumn("page", F.xxhash64("detail_id", "keys", "parts"))
    lines = named.select("page", F.explode(F.array_distinct(F.concat("keys", "parts"))).alias("key")).where("key != 0")
    met = lines.join(F.broadcast(hot_keys), "key", "left_anti").join(rare, "key").groupBy("page").agg(
        F.collect_list(F.struct("key", "score", "heading")).alias("met")  # at most the lines of a page
    )
    out = named.join(met, "page", "left").select(
        "detail_id", "keys", "bits", "parts", "of", "head",
        *[F.coalesce(F.col(f"met.{f}"), F.array().cast(t)).alias(c) for f, t, c in (("key", "array<long>", "seen"), ("score", "array<float>", "scores"), ("heading", "array<boolean>", "heads"))],
    )
    return out, hot


def keep_lines(keys, bits, parts, of, head: int, find) -> list[int]:
    """Numbers (from 1) of a page's lines that belong to the posting.

    ``find(key)`` gives the score and heading mark of a wording, or None.
    """
    n = len(keys)
    score = [0.0] * n
    known = [False] * n
    heads = [False] * n
    by_line: dict[int, list] = {}
    for p, k in zip(parts, of):
        by_line.setdefault(k, []).append(p)
    for k in range(n):
        if not keys[k]:
            continue
        found = find(keys[k])
        if k in by_line and (found is None or found[0] > 0):
            own = [find(p) for p in by_line[k]]
            got = [f[0] for f in own if f is not None]
            if got and 2 * len(got) >= len(own):
                score[k], known[k] = sum(1.0 if g > 0 else -1.0 for g in got), True
                if sum(g > 0 for g in got) * 2 > len(got):
                    score[k] = 5.0
                continue
        if found is not None:
            score[k], heads[k] = found
            known[k] = True
        elif bits[k] & NEAR:
            score[k], known[k] = 1.5, True
    start = head
    if start < 0:
        # No title line: a body is there only if several lines clearly are text of a posting.
        solid = [k for k in range(n) if keys[k] and known[k] and score[k] < -2 and not bits[k] & (TITLE | PLACE | SHORT)]
        if len(solid) < 4:
            return []
        start = solid[0] - 1
    lines = [k for k in range(start + 1, n) if keys[k]]
    kind: dict[int, str] = {}
    after_title = False
    top = True
    for k in lines:
        f = bits[k]
        if heads[k]:
            kind[k], after_title, top = "h", False, False
        elif f & (TITLE | OWN) and not f & BULLET:
            kind[k], after_title = "f", True
        elif f & PLACE:
            kind[k] = "f" if after_title or not top else "t"
            after_title = False
        elif known[k] and score[k] > 0:
            kind[k] = "f"
            after_title = False
        elif after_title and f & SHORT and not f & BULLET and not (known[k] and score[k] < -8):
            kind[k], after_title = "f", False
        elif known[k] and score[k] < 0:
            kind[k], after_title = "t", False
            if f & PROSE or f & BULLET or not f & SHORT:
                top = False
        else:
            kind[k], after_title = ("t" if f & (PROSE | BULLET) else "?"), False
    # A heading is one if text follows; between furniture it is an entry of a menu.
    for i, k in enumerate(lines):
        if kind[k] == "h":
            after = [kind[x] for x in lines[i + 1:i + 4]]
            before = [kind[x] for x in lines[max(0, i - 2):i]]
            near = after[0] if after else "f"
            kind[k] = "t" if score[k] < 0 or near in "t?" or ("t" in after and before[-1:] != ["f"]) else "f"
    last = max((i for i, k in enumerate(lines) if kind[k] == "t" and not bits[k] & PLACE), default=-1)
    for i, k in enumerate(lines):
        if kind[k] == "?":
            around = {kind[x] for x in lines[max(0, i - 1):i + 2] if x != k}
            kind[k] = "t" if i < last and around != {"f"} or (i and kind[lines[i - 1]] == "t" and i <= last + 1) or (i == 0) else "f"
    kept = [k + 1 for k in lines if kind[k] == "t"]
    if head >= 0 and kept:
        kept.insert(0, head + 1)
    return kept


def body_lines(details: DataFrame) -> DataFrame:
    """``detail_id, kept, head``: the line numbers of each page's posting, counted from 1.

    Takes ``detail_id, raw_text, title, company_name, job_url``; further
    columns are ignored.  Null and blank texts give no row; a page without a
    posting gives an empty list; nulls in the other columns count as blank;
    a repeated row gives a row each time.
    """
    read = read_pages(details)
    evidence = materialize(line_evidence(read).where("key != 0"), "evidence")
    judged, hot = with_verdicts(read, evidence, read.count())
    sent = details.sparkSession.sparkContext.broadcast(hot)
    schema = f"detail_id {dict(details.dtypes)['detail_id']}, kept array<int>, head int"

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = {k: (float(s), bool(h)) for k, s, h in zip(sent.value["key"], sent.value["score"], sent.value["heading"])}
        for b in batches:
            kept = []
            for keys, bits, parts, of, head, seen, scores, heads in zip(*(b[c] for c in ("keys", "bits", "parts", "of", "head", "seen", "scores", "heads"))):
                own = {k: (float(s), bool(h)) for k, s, h in zip(seen, scores, heads)}
                find = lambda k, own=own: common.get(k) or own.get(k)
                kept.append(keep_lines(list(keys), list(bits), list(parts), list(of), int(head), find))
            yield pd.DataFrame({"detail_id": b["detail_id"], "kept": kept, "head": b["head"]})

    out = materialize(judged.mapInPandas(decide, schema), "bodies")
    release(read, evidence)
    return out
