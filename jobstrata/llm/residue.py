"""Pages that hold template residue, filler or an error notice instead of a posting.

Records are aligned around each candidate: what other records hold between the
same words is the slot's filling.  Candidates are fragments in the marks of
template languages, bare names of variables, and labels with nothing after
them.  A fragment in marks is a slot left open, unless sites agree on it (a
posting may well speak of ``${VARIABLE}``); a bare name or a blank is one only
where most records have a filling in its place.  Pages of which nothing remains
once the wording shared by pages is taken away, and which so repeat a
whole-page error template, hold no posting.  What editors write to each other,
and filler, stands in no slot of its own and is told by its wording.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.llm.pages import body_lines, laid_out
from jobstrata.session import materialize
from jobstrata.sources.tables import table

#: A fragment in marks is text if pages of several sites agree on it (those of one site share a
#: template) and they are this share of the pages with a fragment or filled value in its place.
#: A bare name or blank is a slot if fillings are this share of them.
AGREE_SHARE = 0.8
#: Lines a task remembers as having been looked at.
CACHED = 50_000

# Marks of template languages around a variable's name.
_MARKS = re.compile(
    r"\{\{[^{}\n]+\}\}|\$\{[^{}\n]+\}|\{%[^%\n]+%\}|\{[A-Za-z][^{}\n]*\}|\{ [^{}\n]+ \}"
    r"|<%[^%\n]+%>|<<[^<>\n]+>>|<[A-Za-z][\w .-]+>"
    r"|\[\[[^\[\]\n]+\]\]|\[[A-Za-z][^\[\]\n]+\]|\[\s*\]"
    r"|@@[\w .-]+@@|__[A-Za-z][\w .-]*?__|%[A-Za-z][\w.]+%|#[A-Za-z][\w.]+#|~[A-Za-z][\w.]+~"
    r"|\bXX [\w .-]+? XX\b|\((?:enter|insert|your|add|fill in|type)\b[^()\n]*\)|_{3,}",
    re.I,
)
# Names of variables without marks: words joined by underscores or by capitals, not within addresses or files.
_NAME = re.compile(r"(?<![\w/@.$#%-])(?:[A-Za-z]+(?:_[A-Za-z]+)+|[a-z]+(?:[A-Z][a-z]+)+)(?![\w/@(]|\.\w)")
# A short label with nothing after it.
_LABEL = re.compile(r"^\s*[^\W\d_][\w ]{0,30}:\s*$", re.M)
# Names of HTML elements, which aren't variables.
_TAGS = re.compile(r"^</?(?:a|b|i|u|p|br|hr|li|ul|ol|em|td|tr|th|div|span|strong|table|tbody|h[1-6]|img|script|style|body|html|head)\b", re.I)
# What editors write for each other, and filler.
_REMINDER = re.compile(
    r"\b(?:TODO|TBD|TBC|TBA|FIXME|TKTK)\b|(?<![\w.-])[xX]{3,}(?![\w.-])"
    r"|\((?:HR|Manager|Editor|Recruiter|Recruiting|Hiring manager|Admin|Note to \w+)\s*:"
    r"|(?i:\b(?:delete|remove|replace|overwrite|edit) this (?:text|paragraph|section|line|block|sentence|box|copy)\b)"
    r"|(?i:\bto be (?:provided|supplied|confirmed|completed|written|filled in|added|announced|determined|defined) by\b)"
    r"|(?i:\b(?:text|copy|content|description|blurb|duties|details|summary|location|salary)\s+(?:goes here|to go here|to come|to follow|pending)\b)"
    r"|(?i:\b(?:write|describe|explain|add|insert|enter|type|put|list|state)\b[^.\n]*\bin this (?:space|box|field|place|section|paragraph)\b)"
    r"|(?i:\bsection \d+ (?:heading|body|bullet|paragraph|title|list) (?:copy|text)\b)"
    r"|(?i:\b(?:asdf\w*|qwerty|blah)\b)"
)
_LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
    "enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in "
    "reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa "
    "qui officia deserunt mollit anim id est laborum".split()
)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
_WORD = re.compile(r"[^\W\d_]+")


def _filler(sentence: str) -> bool:
    words = [w.lower() for w in _WORD.findall(sentence)]
    return len(words) >= 3 and sum(w in _LATIN for w in words) >= 0.7 * len(words)


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: html.unescape(t) if t and "&" in t else t)


def _tokens(line):
    """Words and signs of a line."""
    return F.regexp_extract_all(line, F.lit(r"(?U)[\w$#%@'’-]+|[^\w\s]"), F.lit(0))


# What stands for the ends of a line among its words, and for nothing beyond them.
_HEAD, _TAIL = ("", "\x02"), ("\x03", "")


def _ends(pair: tuple[str, str]):
    return F.array(*[F.lit(x) for x in pair])


def fragments(details: DataFrame) -> DataFrame:
    """``detail_id, page, site, sure, marked, l2, l1, fill, r1, r2``: what may be residue in each page's text.

    ``sure`` rows are reminders and filler; the others are fragments in
    template marks (``marked``), bare names and blanks after labels, with the
    two words before and after them in the line.
    """
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clean: set[str] = set()  # lines without anything, which many pages repeat
        for b in batches:
            rows = []
            for did, page, site, text in zip(b["detail_id"], b["page"], b["site"], b["raw_text"]):
                own = []
                for raw in text.split("\n"):
                    if raw in clean:
                        continue
                    line = html.unescape(raw) if "&" in raw else raw
                    if _REMINDER.search(line) or any(_filler(s) for s in _SENTENCE.split(line)):
                        own = [(did, page, site, True, False, None, None, None)]
                        break
                    found = [(m, True) for m in _MARKS.finditer(line) if not _TAGS.match(m[0])]
                    inside = [range(m.start(), m.end()) for m, _ in found]
                    found += [(m, False) for m in _NAME.finditer(line) if not any(m.start() in r for r in inside)]
                    new = [(did, page, site, False, marked, line[:m.start()], m[0], line[m.end():]) for m, marked in found]
                    new += [(did, page, site, False, False, m[0].strip(), "", "") for m in _LABEL.finditer(line)]
                    own += new
                    if not new:
                        if len(clean) >= CACHED:
                            clean.clear()
                        clean.add(raw)
                rows += own
            yield pd.DataFrame(rows, columns=["detail_id", "page", "site", "sure", "marked", "left", "fill", "right"])

    own = laid_out(details).select("detail_id", F.xxhash64("raw_text").alias("page"), F.coalesce("site", F.lit("")).alias("site"), "raw_text")
    schema = f"detail_id {dict(details.dtypes)['detail_id']}, page long, site string, sure boolean, marked boolean, left string, fill string, right string"
    near = own.mapInPandas(find, schema).select(
        "*", F.slice(F.concat(_ends(_HEAD), _tokens(F.col("left"))), -2, 2).alias("l"), F.slice(F.concat(_tokens(F.col("right")), _ends(_TAIL)), 1, 2).alias("r")
    )
    return near.select(
        "detail_id", "page", "site", "sure", "marked", F.col("l")[0].alias("l2"), F.col("l")[1].alias("l1"), "fill", F.col("r")[0].alias("r1"), F.col("r")[1].alias("r2")
    )


def filled(details: DataFrame, doubtful: DataFrame) -> DataFrame:
    """``at, l1, r1, fill, page``: pages with other words in the place of a fragment.

    The place is the words next to ``doubtful(at, l2, l1, fill, r1, r2)`` and
    one more on either side (on the left only, where it is part of the place
    as ``at``), within a line.
    """
    line = F.explode(F.split("text", "\n")).alias("line")
    text = details.where("raw_text is not null").select(F.xxhash64("raw_text").alias("page"), _unescaped("raw_text").alias("text"))

    def tokens(of: DataFrame) -> DataFrame:
        return of.select("page", line).select("page", F.concat(_ends(_HEAD), _tokens(F.col("line")), _ends(_TAIL)).alias("t"))

    after = doubtful.select("at", "l2", "l1", "fill", "r1").distinct()
    before = doubtful.where("at = ''").select("at", "l1", "fill", "r1", "r2").distinct()
    # Pages that hold a place's two words at all are found by hashes of neighbouring words; only they are looked at further.
    ends = after.select(F.xxhash64("l2", "l1").alias("h")).unionByName(before.select(F.xxhash64("r1", "r2").alias("h"))).distinct()
    beside = F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.xxhash64(F.element_at("t", i), F.element_at("t", i + 1)))
    some = tokens(text).select("page", F.explode(F.array_distinct(beside)).alias("h")).join(ends, "h", "left_semi").select("page").distinct()
    lines = tokens(text.join(materialize(some, "some"), "page", "left_semi"))
    # Each pair of neighbouring words, with its place from 0.
    pairs = lines.select("page", "t", F.posexplode(F.arrays_zip(F.slice("t", 1, F.size("t") - 1).alias("x"), F.slice("t", 2, F.size("t") - 1).alias("y"))).alias("i", "p"))
    pairs = pairs.select("page", "t", "i", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    # At least one word stands between.
    ahead = pairs.join(after, (F.col("x") == F.col("l2")) & (F.col("y") == F.col("l1"))).where(F.expr("array_contains(slice(t, i + 4, size(t)), r1)"))
    behind = pairs.join(before, (F.col("x") == F.col("r1")) & (F.col("y") == F.col("r2"))).where(F.expr("array_contains(slice(t, 1, greatest(i - 1, 0)), l1)"))
    return ahead.select(*_PLACE, "fill", "page").unionByName(behind.select(*_PLACE, "fill", "page")).distinct()


#: What makes a slot: the words next to it, and before an unmarked one the word before that.
_PLACE = ("at", "l1", "r1")


def open_slots(found: DataFrame, details: DataFrame) -> DataFrame:
    """``detail_id`` of pages with residue among the :func:`fragments` of ``details``."""
    marked = F.col("at") == ""
    near = found.where("not sure").withColumn("at", F.when(F.col("marked"), "").otherwise(F.concat(F.lit("\x01"), "l2")))
    by_fill = near.groupBy(*_PLACE, "fill").agg(F.count_distinct("page").alias("n"), F.count_distinct("site").alias("sites"))
    whole = by_fill.groupBy(*_PLACE).agg(F.sum("n").alias("total"))
    # What may be text, and what only a filling of other records can show to be a slot.
    doubtful = by_fill.join(whole, [*_PLACE]).where(~marked | ((F.col("sites") > 1) & (F.col("n") >= AGREE_SHARE * F.col("total"))))
    around = materialize(near.join(doubtful, [*_PLACE, "fill"]).select(*_PLACE, "l2", "fill", "r2", "n", "total").distinct(), "doubtful")
    others = filled(details, around).join(near.select("page", *_PLACE).distinct(), ["page", *_PLACE], "left_anti")
    others = others.groupBy(*_PLACE, "fill").agg(F.count("*").alias("others"))
    known = around.select(*_PLACE, "fill", "n", "total").distinct().join(others, [*_PLACE, "fill"], "left").na.fill(0, ["others"])
    all_ = AGREE_SHARE * (F.col("total") + F.col("others"))
    text = known.where((marked & (F.col("n") >= all_)) | (~marked & (F.col("others") < all_))).select(*_PLACE, "fill")
    left = near.join(text, [*_PLACE, "fill"], "left_anti")
    return found.where("sure").select("detail_id").unionByName(left.select("detail_id")).distinct()


def find_residue(details: DataFrame, bodies: DataFrame | None = None) -> DataFrame:
    """``detail_id`` of each record whose text isn't a finished posting.

    Takes ``detail_id, raw_text, title, company_name, job_url``; further
    columns are ignored.  Null and blank texts give no row; each id comes once.
    ``bodies`` is the result of :func:`body_lines` on the same records.
    """
    bodies = body_lines(details) if bodies is None else bodies
    bare = bodies.where("size(kept) = 0").select("detail_id")
    return bare.unionByName(open_slots(materialize(fragments(details), "fragments"), details)).distinct()


def _details(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "job_details").select("detail_id", "raw_text", "title", "company_name", "job_url")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_residue(_details(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """``detail_id, line_no`` of the lines to keep; records of p3 give none."""
    details = _details(spark, folder)
    bodies = body_lines(details)
    bad = find_residue(details, bodies)
    kept = bodies.join(bad, "detail_id", "left_anti").select("detail_id", F.explode("kept").alias("line_no"))
    return kept.select("detail_id", F.col("line_no").cast("long").alias("line_no"))
