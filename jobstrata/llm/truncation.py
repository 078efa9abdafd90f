"""Texts cut off by a limit of their source or lost on the way.

A field limit shows as a length at which far more texts end than at the
lengths around it.  The hazard of a length is the share of the texts that reach
it which end there; every hazard is tested against those of its neighbours,
and the false-discovery rate is held per source.  A text that ends unfinished
at a significant length was cut.  Texts cut elsewhere (lost on the way) are
recognised by the ending alone: torn escapes, a "read more" mark, prose without
an end, or a last word that the corpus never ends a line with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobstrata.functions.text import BLANK_CHARS
from jobstrata.session import materialize
from jobstrata.sources.tables import table

#: Neighbouring hazards lie within so many lengths on either side.
REACH = 100
#: Width of the classes of lengths that show limits which back off to a word.
SOFT = 16
#: False-discovery rate per source.
FDR = 0.01
#: A word that stops a line or clause in fewer than this share of its uses doesn't end a text.
STOPS = 0.05
#: Share of the closing entries (labels, list items, sign-offs) that makes their last word a usual one.
USUAL = 0.002
#: Uses of a word that make its share known.
KNOWN = 20

_MORE = r"(?i)\s?(?:\.\.\.|…)?\s?[\[(<](?:read |see |show )?(?:more|continue[ds]?|continue reading|cont\.?|truncated|cut)(?:\.\.\.|…)?[\])>]\s*$|(?i)(?:^|\s)(?:read more|continue reading|show more|see more)\s*[»>→.…]*\s*$"
_DOTS = r"\s*(?:\.\.\.+|…)\s*$"
_END = r"[.!?。！？][\s)\"”’»\]*_]*$"
_CLOSED = r"(?:[)\]|>}\"”»]|```)\s*$"
_TORN = r"(?:\\u[0-9a-fA-F]{0,4}|\\x?|<[/!]?[a-zA-Z]{1,12}|&#?[a-zA-Z0-9]{1,8}|%[0-9A-F]?|�+)$"
_LINK = r"(?:https?://|www\.)\S+$"
_BULLET = r"^\s*(?:[-*•◦▪‣–]|\d{1,2}[.)])\s+"
_LABEL = r"^\s*#?\p{Lu}[\p{L}]*(?:[ -]\p{L}+)?(?:: |\. )\s*\S"
_SIGN = r"^\s*(?:—|--|~|#\p{L}|(?:Thanks|Thank you|Regards|Best|Cheers|Sincerely|Apply by|Good luck)\b)"
_PLACE = r"^\s*(?:the )?\p{Lu}[\p{L}.' -]{1,40}, \p{Lu}{2}$"
_FACE = r"[\x{2600}-\x{27BF}\x{1F000}-\x{1FAFF}][\x{FE0F}\x{200D}]*$"


def _mask(word: Column) -> Column:
    return F.regexp_replace(word, r"\d+", "9")


def _last_line(text: Column) -> Column:
    return F.substring_index(F.translate(text, "\r", "\n"), "\n", -1)


def endings(docs: DataFrame) -> DataFrame:
    """Add what the end of ``text`` shows.  Blank and null texts drop out.

    Patterns are held against the last line only, whatever the length of the text.
    """
    d = docs.withColumn("_body", F.rtrim(F.col("text"), F.lit(BLANK_CHARS))).where("_body != ''")
    d = d.withColumn("_line", _last_line(F.col("_body")))
    more, dots = F.regexp_extract("_line", _MORE, 0), F.regexp_extract("_line", _DOTS, 0)
    d = d.withColumn("_more", more).withColumn("_mark", F.when(F.col("_more") != "", F.col("_more")).otherwise(dots))
    # A mark on a line of its own takes the line end before it along.
    alone = (F.col("_mark") == F.col("_line")) & (F.length("_body") > F.length("_line"))
    left = F.substring(F.col("_body"), F.lit(1), F.length("_body") - F.length("_mark") - F.when(alone, 1).otherwise(0))
    d = d.withColumn("_core", F.when(F.col("_mark") == "", F.col("text")).when(F.col("_more") != "", left).otherwise(F.rtrim(left, F.lit(BLANK_CHARS))))
    d = d.withColumn("_line", F.when(F.col("_mark") == "", F.col("_line")).otherwise(_last_line(F.rtrim(F.col("_core"), F.lit(BLANK_CHARS)))))
    more, dots = F.col("_more"), F.when(F.col("_more") == "", F.col("_mark")).otherwise("")
    return d.select(
        *docs.columns,
        F.length("text").cast("long").alias("n_all"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.length("_core").cast("long").alias("n_core"),
        F.xxhash64("text").alias("h"),
        (more != "").alias("said_more"),
        (dots != "").alias("dotted"),
        F.col("_line").rlike(_END).alias("ended"),
        F.col("_line").rlike(_TORN).alias("torn"),
        F.col("_line").rlike(_CLOSED).alias("closed"),
        F.col("_line").alias("line"),
    ).select(
        "*",
        F.col("line").rlike(_LINK).alias("link"),
        (F.col("line").rlike(_BULLET) | F.col("line").rlike(_LABEL) | F.col("line").rlike(_SIGN)).alias("entry"),
        (F.col("line").rlike(_PLACE) | F.col("line").rlike(_FACE)).alias("stamp"),
        _mask(F.regexp_extract("line", r"[^\s(\[,;]+$", 0)).alias("last"),
    )


def word_stops(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """``last, uses, stops, finals, closing`` of each word.

    ``uses`` counts it anywhere but at the end of a text, ``stops`` those uses
    after which a line or clause ends, ``finals`` the different texts that end
    with it, and ``closing`` those of them whose last line is an entry.
    """
    parts = F.regexp_extract_all("text", F.lit(r"[^\s\u00a0]+(?:[ \t\u00a0]*[\r\n]+)?"), F.lit(0))
    inner = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    # Words as written are counted first: the patterns then see each once, not at each use.
    w = docs.select(F.explode(inner).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    stop = F.col("w").rlike(r"[.,;:!?)\]…。、\r\n]$")
    word = _mask(F.regexp_replace("w", r"^[(\[]+|[\s.,;:!?)\]…。、]+$", ""))
    used = w.select(word.alias("last"), "n", F.when(stop, F.col("n")).otherwise(0).alias("s")).groupBy("last").agg(
        F.sum("n").alias("uses"), F.sum("s").alias("stops")
    )
    finals = ends.select("last", "entry", "h").distinct().groupBy("last").agg(
        F.count("*").alias("finals"), F.count_if("entry").alias("closing")
    )
    return finals.join(used, "last", "left").na.fill(0, ["uses", "stops"])


def hazards(ends: DataFrame) -> DataFrame:
    """``source, kind, at, events, risk, p``: the hazard of each length of each source, tested.

    Kinds are the lengths in characters, in bytes, and without a cut mark, and
    classes of :data:`SOFT` characters.  Repeated texts count once.  ``p`` bounds
    the chance of so many events from above at the hazard of the neighbours
    within :data:`REACH` (a Chernoff bound, so the test is conservative).
    """
    texts = ends.select("source", "n_all", "n_bytes", "n_core", "h").distinct()
    kinds = F.array(
        F.struct(F.lit("chars").alias("kind"), F.lit(1).alias("step"), F.col("n_all").alias("at")),
        F.struct(F.lit("bytes").alias("kind"), F.lit(1).alias("step"), F.col("n_bytes").alias("at")),
        F.struct(F.lit("core").alias("kind"), F.lit(1).alias("step"), F.col("n_core").alias("at")),
        F.struct(F.lit("soft").alias("kind"), F.lit(SOFT).alias("step"), F.floor(F.col("n_all") / SOFT).cast("long").alias("at")),
    )
    counts = texts.select("source", F.explode(kinds).alias("k")).groupBy("source", "k.kind", "k.step", "k.at").agg(
        F.count("*").alias("events")
    )
    line = Window.partitionBy("source", "kind")
    up = line.orderBy("at")
    down = line.orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # The hazard at a length with no event is nought, over as many texts as reach the next length.
    risky = counts.withColumn("risk", F.sum("events").over(down)).withColumn(
        "span", F.least(F.col("at") - F.coalesce(F.lag("at").over(up), F.col("at") - 1), F.lit(REACH).cast("long"))
    ).withColumn("exposure", F.col("risk") * F.col("span"))
    near = up.rangeBetween(-REACH, REACH)
    tested = risky.withColumn("others", F.sum("events").over(near) - F.col("events")).withColumn(
        "over", F.sum("exposure").over(near) - F.col("risk")
    ).withColumn("p0", F.least(F.lit(0.999), (F.col("others") + 0.5) / (F.col("over") + 1.0)))
    rate = F.col("events") / F.col("risk")
    gain = rate * F.log(rate / F.col("p0")) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - F.col("p0")))).otherwise(0.0)
    return tested.withColumn("p", F.when(rate > F.col("p0"), F.exp(-F.col("risk") * gain)).otherwise(1.0))


def significant_lengths(ends: DataFrame) -> DataFrame:
    """Lengths of :func:`hazards` that stay significant at :data:`FDR` (Benjamini-Hochberg per source and kind)."""
    own = Window.partitionBy("source", "kind")
    ranked = hazards(ends).withColumn("m", F.count("*").over(own)).withColumn("i", F.row_number().over(own.orderBy("p", "at")))
    passed = ranked.withColumn("ok", F.col("p") <= F.lit(FDR) * F.col("i") / F.col("m")).withColumn(
        "cut", F.max(F.when(F.col("ok"), F.col("i"))).over(own)
    )
    return passed.where(F.col("i") <= F.col("cut")).select("source", "kind", "at", "events", "risk", "p")


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id, source, cut`` of each text that isn't null, empty or blank.

    Takes ``doc_id, text, source``; further columns are ignored.  A null source
    is a source of its own; an empty table gives an empty table; repeated rows
    are judged alike and each gives a row.
    """
    slim = docs.select("doc_id", "source", "text")
    ends = materialize(endings(slim).drop("text", "line"), "endings")
    sure = materialize(significant_lengths(ends), "lengths")

    def at(kind: str, column: Column) -> tuple[DataFrame, Column]:
        s = sure.where(F.col("kind") == kind).select(F.col("source").alias(f"s_{kind}"), F.col("at").alias(f"a_{kind}"))
        return s, F.col("source").eqNullSafe(F.col(f"s_{kind}")) & (column == F.col(f"a_{kind}"))

    open_ = ends.where(~F.col("ended"))
    for kind, column in (
        ("chars", F.col("n_all")), ("bytes", F.col("n_bytes")), ("core", F.col("n_core")),
        ("soft", F.floor(F.col("n_all") / SOFT)),
    ):
        side, on = at(kind, column)
        open_ = open_.join(side, on, "left").drop(f"s_{kind}")
    hard = F.col("a_chars").isNotNull() | F.col("a_bytes").isNotNull() | F.col("a_core").isNotNull()
    soft = F.col("a_soft").isNotNull()
    known = word_stops(slim.where("text is not null"), ends)
    open_ = open_.join(known, "last", "left")
    seen = F.col("uses") + F.col("finals")
    # A word that many texts end with is one; torn words differ from text to text.
    usual = F.greatest(F.lit(3.0), F.lit(USUAL) * F.lit(ends.where("entry").count()))
    halting = (
        F.when(F.col("last").rlike(r"^\p{Ll}$"), F.lit(True))
        .when((F.col("closing") >= usual) & (F.col("closing") * 2 >= F.col("finals")), F.lit(False))
        .when(seen < KNOWN, F.col("stops") < 2)
        .otherwise(F.col("stops") + F.col("finals") < seen * STOPS)
    )
    whole = F.col("link") | F.col("stamp") | F.col("closed") | (F.col("entry") & ~halting)
    cut = (
        hard | F.col("torn") | F.col("said_more")
        | F.when(F.col("dotted"), soft & ~F.col("entry")).otherwise(~whole)
    )
    return ends.where("ended").select("doc_id", "source", F.lit(False).alias("cut")).unionByName(
        open_.select("doc_id", "source", cut.alias("cut"))
    )


def cut_shares(judged: DataFrame) -> DataFrame:
    """``source, texts, cut_texts, share`` of each source."""
    return judged.groupBy("source").agg(
        F.count("*").alias("texts"), F.count_if("cut").alias("cut_texts")
    ).withColumn("share", F.col("cut_texts") / F.col("texts"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return judge(docs).where("cut").select("doc_id")


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return cut_shares(judge(table(spark, folder, "documents").select("doc_id", "source", "text")))
