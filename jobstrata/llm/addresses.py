"""Addresses: where a URL leads, whatever its spelling, and which posting it names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.functions.text import strip_wide

#: How often a redirect or percent-encoding may be nested.
DEPTH = 3

_TARGET = r"(?i)^(?:https?:)?//[^/?#]+/[^?#]*\?(?:[^#]*&)?[^=&#]+=((?:https?(?:%3a|:))?(?:%2f|/){2}[^&#]+)"
_TRACKING = r"(?:^|&)(?:utm_\w+|gh_src|fbid|fbclid|gclid|trk|ref|src|source|lang|locale|page|c|mc_\w+|sessionid)=[^&]*"
_LOCALE = r"/[a-z]{2}(?:-[a-z]{2})?(?=/)"


def _decoded(c: Column) -> Column:
    """Percent-decoded text; unchanged where the escapes are broken."""
    kept = F.replace(c, F.lit("+"), F.lit("%2B"))
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(kept), c)).otherwise(c)


def landed(df: DataFrame, url: str, out: str = "_u") -> DataFrame:
    """Add the address a URL leads to: redirects that carry their target are followed, escapes undone.

    Step by step in columns of their own: one nested expression would repeat
    each step several times over.
    """
    df = df.withColumn(out, F.coalesce(strip_wide(F.col(url)), F.lit("")))
    for _ in range(DEPTH):
        carries = F.lower(F.substring_index(out, "?", -1)).rlike("=(?:http|%2f|/)") & F.col(out).contains("?")
        df = df.withColumn("_target", F.when(carries, F.regexp_extract(out, _TARGET, 1)).otherwise(""))
        df = df.withColumn(out, F.when(F.col("_target") != "", _decoded(F.col("_target"))).otherwise(F.col(out)))
    for _ in range(2):
        df = df.withColumn(out, _decoded(F.col(out)))
    return df.withColumn(out, F.lower(strip_wide(F.col(out)))).drop("_target")


def url_parts(df: DataFrame, url: str, prefix: str = "_") -> DataFrame:
    """Add ``host``, ``path`` and ``query`` of the landing address, each under ``prefix``.

    The host has no ``www.`` and no port; the path no parameters, no doubled or
    trailing slashes, no locale, and no closing ``/apply``; the query no
    tracking parameters.  Blank and unreadable URLs give empty parts.
    """
    df = landed(df, url, "_u")
    df = df.withColumn("_u", F.substring_index(F.regexp_replace("_u", r"^(?:https?:)?//", ""), "#", 1))
    host = F.regexp_extract("_u", r"^(?:www\.)?([^/?#:;]+)", 1)
    path = F.regexp_extract("_u", r"^[^/?]*([^?]*)", 1)
    df = df.withColumn("_p", F.when(path.contains(";"), F.regexp_replace(path, r";[^/?]*", "")).otherwise(path))
    df = df.withColumn("_p", F.when(F.col("_p").contains("//"), F.regexp_replace("_p", r"/{2,}", "/")).otherwise(F.col("_p")))
    df = df.withColumn("_p", F.rtrim(F.regexp_replace("_p", _LOCALE, ""), F.lit("/")))
    path = F.when(F.col("_p").endswith("/apply"), F.rtrim(F.expr("left(_p, length(_p) - 6)"), F.lit("/"))).otherwise(F.col("_p"))
    query = F.when(F.col("_u").contains("?"), F.regexp_replace(F.regexp_extract("_u", r"\?(.*)$", 1), _TRACKING, "")).otherwise("")
    return df.select(
        "*",
        host.alias(f"{prefix}host"), path.alias(f"{prefix}path"), F.btrim(query, F.lit("&?/")).alias(f"{prefix}query"),
    ).drop("_u", "_p")


def posting_key(host: Column, path: Column, query: Column) -> Column:
    """What a URL says about the posting: site, company and requisition; null where it names none.

    A requisition is a UUID, or a run of at least four digits with its letters.
    A query that names one counts before the path, and the words around a
    requisition at the end of a path (titles, places) don't count.  General
    pages of a careers site name none.
    """
    uuid = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    number = r"(?:req[-_]?|jr[-_]?|r[-_]|job[-_]?)?\d{4,}"
    asked = F.when(query != "", F.regexp_extract(query, rf"(?:^|&)[^=&]*=({uuid}|{number})(?=&|$)", 1)).otherwise("")
    named = F.when(path.contains("_"), F.regexp_extract(path, rf"_({number})$", 1)).otherwise("")
    closing = F.regexp_extract(path, rf"/(?:{uuid}|{number})(?:/[a-z]+)?$", 0)
    before = F.substring(path, F.lit(1), F.length(path) - F.length(closing))
    first = F.substring_index(F.ltrim(path, F.lit("/")), "/", 1)
    return (
        F.when(asked != "", F.concat_ws(" ", host, first, asked))
        .when(named != "", F.concat_ws(" ", host, named))
        .when(closing != "", F.concat_ws(" ", host, before, F.substring_index(F.ltrim(closing, F.lit("/")), "/", 1)))
    )
