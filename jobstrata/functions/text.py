"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, with no-break and zero-width characters.
BLANKS = r"[\s\u00a0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"


def strip(c: Column) -> Column:
    """Remove Unicode white space from both ends (Spark's ``trim`` only removes spaces)."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


#: The same characters as :data:`BLANKS`, one by one.
BLANK_CHARS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)))


def strip_wide(c: Column) -> Column:
    """As :func:`strip`, also removing zero-width characters at the ends."""
    return F.btrim(c, F.lit(BLANK_CHARS))


def filled(c: Column) -> Column:
    """True where the value is neither null nor the empty string."""
    return F.coalesce(c != "", F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def norm_id(c: Column) -> Column:
    """Record id without letter case, outer white space and enclosing braces; null if blank."""
    return F.nullif(F.lower(F.btrim(c, F.lit(BLANK_CHARS + "{}"))), F.lit(""))


def norm_sha(c: Column) -> Column:
    """Commit name in lower case without white space; null if blank."""
    return F.nullif(F.lower(F.regexp_replace(c, f"{BLANKS}+", "")), F.lit(""))


def instant(c: Column) -> Column:
    """Timestamp of an ISO-like date text in any zone, or of epoch seconds.

    Texts without a zone count as UTC; null where nothing can be read.
    """
    s = strip_wide(c)
    zoned = s.rlike(r"(?i)(z|utc|gmt|[+-]\d\d:?\d\d)$")
    stamped = F.when(zoned | ~s.rlike(r"\d:\d\d"), s).otherwise(F.concat(s, F.lit("Z")))
    return F.when(
        s.rlike(r"^\d{9,10}$"), F.timestamp_seconds(s.try_cast("long"))
    ).otherwise(stamped.try_cast("timestamp"))


def sql_literal(c: Column) -> Column:
    """SQL text of a value: NULL, or single-quoted with quotes doubled."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("NULL")).otherwise(
        F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("''")), F.lit("'"))
    )
