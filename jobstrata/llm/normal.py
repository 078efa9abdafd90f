"""Text reduced to what counts when wording is compared, as JVM expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Letters with marks and their base letters, from the Unicode decompositions."""
    src, dst = [], []
    for start, end in ((0x00C0, 0x0250), (0x1E00, 0x1F00)):
        for cp in range(start, end):
            base = unicodedata.normalize("NFKD", chr(cp))[0]
            if base != chr(cp) and base.isascii() and base.isalpha():
                src.append(chr(cp).lower() if len(chr(cp).lower()) == 1 else chr(cp))
                dst.append(base.lower())
    return "".join(src), "".join(dst)


def _misread(encoding: str = "cp1252") -> list[tuple[str, str]]:
    """UTF-8 letters read in a Western code page, and the letters meant."""
    out = []
    for cp in range(0x00C0, 0x0100):
        try:
            out.append((chr(cp).encode().decode(encoding), chr(cp)))
        except UnicodeDecodeError:
            out.append((chr(cp).encode().decode("latin-1"), chr(cp)))
    return out


_SRC, _DST = _accent_table()


def repair_letters(c: Column) -> Column:
    """Undo the commonest wrong decoding of accented letters (only where it occurs)."""
    fixed = c
    for wrong, right in _misread():
        fixed = F.replace(fixed, F.lit(wrong), F.lit(right))
    return F.when(c.contains("Ã"), fixed).otherwise(c)


def _steps(c: Column, *steps) -> Column:
    """Apply steps one after the other, each to the value of the one before (bound once, however often a step names it)."""
    held = F.array(c)
    for step in steps:
        held = F.transform(held, step)
    return F.get(held, F.lit(0))


def _without_markup(t: Column) -> Column:
    marked = t.contains("<") | t.contains("&")
    return F.when(marked, F.regexp_replace(t, r"<[/!]?[a-zA-Z][^<>]*>|&#?\w{1,8};", " ")).otherwise(t)


def _without_accents(t: Column) -> Column:
    """Lower-case text without accents, combining marks and zero-width characters; ASCII texts have none."""
    bare = F.translate(F.regexp_replace(t, r"[\p{M}\u00ad\u200b-\u200f\u2060\ufeff]+", ""), _SRC, _DST)
    return F.when(F.octet_length(t) == F.length(t), t).otherwise(bare)


def plain_words(c: Column) -> Column:
    """Words of a text as an array, without case, accents, punctuation, spacing and markup.

    Every digit is a word of its own, so a number written ``57,500``, ``57500``
    or ``57 500`` gives the same words, and what stands beside it doesn't
    change them.  Null stays null; a text without letters and digits gives an
    empty array.
    """
    t = _steps(
        c, _without_markup, lambda x: F.when(x.contains("US$"), F.regexp_replace(x, r"\bUS\$", "\\$")).otherwise(x),
        lambda x: F.lower(repair_letters(x)), _without_accents, lambda x: F.translate(x, "'‘’ʼ´`", ""),
    )
    return F.regexp_extract_all(t, F.lit(r"[0-9]|[\p{L}\p{N}&&[^0-9]]+"), F.lit(0))
