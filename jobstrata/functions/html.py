"""Visible text of HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose content isn't shown.
HIDDEN = ("script", "style", "head", "noscript", "iframe", "nav", "footer")


class _Shown(HTMLParser):
    """Collects the text chunks that stand outside every hidden element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.level = 0
        self.chunks: list[str] = []

    def handle_starttag(self, tag, attrs) -> None:
        self.level += tag in HIDDEN

    def handle_endtag(self, tag) -> None:
        if tag in HIDDEN and self.level:
            self.level -= 1

    def handle_data(self, data) -> None:
        if self.level == 0 and (chunk := data.strip()):
            self.chunks.append(chunk)


def visible(markup: str | None) -> str:
    """Shown text, one chunk a line.

    Hidden elements nest; a stray end tag does nothing; what follows an
    unclosed hidden element stays hidden.  Null, and markup the parser refuses,
    give the empty text.
    """
    if not markup:
        return ""
    page = _Shown()
    try:
        page.feed(markup)
    except (AssertionError, ValueError):
        return ""
    return "\n".join(page.chunks)


@F.pandas_udf(T.StringType())
def visible_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Column form of :func:`visible`, in Arrow batches."""
    for markup in batches:
        yield markup.map(visible)
