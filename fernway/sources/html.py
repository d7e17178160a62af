"""Text of web pages and markdown files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Tag names.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td th thead "
    "tr ul".split()
)
HIDDEN_TAGS = frozenset("head script style template noscript".split())
HEADINGS = {f"h{i}": i for i in range(1, 7)}


class _Blocks(HTMLParser):
    """Collects visible text per block; ``blocks`` holds (heading level or 0, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str]] = []
        self._text: list[str] = []
        self._level = 0
        self._open: list[str] = []

    def _end_block(self) -> None:
        text = re.sub(r"[ \t\n\r\f]+", " ", "".join(self._text)).strip(" ")
        if text:
            self.blocks.append((self._level, text))
        self._text.clear()

    def handle_starttag(self, tag, attrs):
        # The end tag of a head may be left out; the body ends it, and so does a block.
        if tag == "body" or tag in BLOCK_TAGS and self._open == ["head"]:
            self._open.clear()
        if tag in HIDDEN_TAGS:
            self._open.append(tag)
        if tag in BLOCK_TAGS:
            self._end_block()
            self._level = HEADINGS.get(tag, 0)

    def handle_endtag(self, tag):
        if tag in self._open:
            del self._open[self._open.index(tag) :]
        if tag in BLOCK_TAGS:
            self._end_block()
            self._level = 0

    def handle_data(self, data):
        if not self._open:
            self._text.append(data)


def html_blocks(page: str) -> list[tuple[int, str]]:
    reader = _Blocks()
    # A page cut off inside a tag loses that tag, nothing else.
    reader.feed(re.sub(r"<[A-Za-z/!][^<>]*$", "", page))
    reader.close()
    reader._end_block()
    return reader.blocks


def markdown_blocks(text: str) -> list[tuple[int, str]]:
    blocks: list[tuple[int, str]] = []
    for part in re.split(r"\n\s*\n|(?=^#{1,6} )|(?<=\n)(?=#{1,6} )", text, flags=re.M):
        heading, _, rest = part.strip().partition("\n")
        marks = re.match(r"(#{1,6}) +(.*)", heading)
        if marks:
            blocks.append((len(marks[1]), marks[2].strip()))
            heading, rest = rest.strip(), ""
        body = "\n".join(x for x in (heading, rest) if x)
        if body:
            blocks.append((0, body))
    return blocks


def blocks_of(text: str, kind: str) -> list[tuple[int, str]]:
    return html_blocks(text) if kind == "html" else markdown_blocks(text)


def html_to_text(page: Column) -> Column:
    """Visible text of a web page, one line per block."""

    @F.pandas_udf("string")
    def visible(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(
                lambda page: "\n".join(t for _, t in html_blocks(page)), na_action="ignore"
            )

    return visible(page)


def read_pages(pages: DataFrame, key: str, markup: str) -> DataFrame:
    return pages.select(key, html_to_text(F.col(markup)).alias("text"))
