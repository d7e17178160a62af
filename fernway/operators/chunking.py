"""Cutting documents into chunks."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..sources.html import blocks_of

SIZE = 600
OVERLAP = 50
# Split points, coarse to fine.
SEPARATORS = ("\n\n", "\n", " ", "")


def window_spans(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Fixed windows of ``size`` characters, each starting ``size - overlap`` further on."""
    step = size - overlap
    # Look ahead for a whole window, then move on by a step. What is no longer than the
    # overlap was in the window before. One pass, so long texts cost no more per character.
    windows = rf"(?s)(?=(.{{{overlap + 1},{size}}})).{{1,{step}}}"
    return F.when(F.length(text) <= overlap, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(windows), F.lit(1))
    )


def window_chunk(docs: DataFrame, key: str, text: str, **limits: int) -> DataFrame:
    """One row per window; ``chunk_index`` runs from 0 in each document. No Python, no shuffle."""
    # An inner explode would make Spark run the expression once more, to test its size.
    spans = F.posexplode_outer(window_spans(F.col(text), **limits))
    return docs.select(key, spans.alias("chunk_index", "content")).where("content IS NOT NULL")


def chunk_id(document: Column, index: Column) -> Column:
    return F.concat(document.cast("string"), F.lit("_Chunk_"), index.cast("string"))


def chunk_key(document: Column, index: Column) -> Column:
    """A stable 64-bit id, equal on every run, where the table would assign one."""
    return F.xxhash64(document, index)


def _pack(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join neighbouring parts up to ``size``; the next chunk repeats up to ``overlap``."""
    held: deque[str] = deque()
    width = 0
    for part in parts:
        if held and width + len(part) > size:
            yield "".join(held)
            while held and (width > overlap or width + len(part) > size):
                width -= len(held.popleft())
        held.append(part)
        width += len(part)
    if held:
        yield "".join(held)


def _pieces(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> Iterator[str]:
    at = next((i for i, s in enumerate(separators) if s and s in text), None)
    if at is None:
        parts, finer = list(text), ()
    else:
        # A separator stays at the head of the part it opens.
        starts = [m.start() for m in re.finditer(re.escape(separators[at]), text)]
        edges = [0, *[s for s in starts if s], len(text)]
        parts = [text[a:b] for a, b in zip(edges, edges[1:]) if b > a]
        finer = separators[at + 1 :]
    run: list[str] = []
    for part in parts:
        if len(part) < size or at is None:
            run.append(part)
            continue
        yield from _pack(run, size, overlap)
        run = []
        yield from _pieces(part, size, overlap, finer)
    yield from _pack(run, size, overlap)


def split_recursive(text: str, size: int = SIZE, overlap: int = OVERLAP) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that serves."""
    stripped = (p.strip() for p in _pieces(text, size, overlap, SEPARATORS))
    return [p for p in stripped if p]


def recursive_chunk(
    docs: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP
) -> DataFrame:
    """Paragraph, line, word and character splitting; NULL or blank text gives no row."""

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: [] if t is None else split_recursive(t, size, overlap))

    chunked = docs.select(key, split(F.col(text)).alias("chunks"))
    return chunked.select(key, F.posexplode("chunks").alias("chunk_index", "content"))


def block_lines(markup: str, kind: str, size: int) -> list[tuple[int, str]]:
    """Blocks as ``(heading level or 0, text)``; a body block of ``size`` characters or more is
    several, cut at lines and words."""
    out = []
    for level, text in blocks_of(markup, kind):
        cut = level == 0 and len(text) >= size
        out.extend((level, part) for part in (split_recursive(text, size - 1, 0) if cut else [text]))
    return out


def _sections(blocks: Column, size: int) -> Column:
    """``(heading trail, body)`` of each chunk, in one scan of the blocks.

    The trail holds the last heading of each level that no heading of a lower or equal level followed. Bodies are
    added to the open chunk until the next would pass ``size``; a heading closes it.
    """
    heading_type = "struct<level:int,text:string>"
    trail_type, done_type = f"array<{heading_type}>", "array<struct<heading:string,body:string>>"
    state_type = f"struct<trail:{trail_type},open:string,done:{done_type}>"

    def state(trail: Column, open_: Column, done: Column) -> Column:
        return F.struct(trail.alias("trail"), open_.alias("open"), done.alias("done")).cast(state_type)

    def closed(now: Column) -> Column:
        heading = F.array_join(F.transform(now["trail"], lambda h: h["text"]), "\n")
        chunk = F.array(F.struct(heading.alias("heading"), strip(now["open"]).alias("body")))
        return F.when(now["open"] == "", now["done"]).otherwise(F.concat(now["done"], chunk))

    def step(now: Column, block: Column) -> Column:
        line = F.concat(block["text"], F.lit("\n"))
        above = F.filter(now["trail"], lambda h: h["level"] < block["level"])
        headed = state(F.concat(above, F.array(block.cast(heading_type))), F.lit(""), closed(now))
        full = F.char_length(now["open"]) + F.char_length(line) > size
        begun = state(now["trail"], line, closed(now))
        longer = state(now["trail"], F.concat(now["open"], line), now["done"])
        return F.when(block["level"] > 0, headed).when(full, begun).otherwise(longer)

    start = state(F.array().cast(trail_type), F.lit(""), F.array().cast(done_type))
    return F.aggregate(blocks, start, step, closed)


def structural_chunk(
    pages: DataFrame, key: str, markup: str, size: int = SIZE, kind: str = "html"
) -> DataFrame:
    """Chunks cut at headings, with the heading trail in front of the text.

    ``kind`` is ``html`` or ``markdown``. Blocks under one heading are packed up to
    ``size`` characters; a longer block is cut at lines and words. No text is dropped. Python only
    finds the blocks; trails and packing are expressions of one row, so nothing is exchanged. NULL, or a
    page without a body, gives no row.
    """

    @F.pandas_udf("array<struct<level:int,text:string>>")
    def blocks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(
                lambda t: []
                if t is None
                else [{"level": v, "text": x} for v, x in block_lines(t, kind, size)]
            )

    found = pages.select(key, blocks(F.col(markup)).alias("blocks"))
    # Outer, since an inner explode would make Spark run the scan once more to test its size.
    chunks = F.posexplode_outer(_sections(F.col("blocks"), size)).alias("chunk_index", "s")
    return found.select(key, chunks).where("s IS NOT NULL").select(
        key,
        "chunk_index",
        F.col("s.heading").alias("heading"),
        F.concat_ws("\n", F.nullif(F.col("s.heading"), F.lit("")), "s.body").alias("content"),
    )


def union_documents(*chunk_tables: DataFrame) -> DataFrame:
    """Chunk tables of several document sets as one table."""
    out = chunk_tables[0]
    for table in chunk_tables[1:]:
        out = out.unionByName(table)
    return out


def synthetic_questions(chunks: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """One question per document, about a chunk picked by hash; one aggregate, no sort."""
    order = F.md5(F.concat_ws("-", F.col(key), "chunk_index", F.lit(seed)))
    picked = chunks.groupBy(key).agg(
        F.min_by(F.struct("chunk_index", "content"), F.struct(order, "chunk_index")).alias("p")
    )
    return picked.select(
        key,
        F.col("p.chunk_index").alias("chunk_index"),
        F.concat(F.lit("What does this passage say? "), "p.content").alias("question"),
    )
