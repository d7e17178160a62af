"""Stretches of words that repeat with a period, found on a grid with common-extension queries."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import begin, packed
from .suffix import _ragged

# A perfect difference set: for any two residues there is one shift that takes both into it.
CYCLE, COVER = 31, (1, 5, 11, 24, 25, 27)
LEAST, TIMES = 24, 3
TOGETHER = 1 << 18  # words of texts that are searched at once
PAIRS = 1 << 20  # pairs of places that are compared at once

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
FOUND = pa.struct([("n_words", pa.int64()), ("runs", RUN), ("collapsed", pa.binary())])


def _shifts() -> np.ndarray:
    """Least shift that takes residues ``i`` and ``i + d`` into the cover, by ``[i, d]``."""
    i, d, shift = np.ogrid[:CYCLE, :CYCLE, :CYCLE]
    inside = np.isin(np.arange(CYCLE), COVER)
    return (inside[(i + shift) % CYCLE] & inside[(i + d + shift) % CYCLE]).argmax(axis=2)


SHIFT = _shifts()
SLOT = np.searchsorted(COVER, np.arange(CYCLE))


class Extensions:
    """How far two places of a text go on alike.

    Only suffixes at places whose residue is in the cover are sorted: first by ``CYCLE`` words,
    then by doubling, where those still alike are ranked by what follows. The common prefixes of
    neighbours in that order lie in a sparse table. Two places are compared word by word until
    both are in the cover; from there the least common prefix between their ranks is the answer.
    """

    def __init__(self, text: np.ndarray):
        """``text`` holds whole numbers of at least 0; its last one must occur once."""
        n = len(text)
        self.text = np.append(text, np.zeros(CYCLE, np.int64))
        base = np.arange(0, n, CYCLE)[:, None] + np.array(COVER)
        self.n = base.size
        places = base.ravel()
        self.live = places < n
        bits = max(1, int(text.max()).bit_length())
        step = max(1, 62 // bits)
        order = np.flatnonzero(self.live)
        rank = np.full(self.n, -1, np.int64)
        at = np.arange(len(order))
        for low in range(0, CYCLE, step):
            key = np.zeros(len(at), np.int64)
            for j in range(low, min(low + step, CYCLE)):
                key = (key << bits) | self.text[places[order[at]] + j]
            at = self._refine(order, rank, at, key, first=low == 0)
        levels, ahead = [rank.copy()], len(COVER)
        while len(at):
            at = self._refine(order, rank, at, rank[order[at] + ahead], first=False)
            levels.append(rank.copy())
            ahead *= 2
        self.rank = rank
        self._tabulate(order, places, levels)

    @staticmethod
    def _refine(order, rank, at, key, first):
        """Sort the suffixes at ``at`` of the order by key within equal ranks; returns those still alike."""
        if not len(at):
            return at
        own = np.zeros(len(at), np.int64) if first else rank[order[at]]
        sort = np.argsort(key, kind="stable") if first else np.lexsort((key, own))
        order[at], key, own = order[at][sort], key[sort], own[sort]
        heads = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
        sizes = np.diff(np.flatnonzero(heads), append=len(at))
        rank[order[at]] = np.repeat(at[heads], sizes)
        return at[np.repeat(sizes > 1, sizes)]

    def _tabulate(self, order, places, levels):
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels))):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            common[same] += CYCLE << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        x, y, at = places[order[:-1]] + common, places[order[1:]] + common, np.arange(len(a))
        while len(at):
            at = at[self.text[x[at]] == self.text[y[at]]]
            common[at] += 1
            x[at] += 1
            y[at] += 1
        self.table = [common.astype(np.int32)]
        while 2 << len(self.table) - 1 <= len(common):
            row, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(row[: len(row) - half], row[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from ``i`` and from ``j`` on, where ``i < j``."""
        shift = SHIFT[i % CYCLE, (j - i) % CYCLE]
        out, at, step = np.zeros(len(i), np.int64), np.arange(len(i)), 0
        reached = []
        while len(at):
            there = shift[at] == step
            reached.append(at[there])
            at = at[~there]
            at = at[self.text[i[at] + step] == self.text[j[at] + step]]
            step += 1
            out[at] = step
        at = np.concatenate(reached) if reached else at
        x, y = i[at] + shift[at], j[at] + shift[at]
        x = self.rank[x // CYCLE * len(COVER) + SLOT[x % CYCLE]]
        y = self.rank[y // CYCLE * len(COVER) + SLOT[y % CYCLE]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            some = level == k
            row, l, h = self.table[k], low[some], high[some] - (1 << int(k))
            out[at[some]] += np.minimum(row[l], row[h])
        return out


def _grid(starts: np.ndarray, sizes: np.ndarray, least: int, times: int):
    """Chunks of ``(text, first word, place, period, needed)``: places of each text at the
    multiples of each period, from where ``needed`` equal words make a long enough stretch."""
    of = np.flatnonzero(sizes >= least)
    q, of = _ragged(np.ones(len(of), np.int64), sizes[of] // times)[0], np.repeat(of, sizes[of] // times)
    need = np.maximum(least, times * q) - 2 * q + 1
    counts = np.maximum((sizes[of] - q - need) // q + 1, 0)
    upto = np.cumsum(counts)
    low = 0
    while low < len(q):
        # At least one period at a time, else as many as stay within the bound.
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + PAIRS, "right")))
        k, row = _ragged(np.zeros(high - low, np.int64), counts[low:high])
        row += low
        yield of[row], starts[of[row]], starts[of[row]] + k * q[row], q[row], need[row]
        low = high


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES):
    """Text, start, length and period of all runs of several texts, whose words are numbers that
    follow each other in ``words``. A run has at least ``least`` words and ``times`` (2 or more) periods.

    A run with period q holds a multiple of q within its first q words. From there the common
    extension with the place q words on leads to its end; its start is found by halving, as all
    places of the run reach the same end. A run found with several periods has the least: by the
    periodicity lemma the least one divides the others.
    """
    n = len(sizes)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.insert(words + n, np.cumsum(sizes), np.arange(n))  # every text ends with a number of its own
    none = np.empty(0, np.int64)
    if not len(text) or sizes.max() < least:
        return none, none, none, none
    lce = Extensions(text)
    parts = [(none, none, none, none)]
    for of, first, i, q, need in _grid(starts, sizes, least, times):
        # Single words settle most pairs: the first needed one, the last, and one between.
        for part in (0, 2, 1):
            step = (need - 1) * part // 2
            of, first, i, q, need = _chosen(text[i + step] == text[i + q + step], of, first, i, q, need)
        end = lce.common(i, i + q) + i
        of, first, i, q, end = _chosen(end - i >= need, of, first, i, q, end)

        def reaches(at, some):
            return at + lce.common(at, at + q[some]) == end[some]

        # A run that holds the place before on the grid is found from there.
        later = np.flatnonzero(i - q >= first)
        later = later[reaches(i[later] - q[later], later)]
        keep = np.ones(len(i), bool)
        keep[later] = False
        of, first, i, q, end = _chosen(keep, of, first, i, q, end)
        low, high = np.maximum(first, i - q + 1), i.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            held = reaches(middle, open_)
            high[open_[held]] = middle[held]
            low[open_[~held]] = middle[~held] + 1
            open_ = open_[low[open_] < high[open_]]
        length = end + q - high
        parts.append(_chosen(length >= np.maximum(least, times * q), of, high - first, length, q))
    of, start, length, q = (np.concatenate(x) for x in zip(*parts))
    sort = np.lexsort((q, length, start, of))
    of, start, length, q = (x[sort] for x in (of, start, length, q))
    new = np.append(True, (of[1:] != of[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(of)]
    of, start, length, q = _chosen(new, of, start, length, q)
    sort = np.lexsort((q, start, of))
    return tuple(x[sort] for x in (of, start, length, q))


def _chosen(some: np.ndarray, *columns: np.ndarray):
    return tuple(c[some] for c in columns)


def _collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """Words that no run holds after its first period, with single blanks."""
    if len(start):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, start + length, -1)
        words = compress(words, (np.cumsum(depth[:-1]) == 0).tolist())
    return b" ".join(words)


def _solved(texts: list[list[bytes]], least: int, times: int) -> list[dict]:
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
    of, *runs = find_runs(flat.indices.to_numpy().astype(np.int64), sizes, least, times)
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    rows = []
    for k, words in enumerate(texts):
        own = [x[cuts[k] : cuts[k + 1]] for x in runs]
        found = [dict(zip(("start", "length", "period"), r)) for r in zip(*(x.tolist() for x in own))]
        rows.append({"n_words": len(words), "runs": found, "collapsed": _collapsed(words, *own)})
    return rows


def _search(least: int, times: int):
    def search(texts: pa.Array) -> pa.Array:
        rows, held, size = [], [], 0
        for text in texts:
            held.append((text.as_py() or b"").split())  # bytes are split at the six blanks of ASCII
            size += len(held[-1])
            if size >= TOGETHER:
                rows += _solved(held, least, times)
                held, size = [], 0
        return pa.array(rows + _solved(held, least, times), FOUND)

    return search


def periodic_runs(docs: DataFrame, text: str = "text", *, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Runs of the words of each text, and the text without their repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with least period q, of at
    least ``least`` words and ``times`` (2 or more) periods, that no neighbouring word extends keeping q.
    Returns ``doc`` (the input row), ``n_words``, ``runs`` (array of ``start``, ``length``, ``period``, by
    start, then period) and ``collapsed``: the words that no run holds after its first q words,
    joined by one blank.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Each row is
    handled by itself, where it lies: repeated rows give equal results, ids play no part, an empty
    table gives no rows. Memory grows with the longest text, by about 200 bytes a word.
    """
    begin(docs.sparkSession)
    shape = f"n_words long, runs {RUNS}, collapsed binary"
    search = F.arrow_udf(_search(least, times), shape)
    return (
        packed(docs)
        .withColumn("_got", search(F.col(f"doc.{text}").cast("binary")))
        .select("doc", "_got.n_words", "_got.runs", F.col("_got.collapsed").cast("string").alias("collapsed"))
    )
