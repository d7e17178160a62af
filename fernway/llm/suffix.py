"""Exact removal of long repeated byte strings by interval expansion on a BWT."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import lookup_join
from .common import begin, packed, saved, text_or_empty
from .near import scrambled

LENGTH = 400
PIECE = 1 << 19  # bytes of a text that are hashed at once
BATCH = 1 << 20  # bytes that share one BWT

_draw = np.random.default_rng(400)
_BYTE = _draw.integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_TOP = np.iinfo(np.uint64).max


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` neighbouring bytes, from differences of one running sum."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=sums[1:])
    return scrambled((sums[gram:] - sums[:-gram]) * _powers(pow(_BASE, -1, 2**64), n - gram + 1))


def sliding(values: np.ndarray, width: int, least=np.minimum, pad=_TOP) -> np.ndarray:
    """Least (or greatest) of every ``width`` neighbours, in three passes at any width."""
    n = len(values)
    table = np.full(-(-n // width) * width, pad, values.dtype)
    table[:n] = values
    table = table.reshape(-1, width)
    ahead = least.accumulate(table, axis=1).ravel()
    behind = least.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return least(behind[: n - width + 1], ahead[width - 1 : n])


def runs_of(data: np.ndarray, length: int):
    """Runs of windows with one minimiser: first window, number of windows, minimiser, and
    whether the minimiser occurs in the run more than once.

    The minimiser of a window is the least hash of its grams of half its length, so equal
    windows have equal ones, wherever they are.
    """
    gram = length // 2
    width = length - gram + 1
    parts = []
    for low in range(0, len(data) - length + 1, PIECE):
        piece = data[low : low + PIECE + length - 1]
        grams = gram_hashes(piece, gram)
        least = sliding(grams, width)
        starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        counts = np.diff(starts, append=len(least))
        mins = least[starts]
        # Grams that are the least of some window.
        edge = np.zeros(width - 1, np.uint64)
        most = sliding(np.concatenate([edge, least, edge]), width, np.maximum, np.uint64(0))
        chosen = np.flatnonzero(most == grams)
        at = np.searchsorted(chosen, starts)
        upto = np.searchsorted(chosen, starts + counts - 1 + width)
        found = np.zeros(len(starts), np.int64)
        live = np.flatnonzero(at < upto)
        while len(live):
            found[live] += grams[chosen[at[live]]] == mins[live]
            at[live] += 1
            live = live[(at[live] < upto[live]) & (found[live] < 2)]
        parts.append((starts + low, counts, mins.view(np.int64), found > 1))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*parts))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a text of numbers whose ends are all different, by prefix doubling."""
    n = len(text)
    # As many first letters as fit one number are sorted at once.
    bits = int(text.max()).bit_length() + 1
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(step):
        key <<= bits
        key[: n - j] |= text[j:] + 1
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    live = np.arange(n)
    key = key[order]
    while True:
        # The rank of a suffix is the first place of those not yet told apart from it.
        heads = np.append(True, key[1:] != key[:-1])
        sizes = np.diff(np.flatnonzero(heads), append=len(live))
        rank[order[live]] = np.repeat(live[heads], sizes)
        live = live[np.repeat(sizes > 1, sizes)]
        if not len(live):
            return order
        # Only these are sorted further, within their places.
        at = order[live]
        after = at + step
        key = rank[at] * (n + 1)
        inside = after < n
        key[inside] += rank[after[inside]] + 1
        sort = np.argsort(key)
        order[live], key = at[sort], key[sort]
        step *= 2


def _ragged(starts: np.ndarray, sizes: np.ndarray):
    """All positions of the ranges, and the number of each one's range."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of], of


def common_prefixes(order: np.ndarray, text: np.ndarray, n_ends: int, length: int) -> np.ndarray:
    """For each place in the suffix order whether its suffix shares ``length`` with the one before.

    Breadth-first: every interval of suffixes with a common prefix is extended backwards by
    each letter that stands before one of them in the transform. Where an interval
    begins that isn't yet known as a border, the common prefix with its predecessor has the
    present length. So borders are found by increasing value, each one once; those not found
    before ``length`` share at least that much.
    """
    n = len(text)
    before = text[order - 1]  # the transform; ends are letters of their own, below n_ends
    # Where the suffix one letter longer stands.
    jump = np.empty(n, np.int64)
    small = before.astype(np.uint16) if before.max() < 1 << 16 else before
    jump[np.argsort(small, kind="stable")] = np.arange(n)
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    first = text[order]
    border[np.flatnonzero(first[1:] != first[:-1]) + 1] = True
    fresh = np.flatnonzero(border[:-1])
    sizes = np.diff(fresh, append=n)
    for _ in range(1, length):
        if not len(fresh):
            break
        at, of = _ragged(fresh, sizes)
        # The suffixes of an interval with one letter before them are an interval of the next
        # length, which begins at the first of them.
        letters = before[at]
        live = letters >= n_ends
        at, key = at[live], of[live] * 512 + (letters[live] - n_ends)
        _, where, sizes = np.unique(key, return_index=True, return_counts=True)
        fresh = jump[at[where]]
        new = ~border[fresh]
        fresh, sizes = fresh[new], sizes[new]
        border[fresh] = True
    return ~border[:-1]


def repeated_windows(contents: list[bytes], length: int) -> list[np.ndarray]:
    """First bytes of the windows of each content that occur again in these contents."""
    sizes = np.array([len(c) for c in contents])
    n = len(contents)
    # Each content ends with a letter of its own, below all bytes.
    text = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8).astype(np.int64) + n
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = np.arange(n)
    order = suffix_order(text)
    shares = common_prefixes(order, text, n, length)
    again = shares.copy()
    again[:-1] |= shares[1:]
    starts = np.sort(order[again])
    cuts = np.searchsorted(starts, np.append(0, ends + 1))
    base = np.append(0, ends + 1)
    return [starts[cuts[i] : cuts[i + 1]] - base[i] for i in range(n)]


def _as_ranges(starts: np.ndarray):
    """Runs of neighbouring numbers as first and last."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, -1)].tolist()))


RUNS = "k1 long, k2 long, many boolean, start long, n long, m long, c long, self boolean"
TEXTS = "k1 long, k2 long, many boolean, m long, start long, content binary"
WINDOWS = "k1 long, k2 long, many boolean, at long, w binary"
SPANS = "k1 long, k2 long, low long, high long"


def _short(content: bytes) -> int:
    return int.from_bytes(blake2b(content, digest_size=8).digest(), "little", signed=True)


def _emit_runs(length):
    def emit(batches):
        for batch in batches:
            out = []
            for k1, k2, many, text in zip(*(batch[c] for c in ("k1", "k2", "many", "text"))):
                data = text.encode()
                start, n, m, again = runs_of(np.frombuffer(data, np.uint8), length)
                ends = (start + n + length - 1).tolist()
                c = np.array([_short(data[i:j]) for i, j in zip(start.tolist(), ends)], np.int64)
                frame = {"k1": k1, "k2": k2, "many": many, "start": start, "n": n, "m": m, "c": c}
                out.append(pd.DataFrame(frame | {"self": again}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return emit


def _emit_contents(length):
    def emit(batches):
        for batch in batches:
            rows = []
            for k1, k2, many, text, runs in zip(
                *(batch[c] for c in ("k1", "k2", "many", "text", "runs"))
            ):
                data = text.encode()
                for r in runs:
                    s = r["start"]
                    rows.append((k1, k2, many, r["m"], s, data[s : s + r["n"] + length - 1]))
            yield pd.DataFrame(rows, columns=["k1", "k2", "many", "m", "start", "content"])

    return emit


def _emit_windows(length):
    """Every window of the runs by a 128-bit digest."""

    def emit(batches):
        for batch in batches:
            for k1, k2, many, text, runs in zip(
                *(batch[c] for c in ("k1", "k2", "many", "text", "runs"))
            ):
                data = text.encode()
                for r in runs:
                    at = range(r["start"], r["start"] + r["n"])
                    w = [blake2b(data[i : i + length], digest_size=16).digest() for i in at]
                    yield pd.DataFrame({"k1": k1, "k2": k2, "many": many, "at": at, "w": w})

    return emit


def _emit_spans(length, batch_bytes):
    """Rows come in the order of their minimiser, each content once; minimisers share a BWT up to
    ``batch_bytes``."""

    def solve(rows):
        spans = []
        found = repeated_windows([content for *_, content in rows], length)
        for (k1, k2, many, start, _), starts in zip(rows, found):
            if not many:
                spans += [(k1, k2, start + a, start + b + length) for a, b in _as_ranges(starts)]
        return pd.DataFrame(spans, columns=["k1", "k2", "low", "high"])

    def emit(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch[c] for c in ("k1", "k2", "many", "start", "m", "content"))):
                *place, m, content = row
                if m != last and held > batch_bytes:
                    yield solve(rows)
                    rows, held = [], 0
                last = m
                held += len(content)
                rows.append((*place, content))
        if rows:
            yield solve(rows)

    return emit


def _cut(text: str | None, whole: bool, spans, length: int):
    """Bytes, removed bytes, spans and the rest of one text."""
    data = (text or "").encode()
    if whole and len(data) >= length:
        return len(data), len(data), 1, b""
    merged: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in (() if spans is None else spans)):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    kept, at = [], 0
    for low, high in merged:
        kept.append(data[at:low])
        at = high
    kept.append(data[at:])
    rest = b"".join(kept)
    return len(data), len(data) - len(rest), len(merged), rest


def remove_repeats(
    docs: DataFrame, text: str = "text", *, length: int = LENGTH, batch_bytes: int = BATCH
) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts anywhere else.

    Returns ``doc`` (the input row), ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept`` (binary).

    Rows with equal texts are one text, known by two 64-bit hashes, that is repeated as a whole if
    long enough. The windows of every distinct text are cut into runs with one minimiser; a
    minimiser that occurs once in all texts can't be that of a repeated window. Runs of the others
    with one content are repeated as a whole, and one of them is kept. Different contents meet by
    minimiser, and the common prefixes of their suffixes are derived on a Burrows-Wheeler
    transform by breadth-first backward extension up to ``length``. Equal windows have equal
    minimisers. Where the contents of a minimiser exceed ``batch_bytes``, their windows are counted
    by digest instead, in as many tasks as there are, so no transform exceeds twice that much.
    The result is exact but for hash collisions: 64 bits for equal texts, 64 bits beside minimiser
    and length for equal runs, 128 bits for counted windows.

    Null is empty. Texts shorter than ``length`` stay as they are. Ids play no part.
    """
    begin(docs.sparkSession)
    value = text_or_empty(F.col(f"doc.{text}"))
    rows = packed(docs).select(
        "doc",
        value.alias("text"),
        F.xxhash64(value).alias("k1"),
        F.xxhash64(F.lit(1), value).alias("k2"),
    )
    texts = rows.where(F.octet_length("text") >= length).select("k1", "k2", "text")
    copies = saved(
        texts.groupBy("k1", "k2").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"),
        "suffix-copies",
    )
    once = lookup_join(texts, copies, ["k1", "k2"], "left_anti").withColumn("many", F.lit(False))
    often = lookup_join(texts, copies, ["k1", "k2"], "left_semi").withColumn("many", F.lit(True))
    distinct = once.union(often.dropDuplicates(["k1", "k2"]))
    runs = saved(distinct.mapInPandas(_emit_runs(length), RUNS), "suffix-runs")
    shared = saved(
        runs.groupBy("m")
        .agg(F.count("*").alias("_n"), F.max(F.col("self").cast("int")).alias("_self"))
        .where("_n > 1 OR _self = 1")
        .select("m"),
        "suffix-shared",
    )
    # One kind of join at every size; hot keys are split. What follows is far smaller than all runs.
    runs = saved(runs.join(shared.hint("merge"), ["m"], "left_semi"), "suffix-met")
    alike = saved(
        runs.groupBy("m", "n", "c")
        .agg(
            F.count("*").alias("_n"),
            F.max(F.col("self").cast("int")).alias("_self"),
            F.min(F.struct("k1", "k2", "start")).alias("_at"),
        ),
        "suffix-alike",
    )
    # Runs of one content are covered as a whole, wherever they are.
    whole = lookup_join(
        runs, saved(alike.where("_n > 1").select("m", "n", "c"), "suffix-often"), ["m", "n", "c"], "left_semi"
    ).where("NOT many").select(
        "k1", "k2", F.col("start").alias("low"), (F.col("start") + F.col("n") + length - 1).alias("high")
    )
    size = F.sum(F.col("n") + length - 1)
    groups = saved(
        alike.groupBy("m")
        .agg(F.count("*").alias("_d"), (size > batch_bytes).alias("hot"), F.max("_self").alias("_any"))
        .where("_d > 1 OR _any = 1")
        .select("m", "_d", "hot"),
        "suffix-groups",
    )
    asked = (
        lookup_join(alike, groups, ["m"], "inner")
        .where("_d > 1 OR _n = 1")
        .groupBy(F.col("_at.k1").alias("k1"), F.col("_at.k2").alias("k2"), "hot")
        .agg(F.collect_list(F.struct("_at.start", "n", "m")).alias("runs"))
    )
    asked = saved(asked, "suffix-asked")
    contents = lookup_join(distinct, asked.where("NOT hot").drop("hot"), ["k1", "k2"], "inner")
    found = (
        contents.mapInPandas(_emit_contents(length), TEXTS)
        .repartition("m")
        .sortWithinPartitions("m")
        .mapInPandas(_emit_spans(length, batch_bytes), SPANS)
        .union(whole)
    )
    hot = asked.where("hot").drop("hot")
    if not hot.isEmpty():
        windows = lookup_join(distinct, hot, ["k1", "k2"], "inner").mapInPandas(
            _emit_windows(length), WINDOWS
        )
        windows = saved(windows, "suffix-windows")
        again = saved(
            windows.groupBy("w").agg(F.count("*").alias("_n")).where("_n > 1").select("w"),
            "suffix-again",
        )
        found = found.union(
            lookup_join(windows, again, ["w"], "left_semi")
            .where("NOT many")
            .select("k1", "k2", F.col("at").alias("low"), (F.col("at") + length).alias("high"))
        )
    spans = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    spans = saved(spans, "suffix-spans").union(
        copies.select("k1", "k2", F.lit(None).cast("array<struct<low:bigint,high:bigint>>"))
    )
    marked = spans.withColumn("whole", F.col("spans").isNull())

    def cut(texts: pd.Series, whole: pd.Series, spans: pd.Series) -> pd.DataFrame:
        found = [_cut(t, w is True or w == 1, s, length) for t, w, s in zip(texts, whole, spans)]
        return pd.DataFrame(found, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    shape = "n_bytes long, n_removed long, n_spans long, kept binary"
    return (
        lookup_join(rows, marked, ["k1", "k2"], "left")
        .withColumn("_got", F.pandas_udf(cut, shape)("text", F.coalesce("whole", F.lit(False)), "spans"))
        .select("doc", "_got.*")
    )


def digest(kept: Column) -> Column:
    return F.sha2(kept, 256)
