"""Phrase counts and scores against counting everything."""

import random
import re
from collections import Counter

import pytest

from fernway.llm import phrases
from fernway.llm.oracles import SQL
from fernway.llm.queries import QUERIES
from oracle import compare, duck

SHAPE = "text string, lang string, phrase string, c long, size int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, longest):
    counts, numbers = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            numbers["und" if lang is None else lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang, k, " ".join(words[i : i + k])] += 1
    return counts, numbers


def brute_collocations(rows, longest, least, inside):
    counts, numbers = brute_counts(rows, longest)
    often = {p: c for p, c in counts.items() if c >= least}
    out = set()
    for (lang, k, phrase), a in often.items():
        if k == 1:
            continue
        words = phrase.split(" ")
        if any(
            g == lang and m > k and 100 * c >= inside * a and f" {phrase} " in f" {longer} "
            for (g, m, longer), c in often.items()
        ):
            continue
        cuts = []
        for j in range(1, k):
            l, r = counts[lang, j, " ".join(words[:j])], counts[lang, k - j, " ".join(words[j:])]
            cuts.append((1_000_000 * a * a // (l * r), j, l, r))
        score, _, l, r = min(cuts)
        out.add((lang, phrase, a, l, r, numbers[lang], score))
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    vocabulary = ["The", "of", "süß", "x\x1cy", "A", "a", "Σ", " ", "don't", "1", "\U0001f600"]

    def prose(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" "] * 8 + ["\t", ". ", ", ", "\n", "\x0b", "!"]) for _ in range(n))

    out = [(prose(rnd.randint(0, 60)), rnd.choice(["en", "de", None, "und", ""])) for _ in range(120)]
    out += [(None, "en"), ("", None), (" \t", "de"), ("...", "en"), ("word", "xx"), ("aa aa aa aa aa aa", "en")]
    out += [("new york city hall", "en")] * 14 + [("In new York today", "en")] * 6
    return out + [(("big data " * 3000), "fr"), ("z" * 5000, "fr")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SHAPE)


@pytest.mark.parametrize("share,sampled,longest", [(1, 1, 3), (4, 2, 3), (50, 2, 3), (10**9, 5, 3), (10**9, 1, 4), (3, 1, 2)])
def test_counts_are_whole_whatever_the_sample(spark, rows, share, sampled, longest):
    counted, numbers = phrases.frequent_phrases(frame(spark, rows), longest=longest, share=share, sampled=sampled)
    want, words = brute_counts(rows, longest)
    got = [tuple(r) for r in counted.select("lang", "size", "phrase", "c").collect()]
    assert len(got) == len({g[:3] for g in got})
    assert {g[:3]: g[3] for g in got} == {p: c for p, c in want.items() if c >= phrases.LEAST}
    assert {r.lang: r.n for r in numbers.collect()} == {g: n for g, n in words.items() if n}


def test_a_full_filter_counts_no_less(spark, rows, monkeypatch):
    """Where the bit array is far too small, most phrases pass it by chance."""
    everything = frame(spark, rows).union(frame(spark, [(" ".join(f"u{i}" for i in range(20_000)), "en")] * 12))
    counted, _ = phrases.frequent_phrases(everything, share=2)
    want, _ = brute_counts([(r.text, r.lang) for r in everything.collect()], 3)
    got = {(r.lang, r.size, r.phrase): r.c for r in counted.collect()}
    assert got == {p: c for p, c in want.items() if c >= phrases.LEAST}


@pytest.mark.parametrize("longest,inside", [(3, 50), (4, 50), (3, 100), (2, 50)])
def test_collocations_equal_brute_force(spark, rows, longest, inside):
    found = phrases.collocations(frame(spark, rows), longest=longest, inside=inside, share=7)
    got = [tuple(r) for r in found.select("lang", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_collocations(rows, longest, phrases.LEAST, inside)


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits, on counts that no small text can have."""
    big = 9_876_543_210_123
    counted = spark.createDataFrame(
        [("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7)], "lang string, size int, phrase string, c long"
    )
    numbers = spark.createDataFrame([("en", 3 * big)], "lang string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a, **k: (counted, numbers))
    row = phrases.collocations(counted).first()
    assert row.score == 1_000_000 * (big - 7) ** 2 // (big * (big - 1))


def test_no_rows(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(QUERIES["op13_collocations"](spark, sf_dir), SQL["op13_collocations"], duck(sf_dir)) is None
