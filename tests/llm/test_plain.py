"""Fingerprints and language predictions against plain versions, on the awkward rows too."""

import random
import re
from collections import Counter

import pytest

from fernway.llm import langid, pieces, quality, winnow
from fernway.llm.queries import QUERIES, piece_model
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def plain_units(text):
    out = []
    for w in WORD.findall(text or ""):
        out += [w[i : i + winnow.PIECE] for i in range(max(1, len(w) - winnow.PIECE + 1))]
    return out


def plain_grams(text):
    units = plain_units(text)
    if not units:
        return []
    n = min(len(units), winnow.GRAM)
    return [tuple(units[i : i + winnow.GRAM]) + (None,) * (winnow.GRAM - n) for i in range(len(units) - n + 1)]


def plain_picks(hashes):
    """Place of the rightmost least hash of every window."""
    places = []
    for i in range(max(1, len(hashes) - winnow.WINDOW + 1) if hashes else 0):
        window = hashes[i : i + winnow.WINDOW]
        places.append(i + max(j for j, h in enumerate(window) if h == min(window)))
    return [(hashes[p], p) for p in sorted(set(places))]


def plain_likeness(a, b):
    a, b = ({h for h, _ in x} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_equal_a_plain_version(spark, monkeypatch):
    rnd = random.Random(12)
    vocabulary = ["a", "b", "the", "süß", "\U0001f600x", "long" * 9]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 40))) for _ in range(40)]
    # Ties in every window, texts of fewer units than a gram, and none.
    texts += ["a " * 50, "q" * 900, "a b " * 30, "one", "one two", "", None, " \n", "\x0b\x1c", "z" * 17, "the " * 4000]
    rows = [(i * 7, t) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (21, "other text of that id"), (None, "null id"), (None, None), (None, "null id"), (-5, "low")]
    monkeypatch.setattr(winnow, "SPAN_ROWS", 9)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, edited string, n_chars int")
    keys = {r.t: r.k for r in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -keys[r[1]]))
    pairs = []
    for (i, own), (_, other) in zip(order, order[1:] + order[:1]):
        cut = len(own) // 3
        pairs.append((i, own, other, own[: len(own) - cut] + other[:cut]))
    grams = {g for _, own, _, edited in pairs for t in (own, edited) for g in plain_grams(t)}
    hashed = spark.createDataFrame(sorted(grams, key=str), "a string, b string, c string")
    hashed = hashed.select("*", F.hash("a", "b", "c").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"))
    hash_of = {(r.a, r.b, r.c): r.h for r in hashed.collect()}
    picks = lambda t: plain_picks([hash_of[g] for g in plain_grams(t)])
    show = lambda p: " ".join(f"{h:x}@{i}" for h, i in p)
    want = Counter()
    for i, own, other, edited in pairs:
        a, b, c = picks(own), picks(edited), picks(other)
        want[i, len(own), edited, show(a), show(b), plain_likeness(a, b), plain_likeness(a, c)] += 1
    got = winnow.fingerprint_edits(df).select(
        "doc_id", "n_chars", "edited", winnow.shown(F.col("chosen")).alias("f"),
        winnow.shown(F.col("edited_chosen")).alias("e"), "near_edited", "near_next",
    )
    assert Counter(tuple(r) for r in got.collect()) == want


def plain_gram_counts(text):
    letters = "".join(c if c.isalpha() and ord(c) < 1 << langid.BITS else " " for c in (text or "").lower())
    out = Counter()
    for word in letters.split():
        padded = f" {word} "
        out.update(word)
        out.update(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))
    return out


def plain_profile(counts, size):
    code = lambda g: [len(g), *(0 if c == " " else ord(c) for c in g)]
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


def plain_predictions(learned, texts, size):
    counts = {}
    for text, lang in learned:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(plain_gram_counts(text))
    ranks = {lang: {g: i for i, g in enumerate(plain_profile(c, size))} for lang, c in counts.items() if c}
    out = []
    for text in texts:
        own = plain_profile(plain_gram_counts(text), size)
        if not own or not ranks:
            out.append(("und", 0.0))
            continue
        apart = {
            lang: sum(abs(r[g] - i) if g in r else size for i, g in enumerate(own)) for lang, r in ranks.items()
        }
        best = min(sorted(apart), key=apart.get)
        out.append((best, 1.0 - apart[best] / (size * len(own))))
    return out


@pytest.mark.parametrize("size", [300, 5])
def test_languages_equal_a_plain_version(spark, size):
    """With few ranks, counts tie at the end of a profile."""
    rnd = random.Random(13)
    rows = [(None, "en"), ("", "de"), ("123 ...", "xx"), ("Straße größer süß", "de"), ("the cat's İ", "en"), ("un été à la mer", None)]
    alphabet = {"aa": "abcde ", "bb": "cdefg ", "cc": "éèàbc "}
    for lang, letters in alphabet.items():
        rows += [("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 300))), lang) for _ in range(12)]
    rows += [rows[-1]] * 5 + [("中文 text \U0001f600", "zz"), ("ab" * 20_000, "aa")]
    df = spark.createDataFrame([(i, *r, 1, "c") for i, r in enumerate(rows)], "doc_id long, text string, lang string, rank int, code string")
    profiles = langid.learn_profiles(df, size=size)
    got = langid.predict_languages(df, profiles, size=size)
    got = {r.doc.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    want = plain_predictions(rows, [t for t, _ in rows], size)
    assert got == dict(enumerate(want))


def test_language_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("h"))
    rows = docs.collect()
    want = plain_predictions([(r.text, r.lang) for r in rows if not r.h], [r.text for r in rows], langid.PROFILE)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op7_language_id"](spark, SF).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want)}


def test_long_words_equal_the_library():
    import base64
    import time

    import numpy as np
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    model, rnd = pieces.PieceModel(piece_model()), random.Random(3)
    texts = [
        base64.b64encode(rnd.randbytes(150_000)).decode(),
        "".join(rnd.choices("etaoinshrdlu", k=30_000)),  # cut nowhere, and too long for rounds
        "".join(rnd.choices("etaoinshrdlu", k=900)),
        "".join(rnd.choices(["the", "tion", "\U0001f600", "ü", "\u4e2d"], k=3_000)),
        "a" * 20_001, "a" * 65, "-=" * 3_000, "x" + " " * 200 + "y" * 200, "\u4e2d" * 5_000, "e\u0301" * 5_000,
    ]
    start = time.time()
    got = model.encode(texts)
    assert time.time() - start < 30
    for text, ids in zip(texts, got):
        assert ids == np.array(library.encode(text, add_bos=True, add_eos=True), "<u4").tobytes()
        assert model.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist())


def plain_model(patterns):
    """Expectation-maximisation over vote patterns and their counts, in plain floats."""
    import math

    prior = 0.8
    shares = {(name, c, v): quality.START[c][v] for name in quality.RULES for c in (0, 1) for v in (-1, 0, 1)}

    def chance(votes):
        odds = math.log(prior / (1 - prior))
        for name, v in zip(quality.RULES, votes):
            ratio = math.log(shares[name, 0, v] / shares[name, 1, v])
            odds += max(0.0, ratio) if v == 1 else min(0.0, ratio) if v == -1 else 0.0
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        good = {p: n * chance(p) for p, n in patterns.items()}
        bad = {p: n - good[p] for p, n in patterns.items()}
        sums = sum(good.values()), sum(bad.values())
        if not patterns:
            break
        for at, name in enumerate(quality.RULES):
            for v in (-1, 0, 1):
                for c, weight in enumerate((good, bad)):
                    hit = sum(w for p, w in weight.items() if p[at] == v)
                    shares[name, c, v] = (hit + 1) / (sums[c] + 3)
        new = (sums[0] + 1) / (sums[0] + sums[1] + 2)
        still, prior = abs(new - prior) < 1e-5, new
        if still:
            break
    return chance


def plain_votes(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    repeats = len({j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 8)})
    held = [x for x in (text or "").split("\n") if WORD.search(x)]
    chars, letters = sum(map(len, w)), sum(c.isalpha() for c in text or "")
    capitals, symbols = sum(c.isupper() for c in text or ""), sum(c in "#*$%&|<>" for c in text or "")
    n, dup, size = len(w), len(held) - len(set(held)), chars / max(1, len(w))

    def vote(good, bad):
        return -1 if bad else 1 if good else 0

    failed = n < 20 or 100 * repeats > 30 * n
    return failed, (
        vote(n >= 50, n < 20),
        vote(3.5 <= size <= 9, not 3 <= size <= 10.5),
        vote(symbols * 100 <= n, symbols * 10 >= n),
        vote(dup == 0, dup * 2 >= max(1, len(held))),
        vote(repeats * 20 <= n, repeats * 5 >= n),
        vote(capitals * 8 <= max(1, letters), capitals * 3 >= max(1, letters)),
        vote(letters * 100 >= max(1, chars) * 92, letters * 100 < max(1, chars) * 75),
    )


def test_quality_verdict_equals_a_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in rows}
    votes = {i: plain_votes(t) for i, t in texts.items()}
    chance = plain_model(Counter(v for _, v in votes.values()))
    got = QUERIES["op9_quality"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(rows)
    for r in got:
        failed, own = votes[r.doc_id]
        assert r.quality == pytest.approx(chance(own), abs=1e-9)
        assert r.base_failed == failed and r.kept == (not failed and chance(own) >= 0.5)
    assert len({r.kept for r in got}) == 2
