"""Periodic runs against every period of every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fernway.llm import periods
from fernway.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, doc string, runs int, n_words string, start int"


def brute_runs(words, least=24, times=3):
    """Maximal stretches of every period; of equal stretches the least period."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(rnd, n, letters, broken=False):
    words = [f"w{rnd.randrange(letters)}" for _ in range(n)]
    if n:
        a = rnd.randrange(n)
        p = 1 + (n - a) // rnd.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if broken:
            words[rnd.randrange(n)] = "other"
    return words


def test_extensions_equal_direct_comparison():
    rnd = np.random.default_rng(2)
    for letters, n in ((1, 400), (2, 500), (3, 90), (40, 700), (2, 3)):
        text = np.append(rnd.integers(1, letters + 1, n), 0)
        text[n // 3 : 2 * n // 3] = text[: 2 * n // 3 - n // 3]
        lce = periods.Extensions(text)
        i, j = (x.ravel() for x in np.triu_indices(n + 1, 1))
        some = rnd.permutation(len(i))[:4000]
        i, j = i[some], j[some]
        want = []
        for x, y in zip(i.tolist(), j.tolist()):
            k = 0
            while y + k <= n and text[x + k] == text[y + k]:
                k += 1
            want.append(k)
        assert lce.common(i, j).tolist() == want


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2), (2, 2), (9, 4)])
def test_runs_equal_brute_force(least, times):
    rnd = random.Random(least)
    for _ in range(60):
        texts = [
            planted(rnd, rnd.choice([0, 1, 23, 24, 25, 70, 150, 260]), rnd.choice([1, 2, 3, 60]), rnd.random() < 0.4)
            for _ in range(rnd.randint(1, 6))
        ]
        texts.append(texts[0])  # a copy in the same batch
        numbers = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        flat = np.array([numbers[w] for t in texts for w in t], np.int64)
        of, *runs = periods.find_runs(flat, np.array([len(t) for t in texts]), least, times)
        for k, text in enumerate(texts):
            got = list(zip(*(x[of == k].tolist() for x in runs)))
            assert got == brute_runs(text, least, times)


def test_operator_on_awkward_rows(spark, monkeypatch):
    rnd = random.Random(8)
    texts = [None, "", " \t\r\n", "one", "a " * 23, "a " * 24, "\x0ba\x0c" * 30, "x y " * 40, "a b " * 5000]
    texts += [" ".join(planted(rnd, n, 50)) for n in (100, 300, 900, 20_000)]
    texts += ["  ".join(planted(rnd, 200, 2, True)) for _ in range(20)]
    texts += [texts[9], texts[9], None]
    rows = [(i if i % 5 else None, t, "d", 1, "n", 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SHAPE)
    got = periods.periodic_runs(df).collect()
    assert len(got) == len(rows)
    key = lambda x: (str(x[0]), str(x[1]))
    for g, r in zip(sorted(got, key=lambda g: key((g.doc.doc_id, g.doc.text))), sorted(rows, key=key)):
        words = WORD.findall(r[1] or "")
        assert g.doc.text == r[1] and g.n_words == len(words) and g.doc.start == 2
        if len(words) < 2000:
            runs = brute_runs(words)
            assert [tuple(x) for x in g.runs] == runs
            assert g.collapsed == brute_collapsed(words, runs)
    assert {tuple(g.runs[0]) for g in got if g.n_words == 10_000} == {(0, 10_000, 2)}
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some_run = 0
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue
        runs = brute_runs(words)
        some_run += bool(runs)
        best = (None,) * 4
        if runs:
            s, m, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            best = (s, m, q, 1000 * m // q)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want = (doc_id, len(runs), *best, *(
            hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute_collapsed(words, runs))
        ))
        assert tuple(got[doc_id]) == want
    assert some_run > 5
