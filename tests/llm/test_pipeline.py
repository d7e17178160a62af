"""The whole pipeline, and the words that a mix takes, against plain versions."""

import hashlib
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from fernway.llm import langid, mixing
from fernway.llm.queries import QUERIES, piece_model
from test_llm import LOWER, brute_components, words
from test_plain import plain_predictions
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_taken(spark, rows, slots=1 << 18, longest=1 << 16, most=2.0, bucket_rows=20_000):
    """Words taken of each of ``(doc_id, text, source)``, laid out in the order of Spark's hash."""
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, doc_id long, text string, source string")
    hashed = df.withColumn("key", F.xxhash64("source", "text")).select("n", "key", F.xxhash64(F.lit(17), "key", "doc_id").alias("o"))
    order = {r.n: (r.o, r.key) for r in hashed.collect()}
    size = [len(words(text)) for _, text, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(z for z, r in zip(size, rows) if r[2] == s) for s in names]
    targets = mixing.fill_targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))], 1.5, most)
    block = max(1, min(longest, int(sum(targets)) // slots))
    blocks = [-(-s // block) for s in sizes]
    wanted = [t * b / s if s else 0.0 for t, b, s in zip(targets, blocks, sizes)]
    buckets, total = max(1, len(rows) // bucket_rows), sum(wanted)
    edges = [0.0]
    for w in wanted:
        edges.append(edges[-1] + (w / total if total else 0.0))
    uses = [Counter() for _ in names]
    ranks = [0] * len(names)
    for t in range(1, round(total) + 1):
        x = float(Decimal(t) * mixing.GOLDEN % 1)
        k = next((k for k in range(len(names)) if edges[k] <= x < edges[k + 1]), None)
        if k is not None:
            if ranks[k] < int(blocks[k] * most):
                uses[k][ranks[k] % blocks[k]] += 1
            ranks[k] += 1
    taken = [0] * len(rows)
    for k, name in enumerate(names):
        own = [n for n, r in enumerate(rows) if r[2] == name]
        own.sort(key=lambda n: (order[n][0] % buckets, *order[n], rows[n][0], size[n]))
        if not sizes[k]:
            continue
        starts = [b * sizes[k] // blocks[k] for b in range(blocks[k] + 1)]
        used = np.repeat([uses[k][b] for b in range(blocks[k])], np.diff(starts))
        at = 0
        for n in own:
            taken[n] = int(used[at : at + size[n]].sum())
            at += size[n]
    return size, taken


@pytest.mark.parametrize("buckets", [20_000, 15])
def test_taken_words_equal_a_plain_version(spark, monkeypatch, buckets):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", buckets)
    rows = [(i, "w " * (i % 40), ["a", "é", None, "B"][i % 4 if i % 3 else 0]) for i in range(120)]
    rows += [(200, "  ", "a"), (201, None, "b"), (202, "long " * 3000, "B"), (203, "x", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    for slots, longest in ((1 << 9, 1 << 16), (1 << 14, 3)):
        size, taken = plain_taken(spark, rows, slots, longest, bucket_rows=buckets)
        got = mixing.mix_sources(df, min_slots=slots, max_block=longest).collect()
        assert {r.doc_id: (r.size, r.taken) for r in got} == {r[0]: x for r, x in zip(rows, zip(size, taken))}


def test_mixing_query_equals_a_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    size, taken = plain_taken(spark, rows)
    got = {r.doc_id: (r.size, r.taken) for r in QUERIES["op10_mixing"](spark, SF).collect()}
    assert got == {r[0]: x for r, x in zip(rows, zip(size, taken))}


def test_pipeline_equals_a_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "lang").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    found = plain_predictions([(t, g) for i, t, _, g in docs if not held(i)], [t for _, t, _, _ in docs], langid.PROFILE)
    docs = [d for d, (lang, score) in zip(docs, found) if lang != "und" and score >= 0.1]
    key = lambda line: line.translate(LOWER).strip(" \t\n\x0b\x0c\r")
    seen = Counter(k for _, t, _, _ in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    kept = lambda t: "\n".join(x for x in (t or "").split("\n") if not key(x) or seen[key(x)] < 10)
    docs = [(i, kept(t), s) for i, t, s, _ in docs]
    parts = brute_components([(i, t) for i, t, _ in docs])
    docs = [d for d, (_, n, least) in zip(docs, parts) if not n or d[0] == least]
    size, taken = plain_taken(spark, docs)
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = Counter()
    for (i, text, _), n, w in zip(docs, size, taken):
        ids = model.encode(text, add_bos=True, add_eos=True)
        shas = (np.array(ids, "<u4").tobytes(), model.decode(ids).encode())
        row = (i, len(ids), *(hashlib.sha256(x).hexdigest() for x in shas))
        want[row] += int(w / n + 0.5) if n and 2 * w >= n else 0
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(tuple(r) for r in got.collect()) == +want
