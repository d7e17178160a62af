"""Operators against plain versions, on small tables with every awkward row."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from fernway.llm import langid, lines, mixing, near, pieces, quality, suffix, urls, warc, winnow
from fernway.llm.oracles import SQL
from fernway.llm.queries import QUERIES, piece_model
from fernway.session import new_work_path
from oracle import compare, duck
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Extra columns take names that the operators use themselves.
SHAPE = "doc_id long, text string, lang string, source string, kept int, doc string, key long, n long"


def rows_of(texts, source="s"):
    return [(i, t, "en", source, 1, "x", 2, 3) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    vocabulary = ["the", "An", "of", "süß", "x1", "tion", "er,", "ñado", "Σ", " gap"]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    out = [prose(rnd.randint(1, 90)) for _ in range(40)]
    out += [None, "", " \t\r\n ", "\n\n", "word", "a" * 900, "ab " * 4000, "€uro ☃ \U0001f600 \x00 ▁▁x"]
    base = prose(200)
    out += [base, base, base + " end", "Start " + base, base.upper()]
    shared = ["Shared LINE", "  shared line\x0b", "shared line"]
    out += [prose(8) + "\n" + shared[i % 3] + "\n" + prose(4) for i in range(12)]
    return out + [out[0], out[41], None]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = rows_of(texts)
    # A repeated row, an id with two texts, null ids and a null source.
    rows += [rows[3], (4, "another text of four", "fr", None, 0, None, None, None)]
    rows += [(None, "no id here", None, None, 0, None, None, None)] * 2
    return spark.createDataFrame(rows, SHAPE)


def words(t):
    return WORD.findall(t or "")


def test_lines(spark, docs, texts):
    got = lines.dedup_lines(docs, min_docs=10).collect()

    def key(line):
        return line.translate(LOWER).strip(" \t\n\x0b\x0c\r")

    all_rows = [r.text or "" for r in docs.collect()]
    seen = Counter(k for t in all_rows for k in {key(x) for x in t.split("\n")} if k)
    want = []
    for t in all_rows:
        kept = [x for x in t.split("\n") if not key(x) or seen[key(x)] < 10]
        want.append((len(t.split("\n")), len(t.split("\n")) - len(kept), "\n".join(kept)))
    assert sorted((r.n_lines, r.n_dropped, r.kept) for r in got) == sorted(want)
    assert sum(w[1] for w in want) >= 12


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = [[rows[j][0] for j in range(len(rows)) if label[j] == x and rows[j][0] is not None] for x in label]
    return [(r[0], len(s), min(i) if i else None) for r, s, i in zip(rows, sets, ids)]


def test_near(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near.near_components(docs).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)
    assert found == sorted(brute_components(rows), key=repr)
    unique = near.near_unique(docs)
    assert unique.columns == docs.columns
    blank = sum(not words(t) for _, t in rows)
    labels = {r.label for r in got if r.label is not None}
    assert unique.count() == blank + len(labels)


def test_near_finds_links_beside_the_centre(spark):
    # A chain: neighbours are linked, the ends are not, so one centre can't see all of it.
    base = [f"w{i}" for i in range(120)]
    chain = [" ".join(f"v{k}x{i}" if i < k * 6 else w for i, w in enumerate(base)) for k in range(12)]
    df = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_components(df).collect()}
    want = {i: c for i, _, c in brute_components(list(enumerate(chain)))}
    assert got == want


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in near.connected_components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_linked_pairs_by_matrix():
    rnd = np.random.default_rng(1)

    def block(n):
        sets = [np.unique(rnd.integers(0, 60, 40)) for _ in range(n)]
        return sets, (np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets]), np.array([len(s) for s in sets]))

    a, flat_a = block(9)
    b, flat_b = block(7)
    got = set(zip(*map(list, near.linked_pairs(flat_a, flat_b, 40))))
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b)
            if 100 * len(np.intersect1d(x, y)) >= 40 * len(np.union1d(x, y))}
    assert got == want and want


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("length", [12, 40])
def test_suffix(spark, docs, length):
    rows = [r.text for r in docs.collect()]
    got = suffix.remove_repeats(docs, length=length).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(
        brute_repeats(rows, length)
    )


def test_suffix_bounds_each_transform(spark, docs, monkeypatch):
    rnd = random.Random(11)
    passage = "".join(rnd.choice("abcdefgh") for _ in range(150))
    some = [
        "".join(rnd.choice("xyz") for _ in range(60)) + passage + "".join(rnd.choice("xyz") for _ in range(60))
        for _ in range(80)
    ]
    some += [passage, some[3], "lone " + some[5][20:240], "z" * 400, None, "", "q" * 39, "é" * 90]
    some += [r.text for r in docs.collect()]
    batch, plain = 3000, suffix._emit_spans

    def watched(length, batch_bytes):
        emit = plain(length, batch_bytes)

        def watch(batches):
            batches = list(batches)
            held = {}
            for b in batches:
                for m, content in zip(b["m"], b["content"]):
                    held.setdefault(m, []).append(content)
            for contents in held.values():
                assert len(set(contents)) == len(contents)
                assert sum(map(len, contents)) <= batch
            yield from emit(iter(batches))

        return watch

    monkeypatch.setattr(suffix, "_emit_spans", watched)
    df = spark.createDataFrame(rows_of(some), SHAPE)
    got = suffix.remove_repeats(df, length=40, batch_bytes=batch).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(
        brute_repeats(some, 40)
    )


def test_suffix_at_400_bytes(spark):
    """More than 50 words need not be 400 bytes: shorter passages stay, longer ones go whole."""
    rnd = random.Random(400)
    some, want = [], []
    for size in (380, 394, 399, 400, 401, 640, 800):
        passage = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(120))[: size - 1] + "z"
        assert len(WORD.findall(passage)) > 50
        # No neighbours alike, so that nothing beside the passage repeats.
        for left, right in ("ij", "kl", "mn"):
            ahead, behind = ("".join(rnd.choices("opqr ", k=rnd.randint(50, 900))) for _ in range(2))
            some.append(ahead + left + passage + right + behind)
            want.append(size if size >= 400 else 0)
    got = suffix.remove_repeats(spark.createDataFrame(rows_of(some), SHAPE)).collect()
    assert [r.n_removed for r in sorted(got, key=lambda r: r.doc.doc_id)] == want
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(
        brute_repeats(some, 400)
    )


def test_bwt_against_counting():
    rnd = random.Random(5)
    for trial in range(40):
        length = rnd.choice([4, 8, 12])
        letters = rnd.choice([b"ab", b"abc", bytes(range(250))])
        some = [bytes(rnd.choice(letters) for _ in range(rnd.randint(length, 60))) for _ in range(6)]
        some += [b"a" * 50] * (trial % 2)
        seen = Counter(c[i : i + length] for c in some for i in range(len(c) - length + 1))
        want = [[i for i in range(len(c) - length + 1) if seen[c[i : i + length]] > 1] for c in some]
        assert [g.tolist() for g in suffix.repeated_windows(some, length)] == want


def test_urls(spark):
    captures = spark.createDataFrame(
        [(1, "http://A.b.example.org:80/x", 10), (2, "http://b.example.org/", 25), (3, None, 10),
         (4, "no url", 10), (5, "https://u@a.b.example.org./", 95), (6, "http://example.org", None)],
        "page_id long, url string, fetch_day int",
    )
    entries = spark.createDataFrame(
        [("example.org", 5, "add"), ("example.org", 20, "remove"), ("a.b.example.org", 8, "add"),
         ("b.example.org", 25, "add"), ("b.example.org", 25, "remove"), (None, 1, "add")],
        "pattern string, day int, action string",
    )
    got = {r.doc.page_id: (r.listed, r.matched, r.since) for r in urls.filter_urls(captures, entries).collect()}
    none = (False, None, None)
    assert got == {1: (True, "a.b.example.org", 8), 2: none, 3: none, 4: none,
                   5: (True, "a.b.example.org", 8), 6: none}


def test_urls_of_many_labels_and_awkward_tables(spark):
    deep = ".".join(f"l{i}" for i in range(132)) + ".org"
    long = "a." * 300 + "com"
    rows = [(1, f"http://{deep}/p", 10, "x"), (2, f"http://www.{deep}/", 10, "x"), (3, f"http://{long}/" + "q" * 9000, 10, "x"),
            (1, f"http://{deep}/p", 10, "x"), (4, "http://com", 10, "x"), (None, "http://h", 10, "x")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetch_day int, pattern string")
    entries = spark.createDataFrame([(deep, 1, "add"), ("a.com", 2, "add"), (deep, 1, "add"), ("h", 3, "add")],
                                    "pattern string, day int, action string")
    got = urls.filter_urls(captures, entries).collect()
    assert len(got) == len(rows)
    assert {(r.doc.page_id, r.matched, r.since) for r in got} == {
        (1, deep, 1), (2, deep, 1), (3, "a.com", 2), (4, None, None), (None, "h", 3)}
    assert urls.filter_urls(captures.limit(0), entries).count() == 0
    assert not any(r.listed for r in urls.filter_urls(captures, entries.limit(0)).collect())


def test_warc_ids_with_several_payloads(spark):
    a, b = "A" * 150, "B" * 300
    pages = [(5, "u", a, 1), (5, "u", b, 1), (7, "u", a, 1), (8, "u", b, 1), (5, "u", a, 1), (9, "u", b, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, refers_to int")
    got = sorted(tuple(r) for r in warc.round_trip(df).fillna(-1, ["refers_to"]).collect())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(i, len(x), sha(x), "response" if i == 5 else "revisit", -1 if i == 5 else 5) for i, _, x, _ in pages]
    assert got == sorted(want)


def test_winnow(spark, docs, monkeypatch):
    some = docs.where("doc_id <> 4 AND doc_id IS NOT NULL")
    ids = sorted(((r.doc_id, r.text or "") for r in some.collect()), reverse=True)
    want = []
    for (i, own), (_, other) in zip(ids, ids[1:] + ids[:1]):
        cut = len(own) // 3
        want.append((i, own[: len(own) - cut] + other[:cut]))
    monkeypatch.setattr(winnow, "SPAN_ROWS", 10)
    got = winnow.fingerprint_edits(some)
    out = got.select("doc_id", "n_chars", "edited", "chosen", winnow.shown(F.col("chosen")).alias("f"), "near_edited").collect()
    assert sorted((r.doc_id, r.edited) for r in out) == sorted(want)
    texts_of = dict(ids)
    shown = {}
    for r in out:
        own = texts_of[r.doc_id]
        assert r.n_chars == len(own)
        assert 0 <= r.near_edited <= 1
        assert shown.setdefault(own, r.f) == r.f
        # Rightmost least gram of each window.
        grams = [p & 0x7FFFFFFF for p in r.chosen]
        places = [(1 << 31) - 1 - g for g in grams]
        assert places == sorted(set(places))
        n = max(1, len(words(own)) - winnow.GRAM + 1) if words(own) else 0
        assert all(any(i <= p < i + winnow.WINDOW for p in places) for i in range(max(0, n - winnow.WINDOW + 1)))


def test_winnow_without_white_space(spark):
    rnd = random.Random(7)

    def han(n):
        return "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(n))

    passage = han(winnow.PIECE + winnow.WINDOW + winnow.GRAM - 2)
    base, emoji = han(900), "".join(chr(0x1F300 + rnd.randint(0, 99)) for _ in range(300))
    some = [base, "a" * 900, "x" + base, emoji, han(50) + passage + han(40), han(33) + passage + "b c", han(600)]
    some += ["w " * 20 + base + " end", "q" * winnow.PIECE, "q" * (winnow.PIECE + 1)]
    df = spark.createDataFrame(rows_of(some), SHAPE)
    out = {r.doc_id: r for r in winnow.fingerprint_edits(df).collect()}
    for i in (0, 1, 2, 3, 6, 7):
        assert 0.3 < out[i].near_edited < 1 or (i == 1 and 0 < out[i].near_edited < 1), i
    for i, r in out.items():
        plain = []
        for w in words(some[i]):
            plain += [w[j : j + winnow.PIECE] for j in range(max(1, len(w) - winnow.PIECE + 1))]
        places = [winnow.LAST - (p & winnow.LAST) for p in r.chosen]
        n = max(1, len(plain) - winnow.GRAM + 1)
        assert all(any(j <= p < j + winnow.WINDOW for p in places) for j in range(max(1, n - winnow.WINDOW + 1)))
        assert max(places) < n
    sets = {i: {p >> winnow.PLACES for p in r.chosen} for i, r in out.items()}
    assert len(sets[0] & sets[2]) / len(sets[0] | sets[2]) > 0.95
    assert sets[0] & sets[7] and sets[4] & sets[5] and not sets[0] & sets[6]


def test_warc(spark):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n"
    same = "same payload " * 20
    pages = [(1, "http://a/\r\nX: y", inner * 3), (2, None, same), (3, "u", same), (4, "u", None),
             (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", same),
             (8, "u", "é\r\n\r\n" * 3000), (9, "u", inner[:40])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = sorted((tuple(r) for r in warc.round_trip(df).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        again = html == same and i != 2
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert got == sorted(want, key=repr)


def test_langid(spark, docs):
    train = spark.createDataFrame(
        [("the of and to in", "en"), ("le la les des une", "fr"), (None, "fr"), ("x", None)] * 5,
        "text string, lang string",
    )
    found = langid.predict_languages(docs, langid.learn_profiles(train)).collect()
    by_text = {}
    for r in found:
        letters = any(c.isalpha() for c in r.doc.text or "")
        assert (r.lang_pred in ("en", "fr")) == letters and 0 <= r.score <= 1
        assert by_text.setdefault(r.doc.text, r.lang_pred) == r.lang_pred
    none = langid.predict_languages(docs, langid.learn_profiles(train.where("lang = 'xx'")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_langid_held_out_accuracy(spark):
    got = QUERIES["op7_language_id"](spark, SF).where("held_out")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.95


def test_pieces(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for r in pieces.encode_pieces(docs, piece_model()).collect():
        ids = library.encode(r.doc.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == library.decode(ids)


def test_pieces_on_blanks_and_runs():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    model = pieces.load_model(piece_model())
    rnd = random.Random(2)
    some = [" " * n + "x" * (n % 3) + " " * (n // 2) for n in range(70)]
    some += ["".join(rnd.choice("ab \n\t▁é中<s>0x") for _ in range(200)) for _ in range(200)]
    some += ["the" * 300, "=" * 500, "0" * 333, "hahaha" * 50]
    for text, ids in zip(some, model.encode(some)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert model.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist())


def test_quality(spark, docs):
    for r in quality.judge_quality(docs).collect():
        w, t = words(r.doc.text), r.doc.text or ""
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        seen = Counter(windows)
        twice = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 8)}
        with_word = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
            len(with_word) - len(set(with_word)), len(twice),
        )
        assert r.base_failed == (len(w) < 20 or 100 * len(twice) > 30 * len(w))
        assert 0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_quality_agrees_with_labels(spark):
    got = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").where("NOT base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    share = got.join(labels.select("doc_id", F.col("quality").alias("good")), "doc_id").groupBy("good").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")
    )
    kept = {r.good: r.kept for r in share.collect()}
    assert kept[1] > 0.98 and kept[0] < 0.6


def test_mixing(spark, docs):
    rows = mixing.mix_sources(docs, min_slots=1 << 12)
    got = rows.collect()
    assert len(got) == docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    assert mixing.mixed_rows(docs).columns == docs.columns
    big = QUERIES["op10_mixing"](spark, SF)
    source = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    by = big.join(source, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"))
    assert all(abs(r.t - r.g) <= 0.02 * r.g + 20 for r in by.collect())


def test_targets():
    assert mixing.fill_targets([10, 100, 100], [5, 2, 1], 1.5, 2) == pytest.approx([20, 590 / 3, 295 / 3])
    assert mixing.fill_targets([0, 0], [5, 2], 1.5, 2) == [0, 0]


def test_no_language_to_learn_from(spark):
    some = ["clean text", None, "", "12 !? 34", "süß", "日本"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(some)], "doc_id long, text string, lang string")
    got = langid.reject_unknown(df)
    assert got.columns == df.columns
    assert sorted(r.text for r in got.collect()) == sorted(["clean text", "süß", "日本"])


EMPTY = ["dedup_lines", "near", "suffix", "winnow", "predict", "pieces", "quality", "mix", "warc"]


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(spark, docs, name):
    none = docs.where("doc_id < -1")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    run = {
        "dedup_lines": lambda: lines.dedup_lines(none),
        "near": lambda: near.near_components(none),
        "suffix": lambda: suffix.remove_repeats(none),
        "winnow": lambda: winnow.fingerprint_edits(none),
        "predict": lambda: langid.reject_unknown(none),
        "pieces": lambda: pieces.encode_pieces(none, piece_model()),
        "quality": lambda: quality.judge_quality(none),
        "mix": lambda: mixing.mixed_rows(none),
        "warc": lambda: warc.round_trip(pages),
    }
    assert run[name]().count() == 0


@pytest.mark.parametrize("name", list(SQL))
def test_queries_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), SQL[name], duck(SF)) is None


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        path = new_work_path(spark, name)
        stage(spark, out, SF).write.parquet(path)
        out = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        if name == "minhash_dedup":
            rows = [(r.doc_id, r.text) for r in out.collect()]
            assert [c for i, _, c in brute_components(rows) if words(dict(rows)[i])] == [
                i for i, t in rows if words(t)
            ]
    assert 0 < out.count()
