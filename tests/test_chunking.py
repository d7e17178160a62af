import random
import re

from hypothesis import example, given, settings, strategies as st

from fernway.operators import chunking as ch
from fernway.sources.html import html_blocks, markdown_blocks

texts = st.text(alphabet="ab cé.\n", max_size=3000)


def squash(text):
    return re.sub(r"\s+", "", text)


@settings(max_examples=150, deadline=None, derandomize=True)
@example("a" * 21, 20)
@given(texts, st.integers(20, 200))
def test_recursive_chunks_fit_and_lose_nothing(text, size):
    chunks = ch.split_recursive(text, size, size // 4)
    assert all(0 < len(c) <= size for c in chunks)
    # Every chunk is a piece of the text, and walking the text chunk by chunk leaves no gap.
    bare, reached, start = squash(text), 0, 0
    for chunk in map(squash, chunks):
        # In a repetitive text a chunk may stand in several places: the last one that leaves no gap.
        at = bare.rfind(chunk, start, reached + len(chunk))
        assert at != -1 and at <= reached
        reached = max(reached, at + len(chunk))
        start = max(0, at)
    assert reached == len(bare)


@settings(max_examples=100, deadline=None)
@given(texts)
def test_without_overlap_chunks_join_to_the_text(text):
    assert squash("".join(ch.split_recursive(text, 40, 0))) == squash(text)


def test_paragraphs_stay_whole_and_overlap_is_bounded():
    text = "\n\n".join(f"Paragraph {i} " + "word " * 30 for i in range(6))
    chunks = ch.split_recursive(text, 400, 50)
    assert all(c.startswith("Paragraph") for c in chunks)
    words = ch.split_recursive("w1 " + " ".join(f"w{i}" for i in range(2, 400)), 100, 20)
    for a, b in zip(words, words[1:]):
        shared = set(a.split()) & set(b.split())
        assert 0 < len(" ".join(shared)) <= 20


def test_null_and_blank_give_no_chunk(spark):
    df = spark.createDataFrame([(1, None), (2, "  \n "), (3, "x")], "id int, t string")
    assert [tuple(r) for r in ch.recursive_chunk(df, "id", "t").collect()] == [(3, 0, "x")]


def test_window_chunks_against_slices(spark):
    random.seed(3)
    sizes = [0, 1, 49, 50, 51, 549, 550, 551, 599, 600, 601, 650, 651, 1150, 1151, 5000]
    texts = ["".join(random.choice("aé\n😀b") for _ in range(n)) for n in sizes]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {}
    for r in ch.window_chunk(df, "id", "t").collect():
        got.setdefault(r.id, []).append((r.chunk_index, r.content))
    for i, text in enumerate(texts):
        count = max(-(-(len(text) - 50) // 550), 1)
        want = [(j, text[j * 550 : j * 550 + 600]) for j in range(count)]
        assert sorted(got[i]) == want


def test_structural_chunks_carry_their_heading_trail(spark):
    page = "<h1>A</h1><p>one</p><h2>B</h2><p>two</p><h2>C</h2><p>three</p><h1>D</h1>four"
    md = "# A\n\none\n\n## B\ntwo\n\n## C\n\nthree\n\n# D\nfour"
    for kind, text in (("html", page), ("markdown", md)):
        df = spark.createDataFrame([("d", text)], "doc string, t string")
        rows = ch.structural_chunk(df, "doc", "t", kind=kind).orderBy("chunk_index").collect()
        assert [r.content for r in rows] == ["A\none", "A\nB\ntwo", "A\nC\nthree", "D\nfour"]
        assert [r.chunk_index for r in rows] == [0, 1, 2, 3]


def test_structural_chunks_keep_all_text_within_size(spark):
    words = " ".join(f"w{i}" for i in range(900))
    df = spark.createDataFrame([(1, f"<h1>Title</h1><p>{words}</p>tail")], "id int, t string")
    out = ch.structural_chunk(df, "id", "t", size=200).orderBy("chunk_index").collect()
    bodies = [r.content.removeprefix("Title\n") for r in out]
    assert all(len(body) <= 200 for body in bodies) and {r.heading for r in out} == {"Title"}
    assert " ".join(bodies).split() == (words + " tail").split()


def plain_chunks(blocks, size):
    """Heading trails by a stack, bodies packed one after the other."""
    trail, held, out = [], "", []

    def close():
        if held:
            out.append(("\n".join(t for _, t in trail), held.strip()))

    for level, text in blocks:
        if level:
            close()
            held, trail = "", [h for h in trail if h[0] < level] + [(level, text)]
        else:
            if len(held) + len(text) + 1 > size:
                close()
                held = ""
            held += text + "\n"
    close()
    return out


def test_structural_chunks_against_a_plain_scan(spark):
    random.seed(5)
    tags = ["h1", "h2", "h3", "h6", "p", "p", "p", "div", "li"]
    texts = ["", "x", "é😀 b", "\u00a0y\u00a0", "word " * 30, "q" * 150, "a &amp; b"]
    pages = [
        "".join(f"<{t}>{random.choice(texts)}</{t}>" for t in random.choices(tags, k=random.randrange(40)))
        for _ in range(60)
    ]
    df = spark.createDataFrame([*enumerate(pages), (99, None), (98, "<h1>only</h1>")], "id int, t string")
    for size in (60, 200):
        got = {}
        for r in ch.structural_chunk(df, "id", "t", size=size).orderBy("chunk_index").collect():
            assert r.content == (f"{r.heading}\n" if r.heading else "") + r.content[len(r.heading) + bool(r.heading) :]
            got.setdefault(r.id, []).append((r.heading, r.content[len(r.heading) + bool(r.heading) :]))
        want = {i: plain_chunks(ch.block_lines(p, "html", size), size) for i, p in enumerate(pages)}
        assert got == {i: chunks for i, chunks in want.items() if chunks}


def test_malformed_html():
    assert html_blocks("<p>a &amp; b<p>c<scr") == [(0, "a & b"), (0, "c")]
    assert html_blocks("x<script>var y='</p>';</script>z<!-- no -->") == [(0, "xz")]
    assert html_blocks("") == []
    assert markdown_blocks("plain\nlines\n\n# H\ntext") == [
        (0, "plain\nlines"), (1, "H"), (0, "text"),
    ]
