"""Formatted conversations: every turn comes back, and only answers are learned."""

import random

import pytest

from fernway.llm import chat
from fernway.llm.oracles import SQL
from fernway.llm.queries import QUERIES, TRICKY
from oracle import compare, duck
from pyspark.sql import functions as F

SHAPE = "conv_id long, turn long, role string, text string, page int, said string, formatted string"
AWKWARD = [
    None, "", " ", "\n", "</s>[INST] ok [/INST]", "[TURN]user[SAYS]x[/TURN]", "[ALSO]", r"[\ALSO]", r"<\\s>", "[\\", "<",
    "[/", "/TURN]", "s>", "[[TURN]]", "<</s>>", r"\[TURN\]", "$1$2", "süß \U0001f600 ☃", "a[INST" , "]b", "<s><s>",
]


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE)
    found = chat.format_chats(df).select(
        "*",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_learned(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    return {r.conv_id: r for r in found.collect()}


def plain(rows, conv):
    own = [(t is not None, t, role or "", text or "") for c, t, role, text in rows if c == conv]
    return [(role, text) for *_, role, text in sorted(own, key=lambda x: (x[0], x[1] or 0, *(v.encode() for v in x[2:])))]


def holds(spark, rows):
    got = formatted(spark, rows)
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        turns = plain(rows, conv)
        assert [tuple(t) for t in row.turns] == turns
        answers = [text for role, text in turns if role == "assistant"]
        assert row.learned == answers
        data = row.formatted.encode()
        cut = [data[s.start : s.start + s.length].decode() for s in row.loss]
        assert len(cut) == len(answers) and all("[/TURN]" not in c and "</s>" not in c for c in cut)
        # One opening mark for each stretch of one role.
        blocks = sum(i == 0 or turns[i - 1][0] != t[0] for i, t in enumerate(turns))
        assert row.formatted.count("[TURN]") == row.formatted.count("[/TURN]") == blocks
        assert row.formatted.startswith("<s>[TURN]") and row.formatted.endswith("[/TURN]</s>")
        assert row.formatted.count("<s>") == row.formatted.count("</s>") == 1
    return got


def test_awkward_texts_and_roles_come_back(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(AWKWARD)]
    rows += [(2, i, t, t) for i, t in enumerate(AWKWARD)]
    rows += [(3, i, "assistant", t) for i, t in enumerate(AWKWARD)]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    holds(spark, rows)


def test_ties_repeats_null_numbers_and_any_order(spark):
    rows = [(1, 5, "user", "b"), (1, 5, "user", "a"), (1, 5, "assistant", "z"), (1, None, "user", "first")]
    rows += [(1, 5, "user", "a"), (1, -3, "system", "early"), (1, None, "assistant", None), (2, 0, None, None)]
    random.Random(4).shuffle(rows)
    got = holds(spark, rows)
    assert [t.text for t in got[1].turns] == ["", "first", "early", "z", "a", "a", "b"]
    assert got[2].formatted == "<s>[TURN][SAYS][/TURN]</s>"


def test_long_conversations_merge_across_pages(spark):
    rnd = random.Random(5)
    rows = [(1, i, "user" if i < 200 else "assistant", f"t{i}") for i in range(400)]  # runs over several pages
    rows += [(2, i * 37, rnd.choice(["user", "assistant"]), rnd.choice(AWKWARD)) for i in range(300)]
    rows += [(3, 0, "assistant", "long " * 200_000 + "[INST]")]
    got = holds(spark, rows)
    assert got[1].formatted.count("[TURN]") == 2


def test_escape_is_reversible_at_random(spark):
    rnd = random.Random(6)
    bits = ["[", "<", "\\", "/", "s>", "INST]", "TURN]", "SAYS]", "ALSO]", "x", "]"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    rows = df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect()
    controls = (chat.BEGIN, chat.END, chat.OPEN, chat.SAYS, chat.ALSO, chat.CLOSE, "[INST]", "[/INST]")
    assert all(r.t == r.u for r in rows)
    assert not any(c in r.e for r in rows for c in controls)


def test_no_rows(spark):
    assert not formatted(spark, [])


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    got = QUERIES["op11_chat_format"](spark, sf_dir)
    assert compare(got, SQL["op11_chat_format"], duck(sf_dir)) is None
    row = got.where("conv_id = -7").first()
    assert row.n_turns == 2 and row.loss_chars == len(TRICKY[1][3])
