import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fernway.functions import scalars
from fernway.sources import changes, files, html, tables as st

ARTICLE = """ID: KB-7
Type: FAQ
Category: Billing
Subcategory: Late fees
Title: What: is a late fee?
Tags: fee, billing,late
Last Updated: 2021-05-18 07:08:09
Generated: 2022-02-03T04:05:06.123456

---

# What is it?

A fee.
---
More."""
TICKET = """Ticket ID: TICK-9
Customer ID: CUS-1
Subscription ID: SUB-2
Category: Technical
Priority: High
Status: Resolved
Created: 2019-08-01 10:11:12.250000
Agent ID: TEC-3
Resolved: not yet

---
DESCRIPTION:
---

No signal. Error ERR-12.

---
RESOLUTION:
---

Restarted.
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for name, body in (
        ("kb/faq/billing/KB-7.txt", ARTICLE),
        ("kb/faq/billing/KB-8.txt", ARTICLE.replace("\n", "\r\n").replace("KB-7", "KB-8")),
        ("tickets/2019/08/TICK-9.txt", TICKET),
    ):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body.encode())
    return str(root)


def test_files_are_read_whole_with_their_folders(spark, folder):
    read = files.read_text_files(spark, folder)
    assert read.count() == 3
    rows = {r.file_id: r for r in files.path_fields(read).collect()}
    assert rows["KB-7"].text == ARTICLE
    assert (rows["KB-7"].path_type, rows["KB-7"].path_category) == ("faq", "billing")
    assert (rows["TICK-9"].path_year, rows["TICK-9"].path_month) == (2019, 8)
    assert rows["TICK-9"].path_type is None
    assert files.read_text_files(spark, folder, "TICK*").count() == 1


def test_articles(spark, folder):
    rows = files.parse_article(files.read_text_files(spark, folder, "KB*")).collect()
    assert sorted(r.id for r in rows) == ["KB-7", "KB-8"]
    for r in rows:
        assert r.title == "What: is a late fee?"
        assert r.tags == ["fee", "billing", "late"]
        assert r.last_updated == dt.datetime(2021, 5, 18, 7, 8, 9)
        assert r.generated == dt.datetime(2022, 2, 3, 4, 5, 6, 123456)
        assert r.body == "# What is it?\n\nA fee.\n---\nMore."


def test_tickets(spark, folder):
    (r,) = files.parse_ticket(files.read_text_files(spark, folder, "TICK*")).collect()
    assert (r.ticket_id, r.priority, r.agent_id) == ("TICK-9", "High", "TEC-3")
    assert r.created == dt.datetime(2019, 8, 1, 10, 11, 12, 250000)
    assert r.resolved is None
    assert (r.description, r.resolution) == ("No signal. Error ERR-12.", "Restarted.")


def test_malformed_files_do_not_fail(spark):
    df = spark.createDataFrame(
        [("a", ""), ("b", "no header at all"), ("c", "ID: 1\nID: 2\n---\n")], "path string, text string"
    )
    rows = {r.path: r for r in files.parse_article(df).collect()}
    assert rows["a"].id is None and rows["b"].body is None and rows["c"].id == "1"
    assert files.parse_ticket(df).count() == 3


def test_csv_of_several_blocks_gives_several_tasks(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    with open(path, "w") as f:
        f.write("a,b\n" + "x,1\n" * 5000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = files.read_csv(spark, path, "a string, b int")
        assert got.rdd.getNumPartitions() > 3 and got.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_page_with_an_open_head_keeps_its_text():
    page = "<html><head><title>x</title><body><h1>T</h1><p>hello</p></body></html>"
    assert [text for _, text in html.html_blocks(page)] == ["T", "hello"]
    assert [text for _, text in html.html_blocks("<head><style>p{}</style><p>a</p>")] == ["a"]


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [('say "hi"\nthere', "x", 1), ("a,b", "y", 2)]
    df = spark.createDataFrame(rows, "description string, junk string, target int")
    df.write.option("header", "true").option("escape", '"').csv(path)
    got = files.read_csv(spark, path, df.schema, drop=["junk"], multiLine="true")
    assert got.dtypes == [("description", "string"), ("target", "string")]
    assert sorted(map(tuple, got.collect())) == [("a,b", "2"), ('say "hi"\nthere', "1")]


def test_table_modes_and_ddl(spark, tmp_path):
    df = st.rows_to_df(spark, [{"id": 1, "t": "a"}, {"id": 2, "t": None}], "id int, t string")
    path = str(tmp_path / "table")
    assert st.write_table(df, path).count() == 2
    with pytest.raises(AnalysisException):
        st.write_table(df, path)
    assert st.write_table(df.limit(1), path, "overwrite").count() == 1
    st.create_schema(spark, "shop")
    st.drop_table(spark, "shop.items")
    st.create_table(spark, "shop.items", df.schema, properties={"purpose": "test"})
    st.create_table(spark, "shop.items", "id int, t string")
    st.set_properties(spark, "shop.items", {"synced": "true"})
    assert st.write_table(df, "shop.items", "overwrite").count() == 2
    st.drop_table(spark, "shop.items")
    assert not spark.catalog.tableExists("shop.items")


def test_nested_columns_become_json(spark):
    df = spark.sql(
        "SELECT named_struct('a', 1, 'b', array('x')) AS s, map('k', 2) AS m, "
        "CAST(NULL AS ARRAY<INT>) AS e, 1.5D AS d, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t"
    )
    (row,) = st.stringify_complex(df).collect()
    assert tuple(row) == ('{"a":1,"b":["x"]}', '{"k":2}', None, "1.5", "2024-01-02 03:04:05")


def test_changes_tell_null_from_empty(spark):
    old = spark.createDataFrame([(1, "a"), (2, ""), (3, "c"), (4, None)], "id int, t string")
    new = spark.createDataFrame([(1, "a"), (2, None), (4, None), (5, "e")], "id int, t string")
    got = changes.table_snapshot_changes(old, new, "id", ["t"])
    assert sorted((r.id, r.change) for r in got.collect()) == [
        (2, "update"), (3, "delete"), (5, "insert"),
    ]


def test_scalars_and_registered_functions(spark):
    scalars.register_functions(spark)
    row = spark.sql(
        "SELECT count_words(' a  b\nc ') AS n, count_words('') AS z, count_words(NULL) AS e, "
        "user_prefix('ann.lee@example.com') AS p"
    ).first()
    assert tuple(row) == (3, 0, None, "ann_007")
    df = spark.createDataFrame([("ann.lee@example.com", "!!")], "e string, b string")
    row = df.select(
        scalars.user_prefix(F.col("e")), scalars.decode_base64(F.col("b")),
        scalars.in_set(F.lit(None), ["a"]),
    ).first()
    assert tuple(row) == ("ann_007", None, False)


def test_digest_trees_leave_equal_buckets_out(spark):
    rows = [(i, f"text {i}", None if i % 9 == 0 else i) for i in range(3000)]
    later = [(i, "changed" if i == 77 else t, 5 if i == 90 else v) for i, t, v in rows if i != 2500] + [(9001, "new", 1)]
    shape = "id long, t string, v long"
    old, new = spark.createDataFrame(rows, shape), spark.createDataFrame(later[::-1], shape)
    trees = [changes.digest_tree(d, "id", ["t", "v"], 1 << 12) for d in (old, new)]
    differ = {r.bucket for r in changes.unequal_buckets(*trees).collect()}
    touched = spark.createDataFrame([(i,) for i in (77, 90, 2500, 9001)], "id long")
    assert differ == {r[0] for r in touched.select(F.pmod(F.xxhash64("id"), F.lit(1 << 12))).collect()}
    want = {(77, "update"), (90, "update"), (2500, "delete"), (9001, "insert")}
    given = {"old_tree": trees[0], "new_tree": trees[1]}
    for trees in ({}, given):
        got = changes.table_snapshot_changes(old, new, "id", ["t", "v"], buckets=1 << 12, **trees)
        assert {(r.id, r.change) for r in got.collect()} == want
    assert changes.table_snapshot_changes(old, old, "id", ["t", "v"]).isEmpty()
    assert changes.table_snapshot_changes(old.limit(0), old, "id", ["t"]).count() == 3000
