"""WARC archives: writing with revisits, and reading by verified record boundaries."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.joins import lookup_join
from ..session import new_work_path
from .common import begin, packed, saved, sha256, text_or_empty

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORDS_PER_FILE = 2000
CANDIDATE = (
    "path string, block long, rel long, size long, head int, length long, record_type string, "
    "page_id long, refers_to long, digest string, named string, whole boolean, payload binary"
)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; control characters can't start a line of their own."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def with_revisits(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """``page_id, url, html, digest, n_bytes, refers_to``; ``refers_to`` is null for responses.

    Payloads of ``least`` bytes or more meet by SHA-256 and length. Only digests that occur
    again, counted with partial sums, are joined; their partitions are split where one is hot.
    """
    rows = packed(pages).select(
        F.col(f"doc.{page_id}").cast("long").alias("page_id"),
        F.col(f"doc.{url}").alias("url"),
        text_or_empty(F.col(f"doc.{html}")).alias("html"),
    )
    rows = rows.withColumn("digest", sha256(F.col("html"))).withColumn(
        "n_bytes", F.octet_length("html").cast("long")
    )
    firsts = (
        rows.where(F.col("n_bytes") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1 AND _first IS NOT NULL")
        .select("digest", "_first")
    )
    joined = lookup_join(rows, saved(firsts, "warc-firsts"), ["digest"], "left")
    again = F.col("page_id").isNull() | (F.col("page_id") > F.col("_first"))
    return joined.withColumn("refers_to", F.when(again, F.col("_first"))).drop("_first")


def write_warc(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    *,
    least: int = 100,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record per row, as files of at most ``records_per_file`` records.

    Of equal payloads of ``least`` bytes or more, the least id is a ``response``; others are
    ``revisit`` records without a payload that name it. Null payloads are empty; null ids and
    URLs leave out their header. Rows equal in id and payload are all responses. Spark's own writer
    puts the end of a record after each, so files are committed task by task.
    """
    rows = with_revisits(pages, page_id, url, html, least)
    revisit = F.col("refers_to").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    record = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "),
        F.when(revisit, F.lit("revisit\r\n")).otherwise(F.lit("response\r\n")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        _line("WARC-Target-URI", F.col("url")),
        F.lit("WARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\n"),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}\r\n")).otherwise(F.lit("")),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(END),
        payload,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


_FIELD = re.compile(
    rb"^(WARC-Type|WARC-Record-ID|WARC-Refers-To|WARC-Payload-Digest|Content-Length):[ \t]*(.*?)[ \t]*\r$",
    re.M | re.I,
)
_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def parse_head(piece: bytes):
    """Header end and fields of what follows a magic; none if that is no header."""
    end = piece.find(END.encode())
    if end < 0:
        return None
    fields = {k.lower(): v.decode("latin-1") for k, v in _FIELD.findall(piece[: end + 2])}
    length = fields.get(b"content-length", "")
    if not length.isascii() or not length.isdigit():
        return None
    return end + len(END), int(length), fields


def _page(value: str | None) -> int | None:
    found = _PAGE.match(value or "")
    return int(found[1]) if found else None


def _candidates(batches):
    """Every piece between two magics, with its place in its file split and its header."""
    from hashlib import sha256 as sha

    at: dict = {}
    for batch in batches:
        rows = []
        for path, block, piece in zip(batch["path"], batch["block"], batch["piece"]):
            rel = at.get((path, block), 0)
            at[path, block] = rel + len(piece) + len(MAGIC)
            head = parse_head(piece)
            if head is None:
                rows.append((path, block, rel, len(piece), *[None] * 7, False, None))
                continue
            start, length, f = head
            body = piece[start : start + length]
            whole = len(body) == length
            rows.append(
                (
                    path, block, rel, len(piece), start, length, f.get(b"warc-type"),
                    _page(f.get(b"warc-record-id")), _page(f.get(b"warc-refers-to")),
                    sha(body).hexdigest() if whole else None,
                    f.get(b"warc-payload-digest", "").removeprefix("sha256:"), whole, None,
                )
            )
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in CANDIDATE.split(", ")])
        yield out.astype({c: "Int64" for c in ("head", "length", "page_id", "refers_to")})


def _pieces(spark, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )


def reachable(records: DataFrame) -> DataFrame:
    """The rows of ``path, offset, next`` that a walk from the file's start comes to.

    Pointer jumping: in round k every row knows the row 2^k steps on, and what is 2^k steps after
    a reached row is reached too; so a file of n records takes log2(n) rounds of one join each.
    """
    jumps = saved(records.select("path", "offset", "next"), "warc-jumps")
    reached = saved(jumps.where("offset = 0").select("path", "offset"), "warc-reached")
    known = records.select("path", "offset")
    n = reached.count()
    while n:
        onward = jumps.join(reached, ["path", "offset"], "left_semi").select(
            "path", F.col("next").alias("offset")
        )
        reached = saved(
            reached.union(onward.join(known, ["path", "offset"], "left_semi")).distinct(),
            "warc-reached",
        )
        now = reached.count()
        if now == n:
            return reached
        n = now
        far = jumps.select("path", F.col("offset").alias("next"), F.col("next").alias("_far"))
        jumps = saved(
            jumps.join(far, ["path", "next"]).select("path", "offset", F.col("_far").alias("next")),
            "warc-jumps",
        )
    return reached


def read_warc(spark, path: str) -> DataFrame:
    """Records of all archives below ``path``: ``path, offset, record_type, page_id, refers_to, named,
    payload_bytes, payload_digest``; ``named`` is the digest that the header states, the last two are
    those of the payload that the record itself has.

    Files are split at every magic, wherever a task's part begins. Pieces of a split fill it
    without gaps, so a split's place in its file is the sum of the splits before. Each piece with
    a header proposes a record and the offset of its successor; only those reachable from
    the file's start are records. A magic inside a payload cuts a record into several pieces,
    which are put together again in a second reading, for such records only. What follows a
    broken record isn't reachable and is left out. Empty folders give no rows.
    """
    begin(spark)
    found = saved(
        _pieces(spark, path).mapInPandas(_candidates, CANDIDATE).drop("payload"), "warc-candidates"
    )
    before = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = (
        found.groupBy("path", "block")
        .agg(F.sum(F.col("size") + len(MAGIC)).alias("_bytes"))
        .select("path", "block", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_base"))
    )
    splits = saved(splits, "warc-splits")
    # A piece begins behind its magic, whose offset is the record's; the first piece is before any.
    offset = F.col("_base") + F.col("rel") - len(MAGIC)
    placed = found.join(splits, ["path", "block"]).withColumn("offset", offset)
    placed = saved(placed.drop("_base"), "warc-placed")
    records = placed.where("head IS NOT NULL AND offset >= 0").withColumn(
        "next", F.col("offset") + len(MAGIC) + F.col("head") + F.col("length") + len(END)
    )
    real = saved(
        records.join(reachable(records), ["path", "offset"], "left_semi"), "warc-records"
    )
    simple = real.where("whole").select(
        "path", "offset", "record_type", "page_id", "refers_to", "named",
        F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
    )
    cut = real.where("NOT whole")
    if cut.isEmpty():
        return simple
    # Pieces that belong to a cut record: from it to its successor, in cells of one record's width.
    owner = W.partitionBy("path").orderBy("offset")
    marks = placed.where("offset >= 0").select("path", "block", "rel", "offset").join(
        real.select("path", "offset", F.lit(True).alias("_real"), "whole"), ["path", "offset"], "left"
    )
    last = F.last(F.when(F.col("_real"), F.struct("offset", "whole")), ignorenulls=True)
    owned = marks.withColumn("_own", last.over(owner)).where("NOT _own.whole").select(
        "path", "block", "rel", "offset", F.col("_own.offset").alias("owner")
    )
    owned = saved(owned, "warc-owned")

    def numbered(batches):
        at: dict = {}
        for batch in batches:
            rel = []
            for path, block, piece in zip(batch["path"], batch["block"], batch["piece"]):
                rel.append(at.get((path, block), 0))
                at[path, block] = rel[-1] + len(piece) + len(MAGIC)
            yield batch.assign(rel=rel)

    again = _pieces(spark, path).mapInPandas(
        numbered, "path string, block long, piece binary, rel long"
    )
    whole = (
        again.join(owned, ["path", "block", "rel"])
        .groupBy("path", F.col("owner").alias("offset"))
        .agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("_pieces"))
    )
    joined = F.aggregate(
        F.slice("_pieces", 2, F.greatest(F.size("_pieces") - 1, F.lit(0))),
        F.get("_pieces", F.lit(0))["piece"],
        lambda acc, p: F.concat(acc, F.lit(MAGIC.encode()), p["piece"]),
    )
    body = F.substring(joined, F.col("head") + 1, F.col("length").cast("int"))
    complete = cut.join(whole, ["path", "offset"]).select(
        "path", "offset", "record_type", "page_id", "refers_to", "named",
        F.col("length").alias("payload_bytes"), F.sha2(body, 256).alias("payload_digest"),
    )
    return simple.union(complete)


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload size and digest of the response that a revisit names.

    A revisit names an id and, in its own header, the digest of the payload. Both must agree with the
    response, so ids that several payloads share don't mix them up.
    """
    records = saved(records, "warc-read")
    asked = records.where("refers_to IS NOT NULL").select("refers_to", "named").distinct()
    responses = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named"), "payload_bytes"
    )
    payloads = saved(
        responses.join(asked, ["refers_to", "named"], "left_semi")
        .groupBy("refers_to", "named")
        .agg(F.max("payload_bytes").alias("_bytes")),
        "warc-payloads",
    )
    found = F.col("_bytes").isNotNull()
    return lookup_join(records, payloads, ["refers_to", "named"], "left").select(
        "page_id",
        F.coalesce("_bytes", "payload_bytes").alias("payload_bytes"),
        F.when(found, F.col("named")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages as archives in the shared work area and read them back."""
    path = new_work_path(pages.sparkSession, "warc")
    write_warc(pages, path, **options)
    return resolved(read_warc(pages.sparkSession, path))
