"""The driver's tables, and views over them that stand in for logs.

Each view is stated as portable SQL for the oracle (``VIEW_SQL``). ``Tables`` gives
the same rows as DataFrames, in forms that do not need one task per key.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.ordered import dense_number, neighbour_value
from ..session import tune

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}

# The view definitions of FIXTURES.md.
VIEW_SQL = {
    "request_log": """
        SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS req_no,
               concat('c', conv_id, '-', turn) AS request_id, text AS request,
               next_text AS response
        FROM (SELECT conv_id, turn, role, text,
                     lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
                     lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
              FROM conversations) t
        WHERE role = 'user' AND next_role = 'assistant'""",
    "assessment_log": """
        SELECT user_id AS req_no, concat('u', event_id % 3) AS source_id, ts, event_id,
               'retriever' AS step_id,
               CASE event_type WHEN 'signup' THEN 'positive' WHEN 'purchase' THEN 'negative'
                    WHEN 'error' THEN 'unknown' END AS answer_rating,
               CASE WHEN event_type IN ('signup', 'purchase', 'error')
                    THEN CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('edit ', event_id)
                         END END AS suggested_output,
               CASE WHEN event_type IN ('view', 'click') THEN event_id % 4 END AS position,
               CASE event_type WHEN 'view' THEN 'true' WHEN 'click' THEN 'false'
                    END AS chunk_rating
        FROM events""",
    "trace_chunks": """
        SELECT r.req_no, d.doc_id % 4 AS position, concat('doc/', d.doc_id) AS doc_uri,
               d.text AS content
        FROM request_log r JOIN documents d ON (d.doc_id - d.doc_id % 4) / 4 = r.req_no""",
    "spans": """
        SELECT user_id AS trace_id, event_id AS span_id,
               CASE event_type WHEN 'click' THEN 'CHAT_MODEL' WHEN 'view' THEN 'RETRIEVER'
                    ELSE 'TOOL' END AS span_type,
               event_id * 1000000000 AS start_ns,
               event_id * 1000000000 + CAST(round(value * 100) AS BIGINT) * 10000000 AS end_ns
        FROM events""",
    "visits": """
        SELECT o.o_orderkey AS visit_id, c.c_name AS patient, c.c_mktsegment AS insurer,
               CASE c.c_custkey % 3 WHEN 0 THEN 'HMO' WHEN 1 THEN 'PPO' ELSE 'EPO' END AS plan,
               CASE WHEN c.c_custkey % 5 <> 0 THEN concat('P-', c.c_custkey) END
                    AS policy_number,
               concat('CITY_', o.o_orderkey % 3) AS city, o.o_orderkey % 10 AS practice_id,
               CAST(o.o_orderdate AS DATE) AS visit_date, o.o_orderpriority AS reason,
               o.o_orderstatus AS status
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "practices": """
        SELECT s_suppkey AS practice_id, s_name AS practice_name,
               concat('CITY_', s_suppkey % 3) AS city,
               CASE s_suppkey % 5 WHEN 0 THEN 'HOUSEHOLD' WHEN 1 THEN 'BUILDING'
                    WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'MACHINERY' ELSE 'FURNITURE' END
                    AS insurer,
               CASE WHEN s_acctbal >= 5000 THEN 'In Network' ELSE 'Out of Network' END
                    AS network_status
        FROM supplier""",
    "quotes": """
        SELECT concat('s', user_id % 20) AS symbol, CAST(ts AS DATE) AS day,
               max_by(value, event_id) AS close, max(value) AS day_high, min(value) AS day_low,
               count(*) AS volume
        FROM events GROUP BY 1, 2""",
    "examples": """
        SELECT d.doc_id AS example_id, d.text AS template, CAST(l.quality AS STRING) AS target,
               CASE WHEN d.doc_id % 7 = 0 THEN CAST(1 - l.quality AS STRING)
                    ELSE CAST(l.quality AS STRING) END AS prediction,
               CASE d.doc_id % 5 WHEN 1 THEN 'YES' WHEN 2 THEN 'NO' WHEN 3 THEN 'YES' END
                    AS verdict,
               CASE d.doc_id % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Low'
                    ELSE 'n/a' END AS tool_rating,
               CASE d.doc_id % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END
                    AS format_rating
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "snapshot_old": """
        SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN concat(text, ' old') ELSE text END AS text
        FROM documents WHERE doc_id % 10 <> 0""",
    "snapshot_new": "SELECT doc_id, text FROM documents WHERE doc_id % 11 <> 0",
    # Views of our own, for operators whose inputs no table holds.
    "article_files": """
        SELECT doc_id,
               concat('kb/', CASE doc_id % 4 WHEN 0 THEN 'faq' WHEN 1 THEN 'policy'
                      WHEN 2 THEN 'guide' ELSE 'procedure' END, '/',
                      CASE doc_id % 3 WHEN 0 THEN 'billing' WHEN 1 THEN 'technical'
                      ELSE 'account' END, '/KB-', doc_id, '.txt') AS path,
               concat('ID: KB-', doc_id, chr(10), 'Type: ',
                      CASE doc_id % 4 WHEN 0 THEN 'FAQ' WHEN 1 THEN 'Policy'
                      WHEN 2 THEN 'Guide' ELSE 'Procedure' END, chr(10), 'Category: ',
                      CASE doc_id % 3 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Technical'
                      ELSE 'Account' END, chr(10), 'Subcategory: from ', source, chr(10),
                      'Title: About ', source, ': part ', doc_id, chr(10),
                      'Tags: ', lang, ', ', source, ',help', chr(10),
                      'Last Updated: 2021-05-', lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0'),
                      ' 07:08:09', chr(10), 'Generated: 2022-02-03T04:05:06', chr(10), chr(10),
                      '---', chr(10), chr(10), text) AS text
        FROM documents""",
    "ticket_files": """
        SELECT o_orderkey,
               concat('tickets/', CAST(year(o_orderdate) AS STRING), '/',
                      lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/TICK-', o_orderkey,
                      '.txt') AS path,
               concat('Ticket ID: TICK-', o_orderkey, chr(10), 'Customer ID: CUS-', o_custkey,
                      chr(10), 'Subscription ID: SUB-', o_custkey + 1000, chr(10),
                      'Category: Billing', chr(10), 'Priority: ', o_orderpriority, chr(10),
                      'Status: ', CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed'
                      ELSE 'Resolved' END, chr(10), 'Created: ',
                      CAST(CAST(o_orderdate AS DATE) AS STRING), ' 20:47:57', chr(10),
                      'Agent ID: TEC-', o_orderkey % 97,
                      CASE WHEN o_orderstatus = 'O' THEN '' ELSE concat(chr(10), 'Resolved: ',
                      CAST(CAST(o_orderdate AS DATE) + 1 AS STRING), ' 20:47:57') END,
                      chr(10), chr(10), '---', chr(10), 'DESCRIPTION:', chr(10), '---', chr(10),
                      chr(10), 'Order ', o_orderkey, ' fails: ERR-', o_orderkey % 11, chr(10),
                      chr(10), '---', chr(10), 'RESOLUTION:', chr(10), '---', chr(10), chr(10),
                      'Ticket TICK-', o_orderkey, ' was answered by TEC-', o_orderkey % 97)
                      AS text
        FROM orders""",
    "trajectories": """
        SELECT req_no, request,
               concat('{"thought_0":"look","tool_name_0":"',
                      CASE req_no % 3 WHEN 0 THEN 'patient_lookup' WHEN 1 THEN 'web_search'
                      ELSE 'insurance_lookup' END,
                      '","tool_name_1":"',
                      CASE req_no % 4 WHEN 0 THEN 'web_search' ELSE 'patient_lookup' END,
                      '"', CASE WHEN req_no % 2 = 0 THEN ',"tool_name_10":"finish"' ELSE '' END,
                      '}') AS trajectory
        FROM request_log""",
    "model_texts": """
        SELECT doc_id,
               CASE doc_id % 5
                    WHEN 4 THEN concat('Sorry, no answer for ', doc_id)
                    WHEN 3 THEN concat('{"label":"', lang, '"}')
                    ELSE concat('{"label":"', lang, '","score":', doc_id % 10,
                                ',"ok":', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END,
                                '}') END AS raw
        FROM documents""",
    "answers": """
        SELECT e.example_id, e.target,
               concat(CASE e.example_id % 6 WHEN 0 THEN 'Mortgage Loan' WHEN 1 THEN 'Credit Card'
                      WHEN 2 THEN 'Auto Loan' WHEN 3 THEN 'None' WHEN 4 THEN 'Home loan'
                      ELSE 'Unsure' END, '. ',
                      CASE e.example_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'It names the product.'
                      WHEN 2 THEN 'It names the product. It has a rate.'
                      ELSE e.template END) AS response,
               CASE e.example_id % 6 WHEN 3 THEN 'None' WHEN 5 THEN 'None'
                    ELSE 'Credit Card' END AS expected,
               CASE e.example_id % 4 WHEN 0 THEN 'correct_and_well_reasoned'
                    WHEN 1 THEN 'correct_but_poorly_reasoned' WHEN 2 THEN 'incorrect'
                    ELSE 'unclear' END AS rating
        FROM examples e""",
}
VIEW_NEEDS = {
    "trace_chunks": ["request_log"],
    "trajectories": ["request_log"],
    "answers": ["examples"],
}


def with_views(sql: str, *names: str) -> str:
    """Oracle SQL with the named views, and those they need, in front of it."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in VIEW_NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in wanted)
    sql = sql.strip()
    if not views:
        return sql
    if sql[:5].upper() == "WITH ":
        return f"WITH {views},\n{sql[5:]}"
    return f"WITH {views}\n{sql}"


class Tables:
    """Tables and views of one scale-factor folder; everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self._read(name)
        if name in VIEW_SQL:
            return self._view(name)
        raise AttributeError(name)

    def _read(self, name: str) -> DataFrame:
        """A base table. One of texts that is stored in fewer splits than there are cores,
        as here in a single file, is spread by its key; a table of many splits is not."""
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        key = TEXT_KEYS.get(name)
        cores = self.spark.sparkContext.defaultParallelism
        if key and table.select(key).rdd.getNumPartitions() < cores:
            return table.repartition(cores, key)
        return table

    def _view(self, name: str) -> DataFrame:
        """Run a portable view over named inputs, without touching the catalog."""
        sql = VIEW_SQL[name].replace("{", "{{").replace("}", "}}")
        inputs = {}
        for table in [*BASE, "request_log", "examples"]:
            for word in (f"FROM {table}", f"JOIN {table}"):
                if word in sql:
                    sql = sql.replace(word, f"{word.split()[0]} {{{table}}}")
                    inputs[table] = getattr(self, table)
        return self.spark.sql(sql, **inputs)

    @cached_property
    def request_log(self) -> DataFrame:
        turns = neighbour_value(
            self.conversations,
            ["conv_id"],
            "turn",
            F.expr("turn div 4096"),
            {"next_role": "role", "response": "text"},
            following=True,
        )
        asked = turns.where("role = 'user' AND next_role = 'assistant'").select(
            "conv_id",
            "turn",
            F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("request_id"),
            F.col("text").alias("request"),
            "response",
        )
        numbered = dense_number(asked, ["conv_id", "turn"], "req_no")
        return numbered.select("req_no", "request_id", "request", "response")

    @cached_property
    def trace_chunks(self) -> DataFrame:
        documents = self.documents.select(
            F.expr("doc_id div 4").alias("req_no"),
            (F.col("doc_id") % 4).alias("position"),
            F.concat(F.lit("doc/"), "doc_id").alias("doc_uri"),
            F.col("text").alias("content"),
        )
        return documents.join(self.request_log.select("req_no"), "req_no", "left_semi")

    @cached_property
    def nested_assessments(self) -> DataFrame:
        """The assessment log in its nested shape, one row per reviewer click."""

        def rated(value, **fields):
            ratings = F.struct(F.struct(value.alias("value")).alias("answer_correct"))
            return F.struct(
                *[c.alias(n) for n, c in fields.items()], ratings.alias("ratings")
            )

        flat = self.assessment_log
        return flat.select(
            F.col("req_no").alias("request_id"),
            F.col("ts").alias("timestamp"),
            "event_id",
            F.struct(F.col("source_id").alias("id")).alias("source"),
            "step_id",
            F.when(
                F.col("answer_rating").isNotNull(),
                rated(F.col("answer_rating"), suggested_output=F.col("suggested_output")),
            ).alias("text_assessment"),
            F.when(
                F.col("position").isNotNull(),
                rated(
                    F.col("chunk_rating"), position=F.col("position"), step_id=F.col("step_id")
                ),
            ).alias("retrieval_assessment"),
        )

    @cached_property
    def traced_requests(self) -> DataFrame:
        """The request log with its trace as JSON text; four chunks per trace."""
        # Four documents make a request's chunks; requests without any keep NULL.
        outputs = self.documents.groupBy(F.expr("doc_id div 4").alias("req_no")).agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        (F.col("doc_id") % 4).alias("position"),
                        F.concat(F.lit("doc/"), "doc_id").alias("doc_uri"),
                        F.col("text").alias("content"),
                    )
                )
            ).alias("c")
        )
        span = F.struct(
            F.lit("RETRIEVER").alias("span_type"),
            (F.col("req_no") * 1_000_000_000).alias("start_time_ns"),
            (F.col("req_no") * 1_000_000_000 + 2_000_000_000).alias("end_time_ns"),
            F.transform(
                "c",
                lambda x: F.struct(
                    x["content"].alias("page_content"),
                    F.struct(x["doc_uri"].alias("doc_uri")).alias("metadata"),
                ),
            ).alias("outputs"),
        )
        trace = F.to_json(F.struct("request", "response", F.array(span).alias("spans")))
        return self.request_log.join(outputs, "req_no", "left").select(
            F.col("req_no").alias("log_request_id"),
            "request",
            "response",
            F.when(F.col("c").isNotNull(), trace).alias("trace"),
        )
