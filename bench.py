"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (comma
separated, or ``all``) a different choice of queries.
"""

import json
import os
import time

from fernway.plans.catalog import QUERIES
from fernway.session import local_session

HEADLINE = """
potential_eval_set dedup_assessment_log union_feedback attach_ground_truth zip_filter
read_text_files parse_article parse_ticket html_to_text table_snapshot_changes
recursive_chunk window_chunk structural_chunk synthetic_questions
embed_text vector_top_k knn_join ann_top_k retrieve_context index_sync lookup_then_retrieve
extract_keywords extract_emails extract_codes note_severity
visit_practice_join feature_lookup visits_per_patient mode_per_key latest_note pct_drop
conversation_history stratified_sample variant_grid rank_variants
batch_predict parse_typed_output text_classifier run_scorers score_summary score_language
score_overlap score_relevance score_latency trajectory_tools
gen_visits stream_index_sync stream_quality_monitor
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session("fernway-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dedup_assessment_log"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
