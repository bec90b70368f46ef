"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma-separated names instead of the headline set, or ``all``
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from casewright.session import local_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "ticket_outcomes", "normalize_text", "redact_email", "contains_any", "count_occurrences", "sentiment_by_lexicon",
    "calibrate_severity", "calibration_summary", "collapse_label", "safe_parse_json", "extract_function_args",
    "classification_report", "confusion_matrix", "eval_runs", "multi_task_eval", "join_labels_tickets", "enrich_join",
    "align_by_position", "resume_anti_join", "stratified_folds", "collapse_rare_classes", "tokenize", "count_vectorize",
    "embed_text", "knn_cosine", "knn_ann", "build_fewshot_prompt", "classify_zero_shot", "classify_rag", "enrich_tickets",
    "resume_incremental", "tfidf", "cross_val_predict",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, app="bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
