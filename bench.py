"""Headline queries, timed; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names) choose what is run.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from scanledger.plans.queries import all_queries  # noqa: E402
from scanledger.session import build_session  # noqa: E402

HEADLINE = (
    "report_regions",
    "report_sentences",
    "concept_mentions",
    "concept_labels",
    "concept_labels_wide",
    "concept_counts",
    "requests_categories",
    "requests_questions",
    "requests_resumed",
    "label_prompts",
    "response_lines",
    "responses_valid",
    "stage_append",
    "nest_flatten",
    "final_results",
    "all_stages_run",
    "response_labels",
    "quote_checks",
    "sampled_reports",
    "qc_categories",
    "qc_questions",
    "eval_questions",
    "imperfect_tasks",
    "coverage_metrics",
    "evaluable_metrics",
    "reports_last_wins",
    "json_reports",
    "stream_labels",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "scanledger.partitions": cpus}
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = all_queries()
    # Start the session and its compilers on a small scan before timing.
    spark.range(1000).selectExpr("sum(length(md5(CAST(id AS STRING))))").collect()
    took = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = Path(sf_dir).name.removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec"}
    print(json.dumps({**line, "queries": took, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))


if __name__ == "__main__":
    main()
