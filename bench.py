"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma separated) a selection and
BENCH_RUNS the timed runs after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusops.registry import QUERIES  # noqa: E402
from corpusops.session import build_session  # noqa: E402

HEADLINE = [
    "clean_filter_count", "clean_text", "word_count", "sentence_split", "remove_stopwords", "ascii_dates_removed",
    "lemma_join", "dedup_label_priority", "dedup_by_text", "stratified_sample", "time_split", "lookup_last_wins",
    "frequent_sentences", "remove_frequent_sentences", "exclusive_words_topn", "remove_exclusive_words",
    "full_text_processing", "rule_classify", "rule_classification_report", "classification_metrics", "pr_auc",
    "doc_frequency", "vocab_size_by_min_df", "tfidf_long", "extract_links", "link_page_join", "div_text",
    "two_class_probability", "csv_round_trip", "fit_predict_logreg",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)  # warm-up
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    sf = float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
