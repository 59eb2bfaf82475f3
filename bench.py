"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every query is
run to completion with all its columns (a ``noop`` sink), once to warm up at the
smallest size and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from glotta.plans.registry import QUERIES  # noqa: E402
from glotta.session import build_session  # noqa: E402

HEADLINE = [
    "clean_text", "normalize_document", "word_frequencies", "word_frequencies_top", "docs_by_language",
    "fit_language_profiles", "detect_language", "route_translation", "translation_batches", "translate_batch",
    "translate_corpus", "translate_detected", "translation_lookup", "keep_in_vocabulary", "lemmatize_pos_filter",
    "stem_vocabulary", "document_to_vector", "holdout_split", "classification_report_language", "train_classifier",
    "score_documents", "kmeans_topics", "nearest_words", "build_dictionary", "bag_of_words", "topic_word_weights",
    "topic_term_relevance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["word_frequencies"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
