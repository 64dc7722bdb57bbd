"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_EVENT_LOG=/some/scratch/dir python bench.py   # also write an event log
                                                        # (see tools/stages.py)

Each query is run to completion with the ``noop`` sink (full computation,
no collection to the driver). Prints one JSON line.

``tfidf_scores`` builds and stores the search index (token and score
tables); the search queries after it read that stored index, as the
reference's searches read its precomputed score table.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sift.plans import queries as Q  # noqa: E402
from sift.session import build_session  # noqa: E402

HEADLINE = [
    "tfidf_scores",          # index build: clean, count, df, scores
    "search_batch",          # batch AND/OR search, ranked
    "search_or",             # one interactive query with scan pruning
    "ranked_postings",       # builds the rank-ordered postings that pages and counts read
    "search_page",           # one page of every query of the batch
    "search_matched_page",   # the same by matched tokens alone (builds the block index)
    "search_page_info",      # paging over the batch
    "bigram_counts",         # n-gram extraction over all texts
    "trigram_counts",
    "ngram_vocabulary",      # vocabulary of the labelled comments
    "share_all",             # all share tables in one pass
    "share_by_day",          # comment binding + conditional aggregate
    "share_by_story",
    "report_states",
    "top_stories_pos",
    "stream_share_by_day",   # the day table kept by a stream, two landings
    "ml_score",              # train both classifiers and score all comments
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG")  # optional: stage/task times
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", app_name="sift-bench",
                          shuffle_partitions=max(8, 2 * cpus), extra=extra)
    # Warm-up outside the timings: JVM class loading and code generation
    # start-up would otherwise be charged to whichever query runs first.
    spark.range(1000).selectExpr("sum(id)").collect()
    timings, errors = {}, {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            df = Q.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report, keep measuring the rest
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
