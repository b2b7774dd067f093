"""Time the headline queries: one JSON line on standard output.

Each query runs once to warm up and then ``BENCH_RUNS`` times (2); the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from corpusmill.session import build_session  # noqa: E402

HEADLINE = (
    "curate",
    "curation_funnel",
    "gopher_stats",
    "mask_pii",
    "normalize_text",
    "html_to_text",
    "line_counts",
    "exact_line_dedup",
    "minhash_signature",
    "duplicate_pairs",
    "duplicate_clusters",
    "fuzzy_dedup",
    "sample_k",
    "balanced_training_set",
    "classify_language",
    "build_vocab",
    "encode_tokens",
    "token_windows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
