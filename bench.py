"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from boxframe.plans import catalog
from boxframe.session import local_session

HEADLINE = (
    "threshold_sweep",
    "match_greedy",
    "candidate_pairs",
    "average_precision",
    "content_leak",
    "split_official",
    "distribution",
    "box_normalize",
    "label_text",
    "label_parse",
    "video_summary",
    "running_detections",
    "split_hash",
    "validation_report",
    "stream_video_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "boxframe-bench", shuffle=int(cpus) if cpus.isdigit() else 8)
    # Start-up of the JVM and the first compilation of the matching code are not part of any query.
    catalog.QUERIES["threshold_metrics"](spark, folder).collect()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
