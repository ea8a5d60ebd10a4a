"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores            (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from postloom.session import build_session  # noqa: E402

HEADLINE = [
    "standardize_tapneo", "standardize_jsearch", "standardize_jooble", "standardize_freehire",
    "standardize_tanqeeb", "skip_reasons", "mart_skill_demand", "skills", "skills_context",
    "term_matches", "clean_description", "title_from_description", "html_text", "page_links",
    "page_posting", "unseen_urls", "link_stats", "dedup_keep_first",
    "dedup_latest_repost_count", "repost_counts", "merge_first_last_seen", "merge_staging",
    "mart_daily_rolling", "stream_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["clean_title"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
