"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores, BENCH_QUERIES (a comma
list, or ``all``) the queries, BENCH_RUNS how often each runs; the median counts. Every
query writes its full result to the no-op sink. Raw files and documents that queries read are
landed once, before, and timed as ``landing_*``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ladderlake import queries  # noqa: E402
from ladderlake.queries import REGISTRY  # noqa: E402
from ladderlake.session import build_session  # noqa: E402

HEADLINE = (
    "top_n_players",
    "rank_players",
    "count_by_tier",
    "distinct_players",
    "describe_by_tier",
    "null_percentages",
    "explode_participants",
    "match_facts_stored",
    "json_scan_standings",
    "landing_dedup",
    "lookup_chain",
    "recent_matches_per_player",
    "matches_of_top_players",
    "schema_drift",
    "job_standings_gold",
    "job_match_gold",
    "job_top_matches",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and its code generation is not part of any query.
    REGISTRY["top_n_players"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds, spread = {}, {}
    for name in ("landed_standings", "landed_matches", "stored_docs"):
        start = time.perf_counter()
        path = getattr(queries, name)(spark, sf_dir)
        seconds[name.replace("landed", "landing").replace("stored", "landing")] = round(time.perf_counter() - start, 3)
        setattr(queries, name, lambda spark, sf_dir, path=path: path)
    for name in names:
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": spread,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
