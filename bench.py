"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchloom.plans import registry, views  # noqa: E402
from matchloom.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Feature-store tables are timed as builds of their own; the queries then read them.
TABLES = ("contest", "rated", "match_features", "profile", "title_odds")
HEADLINE = (
    "a1_dedup a5_pair_record a6_rollup a9_kpi_long a12_latest a14_power_index a21_class_report f4_any_column_search j5_asof j9_pair_features "
    "o1_sort p11_round p15_normalize_id s8_profile w2_global_rank w3_min_ranks w4_rolling_form w5_expanding_stats w6_elo_final w8_chrono_split w7_match_features j10_head_to_head "
    "m3_logreg m8_persistence"
).split()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    seconds: dict[str, float] = {}

    def timed(name, run) -> None:
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    spark.range(1000).count()  # JVM start-up is not part of a query
    for name in TABLES:
        timed(f"build_{name}", lambda: getattr(views, name)(spark, SF_DIR))
    for name in HEADLINE:
        timed(name, lambda: registry.QUERIES[name](spark, SF_DIR))
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(SF_DIR).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
