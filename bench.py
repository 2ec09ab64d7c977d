"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from assetlake.queries import load
from assetlake.session import build_session

HEADLINE = [
    "normalize_category",
    "map_category",
    "normalize_channel",
    "channel_from_member",
    "channel_from_tokens",
    "first_channel_wins",
    "archive_safety",
    "safe_members",
    "search_range",
    "search_scored_topk",
    "merge_index",
    "check_index",
    "hash_payloads",
    "pivot_channels",
    "drop_invalid_channels",
    "content_duplicates",
    "verify_hashes",
    "estimate_size",
    "chunk_by_count",
    "chunk_by_bytes",
    "payload_offsets",
    "lookup_texture",
    "merge_rowmaps",
    "check_rowmap",
    "bundle_roundtrip",
    "derive_tier",
    "parse_asset_names",
    "manifest_rollup",
    "diff_snapshots",
    "flatten_release",
    "validate_release",
    "reconcile",
    "to_threejs",
    "to_gltf",
    "to_mtlx",
    "rewrite_texture_paths",
    "catalog_sections",
    "storage_usage",
    "throughput",
    "rate_window",
    "rowmap_retrofit",
    "bake",
    "publish_tier",
    "fetch_all",
    "materialize",
    "rotating_sink",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load()
    times = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)  # the first run warms up
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds per query",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
