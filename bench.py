"""Benchmark of the headline queries.

Runs each query warm (an untimed pass over the whole set, then the median
of 3 per query) at
$BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line.  Results are forced with the ``noop`` sink, so
nothing is collected to the driver.

usage: python bench.py [--all] [name ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "a01_zonal_mean", "a02_region_mean", "a03_pivot_wide", "j14_zone_product", "j17_rolling_bundle",
    "j01_priority_merge", "j07_missing_hours", "w02_interpolate", "a07_keep_last", "j15_cluster_to_pixel",
    "j12_reproject", "j11_zone_pixels", "m02_factorised_mean", "a01_polygon_zonal_mean", "io06_wide_csv_sink",
    "t02_rolling_revision", "chain_zone_products", "chain_hourly_forcing", "io09_raster_per_day", "io03_text_roundtrip",
    "io04_text_sink", "t01_stream_dedupe", "t03_day_completeness",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    from firn.plans import registry
    from firn.session import build_session
    registry.load_all()
    names = list(registry.QUERIES) if "--all" in sys.argv else (args or HEADLINE)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus)

    def run(name):
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up pass over the whole set (JIT, file listings, caches)
        run(name)
    out = {}
    for name in names:
        out[name] = round(statistics.median(run(name) for _ in range(3)), 3)
        print(f"# {name} {out[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "shuffle_partitions": 2 * cpus, "mode": "warm median of 3"}))


if __name__ == "__main__":
    main()
