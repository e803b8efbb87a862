"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON.

Each query runs once to warm up and then three times into a sink that drops its rows; the median counts. With --duckdb the
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from strandline.plans import catalog
from strandline.session import local_session

HEADLINE = [
    "index_twndwi", "day_cloud_mask", "annual_mosaic", "three_year_mosaic", "tide_filter", "cloud_fallback", "gap_fill", "gaussian_smooth", "connected_land", "analysis_zone",
    "zero_crossings", "contour_length", "points_every_30", "annual_movement", "roc_regression", "robust_regression", "all_time_stats", "hotspots", "wms_flags", "region_attribute",
    "grid_best_zone", "nearest_pair", "validation_roc", "validation_rollup",
]


def timed(run, times: int = 3) -> float:  # noqa: ANN001
    run()
    took = []
    for _ in range(times):
        began = time.perf_counter()
        run()
        took.append(time.perf_counter() - began)
    return round(statistics.median(took), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    out: dict = {"metric": "headline queries, sum of medians", "value": 0.0, "unit": "sec", "queries": {}, "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": cpus}
    if "--duckdb" in sys.argv:
        import duckdb

        con = duckdb.connect(config={"threads": cpus})
        con.execute("set timezone = 'UTC'")
        for t in "region nation customer supplier part orders lineitem events".split():
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
        out["metric"] = "the same in DuckDB"
        out["queries"] = {q: timed(lambda q=q: con.execute(catalog.ORACLE_SQL[q]).fetchall()) for q in HEADLINE}
    else:
        spark = local_session(cpus, "bench", "12g")
        spark.conf.set("spark.sql.shuffle.partitions", str(cpus))
        for q in HEADLINE:
            out["queries"][q] = timed(lambda q=q: catalog.QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save())
        spark.stop()
    out["value"] = round(sum(out["queries"].values()), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
