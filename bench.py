"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import load  # noqa: E402
from gaugeworks.session import build_session  # noqa: E402

HEADLINE = [
    "a17_partitioned_layout", "c2_recent", "c3_min_records", "c6_box_sweep", "c7_match_re", "e5_group_by_alt",
    "e7_geo_sum_by_time", "e9_resample_sums", "f1_difference", "f2_last_five", "f3_running_totals",
    "f4_sensor_numbering", "g3_top5_recent_count", "j1_tumbling_batch", "j2_sliding_batch", "j1_tumbling_stream",
    "k1_mad_outliers", "k2_outlier_alerts", "k3_adf_stat", "k5_ar2_fit", "k8_arma_forecast", "k9_arima_forecast",
    "k12_area_forecast", "k13_rbf_forecast", "k14_dbscan_labels", "k15_bayes_marginals", "k16_node_risk",
    "k17_cluster_status", "k18_grid_cells", "k19_tiles",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    queries, wanted = load()[0], sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").count().collect()
    times = {}
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
