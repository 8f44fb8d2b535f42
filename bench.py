"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Building the retail tables
from the star schema is timed as a query of its own, ``mart``, and so are the day tables
of the assembled tables; every other query then reads them and runs to a sink that keeps
nothing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.queries import REGISTRY, common  # noqa: E402
from shelfcast.session import build_session  # noqa: E402
from shelfcast.sources.retail import open_mart  # noqa: E402

HEADLINE = [
    "flagship_forecast", "join_left_demand", "join_left_price", "semi_join_price_weeks", "state_specific_flags",
    "unpivot_events", "pivot_forecast", "onehot_events_pivot", "calendar_wide_features",
    "agg_by_store_dept", "agg_hierarchy_grouping_sets", "item_stats", "topk_items", "minmax_scale",
    "metric_scaled_rmse", "lag_multi", "rolling_mean_of_lags", "rolling_mean_right", "rolling_sd_right",
    "rolling_slope_right", "rolling_shifted", "rolling_centered_shifted_grouped", "future_rolling_shift",
    "dynamic_window_price_mean", "promo_hike_flags", "locf_fill", "label_encode_items", "date_parts",
    "assemble_label_encoded_table", "assemble_series_model_table", "assemble_future_table",
    "assemble_top_level_table", "multiplier_grid_search", "topdown_disaggregate", "ensemble_mean",
    "sink_by_store", "scan_prediction_files", "write_submission", "rf_total_forecast", "glm_tweedie_forecast",
    "rf_bottom_forecast", "gbm_global_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}
    begin = time.perf_counter()
    mart = open_mart(spark, sf_dir)
    for table in (mart.cells, mart.series, mart.prices, mart.sales, mart.actuals, mart.calendar, common.spine(mart)):
        table.schema
    times["mart"] = round(time.perf_counter() - begin, 3)
    begin = time.perf_counter()
    for days in (common.label_days_table, common.series_days_table, common.state_days_table, common.aggregate_days_table):
        days(mart)
    times["day_tables"] = round(time.perf_counter() - begin, 3)
    for name in names:
        begin = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
