"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driftline.catalog import load  # noqa: E402
from driftline.session import build_session, prepare  # noqa: E402

HEADLINE = (
    "sentiment_features_4h",
    "sentiment_features_index_asof",
    "sentiment_features_daily_by_user",
    "ohlc_resample_4h",
    "price_features_1h",
    "price_features_24h",
    "price_features_ticks_split",
    "price_features_near_target",
    "log_returns_clipped",
    "asof_nearest_later",
    "asof_nearest_split",
    "base_price_4h",
    "merged_models",
    "regimes_half_open",
    "resampled_means",
    "keyword_sentiment",
    "tagged_documents",
    "final_signals",
    "described_lineitem",
    "conditional_returns",
    "naive_metrics",
    "stability_verdicts",
    "classification_report",
    "return_acf",
    "weekly_decomposition",
    "stationarity_tests",
    "order_search",
    "scored_documents",
    "batch_predictions",
    "stream_bucket_agg",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    catalog = load()
    # start the JVM's code paths before the clock
    catalog["ohlc_resample_4h"].run(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        catalog[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
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
