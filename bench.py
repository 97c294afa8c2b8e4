"""Headline timings. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Landing the raw files is set-up and not timed; everything else is: planning, data tests, building,
reading back.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from gallery import stored
    from tripmart.plans import dashboard, flows
    from tripmart.plans.registry import MONTHLY_MARTS, STAGED_SERVICES, Lake
    from tripmart.plans.staging import SERVICES
    from tripmart.session import build_session
    from tripmart.workspace import new_workspace

    spark = build_session(
        "tripmart-bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__driver__host="127.0.0.1",
        spark__ui__enabled="false",
        spark__python__sql__dataFrameDebugging__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        timings[name] = round(time.perf_counter() - start, 3)
        return result

    month = "2025-03-01"
    lake = Lake(spark, stored.landed(spark, sf_dir, faultless=True), new_workspace(spark, "bench"))
    timed("zones_and_weather_staging", lambda: (flows.build_zones(lake), flows.build_weather(lake)))
    timed("raw_tests", lambda: lake.side_by_side(lambda s: flows.check_raw(lake, s), SERVICES))
    timed("staging_rebuild", lambda: lake.side_by_side(lake.build, STAGED_SERVICES))
    timed(
        "staging_tests",
        lambda: lake.side_by_side(lambda m: flows.check_model(lake, m), STAGED_SERVICES),
    )
    timed("high_volume_whole", lambda: lake.build("stg_high_volume_fhv"))
    timed("high_volume_one_month", lambda: lake.build("stg_high_volume_fhv", [month]))
    timed("final_rebuild_with_tests", lambda: flows.build_final(lake, full_refresh=True))

    def new_month():
        lake.side_by_side(lambda name: lake.build(name, [month]), STAGED_SERVICES)
        return flows.build_final(lake)

    timed("new_month_staging_and_final", new_month)
    timed(
        "plan_final",
        lambda: flows.plan_months(
            spark,
            [lake.location(s) for s in STAGED_SERVICES],
            [lake.location(m) for m in MONTHLY_MARTS],
        ),
    )

    marts = {n: lake.read(n) for n in ("trips_hourly", "zones_geo", "weather_daily", "trips")}
    timed(
        "dashboard_ten_charts",
        lambda: [dashboard.chart(name, marts).collect() for name in dashboard.CHARTS],
    )
    quarter = dashboard.Filters(period=(datetime(2025, 1, 1), datetime(2025, 4, 1)))
    timed("chart_one_quarter", lambda: dashboard.chart("top_zones", marts, quarter).collect())
    timed("chart_on_mart", lambda: dashboard.chart("speed_by_hour", marts).collect())
    timed(
        "chart_on_trips",
        lambda: dashboard.metric_table("trips", marts, ["hour_label"]).collect(),
    )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "trip_lake_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
