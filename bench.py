"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then `BENCH_RUNS` times; its time is the median.
Results go to Spark's noop sink, so every column is computed and nothing is collected.
`refresh` times stored loads of one fact and its tables: everything, then the hourly load
after the newest percent of the rentals changed, and the one after a percent of all, spread
over all months. With BENCH_DUCKDB=1 the SQL form of each
query is timed in DuckDB as well.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata.catalogue import checks, queries as catalogue  # noqa: E402
from strata.catalogue.sources import GIVEN_TABLES  # noqa: E402
from strata.plans import jobs  # noqa: E402
from strata.session import local_session  # noqa: E402
from strata.sources.extract import timestamp  # noqa: E402

HEADLINE = (
    "bronze_delta_extract",
    "silver_rental",
    "silver_rental_incremental",
    "silver_dedup_latest",
    "dim_customer_full",
    "dim_customer_incremental",
    "dim_inventory_full",
    "pit_lookup_fallback",
    "active_interval_lookup",
    "fact_customer_daily_activity",
    "fact_content_monthly_performance",
    "fact_inventory_daily_utilisation",
    "fact_customer_daily_activity_incremental",
    "fact_content_monthly_performance_incremental",
    "fact_inventory_daily_utilisation_incremental",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def median_of(run, runs: int) -> float:
    run()
    return round(statistics.median(timed(run) for _ in range(runs)), 3)


def refresh(spark, sf: str) -> dict[str, float]:
    fact = "fact_inventory_daily_utilisation"
    lake, settings = catalogue._new_lake(spark), catalogue._load_settings(fact)

    rentals = catalogue.source_without_ties(spark, sf, "rental")
    days = F.unix_date(F.to_date("rental_date"))
    newest = rentals.select(F.percentile_approx(days, 0.99)).first()[0]

    def changed(where, at: str):
        def source(table: str):
            rows = catalogue.source_without_ties(spark, sf, table)
            if table != "rental":
                return rows
            return rows.withColumn("updated_at", F.when(where, timestamp(at)).otherwise(F.col("updated_at")))

        return source

    def load(run, source, at: str) -> float:
        return round(timed(lambda: run(lake, source, at, settings)), 3)

    spread = F.xxhash64("rental_id") % 100 == 0
    hours = ("2026-12-31 00:00:00", "2027-01-01 00:00:00", "2027-01-01 01:00:00")
    return {
        "full_load": load(jobs.full_load, changed(F.lit(False), hours[0]), hours[0]),
        "hourly_load_newest_percent": load(jobs.incremental_load, changed(days >= newest, hours[1]), hours[1]),
        "hourly_load_1_percent": load(jobs.incremental_load, changed(spread, hours[2]), hours[2]),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    # Small files are cut so that all cores read; on a cluster the default is right.
    conf = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"), "spark.sql.files.maxPartitionBytes": "2m"}
    spark = local_session(cores, "bench", **conf)
    found = catalogue.queries()

    def on_spark(name: str):
        return lambda: found[name](spark, sf).write.format("noop").mode("overwrite").save()

    times = {name: median_of(on_spark(name), runs) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
        "cores": cores,
        "refresh": refresh(spark, sf),
    }
    spark.stop()
    if os.environ.get("BENCH_DUCKDB") == "1":
        import duckdb

        con = duckdb.connect(config={"threads": cores})
        for t in GIVEN_TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        sql = checks.oracle_sql()
        result["duckdb"] = {
            n: median_of(lambda n=n: con.execute(f"CREATE OR REPLACE TEMP TABLE out AS {sql[n]}"), runs)
            for n in names
        }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
