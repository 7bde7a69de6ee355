"""Benchmark: the lake load job over landed gzip JSON plus every registered
query, at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``.

Prints one JSON line. Each query is executed to completion through the
``noop`` sink (full plan, no driver-side collection). Inputs that queries share
(landed copies and files, the loaded and the clustered lake table, the stored
marts) are built before, untimed. The load job is the published workload of
the baseline (gzip JSON -> day-partitioned Parquet with a count round trip),
once over hourly files of the given events and once over files of about 100,000
records, the size the baseline's have; throughput is reported per core beside
the baseline's derived figure.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

BASELINE_RECORDS_PER_SEC = 51_945_869 / 480
BASELINE_RECORDS_PER_SEC_PER_CORE = BASELINE_RECORDS_PER_SEC / 13.13


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]

    from pyspark.sql import functions as F

    from tidewater import registry
    from tidewater.plans import lake_load
    from tidewater.session import build_session, scratch_path
    from tidewater.sources import files, fixtures

    spark = build_session(master=f"local[{cpus}]", app="tidewater-bench",
                          shuffle_partitions=max(8, cpus * 2))
    sf = os.path.basename(sf_dir).replace("sf", "")

    # Warm-up (JVM, codegen caches) - not timed.
    fixtures.driver_events(spark, sf_dir).count()

    timings: dict[str, float] = {}
    extra: dict[str, object] = {}

    def load(name: str, landing: str, start: dt.date, end: dt.date) -> None:
        """Time guard, read, normalise, dynamic overwrite and reconciliation."""
        target = scratch_path(spark, f"bench-{name}")
        t0 = time.perf_counter()
        report = lake_load.run_load(spark, landing, target, start, end)
        loaded = report.agg(F.sum("source_count")).first()[0]
        elapsed = time.perf_counter() - t0
        timings[name] = round(elapsed, 3)
        extra.update({
            f"{name}_records": loaded,
            f"{name}_files": len(spark.read.text(landing).inputFiles()),
            f"{name}_records_per_sec": round(loaded / elapsed, 1),
            f"{name}_records_per_sec_per_core": round(loaded / elapsed / cpus, 1),
        })

    if not only or "load_job" in only:
        small, large = scratch_path(spark, "bench-hourly"), scratch_path(spark, "bench-large")
        lines = fixtures.raw_lake_lines(spark, sf_dir)
        files.write_landing_text(lines, small)
        start, end = registry.data_days(spark, sf_dir)
        # Eight days, each event as often as makes two files of 100,000 records a day.
        last = min(end, start + dt.timedelta(days=7))
        some = lines.where(F.col("event_date") <= F.lit(last))
        times = max(1, 200_000 * ((last - start).days + 1) // max(1, some.count()))
        files.write_landing_text(
            some.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
            .withColumn("event_hour", (F.col("event_hour") / 12).cast("int") * 12).drop("copy"),
            large)
        # Untimed warm-up: one full load into a throwaway table (class loading,
        # JIT, codegen caches, codecs), as on a long-running cluster.
        lake_load.run_load(spark, small, scratch_path(spark, "bench-warm"), start, end).count()
        load("load_job", small, start, end)
        load("load_job_large_files", large, start, last)
        extra.update({
            "load_records_per_sec_per_core": extra["load_job_records_per_sec_per_core"],
            "baseline_records_per_sec": round(BASELINE_RECORDS_PER_SEC, 1),
            "baseline_records_per_sec_per_core": round(BASELINE_RECORDS_PER_SEC_PER_CORE, 1),
        })

    registry.shared_inputs(spark, sf_dir)  # untimed

    for key, fn in registry.QUERIES.items():
        if only and key not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.perf_counter() - t0, 3)

    out = {
        "metric": "total_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "run_at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
        **extra,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
