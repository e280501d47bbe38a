"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` sink (no collect to the
driver).  One warm-up of the flagship query first; then each query is run
``$BENCH_REPEAT`` times (default 3) and the median is reported.  ``etl_job``
times the whole batch job (4 CSV exports -> 8 star tables).  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def etl_job(spark, sf_dir: str, repeat: int) -> float:
    """The whole batch job as the source runs it: four CSV exports -> 8 star tables.

    The exports (the bound driver tables, dirtied) are written as CSV once,
    untimed; each timed run reads them with declared schemas, cleans, stages
    the facts and builds the dimensions into a fresh folder.
    """
    from ledgerlens.plans import catalog as C
    from ledgerlens.plans.etl import ProgramConfig, run
    from ledgerlens.sources import bindings as B
    from ledgerlens.sources import files

    root = tempfile.mkdtemp(prefix="ledgerlens-bench-etl-")
    raw = {}
    for name, fn in B.BINDINGS.items():
        raw[name] = os.path.join(root, "raw", name)
        files.write_csv(fn(spark, sf_dir), raw[name])
    cfg = ProgramConfig(C.CAMPUS, C.CLIENT, C.PROGRAM_VALUE, C.SNAPSHOT, vendor_rules=B.BINDING_VENDOR_RULES,
                        canonical_vendors=B.CANONICAL_VENDORS)
    times = []
    for i in range(repeat):
        t = time.perf_counter()
        run(spark, raw, os.path.join(root, f"star-{i}"), cfg)
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [a for a in sys.argv[1:]]

    from ledgerlens.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-bench-"))

    from ledgerlens.plans.catalog import QUERIES

    qs = dict(QUERIES)
    if only:
        qs = {k: v for k, v in qs.items() if k in only}

    def run(fn) -> float:
        t = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run(qs.get("evm_summary_by_building", next(iter(qs.values()))))  # JVM / codegen warm-up
    timings, failed = {}, []
    for name, fn in qs.items():
        try:
            timings[name] = round(statistics.median(run(fn) for _ in range(repeat)), 3)
        except Exception as exc:  # keep benchmarking the rest; report the failure
            timings[name] = None
            failed.append(name)
            print(f"bench: {name} failed: {type(exc).__name__}: {exc}"[:500], file=sys.stderr)
    if not only or "etl_job" in only:
        try:
            timings["etl_job"] = round(etl_job(spark, sf_dir, repeat), 3)
        except Exception as exc:
            timings["etl_job"] = None
            failed.append("etl_job")
            print(f"bench: etl_job failed: {type(exc).__name__}: {exc}"[:500], file=sys.stderr)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
