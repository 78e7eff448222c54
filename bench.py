"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed fully: small results are collected, row-level results
(the decoded table, the filtered scan, the lenient casts) are written to the
``noop`` sink so nothing large travels to the driver.  One untimed warm-up
query starts the JVM and loads the code tables first.

The ``stored_table`` entry times the production path as well: build the
month-partitioned table once (decode + partitioned write), then run every
analysis of ``surveyframe.cli`` against the stored table, one by one (pruned reads) and
all together from one scan, as the command line does.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surveyframe.cli import ANALYSES  # noqa: E402
from surveyframe.plans.consolidate import survey  # noqa: E402
from surveyframe.plans.queries import QUERIES  # noqa: E402
from surveyframe.plans.together import at_once, together  # noqa: E402
from surveyframe.session import get_spark  # noqa: E402
from surveyframe.sources.tables import read_consolidated, write_consolidated  # noqa: E402

ROW_LEVEL = {"survey_processed", "scan_pruned_filtered", "lenient_casts"}


def run(df, name: str) -> None:
    if name in ROW_LEVEL:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="surveyframe-bench",
                      shuffle_partitions=max(8, 2 * int(cpus)),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir

    run(QUERIES["kpi_row"](spark, sf_dir), "kpi_row")  # warm-up, untimed

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        t0 = time.perf_counter()
        try:
            run(fn(spark, sf_dir), name)
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001  (report, keep benchmarking the rest)
            errors[name] = str(e)[:300]
    total = round(sum(times.values()), 3)

    try:
        work = tempfile.mkdtemp(prefix="bench-table-", dir=os.environ.get("BENCH_WORK_DIR", "/tmp"))
        table = os.path.join(work, "t")
        t0 = time.perf_counter()
        write_consolidated(survey(spark, sf_dir), table)
        t1 = time.perf_counter()
        table_df = read_consolidated(spark, table)
        for fn in ANALYSES.values():
            fn(table_df).collect()
        t2 = time.perf_counter()
        with together(table_df, list(ANALYSES.values())) as results:
            at_once(lambda fn: results[fn].collect(), list(results))
        t3 = time.perf_counter()
        stored = {"build_table_sec": round(t1 - t0, 3), "analyses_on_table_sec": round(t2 - t1, 3),
                  "analyses_together_sec": round(t3 - t2, 3), "n_analyses": len(ANALYSES)}
    except Exception as e:  # noqa: BLE001
        stored = {"error": str(e)[:300]}
    out = {"metric": "total_query_seconds", "value": total, "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus), "stored_table": stored}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
