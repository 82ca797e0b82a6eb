"""Bench: time the headline jobs on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
The 17 extracts are first derived from the test tables and written once
(timed separately as fixture setup, ``setup_derive_extracts_sec``).  Each job is
fully executed through the ``noop`` sink (every column is computed, nothing is
collected); the first run of each warms the JVM and is discarded, and the
median of the others counts.  ``wide_from_json`` is the command-line job: the
extracts as JSON lines, parsed once into Parquet, then the wide table.  Row
counts are taken once, outside the timing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from policylens import job as job_io  # noqa: E402
from policylens import schemas  # noqa: E402
from policylens.operators.period import Period  # noqa: E402
from policylens.plans import endorsement, extensions, plain, policy  # noqa: E402
from policylens.queries import WINDOW  # noqa: E402
from policylens.session import local_session, scratch_path  # noqa: E402
from policylens.sources import files  # noqa: E402
from policylens.sources.adapter import materialize_sources, sources_for  # noqa: E402

# Headline jobs on the written extracts.
JOBS = {
    "endorsement_rollup": lambda src, w: endorsement.endorsement_rollup(src, w),
    "policy_indicators": lambda src, w: policy.policy_indicators(src, w),
    "policy_wide_table": lambda src, w: policy.policy_wide_table(src, w),
    "plain_wide_table": lambda src, w: plain.plain_wide_table(src),
    "premium_income_by_company": lambda src, w: policy.premium_income_by_company(src, w),
    "claims_ratio": lambda src, w: extensions.claims_ratio(src, w),
    "ncd_coefficient": lambda src, w: extensions.ncd_coefficient(src),
}



def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="policylens-bench")
    times, rows = {}, {}
    # 1. Derive the 17 extracts from the test tables and write them once.
    t0 = time.perf_counter()
    src = materialize_sources(spark, sources_for(spark, sf_dir), scratch_path(spark, "bench-extracts"))
    setup_sec = round(time.perf_counter() - t0, 3)
    # 2. The jobs on the extracts.
    window: Period = WINDOW
    errors = {}
    for name, job in JOBS.items():
        taken = []
        try:
            for i in range(repeats + 1):
                t0 = time.perf_counter()
                job(src, window).write.format("noop").mode("overwrite").save()
                if i > 0 or repeats == 0:
                    taken.append(time.perf_counter() - t0)
            times[name] = round(median(taken), 3)
            rows[name] = job(src, window).agg(F.count(F.lit(1)).alias("n")).first()["n"]
        except Exception as exc:  # report the others even if one job fails
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    # 3. The current job's own input: JSON lines.
    try:
        base = scratch_path(spark, "bench-json")
        materialize_sources(spark, src, base, fmt="json")
        for name in ("vehicle", "company"):
            columns = schemas.VEHICLE_COLUMNS if name == "vehicle" else schemas.COMPANY_COLUMNS
            files.to_delimited_lines(getattr(src, name), columns, "|").write.text(f"{base}/{name}-text")
        overrides = {name: f"{base}/{name}-text" for name in ("vehicle", "company")}
        t0 = time.perf_counter()
        read = job_io.ingested(job_io.read_extracts(spark, base, overrides, None, 22, job_io.WIDE_INPUTS))
        policy.policy_wide_table(read, window).write.format("noop").mode("overwrite").save()
        times["wide_from_json"] = round(time.perf_counter() - t0, 3)
    except Exception as exc:
        errors["wide_from_json"] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_jobs_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "setup_derive_extracts_sec": setup_sec, **({"errors": errors} if errors else {}), "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
