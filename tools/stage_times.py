"""Stage durations from a Spark event log folder (for tuning; no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir`` set
to a scratch folder, optionally tagging the measured part with
``sparkContext.setJobDescription(tag)``, then:

    python tools/stage_times.py <event-log-dir> [tag]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv: list[str]) -> int:
    folder, tag = argv[1], (argv[2] if len(argv) > 2 else None)
    files = sorted(f for f in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in f)
    stages, jobs = {}, []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                jobs.append((e["Job ID"], e.get("Properties", {}).get("spark.job.description"), e["Stage IDs"],
                             e["Submission Time"]))
            elif e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = ((si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                                          si["Number of Tasks"], si["Stage Name"][:60])
    chosen = [j for j in jobs if tag is None or j[1] == tag]
    if not chosen:
        print("no jobs found")
        return 1
    t0 = chosen[0][3]
    for job_id, _, stage_ids, submitted in chosen:
        for s in stage_ids:
            if s in stages:
                d, tasks, name = stages[s]
                print(f"job {job_id:4d} +{(submitted - t0) / 1000:6.2f}s  stage {s:4d}  {d:6.2f}s  {tasks:5d} tasks  {name}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
