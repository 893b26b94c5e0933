"""Summarise a Spark event log: per job wall time, per stage tasks and run time.

Usage:
  run a job with spark.eventLog.enabled=true and
  spark.eventLog.dir=file:///tmp/run-XXXX (a scratch folder), then
  python scripts/event_log_summary.py /tmp/run-XXXX [last_n_stages]

Reads plain or zstd-compressed logs, rolled (``eventlog_v2_*``) or single-file.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    last = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    files = sorted(p for p in glob.glob(os.path.join(root, "**", "*"), recursive=True) if os.path.isfile(p))
    files = [p for p in files if "appstatus" not in os.path.basename(p)]
    jobs, stages, run_ms = {}, {}, defaultdict(list)
    for path in files:
        for line in _lines(path):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None]
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Submission Time"), si.get("Completion Time"), si["Stage Name"])
            elif ev == "SparkListenerTaskEnd":
                run_ms[e["Stage ID"]].append((e.get("Task Metrics") or {}).get("Executor Run Time", 0))
    done = [b - a for a, b in jobs.values() if b]
    if done:
        print(f"jobs: {len(done)}  mean wall {sum(done) / len(done):.0f} ms  total {sum(done) / 1000:.1f} s")
    for sid in sorted(stages)[-last:]:
        start, end, name = stages[sid]
        tasks = run_ms[sid]
        wall = (end - start) if start and end else -1
        print(
            f"stage {sid:4d} wall {wall:6d} ms  tasks {len(tasks):4d}  "
            f"max {max(tasks, default=0):6d} ms  sum {sum(tasks):7d} ms  {name[:50]}"
        )


if __name__ == "__main__":
    main()
