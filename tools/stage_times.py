"""Summarise a Spark event log per job description (bench tags jobs with the query key).

usage: python tools/stage_times.py <event-log-file-or-dir>
Prints, per description: jobs, stages, tasks, summed task run time (s), job wall time (s).
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event-log lines; rolling logs are zstd-compressed by default."""
    if path.endswith(".zstd") or path.endswith(".zst"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    target = sys.argv[1]
    files = [target] if os.path.isfile(target) else sorted(glob.glob(os.path.join(target, "**", "*"), recursive=True))
    jobs, stage_job = {}, {}
    agg = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "task_s": 0.0, "wall_s": 0.0})
    for f in files:
        if not os.path.isfile(f) or os.path.basename(f).startswith((".", "appstatus")):
            continue
        for line in _lines(f):
            if line.strip():
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description", "(none)")
                    desc = " ".join(desc.split()) or "(none)"  # streaming batches carry a multi-line id
                    jobs[e["Job ID"]] = (desc, e["Submission Time"])
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = e["Job ID"]
                    agg[desc]["jobs"] += 1
                elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                    desc, start = jobs[e["Job ID"]]
                    agg[desc]["wall_s"] += (e["Completion Time"] - start) / 1000
                elif ev == "SparkListenerStageCompleted":
                    sid = e["Stage Info"]["Stage ID"]
                    if sid in stage_job:
                        agg[jobs[stage_job[sid]][0]]["stages"] += 1
                elif ev == "SparkListenerTaskEnd":
                    sid = e.get("Stage ID")
                    if sid in stage_job:
                        m = e.get("Task Metrics") or {}
                        a = agg[jobs[stage_job[sid]][0]]
                        a["tasks"] += 1
                        a["task_s"] += m.get("Executor Run Time", 0) / 1000
    print(f"{'description':32} {'jobs':>5} {'stages':>6} {'tasks':>6} {'task_s':>8} {'wall_s':>8}")
    for desc, a in sorted(agg.items(), key=lambda kv: -kv[1]["wall_s"]):
        print(f"{desc[:32]:32} {a['jobs']:5d} {a['stages']:6d} {a['tasks']:6d} {a['task_s']:8.2f} {a['wall_s']:8.2f}")


if __name__ == "__main__":
    main()
