"""Summarise a Spark event log written by ``bench.py`` (BENCH_EVENT_LOG_DIR).

usage: python tools/stage_times.py <event-log file or folder> [phase]

Per query (job description ``<query>:<phase>``, default phase ``warm``): jobs,
stages, summed stage wall time, summed task time and shuffle bytes written.
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict


def _lines(path: str):
    """Event-log lines from a file or a rolling event-log folder (events_<n>_*)."""
    import os
    import re

    files = [path]
    if os.path.isdir(path):
        names = [n for n in os.listdir(path) if n.startswith("events_")]
        names.sort(key=lambda n: int(re.match(r"events_(\d+)_", n).group(1)))
        files = [os.path.join(path, n) for n in names]
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard

            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    phase = sys.argv[2] if len(sys.argv) > 2 else "warm"
    stage_job, job_desc = {}, {}
    per = defaultdict(lambda: {"jobs": set(), "stages": 0, "stage_ms": 0, "task_ms": 0, "shuffle_w": 0})
    for line in _lines(path):
        if True:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                job_desc[ev["Job ID"]] = desc
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                desc = job_desc.get(stage_job.get(info["Stage ID"]), "")
                if not desc.endswith(":" + phase):
                    continue
                q = per[desc.rsplit(":", 1)[0]]
                q["jobs"].add(stage_job.get(info["Stage ID"]))
                q["stages"] += 1
                if info.get("Submission Time") and info.get("Completion Time"):
                    q["stage_ms"] += info["Completion Time"] - info["Submission Time"]
                for acc in info.get("Accumulables", []):
                    name, value = acc.get("Name", ""), acc.get("Value")
                    if name == "internal.metrics.executorRunTime":
                        q["task_ms"] += int(value)
                    elif name == "internal.metrics.shuffle.write.bytesWritten":
                        q["shuffle_w"] += int(value)
    print(f"{'query':24s} {'jobs':>4s} {'stages':>6s} {'stage_s':>8s} {'task_s':>7s} {'shuffle_MB':>10s}")
    for name, q in sorted(per.items(), key=lambda kv: -kv[1]["stage_ms"]):
        print(f"{name:24s} {len(q['jobs']):4d} {q['stages']:6d} {q['stage_ms'] / 1000:8.2f} "
              f"{q['task_ms'] / 1000:7.2f} {q['shuffle_w'] / 2**20:10.2f}")


if __name__ == "__main__":
    main()
