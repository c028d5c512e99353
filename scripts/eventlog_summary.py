"""Summarise a Spark event log: per stage, wall time, tasks, input and
shuffle bytes, spill, and the slowest task against the median (a skew
signal). Reads the JSON-lines log Spark writes when
`spark.eventLog.enabled` is on (bench.py: BENCH_EVENT_LOG=<dir>).

    python scripts/eventlog_summary.py <event-log-file-or-dir> [top_n]
"""
from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def _acc(info: dict, name: str) -> int:
    for a in info.get("Accumulables", []):
        if a.get("Name") == name:
            try:
                return int(a.get("Value", 0))
            except (TypeError, ValueError):
                return 0
    return 0


def _lines(files):
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard
            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                buf = b""
                while chunk := reader.read(1 << 20):
                    buf += chunk
                    *done, buf = buf.split(b"\n")
                    yield from (ln for ln in done if ln)
                if buf:
                    yield buf
        else:
            with open(fp, "rb") as f:
                yield from (ln for ln in f if ln.strip())


def summarise(path: str, top: int = 15) -> None:
    files = [path]
    if os.path.isdir(path):
        # newest application; Spark 4 writes a folder of rolling event files
        logs = [os.path.join(path, f) for f in os.listdir(path) if not f.startswith(".")]
        app = max(logs, key=os.path.getmtime)
        files = sorted(os.path.join(app, f) for f in os.listdir(app)
                       if f.startswith("events_")) if os.path.isdir(app) else [app]
    stages, task_times, described = {}, defaultdict(list), {}
    for line in _lines(files):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description")
            for sid in ev.get("Stage IDs", []):
                if desc:
                    described[sid] = desc
        elif kind == "SparkListenerTaskEnd":
            ti = ev.get("Task Info", {})
            task_times[(ev["Stage ID"], ev["Stage Attempt ID"])].append(
                ti.get("Finish Time", 0) - ti.get("Launch Time", 0))
        elif kind == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            key = (si["Stage ID"], si["Stage Attempt ID"])
            stages[key] = {
                "name": (described.get(si["Stage ID"]) or si.get("Stage Name", ""))[:48],
                "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                "tasks": si.get("Number of Tasks", 0),
                "in": _acc(si, "internal.metrics.input.bytesRead"),
                "sh_r": _acc(si, "internal.metrics.shuffle.read.remoteBytesRead")
                        + _acc(si, "internal.metrics.shuffle.read.localBytesRead"),
                "sh_w": _acc(si, "internal.metrics.shuffle.write.bytesWritten"),
                "spill": _acc(si, "internal.metrics.diskBytesSpilled"),
            }
    print("%6s %7s %5s %10s %10s %10s %8s %7s  %s" % (
        "stage", "ms", "tasks", "input", "shuf_rd", "shuf_wr", "spill", "max/med", "name"))
    total = sum(s["ms"] for s in stages.values())
    for key, s in sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]:
        t = task_times.get(key) or [0]
        med = statistics.median(t) or 1
        print("%6s %7d %5d %10d %10d %10d %8d %7.1f  %s" % (
            "%d.%d" % key, s["ms"], s["tasks"], s["in"], s["sh_r"], s["sh_w"], s["spill"],
            max(t) / med, s["name"]))
    print("stages: %d, summed stage time: %d ms, total spill: %d bytes" % (
        len(stages), total, sum(s["spill"] for s in stages.values())))


if __name__ == "__main__":
    summarise(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
