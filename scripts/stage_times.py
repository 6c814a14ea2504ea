"""Summarise a Spark event log: per job group (bench query), wall time, time
between jobs, task time, and the slowest stages.

Usage: python scripts/stage_times.py <event log folder or file> [group ...]
(a bench run with BENCH_EVENT_LOG=<folder> tags every job with its query name).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import signal
import sys


def events(path: str):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True))
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path, only = sys.argv[1], set(sys.argv[2:])
    jobs: dict[int, dict] = {}
    stage_group: dict[int, str] = {}
    stages: dict[int, tuple[str, int]] = {}
    task_ms: collections.Counter = collections.Counter()
    for e in events(path):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id") or "-"
            jobs[e["Job ID"]] = {"group": group, "start": e["Submission Time"]}
            for sid in e["Stage IDs"]:
                stage_group[sid] = group
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerTaskEnd" and e["Stage ID"] in stage_group:
            info = e["Task Info"]
            task_ms[stage_group[e["Stage ID"]]] += info["Finish Time"] - info["Launch Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Submission Time" in info and info["Stage ID"] in stage_group:
                stages[info["Stage ID"]] = (info["Stage Name"][:70], info["Completion Time"] - info["Submission Time"])
    by_group: dict[str, list[dict]] = collections.defaultdict(list)
    for job in jobs.values():
        if "end" in job:
            by_group[job["group"]].append(job)
    print(f"{'group':28} {'jobs':>5} {'span s':>8} {'gaps s':>8} {'task s':>8}")
    for group, js in sorted(by_group.items(), key=lambda kv: -(max(j["end"] for j in kv[1]) - min(j["start"] for j in kv[1]))):
        if only and group not in only:
            continue
        span = max(j["end"] for j in js) - min(j["start"] for j in js)
        busy = sum(j["end"] - j["start"] for j in js)
        print(f"{group:28} {len(js):5d} {span / 1000:8.2f} {(span - busy) / 1000:8.2f} {task_ms[group] / 1000:8.2f}")
    slow = collections.defaultdict(lambda: [0, 0])
    for sid, (name, ms) in stages.items():
        if not only or stage_group[sid] in only:
            slow[name][0] += 1
            slow[name][1] += ms
    print("\nslowest stage kinds (count, total s):")
    for name, (n, ms) in sorted(slow.items(), key=lambda kv: -kv[1][1])[:10]:
        print(f"  {n:4d} {ms / 1000:8.2f}  {name}")


if __name__ == "__main__":
    signal.signal(signal.SIGPIPE, signal.SIG_DFL)  # quiet when piped to head
    main()
