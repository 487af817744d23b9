"""Summarise a Spark event log: wall time per job and the slowest stages.

Usage: python scripts/stage_times.py <event-log-file-or-folder> [top_n]
Reads the JSON lines Spark writes when ``spark.eventLog.enabled`` is on.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _files(path: str):
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if not n.startswith(".") and not n.startswith("appstatus")]
    return out


def events(path: str):
    for f in _files(path):
        with open(f, "rb") as raw:
            if f.endswith(".zstd"):
                import zstandard
                raw = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs, stages, tasks = {}, {}, {}
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e.get("Properties", {}).get("spark.job.description", "")]
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if info.get("Submission Time") and info.get("Completion Time"):
                stages[(info["Stage ID"], info["Stage Attempt ID"])] = (
                    info["Completion Time"] - info["Submission Time"], info["Number of Tasks"], info["Stage Name"])
        elif kind == "SparkListenerTaskEnd":
            key = (e["Stage ID"], e["Stage Attempt ID"])
            t = e["Task Info"]
            tasks.setdefault(key, []).append(t["Finish Time"] - t["Launch Time"])
    total = sum((end - start) for start, end, _ in jobs.values() if end)
    print(f"jobs: {len(jobs)}, summed job wall time {total / 1000:.1f} s")
    print(f"{'stage':>8} {'wall s':>7} {'tasks':>6} {'max task s':>10}  name")
    for key, (ms, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        longest = max(tasks.get(key, [0])) / 1000
        print(f"{key[0]:>8} {ms / 1000:>7.2f} {n:>6} {longest:>10.2f}  {name[:70]}")


if __name__ == "__main__":
    main()
