"""Summarize stage and task times from a Spark event log.

    python tools/stages.py <event log file or folder> [top_n]

For each stage: wall time, task count, and the max / median task time. A
max far above the median marks a straggler, i.e. a skewed partition.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a file, or a rolling-log folder of parts,
    plain or zstd-compressed (Spark 4's default)."""
    parts = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, n) for n in os.listdir(path) if n.startswith("events_"))
    for part in parts:
        if part.endswith(".zstd"):
            import zstandard
            with open(part, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(part, encoding="utf-8") as f:
                yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    tasks = defaultdict(list)
    stages = {}
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                tasks[ev["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                if "Completion Time" in si and "Submission Time" in si:
                    stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                              si.get("Stage Name", ""))
    rows = sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]
    print(f"{'stage':>6} {'wall_ms':>8} {'tasks':>6} {'max_ms':>7} {'median_ms':>9} {'skew':>5}  name")
    for sid, (wall, name) in rows:
        t = tasks.get(sid, [0])
        med = statistics.median(t) or 1
        print(f"{sid:>6} {wall:>8} {len(t):>6} {max(t):>7} {statistics.median(t):>9.0f} "
              f"{max(t) / med:>5.1f}  {name[:60]}")


if __name__ == "__main__":
    main()
