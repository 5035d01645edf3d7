"""Summarise a Spark event log (JSON lines): per job its stages with task
count and duration, slowest first.

    BENCH_EVENTLOG_DIR=$(mktemp -d /tmp/run-XXXXXX) BENCH_QUERIES=frequent_pairs python bench.py
    python tools/eventlog_summary.py <event-log-file-or-folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path):
    """A single log file, or a rolling log folder (``eventlog_v2_*``)."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for name in files:
        if name.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
            import io

            import zstandard

            with open(name, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(name) as f:
                yield from f


def main(argv):
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 25
    stages = []
    for line in _lines(path):
        ev = json.loads(line)
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        start, end = info.get("Submission Time"), info.get("Completion Time")
        if start is None or end is None:
            continue
        stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                       info["Stage Name"][:70]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.2f} s summed stage time")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:8.2f} s  stage {sid:4d}  tasks {tasks:5d}  {name}")


if __name__ == "__main__":
    main(sys.argv)
