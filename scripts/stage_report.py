"""Stage-level summary of a Spark event log (no web UI needed).

Usage: BENCH_EVENT_LOG=1 BENCH_QUERIES=... python bench.py   # prints the log folder on stderr
       python scripts/stage_report.py <event-log file or folder> [--top 15]

Per stage: wall time, tasks, max / median task run time, and max / median bytes read per task
(scan input + shuffle read). A stage is flagged as skewed when its slowest task takes more than
5x the median and more than one second.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def load(path: str) -> list[dict]:
    """Events of one log file or of every ``events_*`` / plain log file below a folder."""
    if os.path.isfile(path):
        files = [path]
    else:
        files = sorted(
            f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
            if os.path.isfile(f) and not os.path.basename(f).startswith((".", "appstatus"))
        )
    events = []
    for f in files:
        for line in _lines(f):
            line = line.strip()
            if line:
                events.append(json.loads(line))
    return events


def summarise(events: list[dict]) -> list[dict]:
    stages, tasks = {}, defaultdict(list)
    for e in events:
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            key = (info["Stage ID"], info.get("Stage Attempt ID", 0))
            stages[key] = {
                "stage": info["Stage ID"],
                "name": info.get("Stage Name", "")[:60],
                "tasks": info.get("Number of Tasks", 0),
                "wall_s": (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0,
            }
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            shuffle = m.get("Shuffle Read Metrics") or {}
            read = (m.get("Input Metrics") or {}).get("Bytes Read", 0) + shuffle.get(
                "Remote Bytes Read", 0
            ) + shuffle.get("Local Bytes Read", 0)
            key = (e["Stage ID"], e.get("Stage Attempt ID", 0))
            tasks[key].append((m.get("Executor Run Time", 0) / 1000.0, read))
    rows = []
    for key, st in stages.items():
        ts = tasks.get(key, [])
        if ts:
            times = [t for t, _ in ts]
            reads = [b for _, b in ts]
            st.update(
                max_task_s=max(times), median_task_s=statistics.median(times),
                max_read_mb=max(reads) / 1e6, median_read_mb=statistics.median(reads) / 1e6,
            )
            st["skewed"] = st["max_task_s"] > 1.0 and st["max_task_s"] > 5 * max(st["median_task_s"], 1e-3)
        rows.append(st)
    return sorted(rows, key=lambda r: -r["wall_s"])


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=15)
    args = ap.parse_args()
    rows = summarise(load(args.path))
    print("| stage | name | wall s | tasks | max task s | median task s | max MB read | median MB read | skewed |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for r in rows[: args.top]:
        print(
            f"| {r['stage']} | {r['name']} | {r['wall_s']:.2f} | {r['tasks']} | {r.get('max_task_s', 0):.2f} "
            f"| {r.get('median_task_s', 0):.2f} | {r.get('max_read_mb', 0):.1f} | {r.get('median_read_mb', 0):.1f} "
            f"| {'yes' if r.get('skewed') else ''} |"
        )
    total = sum(r["wall_s"] for r in rows)
    print(f"\n{len(rows)} stages, {total:.1f} s summed stage wall time, "
          f"{sum(1 for r in rows if r.get('skewed'))} flagged as skewed")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
