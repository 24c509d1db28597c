"""Stage durations and task counts from a Spark event log folder.

Usage: python tools/stage_times.py <event-log-dir>   (see BENCH_EVENT_LOG in bench.py)
"""

from __future__ import annotations

import glob
import json
import os
import sys


def main() -> None:
    files = [f for f in glob.glob(os.path.join(sys.argv[1], "**", "events_*"), recursive=True)
             if os.path.isfile(f)]
    for path in sorted(files):
        jobs, stages = {}, {}
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    for sid in ev["Stage IDs"]:
                        jobs[sid] = ev["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    if "Completion Time" in info and "Submission Time" in info:
                        stages[info["Stage ID"]] = (
                            info["Completion Time"] - info["Submission Time"],
                            info["Number of Tasks"], info["Stage Name"][:60])
        print(f"{path}:")
        print(f"{'job':>5} {'stage':>6} {'ms':>7} {'tasks':>6}  name")
        for sid in sorted(stages):
            ms, tasks, name = stages[sid]
            print(f"{jobs.get(sid, '-'):>5} {sid:>6} {ms:>7} {tasks:>6}  {name}")


if __name__ == "__main__":
    main()
