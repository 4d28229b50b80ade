"""Per-stage times from a Spark event log (as written by ``BENCH_EVENT_LOG``).

Usage: python tools/stage_times.py EVENT_LOG_DIR_OR_FILE [top_n]
Prints the slowest stages: id, tasks, duration, and the stage name.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        glob.glob(os.path.join(path, "**", "events_*"), recursive=True))
    for f in files:
        raw = open(f, "rb")
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        yield from io.TextIOWrapper(raw, encoding="utf-8")


def main(argv):
    top = int(argv[2]) if len(argv) > 2 else 15
    stages = []
    for line in _lines(argv[1]):
        if '"SparkListenerStageCompleted"' in line:
            info = json.loads(line)["Stage Info"]
            ms = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            stages.append((ms, info["Stage ID"], info["Number of Tasks"], info["Stage Name"]))
    print(f"{len(stages)} stages, {sum(s[0] for s in stages)} ms in total")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"stage {sid:5d}  tasks {tasks:5d}  {ms:7d} ms  {name[:80]}")


if __name__ == "__main__":
    main(sys.argv)
