"""Per-stage times from a Spark event log (written by bench.py with $BENCH_EVENTLOG_DIR).

Usage: python tools/stage_times.py <event-log dir or file> [top_n]
Reads the (zstd-compressed) JSON lines, prints the slowest stages with their
task counts, so stage times never need the web UI.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    target = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [target] if os.path.isfile(target) else sorted(glob.glob(os.path.join(target, "**", "events_*"),
                                                                       recursive=True))
    rows = []
    for f in files:
        for line in _lines(f):
            if '"SparkListenerStageCompleted"' not in line:
                continue
            info = json.loads(line)["Stage Info"]
            ms = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
            rows.append((ms, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:70]))
    for ms, sid, ntasks, name in sorted(rows, reverse=True)[:top]:
        print(f"{ms:8d} ms  stage {sid:5d}  tasks {ntasks:5d}  {name}")
    print(f"{len(rows)} stages, {sum(r[0] for r in rows)} ms total")


if __name__ == "__main__":
    main()
