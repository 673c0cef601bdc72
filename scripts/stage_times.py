"""Summarize a Spark event log: time per job group and the slowest stages.

usage: python scripts/stage_times.py <event log dir or file> [top_n]

Reads plain or zstd-compressed logs (rolling directories included).  Use with
``BENCH_EVENT_LOG_DIR=<scratch dir> python bench.py``; each query runs in a
job group named after it.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        head = fh.read(4)
        fh.seek(0)
        if head == b"\x28\xb5\x2f\xfd":  # zstd frame
            import zstandard
            stream = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(stream, encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def main() -> None:
    root = sys.argv[1]
    top_n = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [root] if os.path.isfile(root) else sorted(
        f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True)
        if os.path.isfile(f) and "appstatus" not in os.path.basename(f))
    group_of, stages = {}, []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id", "(none)")
                for sid in e["Stage IDs"]:
                    group_of[sid] = g
            elif e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages.append((group_of.get(si["Stage ID"], "(none)"), si["Stage ID"],
                               si["Number of Tasks"], round(secs, 2), si["Stage Name"][:60]))
    per_group = collections.defaultdict(float)
    for g, _, _, secs, _ in stages:
        per_group[g] += secs
    print("seconds per job group:")
    for g, secs in sorted(per_group.items(), key=lambda x: -x[1]):
        print(f"  {g:32s} {secs:8.2f}")
    print(f"slowest {top_n} stages (group, stage, tasks, seconds, name):")
    for s in sorted(stages, key=lambda x: -x[3])[:top_n]:
        print("  ", s)


if __name__ == "__main__":
    main()
