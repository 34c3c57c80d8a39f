"""Stage times from a Spark event log (no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
pointing at a scratch folder, label the job with
``spark.sparkContext.setJobDescription(label)``, then:

    python tools/stage_times.py <event-log-dir> [label]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stage_times(log_dir: str, label: str | None = None):
    files = sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)) or \
        sorted(p for p in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(p))
    desc, out = {}, []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                d = (e.get("Properties") or {}).get("spark.job.description")
                for s in e["Stage IDs"]:
                    desc[s] = d
            elif e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if label is None or desc.get(si["Stage ID"]) == label:
                    dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                    out.append((si["Stage ID"], dur, si["Number of Tasks"], si["Stage Name"][:70]))
    return out


if __name__ == "__main__":
    rows = stage_times(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)
    for sid, dur, tasks, name in rows:
        print(f"stage {sid:5d} {dur:8.2f}s {tasks:5d} tasks  {name}")
    print(f"total {sum(r[1] for r in rows):.2f}s over {len(rows)} stages")
