"""Summarise a Spark event log: wall time per job group (query), slowest
stages with their task counts and the spread of task times.

    BENCH_EVENT_LOG=/tmp/run-xyz python bench.py
    python tools/event_log_profile.py /tmp/run-xyz [group ...]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "**", "events*"), recursive=True)
                       + glob.glob(os.path.join(folder, "*", "events*"))):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode().splitlines()


def main():
    folder, groups = sys.argv[1], set(sys.argv[2:])
    jobs, stage_job, stages, tasks = {}, {}, {}, defaultdict(list)
    for line in _lines(folder):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            jobs[e["Job ID"]] = {"group": group, "start": e["Submission Time"]}
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Number of Tasks"], si["Stage Name"][:60])
        elif ev == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks[e["Stage ID"]].append(ti["Finish Time"] - ti["Launch Time"])
    per_group = defaultdict(lambda: [0, 0])
    for j in jobs.values():
        if groups and j["group"] not in groups:
            continue
        per_group[j["group"]][0] += j.get("end", j["start"]) - j["start"]
        per_group[j["group"]][1] += 1
    for g, (ms, n) in sorted(per_group.items(), key=lambda kv: -kv[1][0]):
        print(f"{g}: {n} jobs, {ms} ms in jobs")
    print("slowest stages:")
    ranked = sorted(((d, s) for s, (d, _, _) in stages.items()
                     if not groups or jobs.get(stage_job.get(s), {}).get("group") in groups), reverse=True)
    for d, s in ranked[:15]:
        _, n, name = stages[s]
        t = sorted(tasks[s])
        spread = f"task ms min/median/max {t[0]}/{t[len(t) // 2]}/{t[-1]}" if t else ""
        group = jobs.get(stage_job.get(s), {}).get("group")
        print(f"  stage {s} [{group}] {d} ms, {n} tasks, {spread}  {name}")


if __name__ == "__main__":
    main()
