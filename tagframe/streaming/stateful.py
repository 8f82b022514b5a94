"""Keyed state: tracking over a stream of detections, and the lease queue as a fold of events."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tracking import Options, Track, frame_step, frames


def track(detections: DataFrame, options: Options = Options()) -> DataFrame:
    """As operators.tracking.assign, over a stream: a video's open tracks are its state.

    Frames must arrive in order of time; a track is forgotten once the gap is exceeded.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["at", "det_id"], kind="stable")
        tracks, made = [], 0
        if state.exists:
            text, made = state.get
            tracks = [Track(n, tuple(b), last) for n, b, last in json.loads(text)]
        numbers: list[int] = []
        for at, shift, found in frames(rows):
            own, made = frame_step(tracks, made, at, shift, found, options)
            numbers += own
        state.update((json.dumps([(t.number, t.box, t.last) for t in tracks]), made))
        yield pd.DataFrame({"video_id": key[0], "det_id": rows.det_id, "at": rows["at"], "track_id": numbers})

    kind = detections.schema["video_id"].dataType.simpleString()
    return detections.groupBy("video_id").applyInPandasWithState(step, f"video_id {kind}, det_id long, at long, track_id long", "open string, made long", "append", GroupStateTimeout.NoTimeout)


def free(s: dict, at: float) -> bool:
    """Whether a task can be claimed: queued, or running with its lease over, while attempts are left."""
    over = s["status"] == "running" and s["until"] is not None and s["until"] < at
    return (s["status"] == "queued" or over) and s["attempts"] < s["most"]


def fold(state: dict | None, event: dict, lease_s: float = 3600.0) -> dict | None:
    """One event of a task: enqueue, claim, complete, fail.

    A task is completed or failed by the worker that claimed it last only; a failed one is queued again
    while attempts are left.  A heartbeat is a worker's, not a task's (``workers``), and extends no lease.
    """
    s, kind, at, worker = dict(state) if state else None, event["kind"], event["at"], event.get("worker")
    if kind == "enqueue":
        return s or {"status": "queued", "priority": event.get("priority", 100), "attempts": 0, "most": event.get("most", 3), "owner": None, "until": None, "created": at, "at": at}
    if s is None:
        return None
    if kind == "claim" and free(s, at):
        return s | {"status": "running", "attempts": s["attempts"] + 1, "owner": worker, "until": at + lease_s, "at": at}
    if kind in ("complete", "fail") and s["owner"] is not None and s["owner"] == worker:
        again = "failed" if s["attempts"] >= s["most"] else "queued"
        return s | {"status": "done" if kind == "complete" else again, "until": None, "at": at}
    return s


def queue(events: DataFrame) -> DataFrame:
    """The latest state of each task after each batch.  Events: task_id, kind, at, worker, seq.
    Claims that choose among a queue's tasks are ``claims``."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["at", "seq"])
        s = json.loads(state.get[0]) if state.exists else None
        for r in rows.to_dict("records"):
            s = fold(s, r)
        if s is not None:
            state.update((json.dumps(s),))
            yield pd.DataFrame([{"task_id": key[0], "status": s["status"], "attempts": s["attempts"], "owner": s["owner"], "at": s["at"]}])

    kind = events.schema["task_id"].dataType.simpleString()
    return events.groupBy("task_id").applyInPandasWithState(step, f"task_id {kind}, status string, attempts long, owner string, at double", "s string", "update", GroupStateTimeout.NoTimeout)


CLAIMS = "queue string, seq long, at double, worker string, task_id string, attempts long"


def claims(events: DataFrame, lease_s: float = 3600.0) -> DataFrame:
    """What each claim of a queue takes: the claimable task of the lowest (priority, created, id).

    Events: queue, task_id (null of claims), kind, at, worker, seq, priority, most.  A queue's unfinished
    tasks are its state; finished ones are forgotten, and events of unknown tasks do nothing.  Two heaps
    hold the claimable tasks and the ends of leases, so a claim does not look through all tasks.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["at", "seq"])
        tasks: dict[str, dict] = json.loads(state.get[0]) if state.exists else {}
        place = lambda i: (tasks[i]["priority"], tasks[i]["created"], i)
        ready = [place(i) for i, s in tasks.items() if s["status"] == "queued"]
        leases = [(s["until"], i) for i, s in tasks.items() if s["status"] == "running"]
        heapq.heapify(ready)
        heapq.heapify(leases)
        out = []
        for r in rows.astype(object).where(rows.notna(), None).to_dict("records"):
            at, i = r["at"], r["task_id"]
            if r["kind"] == "claim":
                i = None
                while leases and leases[0][0] < at:
                    over = heapq.heappop(leases)[1]
                    if over in tasks:
                        heapq.heappush(ready, place(over))
                while ready and not ((i := heapq.heappop(ready)[2]) in tasks and free(tasks[i], at)):
                    i = None
                if i is None:
                    continue
                tasks[i] = fold(tasks[i], r, lease_s)
                heapq.heappush(leases, (tasks[i]["until"], i))
                out.append((key[0], r["seq"], at, r["worker"], i, tasks[i]["attempts"]))
            elif (s := fold(tasks.get(i), {k: v for k, v in r.items() if v is not None}, lease_s)) is not None:
                if s["status"] in ("done", "failed"):
                    tasks.pop(i, None)
                    continue
                tasks[i] = s
                if s["status"] == "queued":
                    heapq.heappush(ready, place(i))
        state.update((json.dumps(tasks),))
        yield pd.DataFrame(out, columns=["queue", "seq", "at", "worker", "task_id", "attempts"])

    return events.groupBy("queue").applyInPandasWithState(step, CLAIMS, "s string", "append", GroupStateTimeout.NoTimeout)


def workers(events: DataFrame, now: Column) -> DataFrame:
    """Each worker's last heartbeat and the seconds since then (update mode, key worker)."""
    return events.where("kind = 'heartbeat'").groupBy("worker").agg(F.max("at").alias("last_seen")).withColumn("seconds_since", now - F.col("last_seen"))
