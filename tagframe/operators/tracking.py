"""Assigning detections to tracks over time; exact for a video, distributed over videos.

The step is inherently sequential within a video.  Detections of one video are one group of
applyInPandas (bounded by a video's length); many videos run in parallel.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Options:
    most_gap: int = 1800
    least_iou: float = 0.15
    most_distance: float = 1.2
    distance_weight: float = 0.45
    buffer: int = 24


@dataclass(eq=False)
class Track:
    number: int
    box: tuple[float, float, float, float]
    last: int
    kept: list[tuple] = field(default_factory=list)


def overlap(a, b) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0.0, w) * max(0.0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if union > 0 else 0.0


def distance(a, b) -> float:
    side = max(math.sqrt(max(0.0, (x[2] - x[0]) * (x[3] - x[1]))) for x in (a, b))
    return math.hypot((a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2) / max(side, 1.0)


def frame_step(tracks: list[Track], made: int, at: int, shift: tuple[float, float], found: list[tuple], options: Options) -> tuple[list[int], int]:
    """Forgets tracks past the gap and moves the others' boxes; then detections (box, confidence), best
    first, each take the best free track, the oldest on ties, or open one.  ``tracks`` holds live ones
    only and is changed in place.  Gives the track numbers in the order of ``found`` and the number made."""
    tracks[:] = [t for t in tracks if at - t.last <= options.most_gap]
    for t in tracks:
        t.box = (t.box[0] + shift[0], t.box[1] + shift[1], t.box[2] + shift[0], t.box[3] + shift[1])
    free, out = list(tracks), [0] * len(found)
    for i in sorted(range(len(found)), key=lambda i: (-found[i][1], i)):
        box, best, top = found[i][0], None, -math.inf
        for t in free:
            near, far = overlap(t.box, box), distance(t.box, box)
            if near < options.least_iou and far > options.most_distance:
                continue
            score = near + options.distance_weight * (1 - far / options.most_distance)
            if score > top:
                best, top = t, score
        if best is None:
            made += 1
            best = Track(made, box, at)
            tracks.append(best)
        else:
            free.remove(best)
        best.box, best.last = box, at
        out[i] = best.number
    return out, made


def frames(rows: pd.DataFrame):
    """(at, shift, detections) of each frame, from rows in order."""
    every = zip(*(rows[c].tolist() for c in ("at", "shift_x", "shift_y", "confidence", "x_min", "y_min", "x_max", "y_max")))
    for at, own in groupby(every, key=lambda r: r[0]):
        own = list(own)
        yield int(at), (own[0][1], own[0][2]), [(tuple(r[4:]), r[3]) for r in own]


def assign(detections: DataFrame, options: Options = Options()) -> DataFrame:
    """``detections``: video_id, det_id, at (ms), shift_x, shift_y, confidence and the box.  Adds track_id."""
    kind = detections.schema["video_id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "det_id"], kind="stable")
        tracks: list[Track] = []
        numbers: list[int] = []
        made = 0
        for at, shift, found in frames(pdf):
            own, made = frame_step(tracks, made, at, shift, found, options)
            numbers += own
        return pd.DataFrame({"video_id": pdf.video_id, "det_id": pdf.det_id, "at": pdf["at"], "track_id": numbers})

    return detections.groupBy("video_id").applyInPandas(run, f"video_id {kind}, det_id long, at long, track_id long")


def matched_truth(pairs: DataFrame, image: str = "image_id") -> DataFrame:
    """One-to-one matches of truth and prediction by descending overlap.  ``pairs``: image, truth, pred, iou > 0."""
    kind = pairs.schema[image].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["iou", "truth", "pred"], ascending=[False, True, True])
        a, b, rows = set(), set(), []
        for r in pdf.itertuples():
            if r.truth not in a and r.pred not in b:
                a.add(r.truth)
                b.add(r.pred)
                rows.append((getattr(r, image), r.truth, r.pred, r.iou))
        return pd.DataFrame(rows, columns=[image, "truth", "pred", "iou"])

    return pairs.groupBy(image).applyInPandas(run, f"{image} {kind}, truth long, pred long, iou double")


class Nearest:
    """Free boxes by overlap with a given one; rows of x_min, y_min, x_max, y_max with their ids."""

    def __init__(self, ids: np.ndarray, boxes: np.ndarray):
        order = np.argsort(boxes[:, 0], kind="stable")
        self.rows, self.ids, self.sides = order, ids[order], np.ascontiguousarray(boxes[order].T)
        self.area = np.maximum(0.0, self.sides[2] - self.sides[0]) * np.maximum(0.0, self.sides[3] - self.sides[1])
        self.widest = float((self.sides[2] - self.sides[0]).max(initial=0.0))

    def best(self, box: np.ndarray, free: np.ndarray, most: int) -> tuple[list[tuple[float, int, int]], bool]:
        """(overlap, id, row) of the ``most`` free boxes of highest overlap above 0, by overlap, then id;
        and whether these are all."""
        # A box that starts further left ends before this one begins; the margin is for rounding.
        a, b = np.searchsorted(self.sides[0], [box[0] - self.widest * (1 + 1e-9) - 1e-9 * abs(box[0]), box[2]])
        at = a + np.flatnonzero(free[self.rows[a:b]])
        x0, y0, x1, y1 = self.sides[:, at]
        inter = np.maximum(0.0, np.minimum(box[2], x1) - np.maximum(box[0], x0)) * np.maximum(0.0, np.minimum(box[3], y1) - np.maximum(box[1], y0))
        at, inter = at[inter > 0], inter[inter > 0]
        iou = inter / (max(0.0, box[2] - box[0]) * max(0.0, box[3] - box[1]) + self.area[at] - inter)
        every = len(at) <= most
        if not every:
            least = np.partition(iou, len(iou) - most)[len(iou) - most]
            above, even = np.flatnonzero(iou > least), np.flatnonzero(iou == least)
            even = even[np.argsort(self.ids[at[even]], kind="stable")][: most - len(above)]
            keep = np.append(above, even)
            at, iou = at[keep], iou[keep]
        order = np.lexsort((self.ids[at], -iou))
        return list(zip(iou[order].tolist(), self.ids[at[order]].tolist(), self.rows[at[order]].tolist())), every


def greedy_matches(truth_ids: np.ndarray, truths: np.ndarray, pred_ids: np.ndarray, preds: np.ndarray, most: int = 32) -> list[tuple[int, int, float]]:
    """(truth, pred, overlap) by descending overlap, then truth, then prediction.  A truth holds its ``most`` best
    free predictions only and looks again when those are taken, so memory grows with boxes, not with pairs."""
    free, near, taken = np.ones(len(preds), bool), Nearest(pred_ids, preds), 0
    settled: set[int] = set()
    used: set[int] = set()
    lists: dict[int, tuple[list, bool]] = {}
    heap: list[tuple[float, int, int, int, int, int]] = []
    out = []

    def look(row: int) -> None:
        lists[row] = near.best(truths[row], free, most)
        push(row, 0)

    def push(row: int, place: int) -> None:
        found, every = lists[row]
        if place < len(found):
            iou, pred, at = found[place]
            heapq.heappush(heap, (-iou, int(truth_ids[row]), pred, row, place, at))
        elif found and not every:
            look(row)

    for row in range(len(truths)):
        look(row)
    while heap:
        iou, truth, pred, row, place, at = heapq.heappop(heap)
        if truth in settled:
            del lists[row]
        elif not free[at] or pred in used:
            free[at] = False
            push(row, place + 1)
        else:
            out.append((truth, pred, -iou))
            settled.add(truth)
            used.add(pred)
            free[at] = False
            del lists[row]
            taken += 1
            if taken * 2 > len(near.rows):  # half are taken: those left only
                left = np.flatnonzero(free)
                near, taken = Nearest(pred_ids[left], preds[left]), 0
                near.rows = left[near.rows]
    return out


def matched_boxes(boxes: DataFrame, image: str = "image_id") -> DataFrame:
    """``matched_truth`` of all overlapping boxes of an image, without their pairs.  ``boxes``: image, id, is_pred and
    the box; rows with a null among them match nothing.  An image's boxes are one group."""
    kind = boxes.schema[image].dataType.simpleString()
    sides = ["x_min", "y_min", "x_max", "y_max"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, p = pdf[~pdf.is_pred], pdf[pdf.is_pred]
        found = greedy_matches(*(x for side in (t, p) for x in (side.id.to_numpy(np.int64), side[sides].to_numpy(float))))
        return pd.DataFrame([(key[0], *r) for r in found], columns=[image, "truth", "pred", "iou"])

    rows = boxes.select(image, F.col("id").cast("long").alias("id"), "is_pred", *(F.col(c).cast("double").alias(c) for c in sides)).dropna()
    return rows.groupBy(image).applyInPandas(run, f"{image} {kind}, truth long, pred long, iou double")


def cascade(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Drops rows whose targets are all settled by earlier rows of their group.  Columns: ordinal,
    targets array<string>, settles array<string>."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        done: set[str] = set()
        keep = []
        for r in pdf.sort_values("ordinal").itertuples():
            if len(r.targets) and set(r.targets) <= done:
                continue
            keep.append(r.Index)
            done |= set(r.settles)
        return pdf.loc[keep]

    return candidates.groupBy(*keys).applyInPandas(run, schema)
