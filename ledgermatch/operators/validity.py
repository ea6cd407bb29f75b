"""Validity of polygons, and their repair by the even-odd rule.

A polygon's edges are cut wherever two of them meet.  A piece that occurs an even number of times bounds nothing; the others bound the region that an odd number of rings
encloses, and are traced into simple rings: outer rings run counter-clockwise, holes clockwise.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.polygons import PAIRS, inside, ring_edges, rings_of

#: What can be wrong with a geometry, in the order in which it is looked for.
PROBLEMS = ("missing", "empty", "few_points", "spike", "self_intersection")
#: Points closer than this share of a polygon's extent are one.
GRID = 1e-12


def _snap(rings: list[np.ndarray]) -> tuple[list[np.ndarray], float]:
    """Rings without repeated neighbours, and the width of the grid on which points are compared."""
    kept = []
    for r in rings:
        r = r[np.any(r != np.roll(r, 1, axis=0), axis=1)] if len(r) > 1 else r
        kept.append(r)
    points = np.concatenate([np.zeros((0, 2)), *kept])
    extent = float(np.abs(points).max()) if len(points) else 0.0
    return kept, max(extent * GRID, 1e-12)


def _cuts(e: np.ndarray, near: float) -> dict[int, list[tuple[float, float, float]]]:
    """Per edge the points where others meet it between its ends: (how far along, x, y)."""
    found: dict[int, list[tuple[float, float, float]]] = defaultdict(list)
    lo, hi = np.minimum(e[:, :2], e[:, 2:]) - near, np.maximum(e[:, :2], e[:, 2:]) + near
    d = e[:, 2:] - e[:, :2]
    size = np.hypot(d[:, 0], d[:, 1])
    for i in range(0, len(e), step := max(1, PAIRS // max(1, len(e)))):
        part = slice(i, i + step)
        meet = (lo[part, None, 0] <= hi[None, :, 0]) & (hi[part, None, 0] >= lo[None, :, 0]) & (lo[part, None, 1] <= hi[None, :, 1]) & (hi[part, None, 1] >= lo[None, :, 1])
        a, b = np.nonzero(meet)
        a += i
        a, b = a[a != b], b[a != b]
        # an end of b on a, between a's ends
        for end in (0, 2):
            gap = e[b, end : end + 2] - e[a, :2]
            along = (gap * d[a]).sum(axis=1) / np.maximum(size[a], 1e-300)
            off = np.abs(d[a, 0] * gap[:, 1] - d[a, 1] * gap[:, 0]) / np.maximum(size[a], 1e-300)
            for k in np.flatnonzero((off <= near) & (along > near) & (along < size[a] - near)):
                found[int(a[k])].append((along[k] / size[a[k]], float(e[b[k], end]), float(e[b[k], end + 1])))
        # crossings between the ends of both, each once for a and once for b
        cross = d[a, 0] * d[b, 1] - d[a, 1] * d[b, 0]
        gap = e[b, :2] - e[a, :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap[:, 0] * d[b, 1] - gap[:, 1] * d[b, 0]) / cross
            u = (gap[:, 0] * d[a, 1] - gap[:, 1] * d[a, 0]) / cross
        for k in np.flatnonzero((cross != 0) & (t * size[a] > near) & ((1 - t) * size[a] > near) & (u * size[b] > near) & ((1 - u) * size[b] > near)):
            one, other = (int(a[k]), t[k]), (int(b[k]), u[k])
            base, at = min(one, other)  # the same point for both edges
            x, y = (e[base, :2] + at * d[base]).tolist()
            found[one[0]].append((float(t[k]), x, y))
    return found


def problem_of(rings: list[np.ndarray] | None) -> str | None:
    """The first of PROBLEMS that a polygon has, or None."""
    if rings is None:
        return "missing"
    rings = [r for r in rings if len(r)]
    if not rings:
        return "empty"
    rings, near = _snap(rings)
    if any(len(np.unique(r, axis=0)) < 3 for r in rings):
        return "few_points"
    for r in rings:
        before, after = r - np.roll(r, 1, axis=0), np.roll(r, -1, axis=0) - r
        back = (np.abs(before[:, 0] * after[:, 1] - before[:, 1] * after[:, 0]) <= near * np.hypot(*before.T)) & ((before * after).sum(axis=1) < 0)
        if back.any():
            return "spike"
    e = ring_edges(rings)
    points = np.concatenate(rings)
    # rings may touch each other in points; a ring that meets itself, or an edge that crosses or covers another, is none
    for r in rings:
        if len(np.unique(r, axis=0)) < len(r) or _cuts(ring_edges([r]), near):
            return "self_intersection"
    if len(rings) > 1:
        cuts = _cuts(e, near)
        on = {(float(x), float(y)) for x, y in points}
        if any((x, y) not in on for c in cuts.values() for _, x, y in c) or len({frozenset(((a, b), (c, d))) for a, b, c, d in e.tolist()}) < len(e):
            return "self_intersection"
    return None


def repair(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Simple rings around the region that an odd number of the given rings encloses; none where that has no area."""
    rings, near = _snap([r for r in rings if len(r)])
    e = ring_edges(rings)
    cuts, grid = _cuts(e, near), 8 * near
    name: dict[tuple[int, int], int] = {}
    at: list[tuple[float, float]] = []

    def node(x: float, y: float) -> int:
        cell = (round(x / grid), round(y / grid))
        for dx in (0, -1, 1):
            for dy in (0, -1, 1):
                if (found := name.get((cell[0] + dx, cell[1] + dy))) is not None and abs(at[found][0] - x) <= grid and abs(at[found][1] - y) <= grid:
                    return found
        name[cell] = len(at)
        at.append((x, y))
        return name[cell]

    odd: set[tuple[int, int]] = set()
    for i, (x1, y1, x2, y2) in enumerate(e.tolist()):
        stops = [node(x1, y1), *[node(x, y) for _, x, y in sorted(cuts.get(i, ()))], node(x2, y2)]
        for a, b in zip(stops, stops[1:], strict=False):
            if a != b:
                odd ^= {(min(a, b), max(a, b))}
    links: dict[int, set[int]] = defaultdict(set)
    for a, b in odd:
        links[a].add(b), links[b].add(a)
    made = []
    for first in sorted(links):
        while links[first]:
            way = [first]
            while True:
                now = way[-1]
                came = way[-2] if len(way) > 1 else None
                # the sharpest turn to the right stays on the border of one region
                angle = lambda n: np.arctan2(at[n][1] - at[now][1], at[n][0] - at[now][0])  # noqa: B023, E731
                base = angle(came) if came is not None else 0.0
                step = min(links[now], key=lambda n: ((angle(n) - base) % (2 * np.pi) or 2 * np.pi, n))  # noqa: B023
                links[now].discard(step), links[step].discard(now)
                if step in way:  # a loop: a ring of its own
                    k = way.index(step)
                    made.append(np.array([at[n] for n in way[k:]]))
                    way = way[: k + 1]
                    if len(way) == 1 or not links[step]:
                        break
                else:
                    way.append(step)
            # what is left of the way was walked towards the loop and goes on from its start
            for a, b in zip(way, way[1:], strict=False):
                links[a].add(b), links[b].add(a)
    edges = [ring_edges([r]) for r in made]
    area = [float((x[:, 0] * x[:, 3] - x[:, 2] * x[:, 1]).sum() / 2) for x in edges]
    out = []
    for i, r in enumerate(made):
        # a point just inside the ring: beside the middle of its first edge, on the side that it encloses
        (x1, y1, x2, y2), turn = edges[i][0], np.sign(area[i])
        width = np.hypot(x2 - x1, y2 - y1)
        step = min(width, abs(area[i]) ** 0.5) * 1e-6
        x, y = (x1 + x2) / 2 - turn * (y2 - y1) / width * step, (y1 + y2) / 2 + turn * (x2 - x1) / width * step
        depth = sum(inside(edges[j], x, y) for j in range(len(made)) if j != i)
        outer = depth % 2 == 0
        out.append((depth, -abs(area[i]), r if (turn > 0) == outer else r[::-1]))
    return [r for _, _, r in sorted(out, key=lambda x: x[:2])]


def _listed(rings: list[np.ndarray] | None) -> list[list[dict]] | None:
    return None if rings is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def _convex(rings: list[list[np.ndarray] | None]) -> np.ndarray:
    """Which polygons are one ring of three or four points that turns one way at each, by more than rounding makes of a straight line: it goes around once and has no problem."""
    sound = np.zeros(len(rings), dtype=bool)
    for n in (3, 4):
        at = [i for i, r in enumerate(rings) if r is not None and len(r) == 1 and len(r[0]) == n]
        if at:
            p = np.stack([rings[i][0] for i in at])
            d = np.roll(p, -1, axis=1) - p
            e = np.roll(d, -1, axis=1)
            turn = d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0]
            least = np.abs(p).max(axis=(1, 2))[:, None] * 1e-9 * (np.abs(d).sum(axis=2) + np.abs(e).sum(axis=2))
            sound[at] = (turn > least).all(axis=1) | (turn < -least).all(axis=1)
    return sound


RINGS = "array<array<struct<x: double, y: double>>>"
_KIND = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def checked(polygons: DataFrame, key: str = "row_idx", fix: bool = False) -> DataFrame:
    """Per polygon: key, problem (null if valid) and, with ``fix``, rings: repaired where they intersect themselves or have spikes, null where nothing is left.

    Polygons are dealt out before, as a small file of many polygons would be one task.  Convex triangles and quadrangles are told by a batch; the others are looked at point by point.
    """
    kind = polygons.schema[key].dataType.simpleString()
    spark = polygons.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    rows = polygons.select(F.col(key).alias("key"), F.col("rings").cast(RINGS)).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(1).is_valid().to_pylist()
            rings = [r if g else None for r, g in zip(rings_of(batch.column(1)), given, strict=True)]
            problems = [None if c else problem_of(r) for r, c in zip(rings, _convex(rings), strict=True)]
            columns = [batch.column(0), pa.array(problems, pa.string())]
            if fix:
                done = [repair(r) if p in ("spike", "self_intersection") else r if p is None else None for r, p in zip(rings, problems, strict=True)]
                columns.append(pa.array([_listed(r) if r else None for r in done], _KIND))
            yield pa.RecordBatch.from_arrays(columns, ["key", "problem", "rings"][: len(columns)])

    # no filter before: it would be pushed down to where the rings are made, and make them again
    return rows.mapInArrow(run, f"key {kind}, problem string" + (f", rings {RINGS}" if fix else "")).withColumnRenamed("key", key)


def shares(checked_: DataFrame) -> DataFrame:
    """Rows (problem, n, pct) for all PROBLEMS and ``valid``, with 0 where there are none."""
    counted = checked_.groupBy(F.coalesce("problem", F.lit("valid")).alias("problem")).agg(F.count("*").alias("n"))
    every = checked_.sparkSession.createDataFrame([(p,) for p in ("valid", *PROBLEMS)], "problem string")
    rows = every.join(counted, "problem", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = checked_.agg(F.count("*").alias("total"))  # one row
    return rows.join(F.broadcast(total)).select("problem", "n", F.when(F.col("total") > 0, F.round(F.col("n") / F.nullif("total", F.lit(0)) * 100, 2)).otherwise(0.0).alias("pct"))
