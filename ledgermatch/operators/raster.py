"""Patches of a pixel mask and their outlines.

Pixels are rows (x, y).  They are labelled tile by tile, and labels that touch over a tile's border are united, so no task holds more than a tile; patches join over corners
as over sides.  Outlines are sides of pixels without a neighbour, joined to straight runs before they are traced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.operators.clusters import components

Keep = Callable[[DataFrame], DataFrame]
TILE = 256


def label_tile(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the pixels of a tile the least pixel (x, y) of each one's patch within it; least by y, then x."""
    order = np.lexsort((x, y))
    x, y = x[order], y[order]
    # runs of pixels in a row
    new = np.concatenate(([True], (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)))
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    begin, end, row = x[first], x[np.append(first[1:], len(x)) - 1], y[first]
    root = list(range(len(first)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    at = {int(r): (int(a), int(b)) for r, a, b in zip(*(lambda r: (r, np.searchsorted(row, r), np.searchsorted(row, r, "right")))(np.unique(row)), strict=True)}
    for r, (a, b) in at.items():
        c, d = at.get(r + 1, (0, 0))
        while a < b and c < d:  # runs of two rows in order of x; corners count
            if begin[c] <= end[a] + 1 and begin[a] <= end[c] + 1:
                i, j = find(a), find(c)
                root[max(i, j)] = min(i, j)
            if end[a] < end[c]:
                a += 1
            else:
                c += 1
    top = np.array([find(i) for i in range(len(root))], dtype=int)[run]
    back = np.empty(len(x), dtype=int)
    back[order] = np.arange(len(x))
    return begin[top][back], row[top][back]


def patches(pixels: DataFrame, keep: Keep, tile: int = TILE) -> DataFrame:
    """Each pixel once with its patch: x, y, patch (struct of y and x: the patch's least pixel).  Rows without x or y are no pixels."""
    known = pixels.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(F.col("x").cast("long"), F.col("y").cast("long")).distinct()
    dealt = known.withColumns({"tx": F.floor(F.col("x") / tile), "ty": F.floor(F.col("y") / tile)})

    def run(f: pd.DataFrame) -> pd.DataFrame:
        px, py = label_tile(f["x"].to_numpy(), f["y"].to_numpy())
        return pd.DataFrame({"x": f["x"], "y": f["y"], "py": py, "px": px})

    own = dealt.groupBy("tx", "ty").applyInPandas(run, "x long, y long, py long, px long").select("x", "y", F.struct(F.col("py").alias("y"), F.col("px").alias("x")).alias("own"))
    own = keep(own)
    # pixels on a tile's border against those over it, below and to the right
    edge = lambda c: F.pmod(F.col(c), F.lit(tile)).isin(0, tile - 1)
    border = own.where(edge("x") | edge("y"))
    ahead = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (-1, 1), (0, 1), (1, 1))])).alias("d")
    near = border.select(F.col("own").alias("a"), "x", "y", ahead).select("a", (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"))
    links = near.join(border.select("x", "y", F.col("own").alias("b")), ["x", "y"]).where(F.col("a") != F.col("b")).select("a", "b").distinct()
    tied = components(links, keep)
    return own.join(tied.select(F.col("id").alias("own"), "component"), "own", "left").select("x", "y", F.coalesce("component", "own").alias("patch"))


def sizes(labelled: DataFrame, pixel_m: float = 20.0, least_ha: float = 0.5) -> DataFrame:
    """Patches of more than ``least_ha``: patch, pixels, area_ha and bounds in pixels."""
    rows = labelled.groupBy("patch").agg(F.count("*").alias("pixels"), *[f(c).alias(n) for c, f, n in (("x", F.min, "minx"), ("y", F.min, "miny"), ("x", F.max, "maxx"), ("y", F.max, "maxy"))])
    return rows.withColumn("area_ha", F.col("pixels") * pixel_m**2 / 10_000).where(F.col("area_ha") > least_ha)


def sides(labelled: DataFrame) -> DataFrame:
    """Straight runs of the patches' borders, the patch on their left: patch, x1, y1, x2, y2 in corners of pixels."""
    # of each side of a pixel: the neighbour across, and its ends, the pixel to the left
    way = [(0, -1, 0, 0, 1, 0), (1, 0, 1, 0, 1, 1), (0, 1, 1, 1, 0, 1), (-1, 0, 0, 1, 0, 0)]
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("dx", "dy", "x1", "y1", "x2", "y2"), w, strict=True)]) for w in way])).alias("s")
    all_ = labelled.select("patch", "x", "y", each)
    all_ = all_.select("patch", (F.col("x") + F.col("s.dx")).alias("nx"), (F.col("y") + F.col("s.dy")).alias("ny"), *[(F.col(c[0]) + F.col(f"s.{c}")).alias(c) for c in ("x1", "y1", "x2", "y2")])
    bare = all_.join(labelled.select(F.col("x").alias("nx"), F.col("y").alias("ny")), ["nx", "ny"], "left_anti")
    # one line of one direction: positions that follow each other are one run
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    line = F.when(dy == 0, F.col("y1")).otherwise(F.col("x1"))
    bare = bare.withColumns({"dx": dx, "dy": dy, "line": line, "at": F.when(dy == 0, F.least("x1", "x2")).otherwise(F.least("y1", "y2"))})
    by = Window.partitionBy("patch", "dx", "dy", "line").orderBy("at")
    runs = bare.withColumn("run", F.col("at") - F.row_number().over(by)).groupBy("patch", "dx", "dy", "line", "run").agg(F.min("at").alias("lo"), (F.max("at") + 1).alias("hi"))
    ahead, level = (F.col("dx") + F.col("dy")) > 0, F.col("dy") == 0
    begin, end = F.when(ahead, F.col("lo")).otherwise(F.col("hi")), F.when(ahead, F.col("hi")).otherwise(F.col("lo"))
    pick = lambda along, flat: F.when(flat, along).otherwise(F.col("line"))
    return runs.select("patch", pick(begin, level).alias("x1"), pick(begin, ~level).alias("y1"), pick(end, level).alias("x2"), pick(end, ~level).alias("y2"))


def trace(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> list[list[tuple[int, int]]]:
    """Rings of runs that follow each other, outer ones counter-clockwise and holes clockwise; a way that comes back to a corner leaves a ring there, so no ring touches itself."""
    out: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for a, b, c, d in zip(x1.tolist(), y1.tolist(), x2.tolist(), y2.tolist(), strict=True):
        out[a, b].append((c, d))
    rings = []
    for first in sorted(out):
        while out[first]:
            way, at = [first], {first: 0}
            while way:
                now = way[-1]
                ways = out[now]
                if len(way) > 1:  # the sharpest turn to the left stays on the pixel
                    dx, dy = now[0] - way[-2][0], now[1] - way[-2][1]
                    ways.sort(key=lambda w: dx * (w[1] - now[1]) - dy * (w[0] - now[0]))  # noqa: B023
                step = ways.pop()
                if step in at:
                    rings.append(way[at[step] :])
                    for p in way[at[step] + 1 :]:
                        del at[p]
                    del way[at[step] + 1 :]
                    if len(way) == 1:
                        break
                else:
                    at[step] = len(way)
                    way.append(step)
    return rings


def outlines(labelled: DataFrame, pixel_m: float = 20.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Patches as polygons: patch, rings in metres from (x0, y0).  A group is one patch's runs, which are what its one row holds."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        rings = [[{"x": x0 + x * pixel_m, "y": y0 + y * pixel_m} for x, y in r] for r in trace(*(f[c].to_numpy() for c in ("x1", "y1", "x2", "y2")))]
        return pd.DataFrame({"py": [f["py"].iloc[0]], "px": [f["px"].iloc[0]], "rings": [rings]})

    runs = sides(labelled).withColumns({"py": F.col("patch.y"), "px": F.col("patch.x")}).drop("patch")
    made = runs.groupBy("py", "px").applyInPandas(run, "py long, px long, rings array<array<struct<x: double, y: double>>>")
    return made.select(F.struct(F.col("py").alias("y"), F.col("px").alias("x")).alias("patch"), "rings")
