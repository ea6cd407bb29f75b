"""Connected components of a link table: partitions contract their links by themselves, then roots are looked up.

A round deals the links (a > b) out by ``a`` and contracts each partition: every vertex is tied to the least vertex that the
partition's links reach from it.  Then each vertex takes its root's own root.  A round ends in a written table; the rounds end when no root
has a root above it and no vertex has two.  Links stay distributed; a partition holds its share of them, numbers alone.

Before the first round the partitions are contracted as they come, so a vertex with very many links is down to one link a
partition when links are dealt out by vertex.  Looking up roots is a join of which Spark can split hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, release

#: Rounds halve the longest chain of roots, so 2 ** ROUNDS vertices in a row are needed to run out of them.
ROUNDS = 64


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, least vertex reached) for all vertices of the links but the least ones themselves."""
    vertex, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(vertex))
    while len(u):
        least = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], least)
        np.minimum.at(root, root[v], least)
        while (above := root[root]).tobytes() != root.tobytes():
            root = above
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    tied = np.flatnonzero(root != np.arange(len(vertex)))
    return vertex[tied], vertex[root[tied]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contracted links of a partition; ``own`` tells whether the vertex is one that links of the partition were dealt by."""
    a, b, own, held = [], [], [], 0

    def work() -> tuple[np.ndarray, np.ndarray]:
        own.append(np.unique(np.concatenate(a)))
        return contract(np.concatenate(a), np.concatenate(b))

    for batch in batches:
        a.append(batch.column(0).to_numpy()), b.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held > 2_000_000:  # a long partition is contracted as it comes
            x, y = work()
            a, b, held = [x], [y], 0
    if a:
        x, y = work()
        home = np.isin(x, np.concatenate(own))
        for i in range(0, len(x), 100_000):
            part = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[part], pa.int64()), pa.array(y[part], pa.int64()), pa.array(home[part])], ["a", "b", "own"])


_LINKS = "a long, b long, own boolean"


def connected(links: DataFrame) -> DataFrame:
    """For links (a, b) of long ids: rows (id, component) for every id in a link that isn't its component's least; the component is
    the least id.  An id without a row is its own component.  Links of null ids or from an id to itself join nothing."""
    solid = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, held = solid.mapInArrow(_contracted, _LINKS).select("a", "b"), None
    for _ in range(ROUNDS):
        dealt = cut(now.repartition("a").mapInArrow(_contracted, _LINKS), "links")
        up = dealt.groupBy("a").agg(F.min("b").alias("up")).select(F.col("a").alias("b"), "up")
        seen = cut(dealt.join(up, "b", "left").select("a", "b", "own", "up"), "links")
        release(dealt, *([held] if held else []))
        # ties of strangers to a partition may be a vertex's second; a root that is tied itself hands on its own root
        if not (open_ := seen.agg(F.count("up") + F.count_if(~F.col("own"))).first()[0]):
            return seen.select(F.col("a").alias("id"), F.col("b").alias("component"))
        now, held = seen.select("a", F.coalesce("up", "b").alias("b")), seen
    raise ArithmeticError(f"components are not whole after {ROUNDS} rounds: {open_} ties are open")
