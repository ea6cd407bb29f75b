"""Best-fit packing of token sequences by bin completion, branch and bound, over the histogram of lengths.

Lengths are at most the capacity, so their histogram is a sufficient statistic of bounded size (``capacity`` counts),
whatever the corpus.  The solver works on it alone: it takes the largest length left, enumerates the fillings of the room beside it
that no other dominates, by least waste, and branches over them and how often each is used; a branch is cut when its bins and the waste bound
on the rest can't beat the incumbent.  The first incumbent is best-fit decreasing.  The search ends at the lower bound, when nothing is
left to try, or after ``steps`` steps, its only limit; the plan says which, and ``pack`` logs a plan that isn't proven.

Pieces then take the plan's places by rank within their length.  Ranks come from counts of (length, bucket of a
hash), so no length, however common, is ranked in one task.

Defined results: a null or empty text is a document of the end id alone; repeated rows are packed as often as they occur;
an empty table gives an empty packing.  Only documents longer than the capacity are cut.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut
from ledgermatch.llm.tokens import encoder

CAPACITY = 2048
#: Steps of the search for a plan, its only limit, and how many of them a node counts for.
STEPS, NODE = 1_000_000, 30
#: Nodes of the search remember the sums of every so many lengths, which bounds what a path of nodes holds.
EVERY = 16
_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Plan:
    """``patterns``: (lengths in descending order, how many sequences have it).  ``bins`` sequences; no packing has fewer than ``bound``.

    ``proven``: no packing has fewer than ``bins``.
    """

    patterns: list[tuple[tuple[int, ...], int]]
    bins: int
    bound: int
    proven: bool


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The larger of the volume bound and the bounds by items that can't share a bin (Martello and Toth's L2)."""
    sizes = np.arange(len(counts))
    best = -(-int(counts @ sizes) // capacity)
    upto = np.concatenate((np.cumsum(counts), [counts.sum()]))
    mass = np.concatenate((np.cumsum(counts * sizes), [counts @ sizes]))
    half = capacity // 2
    for k in np.flatnonzero(counts[: half + 1]):
        alone = upto[capacity] - upto[capacity - k]  # longer than capacity - k: nothing of k or more fits beside them
        large = upto[capacity - k] - upto[half]
        room = int(large) * capacity - int(mass[capacity - k] - mass[half])
        rest = int(mass[half] - (mass[k - 1] if k else 0))
        best = max(best, int(alone + large) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: equal bins are handled together."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}
    for length in np.flatnonzero(counts)[::-1]:
        length, left = int(length), int(counts[length])
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                each = min(left, capacity // length)
                n = left // each
                items, n_new = (length,) * each, n
                left -= n * each
                group = open_bins.setdefault(capacity - length * each, {})
                group[items] = group.get(items, 0) + n_new
                continue
            group = open_bins[room]
            items, have = next(iter(group.items()))
            n = min(have, left)
            left -= n
            if n == have:
                del group[items]
                if not group:
                    del open_bins[room]
            else:
                group[items] = have - n
            to = open_bins.setdefault(room - length, {})
            to[(*items, length)] = to.get((*items, length), 0) + n
    return [(items, n) for group in open_bins.values() for items, n in group.items()]


def _covers(big: tuple[int, ...], small: tuple[int, ...]) -> bool:
    """Whether the items of ``small`` fit into bins of the sizes of ``big``, best fit: then ``big`` dominates it."""
    room = list(big)
    for x in small:
        k = min((i for i, r in enumerate(room) if r >= x), key=room.__getitem__, default=None)
        if k is None:
            return False
        room[k] -= x
    return True


def _sums(lengths: list[int], counts: np.ndarray, room: int) -> list[int]:
    """For each EVERY-th i a bit set of the sums up to ``room`` that items of lengths[i:] make."""
    mask, now, reach = (1 << (room + 1)) - 1, 1, []
    for i in range(len(lengths) - 1, -1, -1):
        x = lengths[i]
        left, step = min(int(counts[x]), room // x), 1
        while left:  # by doubling: 1, 2, 4, ... items at once
            step = min(step, left)
            now |= now << (x * step) & mask
            left -= step
            step *= 2
        if i % EVERY == 0:
            reach.append(now)
    return reach[::-1]


class Budget:
    """Steps left to a search."""

    def __init__(self, steps: int) -> None:
        self.left = steps

    def spend(self, steps: int = 1) -> bool:
        """Takes steps; False if there were none left."""
        self.left -= steps
        return self.left >= 0


def fillings(counts: np.ndarray, room: int, budget: Budget | None = None) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of the room from the available lengths, lazily: by least waste, then by fewest items, then largest first.

    A filling that wastes more, or as much with more items, can't dominate one that comes before it, so each is held against those
    before it alone.  ``counts`` must be as it was whenever the next filling is asked for.
    """
    have = np.flatnonzero(counts[: room + 1])
    have = have[have > 0]
    if not len(have):
        yield ()
        return
    budget = budget or Budget(1 << 62)
    given: list[tuple[int, ...]] = []

    def new(found: tuple[int, ...]) -> bool:
        budget.spend(len(given))
        return not any(_covers(g, found) for g in given)

    # most often one or two items fill the room
    if counts[room]:
        given.append((room,))
        yield (room,)
    other = room - have
    pair = have[(other <= have) & (other > 0) & (counts[other] > (other == have))]
    for x in pair[::-1].tolist():
        found = (x, room - x)
        if new(found):
            given.append(found)
            yield found
        if budget.left < 0:
            return
    budget.spend(len(have))
    lengths = have[::-1].tolist()
    reach = _sums(lengths, counts, room)
    least = lengths[-1]

    def exact(i: int, total: int, items: int, used: int) -> Iterator[tuple[int, ...]]:
        """So many items of lengths[i:] that make the total, ``used`` of lengths[i] being taken."""
        if not items:
            if not total:
                yield ()
            return
        for j in range(i, len(lengths)):
            x = lengths[j]
            if x * items < total or not budget.spend():
                return
            if x > total or total - x < least * (items - 1) or not reach[j // EVERY] >> total & 1 or (j == i and used >= counts[x]):
                continue
            for rest in exact(j, total - x, items - 1, used + 1 if j == i else 1):
                yield (x, *rest)

    for total in range(room, least - 1, -1):
        if budget.left < 0:
            return
        if not reach[0] >> total & 1:
            continue
        for items in range(1, total // least + 1):
            if total == room and items <= 2:
                continue
            for found in exact(0, total, items, 0):
                if new(found):
                    given.append(found)
                    yield found


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, steps: int = STEPS) -> Plan:
    """Packs ``counts[length]`` items of each length from 1 to ``capacity``.

    A node takes the largest length left, one of its undominated fillings and how many sequences take it, the most first.  Fillings that a node
    has passed over stay excluded below it as long as the largest length is the same, so no packing is looked at twice.  The search is whole
    but for ``steps`` (a node counts as NODE of them): when it ends before them without meeting the bound, the incumbent is the best there is.
    """
    budget = Budget(steps)
    counts = np.asarray(counts, dtype=np.int64).copy()
    bound = lower_bound(counts, capacity)
    best = best_fit_decreasing(counts, capacity)
    best_bins = sum(n for _, n in best)
    half = capacity // 2 + 1
    sizes = np.arange(len(counts))
    left, large = int(counts @ sizes), int(counts[half:].sum())
    path: list[tuple[tuple[int, ...], int]] = []
    used = 0

    def options(barred: frozenset[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], int, frozenset[tuple[int, ...]]]]:
        """Fillings of a node with their uses and what is barred below."""
        largest = int(np.flatnonzero(counts)[-1])
        passed = barred if not barred or next(iter(barred))[0] == largest else frozenset()
        counts[largest] -= 1
        found = fillings(counts, capacity - largest, budget)
        while True:
            rest = next(found, None)
            if rest is None:
                counts[largest] += 1
                return
            counts[largest] += 1
            items = (largest, *rest)
            if items not in passed:
                lengths, each = np.unique(items, return_counts=True)
                most = int((counts[lengths] // each).min())
                passed = passed | {items}
                for n in range(most, 0, -1):
                    yield items, n, passed
            counts[largest] -= 1

    def take(items: tuple[int, ...], n: int) -> None:
        nonlocal left, large, used
        for x in items:
            counts[x] -= n
        left -= n * sum(items)
        large -= n * sum(x >= half for x in items)
        used += n

    stack = [options(frozenset())] if left else []
    while stack and best_bins > bound and budget.spend(NODE):
        choice = next(stack[-1], None)
        if choice is None:
            stack.pop()
            if path:
                take(path[-1][0], -path[-1][1])
                path.pop()
            continue
        items, n, barred = choice
        take(items, n)
        # the waste so far and the least the rest needs can't beat the incumbent
        if left and used + max(-(-left // capacity), large) < best_bins:
            path.append((items, n))
            stack.append(options(barred))
            continue
        if not left and used < best_bins:
            best, best_bins = [*path, (items, n)], used
        take(items, -n)
    return Plan(best, best_bins, bound, best_bins == bound or (not stack and budget.left >= 0))


def places(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, offset, first sequence, items of this length in a sequence), ascending: who sits where."""
    rows, sequence = [], 0
    ranks: dict[int, int] = {}
    for items, n in plan.patterns:
        offset = 0
        lengths, uses = np.unique(items, return_counts=True)
        for length, each in zip(lengths.tolist()[::-1], uses.tolist()[::-1], strict=True):
            rows.append((length, ranks.get(length, 0), offset, sequence, each))
            ranks[length] = ranks.get(length, 0) + n * each
            offset += length * each
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def seat(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks among equal lengths."""
    span = np.int64(1) << 44
    at = np.searchsorted(table[:, 0] * span + table[:, 1], length * span + rank, side="right") - 1
    _, first, offset, sequence, each = table[at].T
    return sequence + (rank - first) // each, offset + (rank - first) % each * length


def cut_documents(docs: DataFrame, tokenizer: str, lower: bool = True, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: key, piece, start, length, ids_crc32.  A document is its ids and then id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer, lower)
        end = np.zeros(1, np.uint32)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(made.encode(batch.column(1))):
                ids = np.concatenate((ids, end)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    row.append(i), piece.append(k), start.append(at), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["k", "piece", "start", "length", "ids_crc32"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("k", key)


def pack(pieces: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", per_bucket: int = 50_000) -> DataFrame:
    """Adds sequence_id and offset to pieces (key, piece, start, length, ids_crc32)."""
    pieces = cut(pieces, "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = complete_bins(counts, capacity)
    if not plan.proven:
        _log.warning("%d sequences; none has been proven to need more than %d", plan.bins, plan.bound)
    table = places(plan)
    buckets = int(counts.sum()) // per_bucket + 1
    dealt = pieces.withColumn("b", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(buckets)))
    within = Window.partitionBy("length", "b").orderBy(F.col(key), "piece", "ids_crc32")
    base = dealt.groupBy("length", "b").agg(F.count("*").alias("n")).withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("b")) - F.col("n")).select("length", "b", "base")
    ranked = dealt.withColumn("w", F.row_number().over(within)).join(base, ["length", "b"]).withColumn("rank", F.col("base") + F.col("w") - 1).select(*pieces.columns, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = seat(table, batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            rows = batch.drop_columns(["rank"])
            yield rows.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, lower: bool = True, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(cut_documents(docs, tokenizer, lower, capacity, key, text), capacity, key)
