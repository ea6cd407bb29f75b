"""N-gram Jaccard join: every pair of texts whose shingle sets have a Jaccard similarity of 0.8 or more, as components.

1. Sets.  Each text becomes a set of hashed five-word shingles; texts with one set are one class, and only classes go on.
2. Cells.  Two similar sets share a shingle among the first n - ceil(0.8 n) + 1 of each, in any order common to all sets.  The order
   here is by hash, with shingles that very many texts share put last, so cells of a common passage hold only texts made of it.
3. Leaders.  Each class is held against the least class of its largest cells; these links collapse groups of near copies, so
   no group is ever expanded into its pairs.
4. Signature trees.  A cell whose classes are not yet all in one component gets a tree over its classes' bitmaps: a
   node holds the OR of its token bitmaps, ranges of set size and of components.  A dual traversal drops node pairs whose largest
   possible overlap is too small, and pairs within a component; what is left joins components into clusters, by a spanning forest a cell.
   Classes that share a passage meet in a cell for each shingle of it: of cells with the same classes one gets a tree.
5. Clusters.  Within a cluster the same traversal runs over bitmaps of the shingles themselves, where overlaps are exact; links that
   join components come out.

A large cell or cluster is cut into blocks of classes of like sizes and dealt out as pairs of blocks whose sizes allow a link, so no
task holds more than two blocks; copies grow with the number of blocks, whose size grows with the root of the group's.

All bounds are exact: nothing similar is lost, and no pair counts as a link unless its sets say so.  Cells are told apart by 128 bits of hashes.

Defined results: words are lower-cased in A-Z only.  A text with one to four words has one shingle, its word sequence.  A null or
empty text has no shingles and links with nothing.  Repeated rows and equal texts are one class.  A row without an id is
linked like any other; a component's id is the least id in it, null if there is none.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, named, release, small_batches
from ledgermatch.llm.components import connected
from ledgermatch.llm.shingles import shingle_sets

WIDTH = 5
PERCENT = 80
#: A shingle that so many texts share is put last in the order; so many such shingles are known at most (the most common ones).
#: Both bear on speed alone.
COMMON, COMMON_MOST = 32, 200_000
#: Cells of a class whose leaders it is held against first; this too bears on speed alone.
LEADERS = 3
#: Weight of a block of a large cell (bitmaps) or cluster (whole sets), least and most, and shingles that weigh as much as BLOCK classes.
CELL_BLOCKS, CLUSTER_BLOCKS = (2_000, 20_000), (400, 2_000)
BLOCK, VOLUME = 2_000, 400_000


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def similar(overlap, a, b, percent: int = PERCENT):
    """Whether sets of sizes a and b with this overlap are similar: 100 * overlap >= percent * union."""
    return 100 * overlap >= percent * (a + b - overlap)


def _bits(n: int) -> int:
    """The width of the bitmap of a set of n: a power of two, at least n and 64."""
    return max(64, 1 << (n - 1).bit_length())


def signature(hashes: np.ndarray) -> bytes:
    m = _bits(len(hashes))
    at = ((hashes >> np.uint64(20)) & np.uint64(m - 1)).astype(np.int64)
    flags = np.zeros(m, dtype=np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def common_shingles(docs: DataFrame, text: str = "text", width: int = WIDTH) -> np.ndarray:
    """Hashes of very common shingles, sorted.  Counts are gathered where a batch has a shingle at least three times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(batch.column(0), width)])
            flat.sort()
            # sets hold a shingle once, so a run of three is three texts; longer runs are counted from their first place
            head = np.flatnonzero(flat[2:] == flat[:-2]) if len(flat) > 2 else np.zeros(0, np.int64)
            token, n = np.unique(flat[head], return_counts=True)
            del flat
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64) + 2)], ["token", "n"])

    counted = docs.select(docs[text].cast("string").alias("t")).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        rows = counted.where(F.col("n") >= COMMON).orderBy(F.col("n").desc(), "token").limit(COMMON_MOST).select("token").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def describe(docs: DataFrame, common: np.ndarray, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: key, h and g (they name the row by key and text), n (set size), digest, prefix, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sig, prefixes = [], [], [], []
            for own in shingle_sets(batch.column(3), width):
                k = len(own)
                n.append(k)
                digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                sig.append(signature(own) if k else b"")
                if not k:
                    prefixes.append(own)
                    continue
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    last = common[at] == own
                    own = np.concatenate((own[~last], own[last])) if last.any() else own
                prefixes.append(own[: prefix_length(k, percent)])
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
            made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
            columns = [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(digest, pa.binary()), made, pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "h", "g", "n", "digest", "prefix", "sig"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), *named(docs, key, text), docs[text].cast("string").alias("t"))
    return rows.mapInArrow(run, f"key {kind}, h long, g long, n long, digest binary, prefix array<long>, sig binary")


class SignatureTree:
    """Bitmaps of one width over items sorted so that like ones are close; each level's nodes cover ``fan`` nodes of the level below.

    ``bits``: items x words (uint64); ``size``: set sizes; ``component``: dense numbers.  A level holds the OR of bitmaps, the least and largest size,
    the largest slack and the least and largest component.  Slack is set size less bits set, which bounds an overlap from the bits that two
    nodes share; it is 0 where each bit is one shingle (``exact``), and then bounds between items are the overlaps themselves.
    """

    def __init__(self, bits: np.ndarray, size: np.ndarray, component: np.ndarray, exact: bool = False, fan: int = 8) -> None:
        slack = np.zeros(len(size), np.int64) if exact else size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.fan = fan
        self.levels = [(bits, size, size, slack, component, component)]
        while len(bits) > 1:
            at = np.arange(0, len(bits), fan)
            below = self.levels[-1]
            bits = np.bitwise_or.reduceat(bits, at, axis=0)
            self.levels.append((bits, *(f.reduceat(below[k], at) for k, f in enumerate((np.minimum, np.maximum, np.maximum, np.minimum, np.maximum), 1))))

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of each node's children one level below."""
        return node * self.fan, np.minimum((node + 1) * self.fan, len(self.levels[level - 1][0]))


def _possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether some pair under nodes i and j can be a new link: by components, by size ranges, then by the largest possible overlap."""
    least_a, most_a, least_b, most_b = a[1][i], a[2][i], b[1][j], b[2][j]
    fits = (100 * most_a >= percent * least_b) & (100 * most_b >= percent * least_a)
    fits &= ~((a[4][i] == a[5][i]) & (b[4][j] == b[5][j]) & (a[4][i] == b[4][j]))
    at = np.flatnonzero(fits)
    words = a[0].shape[1]
    step = max(1, 4_000_000 // max(1, words))
    for s in range(0, len(at), step):
        k = at[s : s + step]
        shared = np.bitwise_count(a[0][i[k]] & b[0][j[k]]).sum(axis=1).astype(np.int64)
        most = np.minimum(np.minimum(shared + a[3][i[k]], shared + b[3][j[k]]), np.minimum(most_a[k], most_b[k]))
        fits[k] = (100 + percent) * most >= percent * (least_a[k] + least_b[k])
    return fits


def dual_traversal(x: SignatureTree, y: SignatureTree | None, percent: int = PERCENT, frontier: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Item pairs (of x with itself if y is None) that no bound rules out.  The frontier is worked off in parts of bounded size."""
    other = x if y is None else y
    stack = [(len(x.levels) - 1, len(other.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > frontier:
            half = len(i) // 2
            stack += [(la, lb, i[:half], j[:half]), (la, lb, i[half:], j[half:])]
            continue
        keep = _possible(x.levels[la], i, other.levels[lb], j, percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if not la and not lb:
            if y is None:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        # open the higher node; both when they are level
        both = la == lb
        if la >= lb:
            low, end = x.children(la, i)
            n = end - low
            j = np.repeat(j, n)
            i = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        if lb > la or both:
            low, end = other.children(lb, j)
            n = end - low
            i = np.repeat(i, n)
            j = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        la, lb = (la - 1, lb - 1) if both else (la - 1, lb) if la > lb else (la, lb - 1)
        if y is None and la == lb:
            i, j = i[i <= j], j[i <= j]
        stack.append((la, lb, i, j))


class _Forest:
    """Joins components; tells which pairs join two that weren't."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.root.setdefault(x, x)) != x:
            self.root[x] = self.root[up]
            x = up
        return x

    def joining(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Places of pairs (a, b) of components that join two."""
        _, first = np.unique(np.minimum(a, b) * (np.int64(1) << 31) + np.maximum(a, b), return_index=True)
        out = []
        for k in first.tolist():
            x, y = self.find(int(a[k])), self.find(int(b[k]))
            if x != y:
                self.root[max(x, y)] = min(x, y)
                out.append(k)
        return out


def _sorted_items(cid: np.ndarray, component: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Items in the order of a tree's leaves: by component, then by size."""
    return at[np.lexsort((cid[at], n[at], component[at]))]


def cell_links(cid: np.ndarray, component: np.ndarray, n: np.ndarray, sig: list[bytes], percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest over the components of a cell, of pairs of classes that may be similar."""
    width = np.array([len(s) for s in sig])
    dense = np.unique(component, return_inverse=True)[1].astype(np.int64)
    made = {}
    for w in np.unique(width):
        at = _sorted_items(cid, dense, n, np.flatnonzero(width == w))
        made[int(w)] = at, np.frombuffer(b"".join(sig[k] for k in at), dtype="<u8").reshape(len(at), -1)
    forest, out = _Forest(), []
    for w, (at, bits) in made.items():
        tree = SignatureTree(bits, n[at], dense[at])
        joins: list[tuple[SignatureTree | None, np.ndarray]] = [(None, at)]
        if 2 * w in made:  # sizes of similar sets differ by a quarter at most, their widths by a factor of two at most
            more, wide = made[2 * w]
            half = wide.shape[1] // 2
            joins.append((SignatureTree(wide[:, :half] | wide[:, half:], n[more], dense[more]), more))
        for other, where in joins:
            for i, j in dual_traversal(tree, other, percent):
                a, b = at[i], where[j]
                apart = dense[a] != dense[b]
                a, b = a[apart], b[apart]
                out += [(int(cid[a[k]]), int(cid[b[k]])) for k in forest.joining(dense[a], dense[b])]
    return out


def cluster_links(cid: np.ndarray, component: np.ndarray, n: np.ndarray, flat: np.ndarray, starts: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join components within a cluster: pairs of similar sets, by their own shingles (``flat``, from ``starts``)."""
    item = np.repeat(np.arange(len(cid)), np.diff(starts))
    token, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[place] > 1  # a shingle of one set is in no overlap
    bit = (np.cumsum(count > 1) - 1)[place[shared]]
    words = max(1, -(-int((count > 1).sum()) // 64))
    bits = np.zeros((len(cid), words), dtype=np.uint64)
    np.bitwise_or.at(bits, (item[shared], bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    dense = np.unique(component, return_inverse=True)[1].astype(np.int64)
    at = _sorted_items(cid, dense, n, np.arange(len(cid)))
    tree = SignatureTree(bits[at], n[at], dense[at], exact=True)
    forest, out = _Forest(), []
    for i, j in dual_traversal(tree, None, percent):
        a, b = at[i], at[j]
        apart = dense[a] != dense[b]
        a, b = a[apart], b[apart]
        out += [(int(cid[a[k]]), int(cid[b[k]])) for k in forest.joining(dense[a], dense[b])]
    return out


def _pruned(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and bitmaps don't rule out."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, sa, nb, sb in zip(*(batch.column(c).to_pylist() for c in ("na", "sa", "nb", "sb")), strict=True):
                x, y = int.from_bytes(sa, "little"), int.from_bytes(sb, "little")
                for big, small, fold in ((sa, sb, "x"), (sb, sa, "y")):
                    w = 8 * len(big)
                    while w > 8 * len(small):
                        w //= 2
                        if fold == "x":
                            x = (x & ((1 << w) - 1)) | (x >> w)
                        else:
                            y = (y & ((1 << w) - 1)) | (y >> w)
                shared = (x & y).bit_count()
                most = min(na - x.bit_count() + shared, nb - y.bit_count() + shared)
                keep.append((100 + percent) * most >= percent * (na + nb))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sized.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long")


def _sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Whole sets (cid, set) of the classes ``wanted``, made anew from the text of one row a class."""
    rows = docs.select(*named(docs, key, text), docs[text].cast("string").alias("t")).join(classes.select("cid", "h", "g", "digest").join(wanted.distinct(), "cid"), ["h", "g"]).select("cid", "digest", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(2), width))
            right = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, batch.column(1).to_pylist(), strict=True)]
            sets = [s for s, ok in zip(sets, right, strict=True) if ok]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(right, pa.bool_())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))], ["cid", "set"])

    return cut(rows.mapInArrow(run, "cid long, set array<long>").dropDuplicates(["cid"]), "ngram-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("set").alias(f"s{x}"))
    overlap = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(similar(overlap, F.size("sa"), F.size("sb"), percent)).select("a", "b")


def _by_runs(frame: DataFrame, keys: list[str], columns: list[str], work) -> DataFrame:
    """Links (a, b) from ``work(rows)`` for the rows of each key, which are runs of a sorted partition."""
    k = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.combine_chunks()
            new = np.zeros(rows.num_rows + 1, dtype=bool)
            new[[0, -1]] = True
            for c in range(k):
                v = rows.column(c).to_numpy()
                new[1:-1] |= v[1:] != v[:-1]
            edge = np.flatnonzero(new)
            links = [x for s, e in zip(edge, edge[1:], strict=False) for x in work(rows.slice(s, e - s))]
            if links:
                a, b = np.array(links, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            same = np.ones(batch.num_rows, dtype=bool)  # as the last row
            follows = bool(held)
            for c in range(k):
                v = batch.column(c).to_numpy()
                same &= v == v[-1]
                follows = follows and held[-1].column(c)[-1].as_py() == v[0]
            last = int(np.argmax(same))
            if held and not follows:
                yield from out(pa.Table.from_batches(held))
                held = []
            if last:  # all runs but the last are whole
                yield from out(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from out(pa.Table.from_batches(held))

    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.select(*keys, *columns).repartition(parts, *keys).sortWithinPartitions(*keys, "cid").mapInArrow(run, "a long, b long")


def _cell_work(percent: int):
    def work(rows: pa.Table) -> list[tuple[int, int]]:
        cid, component, n = (rows[c].to_numpy() for c in ("cid", "component", "n"))
        return cell_links(cid, component, n, rows["sig"].to_pylist(), percent)

    return work


def _cluster_work(percent: int):
    def work(rows: pa.Table) -> list[tuple[int, int]]:
        cid, component, n = (rows[c].to_numpy() for c in ("cid", "component", "n"))
        sets = [x.values.to_numpy().view(np.uint64) for x in rows["set"].combine_chunks()] if rows.num_rows else []
        starts = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
        return cluster_links(cid, component, n, np.concatenate(sets), starts, percent)

    return work


def _weight(n: Column) -> Column:
    """What a class counts for in a block: one, or more if its set is large."""
    return F.greatest(F.lit(1.0), n * F.lit(BLOCK / VOLUME))


def _dealt(rows: DataFrame, group: str, held: DataFrame, payload: str, blocks: tuple[int, int], percent: int) -> DataFrame:
    """Rows (group, i, j, cid, component, n, payload) of rows (group, cid, component, total): i and j are the task to work them in, ``total`` the
    group's weight, ``held`` has n and the payload of each cid.

    A small group is one task.  A larger one is cut into blocks of classes of like sizes and dealt as pairs of blocks whose sizes allow a
    link.  Blocks come from counts of (group, n) and a hash, so no group is sorted or ranked in one task.
    """
    least, most = blocks
    columns = [group, "i", "j", "cid", "component"]
    zero = F.lit(0).cast("long")
    placed = rows.where(F.col("total") <= least).select(group, zero.alias("i"), zero.alias("j"), "cid", "component")
    large = rows.where(F.col("total") > least)
    if not large.isEmpty():
        placed = placed.union(_blocks(large.join(held.select("cid", "n"), "cid"), group, least, most, percent).select(columns))
    return placed.join(held.select("cid", "n", payload), "cid")


def _blocks(large: DataFrame, group: str, least: int, most: int, percent: int) -> DataFrame:
    """Adds i and j to rows (group, cid, n, total) of large groups."""
    per = large.groupBy(group, "n").agg((F.count("*") * _weight(F.col("n"))).alias("w"), F.first("total").alias("total"))
    upto = Window.partitionBy(group).orderBy("n")  # a row a set size, not a class
    # blocks grow with the root of the group, so that neither tasks nor copies grow with the group itself
    size = F.least(F.lit(float(most)), F.greatest(F.lit(float(least)), F.lit(4.0) * F.sqrt("total")))
    per = per.withColumn("from", F.sum("w").over(upto) - F.col("w")).withColumn("size", size)
    block = lambda share: F.floor((F.col("from") + F.col("w") * share) / F.col("size"))
    per = cut(per.select(group, "n", "w", "from", "size", block(F.lit(0.0)).alias("first"), block(F.lit(1 - 1e-9)).alias("last")), "ngram-sizes")
    bounds = per.select(group, F.explode(F.sequence("first", "last")).alias("k"), "n").groupBy(group, "k").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    # a block's partners: itself and later ones (sizes ascend) whose least size is within reach of its largest
    a = bounds.select(group, F.col("k").alias("i"), F.col("hi").alias("reach"))
    pairs = a.join(bounds.select(group, F.col("k").alias("j"), "lo"), group).where((F.col("i") <= F.col("j")) & (100 * F.col("reach") >= percent * F.col("lo")))
    tasks = pairs.select(group, "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("k"))
    share = F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) / F.lit(float(1 << 20)) * F.lit(1 - 1e-9)
    placed = large.join(per.drop("first", "last"), [group, "n"]).withColumn("k", block(share))
    return placed.join(tasks, [group, "k"])


def _mixed(placed: DataFrame) -> DataFrame:
    """Rows (token, cid, component, total) of cells that hold more than one component; of cells with the same classes the one of the least token stays.

    A class is in a cell once, so the exclusive or of hashes of its classes names what a cell holds; counts and hashes combine before they are shuffled.
    """
    names = F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "cid")).alias("y")
    cells = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("total"), *names).where(F.col("lo") != F.col("hi"))
    return placed.join(cells.groupBy("total", "lo", "hi", "x", "y").agg(F.min("token").alias("token")).select("token", "total"), "token")


def _joined_by_trees(live: DataFrame, members: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Links between components that the leaders left apart."""
    of = lambda df: df.join(members, F.col("cid") == F.col("id"), "left").withColumn("component", F.coalesce("component", "cid")).drop("id")
    mixed = cut(_mixed(of(live.select("token", "cid"))), "ngram-mixed")
    tasks = _dealt(mixed, "token", classes, "sig", CELL_BLOCKS, percent)
    maybe = cut(_by_runs(tasks, ["token", "i", "j"], ["cid", "component", "n", "sig"], _cell_work(percent)).distinct(), "ngram-maybe")
    # components that may be joined, as clusters
    home = of(classes.select("cid", "n"))
    ends = home.select(F.col("cid").alias("id"), F.col("component").alias("c"))
    between = maybe.join(ends.select(F.col("id").alias("a"), F.col("c").alias("ca")), "a").join(ends.select(F.col("id").alias("b"), F.col("c").alias("cb")), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = connected(between).select(F.col("id").alias("component"), F.col("component").alias("cluster"))
    clusters = cut(joined.union(joined.select("cluster", "cluster").distinct()), "ngram-clusters")
    rows = home.join(clusters, "component").select("cid", "n", "component", "cluster")
    rows = cut(rows.join(rows.groupBy("cluster").agg(F.sum(_weight(F.col("n"))).alias("total")), "cluster"), "ngram-clustered")
    sets = _sets(rows.select("cid"), classes, docs, key, text, width)
    tasks = _dealt(rows.drop("n"), "cluster", sets.join(rows.select("cid", "n"), "cid"), "set", CLUSTER_BLOCKS, percent)
    links = cut(_by_runs(tasks, ["cluster", "i", "j"], ["cid", "component", "n", "set"], _cluster_work(percent)), "ngram-links")
    release(mixed, maybe, clusters, rows, sets)
    return links


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: key, h and g (they name the row), n_shingles, component_id (the least key that links reach from it) and component."""
    described = cut(describe(docs, common_shingles(docs, text, width), key, text, width, percent), "ngram-described")
    solid = described.where(F.col("n") > 0)
    grouped = solid.groupBy("digest").agg(F.min("key").alias("doc"), F.min(F.struct("h", "g")).alias("row"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig"))
    classes = cut(grouped.select("digest", "doc", "row.h", "row.g", "n", "prefix", "sig").withColumn("cid", F.monotonically_increasing_id()), "ngram-classes")

    cells = classes.select("cid", F.explode("prefix").alias("token"))
    shared = cells.groupBy("token").agg(F.min("cid").alias("leader"), F.count("*").alias("size")).where(F.col("size") >= 2)
    live = cut(cells.join(shared, "token"), "ngram-cells")
    by_size = Window.partitionBy("cid").orderBy(F.col("size").desc(), "token")
    star = live.where(F.col("cid") != F.col("leader")).withColumn("r", F.row_number().over(by_size)).where(F.col("r") <= LEADERS)
    first = cut(_pruned(star.select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct(), classes, percent), "ngram-pairs")
    sets = _sets(first.select(F.col("a").alias("cid")).union(first.select(F.col("b").alias("cid"))), classes, docs, key, text, width)
    links = cut(_verified(first, sets, percent), "ngram-links")
    release(first, sets)
    members = connected(links)
    more = _joined_by_trees(live, members, classes, docs, key, text, width, percent)
    release(live)
    # components are linked by what the trees found: only these are numbered anew
    tied = members.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more)
    members = connected(tied)

    home = classes.select("digest", "cid", "doc").join(members, F.col("cid") == F.col("id"), "left").select("digest", "doc", F.coalesce("component", "cid").alias("component"))
    least = home.groupBy("component").agg(F.min("doc").alias("component_id"))
    placed = home.join(least, "component").select("digest", "component", "component_id")
    out = described.select("key", "h", "g", "n", "digest").join(placed, "digest", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), "h", "g", F.col("n").alias("n_shingles"), own.alias("component_id"), F.when(F.col("n") > 0, F.col("component")).alias("component"))


def one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each component, the one with the least key; rows without shingles all stay.

    Of rows with one key and text, which differ in other columns at most, the least by those columns stays.
    """
    cols = docs.columns
    joined = cut(join(docs, key, text, width, percent), "ngram-joined")
    least = F.min(F.struct(F.col(key).isNull(), F.col(key), F.col("h"), F.col("g"))).alias("first")
    solid = joined.where(F.col("n_shingles") > 0).groupBy("component").agg(least).select("first.h", "first.g")
    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)], *named(docs, key, text))
    sortable = [F.col(f"c{i}") for i, f in enumerate(docs.schema) if "map<" not in f.dataType.simpleString() and f.name not in (key, text)]
    order = Window.partitionBy("h", "g").orderBy(*(sortable or [F.lit(0)]))
    kept = rows.join(solid.distinct(), ["h", "g"]).withColumn("r", F.row_number().over(order)).where("r = 1")
    empty = joined.where(F.col("n_shingles") == 0).select("h", "g").distinct()
    both = kept.drop("r").union(rows.join(empty, ["h", "g"], "left_semi").select(kept.drop("r").columns))
    return both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
