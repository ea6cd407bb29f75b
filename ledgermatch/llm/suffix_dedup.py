"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts anywhere else.

1. Every window of LENGTH bytes has an anchor, the leftmost of its 24-byte grams with the least hash; equal windows have equal anchors
   at equal places.  A run of windows with one anchor is a segment.  Anchors seen once can't be in a repeated window.
2. Segments of one anchor and one content are repeats as they are: only the first of them goes on, marked as repeated.
3. An anchor with different contents goes to a shard.  Each shard is sorted into a suffix array by induced sorting, and its
   permuted common prefixes tell which windows of its segments repeat.
4. A shard takes about ``SHARD_BYTES``.  An anchor with MANY contents (a common passage in many texts) is
   dealt out again by the place of the anchor in the window and by the bytes that all windows of such a part share; equal windows stay together.
   For one with FLOOD contents even such a part can be too much for a task: its windows are named one by one and counted by name.

All of it is exact, whatever the shards.  Matches never cross documents; strings are judged on the input.

Defined results: texts are UTF-8 bytes, null is empty.  Texts under LENGTH bytes lose nothing.  Repeated rows are occurrences of
each other, so both lose what LENGTH allows.  An empty table gives an empty result.  Texts are told apart by 128 bits of hashes, contents of an
anchor (itself 64 bits) by 64 bits of BLAKE2b and windows of a flood by 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, release
from ledgermatch.llm.shingles import mix64, string_buffers
from ledgermatch.llm.suffix_arrays import common_prefixes, join_strings, suffix_array

LENGTH = 400
GRAM = 24
CHUNK = 1_500_000
#: Bytes from which a text is scanned in parts: places have 24 bits.
LONG, STEP = 1 << 24, 8_000_000
SHARD_BYTES = 1_500_000
#: Contents of an anchor from which it is dealt out again, and into how many parts of anchor places.
MANY, PARTS = 1_000, 8
#: Contents of an anchor from which its windows are counted by name.
FLOOD = 20_000
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


class Hashes:
    """Hashes of any substring of a buffer, from prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        steps = np.full(len(data) + 1, _BASE, dtype=np.uint64)
        steps[0] = 1
        back = np.full(len(data) + 1, _INVERSE, dtype=np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.concatenate(([np.uint64(0)], np.add.accumulate((data.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(steps)[:-1])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, anchor, content, start, size, place) of all segments of the texts; start counts from the text, place is the anchor's in the segment."""
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    hashes = Hashes(data)
    gram = min(GRAM, length)
    at = np.arange(len(data) - gram + 1)
    grams = hashes.of(at, at + gram)
    keys = grams >> np.uint64(24) << np.uint64(24) | at.astype(np.uint64)
    least = _least(keys, length - gram + 1)
    sizes = np.diff(offsets)
    valid = np.zeros(len(data) + 1, dtype=np.int8)
    long = sizes >= length
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(window):
        return none
    anchor_at = least[window] & np.uint64((1 << 24) - 1)
    new = np.concatenate(([True], (anchor_at[1:] != anchor_at[:-1]) | (window[1:] != window[:-1] + 1)))
    first = window[new]
    last = window[np.concatenate((new[1:], [True]))]
    # a text's last window and the next text's first may touch only if the texts' windows are adjacent, which LENGTH > 1 rules out
    size = last + length - first
    text = np.searchsorted(offsets, first, side="right") - 1
    # equal windows have their anchor at one place, so its whole hash is theirs too
    anchor = grams[anchor_at[new].astype(np.int64)]
    return text, anchor.view(np.int64), hashes.of(first, first + size).view(np.int64), first - offsets[text], size, anchor_at[new].astype(np.int64) - first


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal ones."""
    if not len(start):
        return start, end
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    return start[new], end[np.concatenate((new[1:], [True]))]


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each substring, as two longs."""
    whole = memoryview(np.ascontiguousarray(data))
    made = b"".join([hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    pairs = np.frombuffer(made, dtype="<i8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _scan(batches: Iterator[pa.RecordBatch], length: int, long: int, step: int) -> Iterator[pa.RecordBatch]:
    """Segments (h, g, anchor, c, start, size, place, m), once for each content c of a text; and, without an anchor, what repeats within a text."""
    names = ["anchor", "c", "start", "size", "place", "m"]
    for batch in batches:
        data, offsets = string_buffers(batch.column(2))
        at, texts = 0, len(offsets) - 1
        while at < texts:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + min(CHUNK, long - 1), side="right")) - 1)
            part = data[offsets[at] : offsets[to]]
            if len(part) >= long:
                found = _long_segments(part, length, step)
            else:
                found = segments(part, offsets[at : to + 1] - offsets[at], length)
            text, anchor, _, start, size, place = found
            begin = offsets[at:to][text] - offsets[at] + start
            c = digests(part, begin, begin + size)[0]
            by = np.lexsort((start, c, anchor, text))
            text, anchor, c, start, size, place = (x[by] for x in (text, anchor, c, start, size, place))
            same = np.ones(max(0, len(text) - 1), dtype=bool)
            for x in (text, anchor, c):
                same &= x[1:] == x[:-1]
            new = np.flatnonzero(np.concatenate((np.ones(min(1, len(text)), bool), ~same)))
            m = np.diff(np.concatenate((new, [len(text)])))
            own = text[new]
            out = [x[new] for x in (anchor, c, start, size, place)] + [m]
            null = np.zeros(len(new), dtype=bool)
            local = np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False]))) if len(text) else np.zeros(0, np.int64)
            if len(local):
                rows = []
                for t in np.unique(text[local]):
                    mine = local[text[local] == t]
                    s, e = merged(start[mine], start[mine] + size[mine])
                    rows.append((np.full(len(s), t), s, e - s))
                lt, ls, lsize = (np.concatenate(x) for x in zip(*rows, strict=True))
                zero = np.zeros(len(ls), np.int64)
                own = np.concatenate((own, lt))
                out = [np.concatenate((x, y)) for x, y in zip(out, [zero, zero, ls, lsize, zero, zero], strict=True)]
                null = np.concatenate((null, np.ones(len(ls), dtype=bool)))
            arrays = [pa.array(x.astype(np.int64), pa.int64(), mask=null if n == "anchor" else None) for n, x in zip(names, out, strict=True)]
            row = pa.array(own + at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), *arrays], ["h", "g", *names])
            at = to


def _long_segments(data: np.ndarray, length: int, step: int) -> tuple[np.ndarray, ...]:
    """Segments of one very long text, by overlapping parts; a segment that a part's edge cuts is two segments, which changes nothing."""
    parts = []
    for s in range(0, max(1, len(data) - length + 1), step):
        piece = data[s : s + step + length - 1]
        found = segments(piece, np.array([0, len(piece)]), length)
        parts.append((found[0], found[1], found[2], found[3] + s, found[4], found[5]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def repeated_windows(strings: list[bytes], many: np.ndarray, length: int = LENGTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each string the intervals of bytes covered by its windows that start elsewhere too.  ``many``: strings that occur more than once."""
    text, first = join_strings(strings)
    order = suffix_array(text, len(strings))
    shared = common_prefixes(text, order)
    again = np.zeros(len(text), dtype=bool)
    hit = np.flatnonzero(shared >= length)
    again[hit] = True
    before = np.full(len(text), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    again[before[hit]] = True
    out = []
    for i, s in enumerate(strings):
        n = len(s) - length + 1
        if many[i]:
            out.append((np.zeros(1, np.int64), np.full(1, len(s), np.int64)))
            continue
        w = np.flatnonzero(again[first[i] : first[i] + max(0, n)])
        out.append(merged(w, w + length))
    return out


def _payloads(batches: Iterator[pa.RecordBatch], shards: int, length: int) -> Iterator[pa.RecordBatch]:
    """Segments' bytes with their shards, from texts and the lists of their segments."""
    names = ["shard", "anchor", "c", "base", "many", "bytes"]
    step = -(-(length - GRAM + 1) // PARTS)
    for batch in batches:
        rows: list[tuple] = []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = (text or "").encode()
            for w in wanted:
                name, start, size, place = (w["anchor"], w["c"]), w["start"], w["size"], w["place"]
                if not w["split"]:
                    rows.append((w["anchor"] % shards, *name, 0, w["many"], data[start : start + size]))
                    continue
                for d in range(0, length - GRAM + 1, step):
                    # windows with the anchor d to d + step - 1 bytes in: they all hold the bytes between
                    a, b = max(0, place - d - step + 1), min(place - d, size - length)
                    if a <= b:
                        core = hashlib.blake2b(data[start + place - d : start + place - d - step + 1 + length] + d.to_bytes(2, "little"), digest_size=8).digest()
                        rows.append((int.from_bytes(core, "little") % shards, *name, a, w["many"], data[start + a : start + b + length]))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """All windows of segments, by name (w, v), from texts and the lists of their segments."""
    names = ["w", "v", "anchor", "c", "base", "n"]
    for batch in batches:
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            for x in wanted:
                base = np.arange(x["size"] - length + 1)
                first, second = digests(data, x["start"] + base, x["start"] + base + length)
                same = [np.full(len(base), x[k], dtype=np.int64) for k in ("anchor", "c")]
                yield pa.RecordBatch.from_arrays([pa.array(y, pa.int64()) for y in (first, second, *same, base, np.full(len(base), 2 if x["many"] else 1))], names)


def _shard(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Sorts each shard of a partition (rows in order of shard) and tells what repeats."""

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = repeated_windows([r[5] for r in rows], np.array([r[4] for r in rows]), length)
        made = [(*r[1:3], r[3] + a, r[3] + b) for r, (s, e) in zip(rows, found, strict=True) if not r[4] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        columns = list(zip(*made, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["anchor", "c", "from", "to"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                yield from out(held)
                held = []
            held.append(row)
    if held:
        yield from out(held)


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, g, n_removed, n_spans, kept_sha256, kept) of texts and the intervals to remove."""
    for batch in batches:
        made = []
        for h, g, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = (text or "").encode()
            s, e = merged(np.array([x["from"] for x in spans], np.int64), np.array([x["to"] for x in spans], np.int64))
            kept = b"".join(data[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(data)], strict=True))
            made.append((h, g, int((e - s).sum()), len(s), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*made, strict=True)) or [()] * 6
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["h", "g", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_bytes: bool = False) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes left, if asked for)."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[key].alias("key"), body.alias("t")).withColumn("h", F.xxhash64("t")).withColumn("g", F.xxhash64(F.lit(7), "t", F.octet_length("t")))
    kinds = "h long, g long, anchor long, c long, start long, size long, place long, m long"
    scanned = cut(rows.where(F.octet_length("t") >= length).select("h", "g", "t").mapInArrow(lambda b: _scan(b, length, LONG, STEP), kinds), "suffix-segments")
    local = scanned.where(F.col("anchor").isNull()).select("h", "g", F.col("start").alias("from"), (F.col("start") + F.col("size")).alias("to"))
    each = scanned.where(F.col("anchor").isNotNull())

    # how often each content of an anchor occurs, and where first; anchors with one occurrence go no further
    name, row = ["anchor", "c"], ["h", "g"]
    first = F.min(F.struct(*row, "start", "size", "place")).alias("first")
    contents = each.groupBy(name).agg(F.sum("m").alias("n"), first)
    per_anchor = contents.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where(F.col("total") >= 2)
    shared = cut(contents.join(per_anchor, "anchor").select(*name, "n", "first", "kinds"), "suffix-contents")
    sharded = shared.where(F.col("kinds") >= 2)
    volume, most = sharded.agg(F.coalesce(F.sum("first.size"), F.lit(0)), F.max("kinds")).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, volume // SHARD_BYTES + 1)

    # occurrences: whole segments of a repeated content, and those that wait for their shard
    placed = cut(each.select(*row, *name, "start", "size").join(shared.select(*name, "n", "kinds"), name), "suffix-placed")
    whole = placed.where(F.col("n") >= 2).select("h", "g", F.col("start").alias("from"), (F.col("start") + F.col("size")).alias("to"))
    waiting = placed.where((F.col("n") == 1) & (F.col("kinds") >= 2)).select(*row, *name, "start")

    # the bytes of one occurrence of each content, gathered by text
    occurrence = [F.col(f"first.{x}").alias(x) for x in ("start", "size", "place")]
    marks = [(F.col("n") >= 2).alias("many"), (F.col("kinds") >= MANY).alias("split"), (F.col("kinds") >= FLOOD).alias("flood")]
    wanted = sharded.select("first.h", "first.g", F.struct(*name, *occurrence, *marks).alias("w")).groupBy(row).agg(F.collect_list("w").alias("wanted"))
    involved = placed.select(row).union(local.select(row)).distinct().join(wanted, row, "full")
    # texts that lose something or lend bytes, fetched once; equal texts are one here
    texts = cut(rows.select(*row, "t").join(involved, row).dropDuplicates(row).select(*row, "t", "wanted"), "suffix-texts")
    lending = texts.where(F.col("wanted").isNotNull()).select("t", F.filter("wanted", lambda w: ~w["flood"]).alias("wanted"))
    names = "anchor long, c long"
    payloads = lending.mapInArrow(lambda b: _payloads(b, shards, length), f"shard long, {names}, base long, many boolean, bytes binary")
    dealt = payloads.repartition(min(shards, 4 * parts), "shard").sortWithinPartitions("shard")
    found = cut(dealt.mapInArrow(lambda b: _shard(b, length), f"{names}, `from` long, `to` long"), "suffix-found")
    if most and most >= FLOOD:
        flood = texts.where(F.col("wanted").isNotNull()).select("t", F.filter("wanted", lambda w: w["flood"]).alias("wanted")).where(F.size("wanted") > 0)
        windows = cut(flood.mapInArrow(lambda b: _windows(b, length), f"w long, v long, {names}, base long, n long"), "suffix-windows")
        again = windows.groupBy("w", "v").agg(F.sum("n").alias("times")).where("times >= 2").drop("times")
        found = found.union(windows.where("n = 1").join(again, ["w", "v"]).select(*name, "base", F.col("base") + length))
    partly = waiting.join(found, name).select(*row, (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))

    spans = local.union(whole).union(partly).distinct()
    by_text = spans.groupBy(row).agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    losing = texts.select(*row, "t").join(by_text, row).mapInArrow(_cut_texts, "h long, g long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    losing = cut(losing if with_bytes else losing.drop("kept"), "suffix-losing")
    release(scanned, shared, placed, texts, found)
    intact = [F.octet_length("t").cast("long").alias("n_bytes"), F.sha2("t", 256).alias("whole_sha256")]
    more = [F.encode("t", "utf-8").alias("whole")] if with_bytes else []
    out = rows.select("key", *row, *intact, *more).join(losing, row, "left")
    kept = [F.coalesce("kept", "whole").alias("kept")] if with_bytes else []
    none = F.lit(0)
    return out.select(F.col("key").alias(key), "n_bytes", F.coalesce("n_removed", none).cast("long").alias("n_removed"), F.coalesce("n_spans", none).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"), *kept)
