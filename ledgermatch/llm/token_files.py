"""Token ids in files of fixed-width bit packing.

A file holds the ids of consecutive documents, each id in the least bits that the vocabulary needs:

    magic 8 bytes
    payload: blocks of ``block`` ids, each starting on a byte
    for each block: byte offset of its payload u64 (one more than blocks)
    for each document: first id u64 (one more than documents) | document id i64 | null flag u8
    tail: bits u32 | block ids u32 | ids u64 | documents u64 | byte of the offsets u64 | magic 8 bytes

Integers are little-endian.  Block offsets let a reader unpack any range of ids, and so any document, from the blocks it touches;
unpacking is whole-array numpy.  A writer holds one block and 17 bytes a document, a reader the same and the range it asks for.  Files lie in
the shared folder and their number follows the bytes of text.  A task writes its file under a name of its own and the manifest has the
names of those that ended, so a task that runs again leaves no trace in what is read.

Defined results: a null or empty text is a document of the end id alone.  Documents ascend by ``doc_id`` (null first), then by
a hash of the text; repeated rows are repeated documents.  An empty table gives no file.
"""

from __future__ import annotations

import io
import itertools
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, scratch_path
from ledgermatch.llm.tokens import encoder

MAGIC = b"LMTOKENS"
_TAIL = struct.Struct("<IIQQQ8s")
#: Bytes of text for a file, and the least, to which more files go where there are cores for them.
FILE_BYTES, LEAST_BYTES = 64_000_000, 1_000_000
#: Ids that a reader unpacks at once.
SPAN = 1_000_000


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, low bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    shifts = np.arange(bits, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> shifts & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(payload, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(payload, dtype=np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    """Writes documents one after another to an open stream."""

    def __init__(self, out, vocabulary: int, block: int = 65_536) -> None:
        self.out, self.vocabulary, self.bits, self.block = out, vocabulary, bits_for(vocabulary), block
        self.waiting, self.held = [], 0
        self.offsets, self.first, self.keys, self.nulls = array("Q", [0]), array("Q", [0]), array("q"), bytearray()
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >= self.vocabulary:
            raise ValueError("an id is beyond the vocabulary")
        self.first.append(self.first[-1] + len(ids))
        self.keys.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.waiting.append(ids.astype(np.uint32))
        self.held += len(ids)
        if self.held >= self.block:
            self._flush(self.held - self.held % self.block)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for i in range(0, n, self.block):
            payload = pack(flat[i : min(n, i + self.block)], self.bits)
            self.out.write(payload)
            self.offsets.append(self.offsets[-1] + len(payload))
        self.waiting, self.held = [flat[n:]], len(flat) - n

    def close(self) -> None:
        """Writes what waits, and the index."""
        self._flush(self.held)
        at = len(MAGIC) + self.offsets[-1]
        for column, kind in ((self.offsets, "<u8"), (self.first, "<u8"), (self.keys, "<i8")):
            self.out.write(np.array(column, dtype=kind).tobytes())
        self.out.write(bytes(self.nulls))
        self.out.write(_TAIL.pack(self.bits, self.block, self.first[-1], len(self.keys), at, MAGIC))


def encode_file(documents: list[np.ndarray], doc_ids: list[int | None], vocabulary: int, block: int = 65_536) -> bytes:
    """The bytes of one file."""
    out = io.BytesIO()
    made = Writer(out, vocabulary, block)
    for k, ids in zip(doc_ids, documents, strict=True):
        made.add(k, ids)
    made.close()
    return out.getvalue()


class TokenFile:
    """Reads a file with random access: ``read(at, n)`` gives n of its ``size`` bytes."""

    def __init__(self, data: bytes | memoryview | None = None, read: Callable[[int, int], bytes] | None = None, size: int = 0) -> None:
        self.read = read or (lambda at, n: bytes(data[at : at + n]))
        size = size if data is None else len(data)
        if size < _TAIL.size:
            raise ValueError("not a token file")
        self.bits, self.block, self.n_ids, self.n_docs, at, magic = _TAIL.unpack(self.read(size - _TAIL.size, _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        blocks = -(-self.n_ids // self.block)
        index = self.read(at, size - _TAIL.size - at)
        self.offsets = np.frombuffer(index, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        self.first = np.frombuffer(index, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        keys, at = np.frombuffer(index, "<i8", self.n_docs, at), at + 8 * self.n_docs
        nulls = np.frombuffer(index, np.uint8, self.n_docs, at)
        self.doc_ids = [None if z else int(k) for k, z in zip(keys, nulls, strict=True)]

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` up to ``end``, from the blocks that hold them alone."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        a, b = begin // self.block, (end - 1) // self.block + 1
        data = self.read(len(MAGIC) + int(self.offsets[a]), int(self.offsets[b] - self.offsets[a]))
        at = self.offsets[a : b + 1] - self.offsets[a]
        parts = [unpack(data[at[i] : at[i + 1]], self.bits, min(self.block, self.n_ids - (a + i) * self.block)) for i in range(b - a)]
        skip = a * self.block
        return np.concatenate(parts)[begin - skip : end - skip]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))

    def checksums(self, span: int = SPAN) -> Iterator[int]:
        """The CRC-32 of each document's ids as little-endian unsigned 32-bit integers, with ``span`` ids or one block's in memory."""
        begin, end, held = 0, 0, np.zeros(0, "<u4")
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            crc = 0
            while a < b:
                if a >= end:
                    begin, end = a, min(self.n_ids, a + span)
                    held = self.ids(begin, end).astype("<u4")
                crc = zlib.crc32(held[a - begin : min(b, end) - begin].tobytes(), crc)
                a = min(b, end)
            yield crc


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


@dataclass(frozen=True)
class TokenFiles:
    """A folder of files and their manifest: file, file_no (ascending doc_id), n_docs, n_ids."""

    folder: str
    manifest: DataFrame


def _number_of_files(docs: DataFrame, text: str) -> int:
    """Files by the bytes of text."""
    total = docs.agg(F.sum(F.octet_length(docs[text].cast("string")).cast("long")).alias("n")).first().n or 0
    return max(1, -(-total // FILE_BYTES), min(docs.sparkSession.sparkContext.defaultParallelism, -(-total // LEAST_BYTES)))


def write(docs: DataFrame, tokenizer: str, lower: bool = False, key: str = "doc_id", text: str = "text", files: int | None = None, folder: str | None = None) -> TokenFiles:
    """Encodes all texts, ends each with id 0 and writes them in ascending order of ``key``, one file for a range of keys.

    The texts are dealt out by ranges of (key, hash of the text, row), so that neither one key nor one text need fill a file.  Without ``files`` their number follows the bytes of
    text, so a file stays near FILE_BYTES of text (one document is never split over files).
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    files = files or _number_of_files(docs, text)
    rows = docs.select(docs[key].cast("long").alias("k"), docs[text].cast("string").alias("t")).withColumn("h", F.xxhash64("t")).withColumn("r", F.monotonically_increasing_id())
    order = [F.col("k").asc_nulls_first(), F.col("h").asc(), F.col("r").asc()]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).withColumn("p", F.spark_partition_id()).select("k", "t", "p")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer, lower)
        end = np.zeros(1, np.uint32)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        store, path = _files(folder)
        store.create_dir(path, recursive=True)
        part = first.column(2)[0].as_py()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
        with store.open_output_stream(f"{path}/{name}") as out:
            file = Writer(out, made.size)
            for batch in itertools.chain([first], batches):
                for k, ids in zip(batch.column(0).to_pylist(), made.encode(batch.column(1)), strict=True):
                    file.add(k, np.concatenate((ids, end)))
            file.close()
        counts = {"n_docs": len(file.keys), "n_ids": file.first[-1]}
        yield pa.RecordBatch.from_pydict({"file": [name], "file_no": pa.array([part], pa.int64()), **{k: pa.array([v], pa.int64()) for k, v in counts.items()}})

    manifest = cut(dealt.mapInArrow(run, "file string, file_no long, n_docs long, n_ids long"), "token-manifest")
    return TokenFiles(folder, manifest)


def read(spark: SparkSession, written: TokenFiles, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start (ids of all documents before it), n_tokens, ids_crc32, file, file_doc."""
    folder = written.folder
    # one row a file: the running total is over the manifest, not over documents
    placed = written.manifest.withColumn("base", F.sum("n_ids").over(Window.orderBy("file_no")) - F.col("n_ids"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, base in zip(frame["file"], frame["base"], strict=True):
                store, path = _files(folder)
                with store.open_input_file(f"{path}/{name}") as source:
                    got = TokenFile(read=lambda at, n: source.read_at(n, at), size=source.size())  # noqa: B023
                    crc = list(got.checksums())
                yield pd.DataFrame({"k": pd.array(got.doc_ids, dtype="Int64"), "start": base + got.first[:-1], "n_tokens": np.diff(got.first), "ids_crc32": np.array(crc, dtype=np.int64), "file": name, "file_doc": np.arange(got.n_docs)})

    each = placed.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file_no")
    return each.mapInPandas(run, "k long, start long, n_tokens long, ids_crc32 long, file string, file_doc long").withColumnRenamed("k", key)
