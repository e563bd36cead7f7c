"""Token ids in files of fixed-width bits, with offsets for reading any part of them.

A file holds the documents of one range of doc_id in ascending order. Layout, little-endian:

    magic 8 bytes | bits, block size, file number, unused: 4 x u32 | documents, ids: 2 x u64
    doc_id i64 each, lowest for null | first id of each document u64, and the end
    byte offset of each block in the data u64, and the end | data

A block is `block size` ids of `bits` bits, filled from the lowest bit and padded to eight
ids, so each block begins at a byte and can be unpacked alone with a few numpy operations.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import blocks as B
from strata.llm import words as W
from strata.llm.ship import ship
from strata.llm.tokens import Encoder, tokenizer_json, vocabulary_size

MAGIC = b"STRATAID"
BLOCK = 8192
FILE_BYTES = 16 << 20
_HEAD = struct.Struct("<8s4I2Q")
_NULL = np.iinfo(np.int64).min


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another in `bits` bits each, padded to a multiple of eight ids."""
    groups = -(-len(ids) // 8)
    held = np.zeros(groups * 8, np.uint64)
    held[: len(ids)] = ids
    held = held.reshape(groups, 8)
    out = np.zeros((groups, bits + 8), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = held[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack(data: bytes | np.ndarray, n: int, bits: int) -> np.ndarray:
    """The first n ids of packed data."""
    groups = -(-n // 8)
    raw = np.zeros((groups, bits + 8), np.uint64)
    raw[:, :bits] = np.frombuffer(data, np.uint8, groups * bits).reshape(groups, bits)
    out, mask = np.empty((groups, 8), np.uint32), np.uint64((1 << bits) - 1)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            value |= raw[:, byte + k] << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


def file_bytes(number: int, doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    body = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, body)]).astype("<u8")
    head = _HEAD.pack(MAGIC, bits, block, number, 0, len(doc_ids), len(ids))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes(), offsets.tobytes(), *body])


class PackedFile:
    """A file's bytes, or a memory map of them: ids of any document or range, block by block."""

    def __init__(self, data):
        self.data = memoryview(data)
        magic, self.bits, self.block, self.number, _, self.n_docs, self.n_ids = _HEAD.unpack_from(self.data)
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(self.data, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.starts = np.frombuffer(self.data, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(self.data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.base = at + 8 * (n_blocks + 1)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first..last (excluded); only the blocks that hold them are read."""
        if last <= first:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, -(-last // self.block)
        out = [
            unpack(
                self.data[self.base + self.offsets[i] : self.base + self.offsets[i + 1]],
                min(self.block, self.n_ids - i * self.block),
                self.bits,
            )
            for i in range(a, b)
        ]
        return np.concatenate(out)[first - a * self.block : last - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, file_text_bytes: int = FILE_BYTES) -> None:
    """Encode whole texts, append `end_id` to each, and write files in ascending doc_id order.

    Null texts are empty; null doc_ids come first; rows with equal doc_ids are all written,
    in the order of their texts. An empty table writes no ids. Other columns are not read.
    The files go through Spark's output commit, so lost and repeated tasks leave one copy.
    """
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(tokenizer_json(tokenizer))
    bits = width_of(max(vocabulary_size(source.value), end_id + 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = max(1, math.ceil(B.text_bytes(rows) / file_text_bytes), B.shuffle_partitions(docs))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.held_by_worker(source.value), np.array([end_id], "<u4").tobytes()
        doc_ids, counts, bodies = [], [], []
        for batch in batches:
            doc_ids.append(batch.column("doc_id").fill_null(_NULL).to_numpy(zero_copy_only=False))
            text = batch.column("text")
            for a, b in W.parts(W.utf8(text)[1]):
                for ids in encoder.encode(text.slice(a, b - a).to_pylist()):
                    counts.append(len(ids) // 4 + 1)
                    bodies += (ids, end)
        if counts:
            ids = np.frombuffer(b"".join(bodies), "<u4")
            starts = np.r_[0, np.cumsum(counts)]
            body = file_bytes(TaskContext.get().partitionId(), np.concatenate(doc_ids), starts, ids, bits)
            yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])

    # One row a file. The text writer adds one line end after it, which readers never reach.
    files = rows.mapInArrow(run, "body binary").select(F.col("body").cast("string").alias("value"))
    files.write.option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def file_index(spark: SparkSession, path: str) -> dict[int, int]:
    """Number of ids before each file, by file number; one entry a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("content"):
                held = PackedFile(body.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array([held.number]), pa.array([held.n_ids])], ["number", "n_ids"])

    sizes = sorted(_files(spark, path).mapInArrow(run, "number long, n_ids long").collect())
    before = np.cumsum([0, *(r["n_ids"] for r in sizes)])
    return {r["number"]: int(b) for r, b in zip(sizes, before)}


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every written document.

    start counts the ids of all documents before it, over all files; ids are little-endian
    unsigned 32-bit numbers.
    """
    ship(spark)
    before = spark.sparkContext.broadcast(file_index(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("content"):
                held = PackedFile(body.as_buffer())
                base = before.value[held.number]
                step = max(1, int(held.n_docs * (1 << 18) // max(1, held.n_ids)))
                for a in range(0, held.n_docs, step):
                    b = min(held.n_docs, a + step)
                    starts = held.starts[a : b + 1]
                    ids = held.ids(int(starts[0]), int(starts[-1])).astype("<u4")
                    doc_ids = held.doc_ids[a:b]
                    binary = pa.Array.from_buffers(
                        pa.large_binary(), b - a,
                        [None, pa.py_buffer((4 * (starts - starts[0])).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())],
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, mask=doc_ids == _NULL),
                            pa.array(starts[:-1] + base),
                            pa.array(np.diff(starts)),
                            binary.cast(pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return _files(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
