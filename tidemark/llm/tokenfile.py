"""Token files of fixed-width ids: writer, vectorised reader and random access.

One file per range of documents. Layout, all little-endian:

    header   magic, version, bits per id, ids per block
    blocks   ids of a block in ``bits`` bits each, least significant bit first, padded to a byte
    index    doc ids (int64) and ids per document (uint64), block offsets (uint64, one more than blocks)
    trailer  documents, documents with a null id (they come first), ids, blocks, magic
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import Encoder
from tidemark.llm.shared import pieces
from tidemark.session import checkpoint_dir, materialize

MAGIC = b"TIDE"
HEADER = struct.Struct("<4sHHI")
TRAILER = struct.Struct("<QQQQ4s")
BLOCK_IDS = 1 << 16


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def id_bits(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class Reader:
    """One token file: its index is read at once, its ids block by block or at random."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        magic, _, self.bits, self.block_ids = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        n_docs, self.n_null, self.n_ids, n_blocks, end = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC or end != MAGIC:
            raise OSError(f"{uri} is not a whole token file")
        width = 8 * (2 * n_docs + n_blocks + 1)
        index = self.file.read_at(width, size - TRAILER.size - width)
        self.doc_ids = np.frombuffer(index, "<i8", n_docs)
        self.counts = np.frombuffer(index, "<u8", n_docs, 8 * n_docs).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", n_blocks + 1, 16 * n_docs).astype(np.int64)

    def block(self, n: int) -> np.ndarray:
        count = min(self.block_ids, self.n_ids - n * self.block_ids)
        return unpack(self.file.read_at(int(self.offsets[n + 1] - self.offsets[n]), int(self.offsets[n])), count, self.bits)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, from the blocks that hold them."""
        if count <= 0:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        held = np.concatenate([self.block(n) for n in range(first, last + 1)])
        return held[start - first * self.block_ids :][:count]

    def documents(self):
        """For each document in order: doc_id (None if null), start in this file, ids, crc32 of the ids; one block in memory."""
        at, start, block = -1, 0, np.zeros(0, "<u4")
        for n, count in enumerate(self.counts.tolist()):
            crc, done = 0, 0
            while done < count:
                want = (start + done) // self.block_ids
                if want != at:
                    at, block = want, self.block(want)
                part = block[start + done - at * self.block_ids :][: count - done]
                crc = zlib.crc32(part.tobytes(), crc)
                done += len(part)
            yield (None if n < self.n_null else int(self.doc_ids[n])), start, count, crc
            start += count


def _write(batches, tokenizer, end_id, folder, block_ids):
    encoder = Encoder(tokenizer)
    bits = id_bits(max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1))
    end = np.array([end_id], "<u4").tobytes()
    store, root = open_store(folder)
    part = TaskContext.get().partitionId()
    scratch, target = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}", f"{root}/part-{part:06d}.ids"
    doc_ids, counts, offsets, n_null, n_ids = [], [], [HEADER.size], 0, 0
    waiting = bytearray()
    out = None

    def flush(whole):
        nonlocal n_ids
        size = 4 * block_ids
        begin = 0
        while len(waiting) - begin >= size or (whole and begin < len(waiting)):
            ids = np.frombuffer(bytes(waiting[begin : begin + size]), "<u4")
            data = pack(ids, bits)
            out.write(data)
            offsets.append(offsets[-1] + len(data))
            n_ids += len(ids)
            begin += size
        del waiting[:begin]

    for batch in pieces(batches):
        if out is None:
            store.create_dir(root)
            out = store.open_output_stream(scratch)
            out.write(HEADER.pack(MAGIC, 1, bits, block_ids))
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode([t or "" for t in batch.column("text").to_pylist()])):
            n_null += doc is None
            doc_ids.append(doc or 0)
            counts.append(len(ids) // 4 + 1)
            waiting += ids
            waiting += end
            if len(waiting) >= 4 * block_ids:
                flush(False)
    if out is None:
        return
    flush(True)
    out.write(np.array(doc_ids, "<i8").tobytes() + np.array(counts, "<u8").tobytes() + np.array(offsets, "<u8").tobytes())
    out.write(TRAILER.pack(len(doc_ids), n_null, n_ids, len(offsets) - 1, MAGIC))
    out.close()
    store.move(scratch, target)  # a repeated task replaces the file by an equal one
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([f"part-{part:06d}.ids"]), pa.array([len(doc_ids)], pa.int64()), pa.array([n_ids], pa.int64())], ["part", "file", "n_docs", "n_ids"])


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, block_ids: int = BLOCK_IDS) -> tuple[str, DataFrame]:
    """Write the ids of ``docs`` (doc_id, text) to files, ascending by doc_id, and return the folder and the list of files.

    Every document is its ids (null text: none) and ``end_id``. Files hold ranges of doc_id, in
    order of their names; null ids come first, and rows that repeat a doc_id follow each other by text. The folder is in the
    shared checkpoint folder unless one is given. An empty table gives no files.
    """
    folder = folder or f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(
        partial(_write, tokenizer=tokenizer, end_id=end_id, folder=folder, block_ids=block_ids), "part long, file string, n_docs long, n_ids long"
    )
    return folder, materialize(files)


def _read(batches, folder):
    for batch in batches:
        for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
            rows = []
            for doc, start, count, crc in Reader(f"{folder}/{file}").documents():
                rows.append((doc, before + start, count, crc))
                if len(rows) == 50_000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)


def _rows(rows):
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4, ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(folder: str, files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32; one task per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    listed = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    spread = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(spread, "file").mapInArrow(partial(_read, folder=folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
