"""Packs: rows of one key as one binary value, an Arrow stream.

The engine hands rows to keyed state one by one, value by value; a pack crosses as one value and is taken apart as columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Rows, and their bytes, that a partition gathers before it packs them; rows that one batch of unpacked rows holds.
GATHERED_ROWS = 200_000
GATHERED_BYTES = 32 << 20
UNPACKED_ROWS = 20_000
_OPTIONS = pa.ipc.IpcWriteOptions(compression="lz4")


def write(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_OPTIONS) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def read(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def codes(table: pa.Table, names: list[str]) -> np.ndarray:
    """A number for each row, the same where the named columns are the same; nulls are a value of their own."""
    code = np.zeros(table.num_rows, np.int64)
    for name in names:
        one = pc.dictionary_encode(table.column(name).combine_chunks(), null_encoding="encode")
        one = one.combine_chunks() if isinstance(one, pa.ChunkedArray) else one
        code = np.unique(code * (len(one.dictionary) + 1) + one.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return code


def split(table: pa.Table, names: list[str]) -> Iterator[pa.Table]:
    """The rows by their values in the named columns, otherwise in their order."""
    code = codes(table, names)
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else order
    table = table.take(pa.array(order))
    for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), table.num_rows]):
        yield table.slice(begin, end - begin)


def pack(rows: DataFrame, keys: list[str], time: str | None = None) -> DataFrame:
    """``(*keys, time, pack)``: the rows of each partition in packs of one key; a pack's ``time`` is that of its last row, which it holds otherwise not."""
    held = [c for c in rows.columns if c != time]
    outer = [*keys, *([time] if time else [])]
    schema = StructType([rows.schema[c] for c in outer]).add("pack", "binary")

    def packed(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list] = [[] for _ in outer]
        data = []
        table = pa.Table.from_batches(tables).combine_chunks()
        for part in split(table, keys):
            for place, name in enumerate(outer):
                found[place].append(pc.max(part.column(name)) if name == time else part.column(name)[0])
            data.append(write(part.select(held)))
        arrays = [pa.array([v.as_py() for v in values], table.schema.field(name).type) for name, values in zip(outer, found)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(data, pa.binary())], [*outer, "pack"])

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, count, size = [], 0, 0
        for batch in batches:
            gathered.append(batch)
            count, size = count + batch.num_rows, size + batch.nbytes
            if count >= GATHERED_ROWS or size >= GATHERED_BYTES:
                yield from packed(gathered)
                gathered, count, size = [], 0, 0
        if count:
            yield from packed(gathered)

    return rows.mapInArrow(each, schema)


def unpack(packs: DataFrame, schema: str) -> DataFrame:
    """The rows of all packs."""
    names = [column.split()[0] for column in schema.split(", ")]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("pack"):
                yield from read(data.as_buffer()).select(names).to_batches(max_chunksize=UNPACKED_ROWS)

    return packs.select("pack").mapInArrow(each, schema)
