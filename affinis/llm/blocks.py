"""Documents in blocks: what one Python task holds at a time, and how it packs rows for a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

BLOCK_BYTES = 24 << 20
BLOCK_DOCS = 60_000


def document_blocks(
    batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES, docs: int = BLOCK_DOCS
) -> Iterator[tuple[int, list, list[bytes]]]:
    """``(number, ids, texts)`` of about ``limit`` bytes; a NULL text is empty, a longer text is a block of its own.

    Numbers are unique in the job and the same when a task is run again on the same input.
    """
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 24
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        keys = batch.column("doc_id").to_pylist()
        for key, text in zip(keys, batch.column("text").cast(pa.large_binary())):
            data = text.as_py() or b""
            if ids and (size + len(data) > limit or len(ids) == docs):
                yield number, ids, texts
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(key)
            texts.append(data)
            size += len(data)
    if ids:
        yield number, ids, texts


def binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array whose rows are ``data`` cut at ``bounds`` (counted in elements)."""
    data = np.ascontiguousarray(data)
    offsets = (np.asarray(bounds, np.int64) * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def part_keys(spark, n: int) -> list[int]:
    """One key per shuffle partition: ``repartition(n, key)`` sends the i-th of them to partition i."""
    from pyspark.sql import functions as F

    where = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    keys = spark.range(40 * n).groupBy(where.alias("to")).agg(F.min("id").alias("key"))
    found = {r["to"]: r["key"] for r in keys.collect()}
    return [found.get(i, i) for i in range(n)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


PACKED = "part int, nodes binary, keys binary, owners binary"


def packed_rows(parts: list[int], nodes: np.ndarray, key: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """Keys of 64 bits and the nodes that have them, one row per partition.

    The upper half of a key gives the partition, the lower half travels, with
    the node's number in the block; the top bit of ``owner`` is a mark that is
    passed on. Unequal keys meet by chance once in 2^32, so what shares a key
    has still to be compared.
    """
    n = len(parts)
    part = ((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    key, owner = key[order].astype(np.uint32), owner[order]
    cuts = np.searchsorted(part[order], np.arange(n + 1))
    rows = []
    for p in range(n):
        a, b = cuts[p], cuts[p + 1]
        if a < b:
            used, local = np.unique(owner[a:b] & 0x7FFF, return_inverse=True)
            marked = local.astype(np.uint16) | (owner[a:b] & 0x8000)
            rows.append((parts[p], nodes[used].tobytes(), key[a:b].tobytes(), marked.tobytes()))
    columns = list(zip(*rows)) or [[]] * 4
    arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "nodes", "keys", "owners"])


def unpacked(rows: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(key, node, mark)`` of the rows of a partition, only keys that occur more than once, in order of key."""
    keys, nodes, marks = [], [], []
    for names, key, owner in rows:
        owners = np.frombuffer(owner, np.uint16)
        keys.append(np.frombuffer(key, np.uint32))
        nodes.append(np.frombuffer(names, np.int64)[owners & 0x7FFF])
        marks.append((owners >> 15).astype(bool))
    key, node, mark = np.concatenate(keys), np.concatenate(nodes), np.concatenate(marks)
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.append(key[1:] == key[:-1], False)[: len(key)]
    several = same | np.append(False, same[:-1])[: len(key)]
    return key[several], node[order[several]], mark[order[several]]
