"""Lists of numbers as short byte strings, for tables that are shuffled.

Each column is cut into planes of bytes (all lowest bytes, all second ones and so on),
as many as its largest value needs, and planes that get shorter are compressed.
Nothing is rounded: doubles that are not all whole keep their eight bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CODEC = "zstd"
INTEGER, WHOLE, BITS = range(3)


@dataclass
class Planes:
    kind: int
    base: int
    planes: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Planes:
        kind, base = INTEGER, 0
        if values.dtype == np.float64:
            kind = BITS if np.signbit(values).any() or (values >= 2.0**53).any() or (np.rint(values) != values).any() else WHOLE
            bits = values.astype(np.uint64) if kind == WHOLE else values.view(np.uint64)
        elif values.dtype == np.uint64:
            bits = values
        else:
            base = int(values.min()) if len(values) else 0
            bits = values.astype(np.int64).view(np.uint64) - np.int64(base).view(np.uint64)
        size = (int(bits.max()).bit_length() + 7) // 8 if len(bits) else 0
        octets = np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 8)
        return cls(kind, base, np.ascontiguousarray(octets[:, :size].T))


def encode(columns: list[Planes], begin: list[int], end: list[int]) -> bytes:
    """Rows ``begin`` to ``end`` of each column."""
    head, body = [], []
    for column, b, e in zip(columns, begin, end):
        head += [column.kind, column.base, e - b, len(column.planes)]
        for plane in column.planes:
            raw = plane[b:e].tobytes()
            packed = pa.compress(raw, CODEC, asbytes=True) if len(raw) > 64 else raw
            short = len(packed) < len(raw)
            head.append(len(packed) if short else -len(raw))
            body.append(packed if short else raw)
    return np.array(head, np.int64).tobytes() + b"".join(body)


def decode(data: bytes, columns: int) -> list[np.ndarray]:
    """Columns of ``encode``: doubles, or whole numbers as 64 bits (signed if they were)."""
    plan, at = [], 0
    for _ in range(columns):
        kind, base, rows, planes = np.frombuffer(data, np.int64, 4, at).tolist()
        plan.append((kind, base, rows, np.frombuffer(data, np.int64, planes, at + 32).tolist()))
        at += 32 + 8 * planes
    out = []
    for kind, base, rows, sizes in plan:
        octets = np.zeros((rows, 8), np.uint8)
        for i, size in enumerate(sizes):
            raw = data[at : at + abs(size)]
            octets[:, i] = np.frombuffer(raw if size <= 0 else pa.decompress(raw, rows, CODEC, asbytes=True), np.uint8)
            at += abs(size)
        bits = octets.view(np.uint64).reshape(-1)
        if kind == INTEGER:
            out.append(bits.view(np.int64) + np.int64(base))
        else:
            out.append(bits.astype(np.float64) if kind == WHOLE else bits.view(np.float64))
    return out


def steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Values of lists as differences to the one before, the first of a list as it is; small if the lists are in order."""
    bits = values.view(np.uint64)
    out = np.diff(bits, prepend=np.uint64(0))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[first] = bits[first]
    return out


def from_steps(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    bits = np.cumsum(found.view(np.uint64), dtype=np.uint64)
    sizes = sizes[sizes > 0]
    first = np.cumsum(sizes) - sizes
    before = bits[first] - found.view(np.uint64)[first]
    return (bits - np.repeat(before, sizes)).view(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A hash of whole numbers, as unsigned 64 bits (the finish of splitmix64)."""
    x = np.ascontiguousarray(values).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
