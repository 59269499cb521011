"""Removal of byte strings that already stand in an earlier document, by suffix order and backward extension.

A string of ``LENGTH`` bytes is judged at its *anchor*: the ``GRAM`` bytes in it
with the smallest hash, the leftmost of equal ones. Equal strings have equal
anchors at the same distance from their start, so only anchors travel:

1. Each different text ships the hashes of its anchors, packed. Hashes that two
   texts or more have are sent back to these texts.
2. Occurrences of such anchors are dealt out by hash, with the bytes around them.
3. A partition sorts its occurrences by the bytes from the anchor on (a suffix
   array of the anchors with its common prefixes, cut at ``LENGTH``). Backward
   extension by one preceding byte is a stable sort by that byte, the step of a
   Burrows-Wheeler transform; common prefixes of the longer strings follow as
   one more than range minima of the shorter ones'. Breadth-first, after a steps
   the intervals with common prefixes of at least ``LENGTH`` are the equal strings
   that start a bytes before their anchors. There are at most LENGTH - GRAM steps.
4. Strings of an interval that are not in its smallest document are removed.

Equal texts are one text, that of the smallest ``doc_id``; the others lose all
if they have ``LENGTH`` bytes. The comparison is of bytes; hashes only bring
candidates together. Texts are told apart by 64-bit hash and length.

Defined cases: a NULL text is empty and a text shorter than ``LENGTH`` loses
nothing; a row without ``doc_id`` neither removes nor loses anything; rows with
the same id never remove from each other; equal rows give equal results; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.blocks import PACKED, document_blocks, mixed, packed_rows, part_keys, unpacked
from affinis.llm.common import partitions
from affinis.session import materialize

LENGTH = 50
GRAM = 24
LEFT = LENGTH - GRAM  # the most bytes that a string has before its anchor
AROUND = LEFT + LENGTH
PLACE_BITS = 20
CHUNK = 1 << (PLACE_BITS - 1)
BLOCK_DOCS = 30_000
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all stretches of 24 = 16 + 8 bytes; widths are doubled, so no stretch is read byte by byte."""
    h, width = data.astype(np.uint64), 1
    for factor in FACTORS[:3]:
        h = h[:-width] * factor + h[width:]
        width *= 2
    wide = h[:-8] * FACTORS[3] + h[8:]
    n = len(data) - GRAM + 1
    return mixed(wide[:n] * FACTORS[0] + h[16 : 16 + n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, place, first, last)``: the strings that start at ``first`` to ``last`` have their anchor at ``place``.

    Long texts are taken in chunks, so that a place fits into the low bits of
    the number whose minimum is sought.
    """
    raw = np.frombuffer(data, np.uint8)
    out = []
    for begin in range(0, len(raw) - LENGTH + 1, CHUNK):
        part = raw[begin : begin + CHUNK + LENGTH - 1]
        h = _gram_hashes(part)
        least = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
        width, want = 1, LEFT + 1
        while 2 * width <= want:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < want:
            least = np.minimum(least[: -(want - width)], least[want - width :])
        change = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.append(0, change)
        last = np.append(change, len(least)) - 1
        chosen = least[first]
        place = (chosen & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        out.append((chosen >> np.uint64(PLACE_BITS), place + begin, first + begin, last + begin))
    if not out:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(c) for c in zip(*out))


def _shifted(hashes: np.ndarray) -> np.ndarray:
    """Anchor hashes of 44 bits as keys whose upper half is evenly spread."""
    return mixed(hashes)


def _ship(parts: list[int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, nodes, texts in document_blocks(batches, docs=BLOCK_DOCS):
            number: dict[int, int] = {}
            keys, owners = [], []
            for node, text in zip(nodes, texts):
                if node in number:
                    continue
                i = number[node] = len(number)
                key = _shifted(np.unique(anchors(text)[0]))
                keys.append(key)
                owners.append(np.full(len(key), i, np.uint16))
            yield packed_rows(parts, np.array(list(number), np.int64), np.concatenate(keys), np.concatenate(owners))

    return run


def _shared(parts: list[int]):
    """Per text the keys of a partition that another text has too."""
    index = {key: i for i, key in enumerate(parts)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                held.setdefault(r["part"], []).append((r["nodes"], r["keys"], r["owners"]))
        for part, rows in held.items():
            key, node, _ = unpacked(rows)
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            once = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
            key, node = key[once], node[once]
            same = np.append(key[1:] == key[:-1], False)[: len(key)]
            several = same | np.append(False, same[:-1])[: len(key)]
            key, node = key[several], node[several]
            order = np.argsort(node, kind="stable")
            key, node = key[order], node[order]
            start = np.flatnonzero(np.append(True, node[1:] != node[:-1])[: len(node)])
            values = pa.array(np.int64(index[part]) << 32 | key.astype(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(node)), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([pa.array(node[start]), lists], names=["node", "keys"])

    return run


AROUNDS = "part int, doc_id bigint, node bigint, n int, hashes binary, arounds binary, places binary, spans binary"


def _arounds(parts: list[int]):
    """Occurrences of shared anchors with the bytes around them, packed per text and partition."""
    n = np.uint64(len(parts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys = batch.column("keys")
            for i, (doc, node, right) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "node", "head_node")))):
                if right is None or right != node:
                    continue
                data = batch.column("text")[i].as_py().encode()
                asked = np.unique(np.array(keys[i].values, np.int64))
                h, place, first, last = anchors(data)
                key = _shifted(h)
                part = ((key >> np.uint64(32)) * n) >> np.uint64(32)
                name = (part << np.uint64(32) | (key & np.uint64(0xFFFFFFFF))).astype(np.int64)
                at = np.searchsorted(asked, name)
                use = np.flatnonzero(asked[np.minimum(at, len(asked) - 1)] == name)
                use = use[np.argsort(part[use], kind="stable")]
                padded = np.frombuffer(bytes(LEFT) + data + bytes(AROUND), np.uint8)
                around = padded[place[use][:, None] + np.arange(AROUND)]
                spans = np.stack([place[use] - last[use], place[use] - first[use]], axis=1).astype(np.uint8)
                cuts = np.flatnonzero(np.append(True, part[use][1:] != part[use][:-1])[: len(use)]).tolist() + [len(use)]
                for a, b in zip(cuts, cuts[1:]):
                    u = use[a:b]
                    packed = (h[u].tobytes(), around[a:b].tobytes(), place[u].tobytes(), spans[a:b].tobytes())
                    rows.append((parts[int(part[u[0]])], doc, node, b - a, *packed))
            columns = list(zip(*rows)) or [[]] * 8
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
            names = ["part", "doc_id", "node", "n", "hashes", "arounds", "places", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


class RangeMinima:
    """Minima of ranges of an array, from minima of ranges whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        width = 1
        while 2 * width <= len(values):
            t = self.tables[-1]
            self.tables.append(np.minimum(t[:-width], t[width:]))
            width *= 2
        self.flat = np.concatenate(self.tables)
        self.offsets = np.cumsum([0, *map(len, self.tables[:-1])])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        base = self.offsets[level]
        return np.minimum(self.flat[base + first], self.flat[base + last + 1 - (1 << level)])


def repeated_strings(around: np.ndarray, spans: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per occurrence a bit mask: bit a is set if the string that starts a bytes before the anchor stands in a smaller document.

    ``around`` has the ``LEFT`` bytes before each anchor and the ``LENGTH`` bytes
    from it on, ``spans`` the least and the largest a of the strings it stands for.
    """
    n = len(doc)
    masks = np.zeros(n, np.uint32)
    if n < 2:
        return masks
    suffix = np.ascontiguousarray(around[:, LEFT:])
    order = np.argsort(suffix.view(f"V{LENGTH}").ravel(), kind="stable")
    ordered = suffix[order]
    unequal = ordered[1:] != ordered[:-1]
    common = np.where(unequal.any(axis=1), unequal.argmax(axis=1), LENGTH)
    common = np.append(0, common).astype(np.uint8)  # of each suffix and the one before
    for a in range(LEFT + 1):
        if a:  # backward extension: stable by the preceding byte
            byte = around[order, LEFT - a]
            step = np.argsort(byte, kind="stable")
            same = byte[step][1:] == byte[step][:-1]
            at = np.flatnonzero(same)
            new = np.zeros(n, np.uint8)
            new[at + 1] = 1 + RangeMinima(common).of(step[at] + 1, step[at + 1])
            order, common = order[step], new
        valid = (spans[order, 0] <= a) & (a <= spans[order, 1])
        first = np.flatnonzero(common < LENGTH)
        owner = np.where(valid, doc[order], np.iinfo(np.int64).max)
        least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, n)))
        masks[order[valid & (least < owner)]] |= np.uint32(1 << a)
    return masks


def _removals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            held.setdefault(r["part"], []).append(r)
    for rows in held.values():
        gather = lambda c, t: np.frombuffer(b"".join(r[c] for r in rows), t)
        counts = [r["n"] for r in rows]
        around, spans = gather("arounds", np.uint8).reshape(-1, AROUND), gather("spans", np.uint8).reshape(-1, 2)
        doc, node = (np.repeat(np.array([r[c] for r in rows], np.int64), counts) for c in ("doc_id", "node"))
        masks = repeated_strings(around, spans, doc)
        use = np.flatnonzero(masks)
        place = gather("places", np.int64)[use]
        arrays = [pa.array(doc[use]), pa.array(node[use]), pa.array(place), pa.array(masks[use].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "node", "place", "mask"])


def removed_runs(size: int, places: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the strings of the masks cover."""
    edges = np.zeros(size + 1, np.int64)
    for a in range(LEFT + 1):
        starts = places[masks >> a & 1 == 1] - a
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + LENGTH, -1)
    inside = np.cumsum(edges) > 0
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    change = np.append(0, change) if len(inside) and inside[0] else change
    return change[0::2], change[1::2]


def _results(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = np.empty(0, np.int64)
    for batch in batches:
        ids, nodes = batch.column("doc_id").to_pylist(), batch.column("node").to_pylist()
        rows = []
        for i, (node, text) in enumerate(zip(nodes, batch.column("text").cast(pa.large_binary()))):
            data = text.as_py() or b""
            starts = ends = nothing
            found = batch.column("found")[i]
            if found.is_valid:
                owner, place, mask = (np.array(found.values.field(c), np.int64) for c in ("node", "place", "mask"))
                own = owner == node
                if (own & (mask < 0)).any():  # a copy
                    starts, ends = np.zeros(1, np.int64), np.full(1, len(data))
                elif own.any():
                    starts, ends = removed_runs(len(data), place[own], mask[own])
            at, kept = 0, hashlib.sha256()
            for a, b in zip(starts.tolist(), ends.tolist()):
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            rows.append((ids[i], len(data), int((ends - starts).sum()), len(starts), kept.hexdigest(), starts.tolist(), ends.tolist()))
        columns = list(zip(*rows)) or [[]] * 7
        types = (*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


RESULTS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, starts array<bigint>, ends array<bigint>"


def removals(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: sizes, the removed runs (``starts`` and ``ends`` in bytes) and the hash of what is kept."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    parts = part_keys(spark, n)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    name = F.xxhash64("text", F.octet_length("text"))
    long = F.octet_length("text") >= LENGTH

    ids = materialize(texts.where(long & F.col("doc_id").isNotNull()).select("doc_id", name.alias("node")), "names")
    heads = ids.groupBy("node").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n"))
    copies = ids.join(heads.where("n > 1").select("node", "head"), "node").where("doc_id > head")
    whole = F.lit(-1).cast("bigint")
    copies = copies.select("doc_id", "node", whole.alias("place"), whole.alias("mask"))

    # the column that blocks take as the id is the name of the text here
    named = texts.where(long & F.col("doc_id").isNotNull()).select(name.alias("doc_id"), "text")
    shipped = named.mapInArrow(_ship(parts), PACKED).repartition(n, "part")
    shared = shipped.mapInArrow(_shared(parts), "node bigint, keys array<bigint>")
    shared = shared.groupBy("node").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    asked = shared.join(heads.select("node", "head"), "node").select("head", F.col("node").alias("head_node"), "keys")

    # the texts are dealt out by id once, for both joins
    met = texts.join(asked, F.col("doc_id") == F.col("head"), "left").select("doc_id", "text", name.alias("node"), "head_node", "keys")
    around = met.mapInArrow(_arounds(parts), AROUNDS).repartition(n, "part")
    found = around.mapInArrow(_removals, "doc_id bigint, node bigint, place bigint, mask bigint").unionByName(copies)
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("node", "place", "mask")).alias("found"))
    found = found.withColumnRenamed("doc_id", "id")
    final = texts.join(found, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", name.alias("node"), "found")
    return final.mapInArrow(_results, RESULTS)
