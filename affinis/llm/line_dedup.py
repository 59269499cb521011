"""Removal of lines that many documents share, by streaming over sorted hashes of lines.

Each line is a row of the 128-bit hash of its key (the line without blanks at
its ends, A-Z in lower case), its document and its position. The rows are dealt
into ranges of hash, document and position together and sorted inside a range,
so a line that a third of all documents have is many ranges and not one. A task
streams over its range: equal hashes are a run, in a run documents come one
after the other, and a run is decided once enough documents have passed; only
lines of fewer documents than that are held back.

A run at an edge of a range may go on in the next one. Its lines are written as
open, with one row per run for the number of documents and the first and the
last of them; these rows (at most two per range) are added up and settle the
open lines. What comes out is a compressed bitmap of the lines that stay, for
each document that loses some; texts are not shuffled to find them.

Defined cases: a NULL or empty text is one empty line, and stays; rows with the
same ``doc_id`` count as one document, and so do all rows without one; equal
rows get equal bitmaps; a document of very many lines is rows like any other
until its bitmap is made (one bit per line); keys are told apart by 128 bits,
texts under one id by 64; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.common import lower_ascii
from affinis.session import materialize, stack

BLANKS = " \t\n\x0b\x0c\r"
DROP, OPEN, EDGE = 0, 1, 2
ORDER = ("h1", "h2", "doc_id", "row", "pos")
FOUND = {
    "kind": pa.int8(), "h1": pa.int64(), "h2": pa.int64(), "doc_id": pa.int64(), "row": pa.int64(), "pos": pa.int32(),
    "n_lines": pa.int32(), "range": pa.int32(), "docs": pa.int64(), "last_doc": pa.int64(),
}
FOUND_SCHEMA = (
    "kind tinyint, h1 bigint, h2 bigint, doc_id bigint, row bigint, pos int, n_lines int,"
    " range int, docs bigint, last_doc bigint"
)


def line_rows(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``(h1, h2, doc_id, row, pos, n_lines)`` of every line whose key has at least ``min_chars`` code points."""
    row = F.xxhash64("text").alias("row")
    cut = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row, F.split("text", "\n", -1).alias("lines"))
    lines = cut.select("doc_id", "row", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = lines.withColumn("key", lower_ascii(F.btrim("line", F.lit(BLANKS))))
    keyed = keyed.where(F.char_length("key") >= min_chars)
    hashes = F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    return keyed.select(*hashes, "doc_id", "row", "pos", "n_lines")


class _Rows:
    """Lines in sorted order as columns."""

    __slots__ = ("columns", "id_null")

    def __init__(self, columns: dict[str, np.ndarray], id_null: np.ndarray):
        self.columns, self.id_null = columns, id_null

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        ids = batch.column("doc_id")
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "row", "pos", "n_lines")}
        columns["doc_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
        return cls(columns, ids.is_null().to_numpy(zero_copy_only=False))

    def __len__(self) -> int:
        return len(self.id_null)

    def __getitem__(self, which) -> _Rows:
        return _Rows({c: a[which] for c, a in self.columns.items()}, self.id_null[which])

    def changes(self, *names: str) -> np.ndarray:
        """For every row, whether one of the columns differs from the row before; true for the first."""
        out = np.ones(len(self), bool)
        out[1:] = False
        for name in names:
            out[1:] |= self.columns[name][1:] != self.columns[name][:-1]
        if "doc_id" in names:
            out[1:] |= self.id_null[1:] != self.id_null[:-1]
        return out

    def key(self, at: int) -> tuple[int, int]:
        return int(self.columns["h1"][at]), int(self.columns["h2"][at])

    def doc(self, at: int) -> int | None:
        return None if self.id_null[at] else int(self.columns["doc_id"][at])

    def line(self, at: int) -> tuple[int | None, int, int]:
        return self.doc(at), int(self.columns["row"][at]), int(self.columns["pos"][at])

    def is_line(self, line: tuple[int | None, int, int]) -> np.ndarray:
        doc, row, pos = line
        same_doc = self.id_null if doc is None else ~self.id_null & (self.columns["doc_id"] == doc)
        return same_doc & (self.columns["row"] == row) & (self.columns["pos"] == pos)

    def batch(self, kind: int) -> pa.RecordBatch:
        """As output; rows that are equal to the one before are one row."""
        new = self.changes(*ORDER)
        out, n = self[new], int(new.sum())
        given = {c: pa.array(a, FOUND[c]) for c, a in out.columns.items() if c != "doc_id"}
        given["doc_id"] = pa.array(out.columns["doc_id"], pa.int64(), mask=out.id_null)
        given["kind"] = pa.array(np.full(n, kind, np.int8))
        return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(n, t)) for c, t in FOUND.items()], names=list(FOUND))


class _Run:
    """The lines of one hash that have been seen in this range so far."""

    def __init__(self, rows: _Rows, leads: bool):
        self.key, self.leads = rows.key(0), leads  # a leading run may have begun in an earlier range
        self.first, self.docs, self.last_doc = rows.line(0), 0, None
        self.held: list[_Rows] = []
        self.decided = False

    def edge(self, part: int) -> pa.RecordBatch:
        doc, row, pos = self.first
        values = {
            "kind": EDGE, "h1": self.key[0], "h2": self.key[1], "doc_id": doc, "row": row, "pos": pos, "range": part,
            "docs": self.docs, "last_doc": self.last_doc,
        }
        return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in FOUND.items()], names=list(FOUND))


def stream_ranges(min_docs: int, keep_first: bool):
    """Function over the sorted batches of a range; see the module for what it writes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        current: _Run | None = None

        def extend(rows: _Rows) -> Iterator[pa.RecordBatch]:
            docs = int(rows.changes("doc_id").sum())
            current.docs += docs - (current.docs > 0 and rows.doc(0) == current.last_doc)
            current.last_doc = rows.doc(len(rows) - 1)
            if current.leads:
                yield rows.batch(OPEN)
                return
            current.held.append(rows)
            if current.docs >= min_docs:
                current.decided = True
                for held in current.held:
                    held = held[~held.is_line(current.first)] if keep_first else held
                    if len(held):
                        yield held.batch(DROP)
                current.held = []

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Rows.of(batch)
            cuts = np.append(np.flatnonzero(rows.changes("h1", "h2")), len(rows))
            head = rows[: cuts[1]]
            if current is None or head.key(0) != current.key:
                if current is not None and current.leads:
                    yield current.edge(part)
                current = _Run(head, leads=current is None)
            yield from extend(head)
            if len(cuts) == 2:
                continue
            if current.leads:
                yield current.edge(part)
            # whole runs inside of the batch
            if len(cuts) > 3:
                inner = rows[cuts[1] : cuts[-2]]
                begins = cuts[1:-2] - cuts[1]
                docs = np.add.reduceat(inner.changes("h1", "h2", "doc_id").astype(np.int64), begins)
                gone = np.repeat(docs >= min_docs, np.diff(np.append(begins, len(inner))))
                if keep_first:
                    line = np.cumsum(inner.changes(*ORDER))
                    gone &= line != np.repeat(line[begins], np.diff(np.append(begins, len(inner))))
                if gone.any():
                    yield inner[gone].batch(DROP)
            tail = rows[cuts[-2] :]
            current = _Run(tail, leads=False)
            yield from extend(tail)
        if current is not None:
            yield current.edge(part)
            if not current.decided:
                for held in current.held:
                    yield held.batch(OPEN)

    return run


def packed(positions: np.ndarray, n_lines: int) -> bytes:
    """Bits of the lines that stay, all but ``positions``: a byte 0 and the bits, or a byte 1 and the bits compressed."""
    keep = np.ones(n_lines, bool)
    keep[positions] = False
    bits = np.packbits(keep).tobytes()
    small = zlib.compress(bits, 6)
    return b"\x01" + small if len(small) < len(bits) else b"\x00" + bits


def unpacked(keep: bytes, n_lines: int) -> np.ndarray:
    bits = zlib.decompress(keep[1:]) if keep[0] else keep[1:]
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n_lines).astype(bool)


def _bitmaps(positions: pd.Series, n_lines: pd.Series) -> pd.DataFrame:
    unique = [np.unique(p) for p in positions]
    return pd.DataFrame(
        {"n_dropped": [len(u) for u in unique], "keep": [packed(u, int(n)) for u, n in zip(unique, n_lines)]}
    )


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``(doc_id, row, n_lines, n_dropped, keep)`` of each document that loses lines.

    Keys of at least ``min_chars`` code points that ``min_docs`` documents have
    lose all their lines, or with ``keep_first`` all but the first one in order
    of ``doc_id``, text and position. ``row`` is the 64-bit hash of the text, to tell rows
    with the same id apart; ``keep`` is read by ``unpacked``.
    """
    lines = line_rows(docs, min_chars)
    ranges = lines.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    found = materialize(ranges.mapInArrow(stream_ranges(min_docs, keep_first), FOUND_SCHEMA), "lines")
    # the same run in neighbouring ranges; a document on both sides of an edge counts once
    following = Window.partitionBy("h1", "h2").orderBy("range")
    goes_on = F.col("doc_id").eqNullSafe(F.lag("last_doc").over(following)) & (F.row_number().over(following) > 1)
    edges = found.where(F.col("kind") == EDGE).withColumn("counted", F.col("docs") - goes_on.cast("bigint"))
    first = F.min_by(F.struct("doc_id", "row", "pos"), "range").alias("first")
    runs = edges.groupBy("h1", "h2").agg(F.sum("counted").alias("all_docs"), first)
    shared = F.broadcast(runs.where(F.col("all_docs") >= min_docs))  # at most two runs per range
    settled = found.where(F.col("kind") == OPEN).join(shared, ["h1", "h2"])
    if keep_first:
        settled = settled.where(~F.struct("doc_id", "row", "pos").eqNullSafe(F.col("first")))
    columns = ["doc_id", "row", "n_lines", "pos"]
    dropped = stack(found.where(F.col("kind") == DROP).select(*columns), settled.select(*columns))
    per_doc = dropped.groupBy("doc_id", "row").agg(F.max("n_lines").alias("n_lines"), F.collect_list("pos").alias("pos"))
    bitmap = F.pandas_udf(_bitmaps, "n_dropped bigint, keep binary")
    return per_doc.select("doc_id", "row", "n_lines", bitmap("pos", "n_lines").alias("b")).select(
        "doc_id", "row", "n_lines", "b.n_dropped", "b.keep"
    )


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, texts = [], []
        for text, keep in zip(batch.column("text"), batch.column("keep")):
            text, keep = text.as_py() or "", keep.as_py()
            n = text.count("\n") + 1
            if keep is not None:
                text = "\n".join([line for line, stays in zip(text.split("\n"), unpacked(keep, n)) if stays])
            counts.append(n)
            texts.append(text)
        arrays = [
            batch.column("doc_id"),
            pa.array(counts, pa.int64()),
            batch.column("n_dropped").fill_null(0),
            pa.array(texts, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_lines", "n_dropped", "text"])


def without_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text)`` per row of ``docs``, with the lines that its bitmap keeps."""
    mine = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("row"))
    theirs = bitmaps.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "n_dropped", "keep")
    met = mine.join(theirs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    schema = "doc_id bigint, n_lines bigint, n_dropped bigint, text string"
    return met.select("doc_id", "text", "n_dropped", "keep").mapInArrow(_kept, schema)
