"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a document with up to k = rate * m
edits. Cut into k + 1 pieces, at least one piece of it is then there unchanged.
The pieces of a block of items form one automaton that runs over every document;
around each piece hit the whole item is verified by Myers' bit-parallel edit
distance. Both sides are compared in lower case.

Items are taken in blocks of ``BLOCK_CHARS`` characters, so what is sent to the
executors is bounded whatever the size of the benchmark: a larger benchmark is
more passes over the documents. No document or item is left out.

Defined cases: a NULL or empty document has no hits, a NULL or blank item is in
none; an item of fewer than ``MIN_CHARS`` characters is reported where it stands
unchanged between word ends, but as such texts also occur by chance, it takes no
document away; equal documents and equal items each give their own rows; of several places of an item
in a document the one with the fewest edits is reported, then the first; a very
long text is matched whole, in memory of some times its size; empty tables give
no rows; other columns are not looked at. Places refer to the text in lower case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import materialize

ERROR_RATE = 0.06
MIN_CHARS = 20
BLOCK_CHARS = 1_000_000
HITS = "doc_id bigint, item_id bigint, distance int, start int, end int"

Items = list[tuple[int, str]]


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of about equal length with their places."""
    cuts = [len(item) * j // (budget + 1) for j in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_place(pattern: str, text: str) -> tuple[int, int]:
    """Fewest edits between ``pattern`` and any stretch of ``text``, and the end of the first such stretch.

    Myers (1999): a column of the distance table is two bit vectors of its steps up and down.
    """
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, place = m, 0
    for i, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (full & ~(vertical | plus)), plus & vertical
        if score < best:
            best, place = score, i
    return best, place


def matcher(items: Items, rate: float = ERROR_RATE) -> Callable[[str | None], list[tuple[int, int, int, int]]]:
    """Function from a text to ``(item_id, distance, start, end)`` of the items it contains."""
    import ahocorasick

    known = [(key, item.lower(), int(rate * len(item))) for key, item in items]
    automaton = ahocorasick.Automaton()
    for n, (_, item, budget) in enumerate(known):
        for at, piece in pieces(item, budget) if len(item) >= MIN_CHARS else [(0, item)]:
            if automaton.exists(piece):
                automaton.get(piece)[1].append((n, at))
            else:
                automaton.add_word(piece, (len(piece), [(n, at)]))
    if known:
        automaton.make_automaton()

    def run(text: str | None) -> list[tuple[int, int, int, int]]:
        if not text or not known:
            return []
        text = text.lower()
        begins: dict[int, set[int]] = {}
        for last, (length, owners) in automaton.iter(text):
            for n, at in owners:
                begins.setdefault(n, set()).add(last + 1 - length - at)
        out = []
        for n, starts in begins.items():
            key, item, budget = known[n]
            if len(item) < MIN_CHARS:
                alone = [a for a in starts if not (text[a - 1 : a].isalnum() or text[a + len(item) : a + len(item) + 1].isalnum())]
                if alone:
                    out.append((key, 0, min(alone), min(alone) + len(item)))
                continue
            exact = text.find(item)
            if exact >= 0:
                out.append((key, 0, exact, exact + len(item)))
                continue
            best = None
            stretches: list[list[int]] = []
            for s in sorted(starts):  # of one item, places that are near each other are verified together
                a, b = max(0, s - budget), min(len(text), s + len(item) + budget)
                if stretches and a <= stretches[-1][1]:
                    stretches[-1][1] = b
                else:
                    stretches.append([a, b])
            for a, b in stretches:
                distance, end = best_place(item, text[a:b])
                if distance <= budget and (best is None or distance < best[0]):
                    _, back = best_place(item[::-1], text[a : a + end][::-1])
                    best = distance, a + end - back, a + end
            if best:
                out.append((key, *best))
        return sorted(out)

    return run


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS, min_chars: int = 1) -> Iterator[Items]:
    """The items block by block; the driver holds one partition of the benchmark at a time."""
    asked = (F.char_length("text") >= min_chars) & F.col("text").rlike(r"\S")
    rows = benchmark.where(asked).select(F.col("item_id").cast("bigint"), "text")
    block: Items = []
    size = 0
    for key, text in rows.toLocalIterator():
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((key, text))
        size += len(text)
    if block:
        yield block


def _hits(items: Items, rate: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher(items, rate)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            rows = [(k, *h) for k, t in zip(keys, batch.column("text")) for h in match(t.as_py())]
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "distance", "start", "end"])

    return run


def _leaks(items: Items, rate: float):
    """Column function: whether a text contains one of the items."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        match = matcher(items, rate)
        for batch in texts:
            yield pd.Series([bool(match(t)) for t in batch], dtype=bool)

    return F.pandas_udf(run, "boolean")


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, limit: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, item_id, distance, start, end)``: every item that a document contains."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for block in item_blocks(benchmark, limit):
        # each pass is written, so that the driver holds one block of items, not all of them
        hits = materialize(texts.mapInArrow(_hits(block, rate), HITS), "leaks")
        found = hits if found is None else found.unionByName(hits)
    return docs.sparkSession.createDataFrame([], HITS) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, limit: int = BLOCK_CHARS) -> DataFrame:
    """The documents that contain no test item of ``MIN_CHARS`` characters or more."""
    clean = written = None
    for block in item_blocks(benchmark, limit, MIN_CHARS):
        if clean is not None:  # what a block leaves is written before the next one, so that the driver holds one block
            docs = written = materialize(clean, "clean", instead_of=written)
        clean = docs.where(~_leaks(block, rate)("text"))
    return docs if clean is None else clean
