"""Ranked search of documents by one automaton of all terms of the items.

No index of the documents is built. The terms of a block of items, each between
two boundary marks, form one Aho-Corasick automaton, which runs over every text
with its boundaries turned into the same mark: an output of the automaton is an
occurrence of a whole term, and leads to the items that have it. One pass adds
up what the weights need (documents, terms and documents per term), a second
one scores. A task keeps the best documents per item that it has seen, with the
last of them as a threshold, and only these leave it.

Scores are whole numbers, see ``contributions``. Items are taken in blocks of
``BLOCK_CHARS`` characters, so automaton, weights and what a task keeps are
bounded whatever the number of items; more items are more passes.

Defined cases: a NULL text has no terms and a document without terms counts
nowhere; rows with the same ``item_id`` (NULL is one too) are one item with the
terms of all; an item without terms, or whose terms no document has, has no
rows; equal documents each take a rank, among equal scores the lower ``doc_id``
first and rows without one last; a very long text is scanned like any other and
held once, as bytes and as a string; empty tables give no rows; other columns
are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.session import materialize, stack

BLOCK_CHARS = 4_000_000
#: Cells of the table of scores (documents by items) that a task fills at a time.
CELLS = 2_000_000
MARK = 0x20
#: Weights count in thousandths, a term's frequency part in millionths of what many occurrences would give.
WEIGHT_UNITS, PART_UNITS = 1000, 1_000_000_000
#: Per byte of UTF-8 its lower case if it belongs to a term, else the mark.
TO_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else MARK for c in range(256)
)

STATS = "term bigint, amount bigint"
BEST = "item bigint, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and bytes beyond ASCII, A-Z in lower case."""
    return text.translate(TO_TERMS).split()


@dataclass
class Block:
    """A block of items: their ids, and per distinct term the items that have it and how often."""

    ids: list[int | None]
    terms: list[bytes]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    longest: int

    @classmethod
    def of(cls, items: list[tuple[int | None, Counter]]) -> Block:
        number: dict[bytes, int] = {}
        rows = [(number.setdefault(t, len(number)), n, c) for n, (_, terms) in enumerate(items) for t, c in terms.items()]
        table = np.array(rows, np.int64).reshape(-1, 3)
        table = table[np.argsort(table[:, 0], kind="stable")]
        starts = np.searchsorted(table[:, 0], np.arange(len(number) + 1))
        longest = max((sum(terms.values()) for _, terms in items), default=0)
        return cls([key for key, _ in items], list(number), starts, table[:, 1], table[:, 2], longest)


def item_blocks(items: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[Block]:
    """The items in order of id, block by block; the driver holds one partition and one block of them at a time."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    block: list[tuple[int | None, Counter]] = []
    size = 0
    for key, text in rows.orderBy("item_id").toLocalIterator():
        if block and block[-1][0] == key:
            block[-1][1].update(terms_of(text.encode()))
        else:
            if block and size + len(text) > limit:
                yield Block.of(block)
                block, size = [], 0
            block.append((key, Counter(terms_of(text.encode()))))
        size += len(text)
    if block:
        yield Block.of(block)


class Scanner:
    """Counts the terms of a block in texts, straight from their bytes."""

    def __init__(self, terms: list[bytes]):
        import ahocorasick

        self._automaton = ahocorasick.Automaton()
        for n, term in enumerate(terms):
            self._automaton.add_word(f" {term.decode('latin-1')} ", n)
        self._any = bool(terms)
        if terms:
            self._automaton.make_automaton()
        self._width = max(1, len(terms))

    def scan(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms per text; and for each text and term that occurs in it the number of the text, the term and how often."""
        lengths, owners, hits = [], [], []
        for text in texts:
            plain = text.translate(TO_TERMS)
            lengths.append(len(plain.split()))
            if self._any:
                guarded = f" {plain.decode('latin-1')} "
                hits.append(np.fromiter((n for _, n in self._automaton.iter(guarded)), np.int64))
            else:
                hits.append(np.zeros(0, np.int64))
        owners = np.repeat(np.arange(len(lengths)), [len(h) for h in hits])
        both = owners * self._width + (np.concatenate(hits) if hits else np.zeros(0, np.int64))
        pairs, tf = np.unique(both, return_counts=True)
        return np.array(lengths, np.int64), pairs // self._width, pairs % self._width, tf


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    """Whole weights of terms that ``df`` of so many documents have."""
    return np.floor(WEIGHT_UNITS * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def contributions(tf: np.ndarray, length: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """Frequency part of a term's score in documents with ``length`` terms; longer ones than the average get less."""
    m = 25 + (75 * length * documents) // max(1, all_terms)
    return (PART_UNITS * tf) // (1000 * tf + 8 * m)


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self._k, self._least = k, np.ones(items, np.int64)
        self._rows = [np.zeros((4, 0), np.int64)]
        self._pending = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores`` of documents (rows) and items (columns); a score equal to the last of the best may have a lower id."""
        doc, item = np.nonzero(scores >= self._least)
        self._rows.append(np.stack([item, scores[doc, item], null[doc], ids[doc]]))
        self._pending += len(doc)
        if self._pending > 4 * self._k * len(self._least) + 100_000:
            self.rows()

    def rows(self) -> np.ndarray:
        """Columns item, score, whether the document has no id, and its id, without all that is not among the best."""
        rows = np.concatenate(self._rows, axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        begins = np.searchsorted(rows[0], np.arange(len(self._least)))
        rows = rows[:, np.arange(rows.shape[1]) - begins[rows[0]] < self._k]
        counts = np.bincount(rows[0], minlength=len(self._least))
        full = np.flatnonzero(counts == self._k)
        self._least[full] = rows[1, np.searchsorted(rows[0], full, side="right") - 1]
        self._rows, self._pending = [rows], 0
        return rows


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t.as_py() or b"" for t in batch.column("text").cast(pa.large_binary())]


#: Numbers that stand for all documents with terms and for all their terms, beside the numbers of terms.
DOCUMENTS, TERMS = -1, -2


def _statistics(terms: list[bytes]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, df = Scanner(terms), np.zeros(len(terms), np.int64)
        documents = total = 0
        for batch in batches:
            length, _, term, _ = scanner.scan(_texts(batch))
            documents, total = documents + int((length > 0).sum()), total + int(length.sum())
            df += np.bincount(term, minlength=len(terms))
        seen = np.flatnonzero(df)
        columns = [np.append(seen, [DOCUMENTS, TERMS]), np.append(df[seen], [documents, total])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "amount"])

    return run


def _best(block: Block, k: int, documents: int, all_terms: int, df: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, weights, best = Scanner(block.terms), term_weights(documents, df), Best(len(block.ids), k)
        width = len(block.ids)
        fits = float(block.longest) * max(1, int(weights.max(initial=0))) * (PART_UNITS // 1000) < 2.0**53
        step = max(1, CELLS // width)
        for batch in batches:
            texts, keys = _texts(batch), batch.column("doc_id")
            ids, null = keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_null().to_numpy(zero_copy_only=False)
            for at in range(0, len(texts), step):
                length, owner, term, tf = scanner.scan(texts[at : at + step])
                value = weights[term] * contributions(tf, length[owner], documents, all_terms)
                # an output of the automaton for every item that has the term
                many = block.starts[term + 1] - block.starts[term]
                entry = np.arange(many.sum()) + np.repeat(block.starts[term] - np.cumsum(many) + many, many)
                cell = np.repeat(owner, many) * width + block.items[entry]
                points = np.repeat(value, many) * block.times[entry]
                if fits:  # sums of doubles are exact below 2^53
                    scores = np.bincount(cell, points, minlength=len(length) * width).astype(np.int64)
                else:
                    scores = np.zeros(len(length) * width, np.int64)
                    np.add.at(scores, cell, points)
                best.add(scores.reshape(len(length), width), ids[at : at + step], null[at : at + step])
        rows = best.rows()
        arrays = [pa.array(rows[0]), pa.array(rows[3], mask=rows[2].astype(bool)), pa.array(rows[1])]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, limit: int = BLOCK_CHARS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score for every item."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = []
    for block in item_blocks(items, limit):
        counted = texts.mapInArrow(_statistics(block.terms), STATS).groupBy("term").agg(F.sum("amount").alias("amount"))
        amounts = {r["term"]: r["amount"] for r in counted.collect()}  # at most a row per term of the block
        df = np.array([amounts.get(n, 0) for n in range(len(block.terms))], np.int64)
        scan = _best(block, k, amounts.get(DOCUMENTS, 0), amounts.get(TERMS, 0), df)
        first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = texts.mapInArrow(scan, BEST).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), "item bigint, item_id bigint")
        found.append(materialize(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return stack(*found)
