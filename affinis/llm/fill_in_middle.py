"""Fill-in-middle transformation by rank and select on words of eight bytes.

Texts are cut at code points, but UTF-8 is only addressed in bytes. The bytes of
a whole batch are viewed as 64-bit words. Arithmetic on a word marks the bytes
that end a code point (those before a byte that is not ``10xxxxxx``); the number
of marks per word, summed up, says how many code points end before each word.
The n-th code point is found by searching these sums for its word and then, in
the word, by multiplying its marks into running counts and comparing all eight
with the count that is still missing. No text is decoded, and no loop runs over
documents, bytes or code points.

Defined cases: a NULL text is empty and stays plain; a row without ``doc_id``
draws its cuts as if the id were empty; equal rows give equal results; a text
that contains a sentinel stays plain; a very long text is one row like any other
(memory of a task: some five times its batch); an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A sentinel as a pattern, for texts that already contain one.
SENTINEL = "<[PSM]>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
DRAWS = ("h1", "h2", "h3", "h4")
CUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

_HIGH = np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)


class Units:
    """Code points of a buffer that holds the texts between consecutive ``bounds``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        size = len(data)
        words = np.zeros(size // 8 + 1, "<u8")
        words.view(np.uint8)[:size] = data
        goes_on = words & (~words << np.uint64(1))  # in each byte, bit 7 is set and bit 6 is not
        starts = ~goes_on & _HIGH
        starts.view(np.uint8)[bounds] |= 0x80  # a text begins with a code point, whatever its bytes are
        ends = starts >> np.uint64(8)
        ends[:-1] |= starts[1:] << np.uint64(56)
        ends[-1] &= (np.uint64(1) << np.uint64(8 * (size % 8))) - np.uint64(1)  # bytes beyond the buffer
        self._ends = ends
        self._before = np.zeros(len(ends) + 1, np.int64)
        np.cumsum(np.bitwise_count(ends), out=self._before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Code points that end before byte ``place``."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._ends[word] & below)

    def select(self, n: np.ndarray) -> np.ndarray:
        """The byte after the ``n``-th code point; byte 0 if ``n`` is 0."""
        word = np.maximum(np.searchsorted(self._before, n, side="left") - 1, 0)
        missing = (n - self._before[word]).astype(np.uint64)
        counts = (self._ends[word] >> np.uint64(7)) * _ONES
        reached = ((counts | _HIGH) - missing * _ONES) & _HIGH
        byte = np.bitwise_count(~reached & _HIGH)
        return np.where(n > 0, 8 * word + byte + 1, 0)


def draws(doc_id: Column, seed: int | str = 1) -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint").alias(h) for k, h in enumerate(DRAWS)]


def _slices(data: np.ndarray, cuts: np.ndarray) -> list[pa.Array]:
    """Columns of the stretches between neighbouring ``cuts`` of a row, without copying the bytes before they are taken."""
    rows, width = cuts.shape
    offsets = np.append(cuts[:, :-1].reshape(-1), cuts[-1:, -1]).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return [parts.take(pa.array(np.arange(rows) * (width - 1) + k)) for k in range(width - 1)]


def cut_batch(texts: pa.Array, h: list[np.ndarray], plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` for texts and their four draws."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return [pa.array([], t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())]
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    units = Units(data, bounds)
    upto = units.rank(bounds)
    first, n = upto[:-1], np.diff(upto)
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    cuts = np.stack([bounds[:-1], units.select(first + low), units.select(first + high), bounds[1:]], axis=1)
    # 0 units after a text's start is its start, also where the select would stop before empty texts
    cuts[:, 1] = np.where(low > 0, cuts[:, 1], bounds[:-1])
    cuts[:, 2] = np.where(high > 0, cuts[:, 2], bounds[:-1])

    taken = pc.match_substring_regex(texts, SENTINEL).to_numpy(zero_copy_only=False)
    plain = (n == 0) | taken | (h[2] % 100 >= 100 - plain_percent)
    spm = ~plain & (h[3] % 100 < spm_percent)
    form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
    pieces = _slices(data, cuts)
    marks = [pa.scalar(m.encode(), pa.large_binary()) for m in (PREFIX, SUFFIX, MIDDLE)]
    nothing = pa.scalar(b"", pa.large_binary())
    joined = [
        pc.binary_join_element_wise(
            *[x for p in order for x in (marks[p], pieces[(0, 2, 1)[p]].filter(pa.array(rows)))], nothing
        )
        for order, rows in (((0, 1, 2), ~plain & ~spm), ((1, 0, 2), spm))
    ]
    whole = texts.cast(pa.large_binary()).filter(pa.array(plain))
    # rows of the three forms, back in the order of the batch
    where = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain & ~spm), np.flatnonzero(spm)])
    output = pa.concat_arrays([whole, *joined]).take(pa.array(np.argsort(where, kind="stable")))
    return [
        pa.array(n),
        pa.array(form.tolist(), pa.string()),
        pa.array(low, mask=plain),
        pa.array(high - low, mask=plain),
        output.cast(pa.binary()).cast(pa.string()),
    ]


def _cut(plain_percent: int, spm_percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in DRAWS]
            columns = cut_batch(batch.column("text"), h, plain_percent, spm_percent)
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return run


def fill_in_middle(docs: DataFrame, seed: int | str = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    A text of ``n`` code points is cut at two drawn places. ``psm`` puts prefix,
    suffix and middle in this order, each after its sentinel, ``spm`` puts the
    suffix first; ``plain`` is the text as it is, for ``plain_percent`` of the
    documents, for empty texts and for those that contain a sentinel.
    """
    key = F.col("doc_id").cast("bigint").alias("doc_id")
    drawn = docs.select(key, "text", *draws(F.col("doc_id"), seed))
    return drawn.mapInArrow(_cut(plain_percent, spm_percent), CUT)


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of; texts with sentinels are plain, so a split is unambiguous."""
    part = F.split(output, SENTINEL, -1)
    return (
        F.when(form == PSM, F.concat(part[1], part[3], part[2]))
        .when(form == SPM, F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
