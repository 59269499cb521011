"""Token counts of a byte-level BPE vocabulary: pieces are counted once per distinct pre-token.

1. Blocks of documents are cut into pre-tokens. A block ships, to the partition
   of each pre-token, the pre-token with its postings: the documents of the
   block that hold it, and how often.
2. A partition counts the pieces of each distinct pre-token once, joins the
   counts to the postings and adds up per document of each block.
3. The partial sums of a block meet and become one row per document.

Token ids are never materialised. A pre-token that more than one in eight
documents of a block hold is dealt over all partitions by block, so that none
of them takes all postings of a very common word; its pieces are counted once
per partition it reaches.

Defined cases: a NULL text is empty; a string of an added special token inside
a text counts as the library does by default, as one token; equal rows, repeated
and NULL ids give one row each; an empty table gives no rows; columns other than
``doc_id`` and ``text`` are not looked at. The input has to be a table that can
be read again in the same order (block numbers come from its partitions).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.blocks import binaries, document_blocks
from affinis.llm.common import partitions

# The pre-token pattern of byte-level BPE, and the same with its classes written out for U+0000 to U+024F.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t\n\x0b\x0c\r\x85\xa0"
LATIN = rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

POSTINGS = "part int, block bigint, tokens array<string>, sizes binary, docs binary, counts binary, ids array<bigint>, n_bytes array<bigint>"
SUMS = "block bigint, docs binary, sums binary, ids array<bigint>, n_bytes array<bigint>"
COMMON = 8


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pre_tokenizer(path: str):
    """Function from a text to its pre-tokens; strings of added tokens come out as themselves."""
    any_text, latin, beyond = regex.compile(PRE_TOKEN), re.compile(LATIN), re.compile(r"[^\x00-ɏ]")
    added = sorted((t.content for t in _tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def plain(text: str) -> list[str]:
        return (any_text if beyond.search(text) else latin).findall(text)

    def pre_tokens(text: str) -> list[str]:
        if special is None or not special.search(text):
            return plain(text)
        out: list[str] = []
        for i, part in enumerate(special.split(text)):
            out.extend([part] if i % 2 else plain(part))
        return out

    return pre_tokens


def _postings(path: str, parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre_tokens = pre_tokenizer(path)
        schema = None
        for block, ids, texts in document_blocks(batches):
            index: dict[str, int] = {}
            pieces, lengths = [], []
            for data in texts:
                tokens = pre_tokens(data.decode("utf-8", "replace"))
                for token in tokens:
                    if token not in index:
                        index[token] = len(index)
                pieces.append(np.fromiter(map(index.__getitem__, tokens), np.int32, len(tokens)))
                lengths.append(len(tokens))
            n = len(ids)
            keys = np.concatenate(pieces).astype(np.int64) * n + np.repeat(np.arange(n), lengths)
            keys, counts = np.unique(keys, return_counts=True)
            token, doc = np.divmod(keys, n)
            names = np.array(list(index), dtype=object)
            part = np.fromiter((crc32(t.encode()) for t in index), np.int64, len(index)) % parts
            common = np.bincount(token, minlength=len(index)) * COMMON > n
            part[common] = (part[common] + block) % parts
            # counts above one byte become several postings of the same document
            times = (counts + 254) // 255
            if (times > 1).any():
                last = np.cumsum(times) - 1
                token, doc = np.repeat(token, times), np.repeat(doc, times)
                rest = counts - 255 * (times - 1)
                counts = np.full(len(token), 255)
                counts[last] = rest
            order = np.argsort(part[token], kind="stable")
            token, doc, counts = token[order], doc[order], counts[order]
            by_part = np.argsort(part, kind="stable")
            sizes = np.bincount(token, minlength=len(index))[by_part]
            used = np.unique(part)
            cut = np.append(np.searchsorted(part[by_part], used), len(by_part))
            ends = np.append(0, np.cumsum(sizes))[cut]
            k = len(used)
            table = {
                "part": pa.array(np.append(used, block % parts), pa.int32()),
                "block": pa.array(np.full(k + 1, block), pa.int64()),
                "tokens": pa.array([*(names[by_part[a:b]].tolist() for a, b in zip(cut, cut[1:])), None], pa.list_(pa.string())),
                "sizes": pa.array([*binaries(sizes.astype(np.uint32), cut).to_pylist(), None], pa.binary()),
                "docs": pa.array([*binaries(doc.astype(np.uint16), ends).to_pylist(), None], pa.binary()),
                "counts": pa.array([*binaries(counts.astype(np.uint8), ends).to_pylist(), None], pa.binary()),
                "ids": pa.array([None] * k + [ids], pa.list_(pa.int64())),
                "n_bytes": pa.array([None] * k + [[len(x) for x in texts]], pa.list_(pa.int64())),
            }
            schema = schema or pa.schema([(c, a.type) for c, a in table.items()])
            yield pa.RecordBatch.from_arrays(list(table.values()), schema=schema)

    return run


def _sums(path: str):
    flush_at = 8_000_000

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        known = {t.content: 1 for t in tokenizer.get_added_tokens_decoder().values()}
        held: dict[int, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for block, sums in held.items():
                docs = np.flatnonzero(sums)
                yield row(block, docs.astype(np.uint16).tobytes(), sums[docs].astype(np.uint32).tobytes(), None, None)
            held.clear()

        def row(block, docs, sums, ids, n_bytes) -> pa.RecordBatch:
            arrays = [
                pa.array([block], pa.int64()),
                pa.array([docs], pa.binary()),
                pa.array([sums], pa.binary()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([n_bytes], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["block", "docs", "sums", "ids", "n_bytes"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["ids"] is not None:
                    yield row(r["block"], None, None, r["ids"], r["n_bytes"])
                    continue
                tokens = r["tokens"]
                new = [t for t in tokens if t not in known]
                if new:
                    known.update(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False))))
                pieces = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
                weights = np.repeat(pieces, np.frombuffer(r["sizes"], np.uint32)) * np.frombuffer(r["counts"], np.uint8)
                got = np.bincount(np.frombuffer(r["docs"], np.uint16), weights).astype(np.int64)
                before = held.get(r["block"])
                if before is None:
                    held[r["block"]] = got
                else:
                    if len(before) < len(got):
                        before, got = got, before
                    before[: len(got)] += got
                    held[r["block"]] = before
                if sum(map(len, held.values())) > flush_at:
                    yield from flush()
        yield from flush()

    return run


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    rows: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            if r["ids"] is not None:
                rows[r["block"]] = r["ids"], r["n_bytes"]
            else:
                total = totals.setdefault(r["block"], np.zeros(1 << 16, np.int64))
                np.add.at(total, np.frombuffer(r["docs"], np.uint16), np.frombuffer(r["sums"], np.uint32).astype(np.int64))
    for block, (ids, n_bytes) in rows.items():
        n_tokens = totals.get(block, np.zeros(len(ids), np.int64))[: len(ids)]
        arrays = [pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_tokens`` with the tokenizer file at ``path``."""
    n = partitions(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    postings = texts.mapInArrow(_postings(path, 4 * n), POSTINGS).repartition(n, "part")
    sums = postings.mapInArrow(_sums(path), SUMS).repartition(n, "block")
    return sums.mapInArrow(_documents, "doc_id bigint, n_bytes bigint, n_tokens bigint")
