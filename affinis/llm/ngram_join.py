"""Near duplicates by an exact similarity join on word shingles: universe partition and pigeonhole.

Two sets that reach the similarity differ in at most H elements. The hash range
of shingles is cut into segments; if the units of all segments add up to H + 1,
a segment of one unit is equal in both sets, or one of two units is equal but
for one element. So sets that share no segment subset, nor a subset with one
element deleted, need not be compared.

* Sets are put in bands of sizes; a set looks into its own band and the one
  below. Each band has its own H, number of segments and units per segment.
* Allocation by cost: per band, one unit (exact subsets) or two (with all
  one-deletion neighbours) is chosen by the expected number of signatures and of
  crowded keys. Some units more than needed let each set leave out its emptiest
  segments, whose keys would be shared by unrelated sets; those beyond the
  allowance are kept, so no link is lost.
* Signatures travel packed, one row per block of documents and partition.
* Copies (equal sets) are one node of the graph. In each group of nodes with a
  common key all are compared with the smallest one; pairs that are then still
  in different components are compared in a second round. Together this finds
  every component, and members of one component are not compared again.
* Before texts are fetched, profiles decide: how many elements a set has in each
  part of the hash range. Sets differ in at least as many elements as their
  profiles do, so most pairs that share a passage only end here.
* Comparison is exact on the sets of 64-bit shingle hashes.

Defined cases: a text that is NULL or without words has an empty set and is
linked with nothing; with fewer words than a shingle the whole sequence is the
one element; rows with equal text are linked whatever their ids; a row without
``doc_id`` can link others and has their component; a very long text is a set of
eight bytes a shingle while it is compared, and the layout is found in steps that
do not grow with its length; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil, exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.blocks import PACKED, document_blocks, mixed, packed_rows, part_keys, unpacked
from affinis.llm.common import partitions, whole_row
from affinis.llm.components import components
from affinis.operators.pairs import spread
from affinis.session import materialize, release_shuffles, stack

WORDS = 5
#: Weight of an expected crowded key against a signature, when a band is laid out.
CROWDED = 200.0
BLOCK_DOCS = 30_000
#: Members of a key that are compared in one go; a larger group is cut into pairs of blocks.
GROUP = 2048
#: Keys of a node that are sent along so that a pair comes out about once.
SKETCH = 8
CLASSES = "doc_id bigint, n_shingles bigint, node bigint, profile binary"
PAIRS = "a bigint, b bigint"
ODD = np.uint64(0x9E3779B97F4A7C15)
BAND, SEGMENT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


@dataclass(frozen=True)
class Band:
    """Sizes ``low`` to ``high``; ``segments`` of ``1 + deletions`` units each, of which a set may leave out ``spare``."""

    low: int
    high: int
    segments: int
    deletions: int
    spare: int


def most_apart(high: int) -> int:
    """The most elements in which a set of at most ``high`` elements and one not smaller can differ at similarity 0.8."""
    total = high + high * 5 // 4
    return max(n - 2 * -(-4 * n // 9) for n in range(max(2, total - 9), total + 1))


def _expected_excess(mean: float, allowed: int) -> float:
    """Mean of what a Poisson variable has beyond ``allowed``: its upper tail, or with the lower tail where that is shorter."""
    if not mean:
        return 0.0
    up = allowed >= mean
    j, excess = (allowed + 1, 0.0) if up else (allowed - 1, mean - allowed)
    term = exp(j * log(mean) - mean - lgamma(j + 1)) if j >= 0 else 0.0
    while j >= 0 and abs(j - allowed) * term > 1e-12:
        excess += abs(j - allowed) * term
        term, j = (term * mean / (j + 1), j + 1) if up else (term * j / mean, j - 1)
    return excess


def _cheapest(low: int, high: int, deletions: int) -> tuple[float, Band]:
    """The layout of a band with the cheapest ``spare``: some 500 of them, then those around the best."""
    apart = most_apart(high)

    def layout(spare: int) -> tuple[float, int, int]:
        segments = ceil((apart + 1 + 2 * spare * (1 + deletions)) / (1 + deletions))
        load = (low + high) / 2 / segments
        bad = exp(-load) * (1 + load * deletions)
        cost = segments + deletions * (low + high) / 2 + CROWDED * _expected_excess(segments * bad, spare)
        return cost, spare, segments

    end = 4 + high // 8
    step = max(1, end // 500)
    _, near, _ = min(map(layout, range(0, end, step)))
    cost, spare, segments = min(map(layout, range(max(0, near - step), min(end, near + step + 1))))
    return cost, Band(low, high, segments if apart else 0, deletions, spare)


def bands(largest: int) -> list[Band]:
    """Bands of ratio 5/4, so that a partner at similarity 0.8 is in the same or the next one."""
    out, low = [], 1
    while low <= largest:
        high = low * 5 // 4
        out.append(min((_cheapest(low, high, deletions) for deletions in (0, 1)), key=lambda found: found[0])[1])
        low = high + 1
    return out


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    known: dict[bytes, int] = {}
    powers = [np.uint64(pow(0x2545F4914F6CDD1D, j + 1, 1 << 64)) for j in range(WORDS)]
    for text in texts:
        words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks only
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(h)
        if n == 0:
            yield h
        elif n < WORDS:
            whole = sum((h[j : j + 1] * powers[j] for j in range(n)), np.full(1, n, np.uint64))
            yield mixed(whole * ODD)
        else:
            rolled = h[: n - WORDS + 1] * powers[0]
            for j in range(1, WORDS):
                rolled += h[j : n - WORDS + 1 + j] * powers[j]
            yield np.unique(mixed(rolled))


def node_of(shingles: np.ndarray) -> int:
    """The name of a set: equal sets have equal names."""
    total = mixed(shingles ^ BAND).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))
    return int(mixed(total).view(np.int64)[0])


def profile_of(shingles: np.ndarray) -> bytes:
    """Number of elements, up to 255, in each of 2^p equal parts of the hash range, one to two a part on average."""
    bits = max(0, len(shingles).bit_length() - 1)
    if not bits:
        return bytes([min(len(shingles), 255)])
    parts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(parts, 255).astype(np.uint8).tobytes()


def folded(profile: bytes, width: int) -> np.ndarray:
    """A profile with ``width`` parts."""
    parts = np.frombuffer(profile, np.uint8).astype(np.int32)
    return parts.reshape(width, -1).sum(axis=1)


def allowed(total):
    """The most elements in which two sets of ``total`` elements together can differ at similarity 0.8."""
    return total + 2 * (-4 * total // 9)


def signatures(shingles: np.ndarray, number: int, band: Band) -> np.ndarray:
    """The keys of a set in the layout of a band."""
    m = band.segments
    segment = ((shingles >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    sizes = np.bincount(segment.astype(np.int64), minlength=m)
    names = mixed(shingles)
    ends = np.cumsum(sizes)
    totals = np.append(np.uint64(0), np.cumsum(names, dtype=np.uint64))
    sums = totals[ends] - totals[ends - sizes]
    salt = np.arange(m, dtype=np.uint64) * SEGMENT + np.full(m, number, np.uint64) * BAND
    keep = np.ones(m, bool)
    if band.spare:
        emptiest = np.argsort(sizes, kind="stable")[: band.spare]
        keep[emptiest[sizes[emptiest] < 2]] = False
    keys = (sums + salt)[keep]
    if band.deletions:
        inside = segment.astype(np.int64)
        used = keep[inside]
        keys = np.append(keys, (sums[inside] - names + salt[inside])[used])
    return mixed(keys)


def _classes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, ids, texts in document_blocks(batches, docs=BLOCK_DOCS):
        sizes, nodes, profiles = zip(*((len(s), node_of(s), profile_of(s)) for s in shingle_sets(texts)))
        arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(profiles, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "node", "profile"])


def _signatures(parts: list[int], layout: list[Band]):
    lows = [b.low for b in layout]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in document_blocks(batches, docs=BLOCK_DOCS):
            nodes: dict[int, int] = {}
            keys, owners = [], []
            for s in shingle_sets(texts):
                node = node_of(s) if len(s) else None
                if node is None or node in nodes:
                    continue
                i = nodes[node] = len(nodes)
                own = int(np.searchsorted(lows, len(s), side="right")) - 1
                for b in (own, own - 1):
                    if b >= 0 and layout[b].segments:
                        got = signatures(s, b, layout[b])
                        keys.append(got)
                        owners.append(np.full(len(got), i | (b == own) << 15, np.uint16))
            if not keys:
                continue
            key, owner = np.concatenate(keys), np.concatenate(owners)
            yield packed_rows(parts, np.array(list(nodes), np.int64), key, owner)

    return run


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each key that two nodes or more have: the smallest node of the key's own band with each other node."""
    held: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            held.setdefault(r["part"], []).append((r["nodes"], r["keys"], r["owners"]))
    for part, rows in held.items():
        key, node, own = unpacked(rows)
        order = np.lexsort((node, ~own, key))
        key, node, own = key[order], node[order], own[order]
        first = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
        key, node, own = key[first], node[first], own[first]
        start = np.append(True, key[1:] != key[:-1])[: len(key)]
        head = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0)) if len(key) else start
        use = ~start & own[head] & (node != node[head]) if len(key) else start
        arrays = [
            pa.array((np.int64(part) << 32 | key[use].astype(np.int64))),
            pa.array(node[head][use]),
            pa.array(node[use]),
            pa.array(own[use]),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "head", "node", "own"])


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose profiles leave a link possible."""
    for batch in batches:
        keep = []
        for p, q, m, n in zip(*(batch.column(c).to_pylist() for c in ("profile_a", "profile_b", "n_a", "n_b"))):
            width = min(len(p), len(q))
            keep.append(np.abs(folded(p, width) - folded(q, width)).sum() <= allowed(m + n))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _apart(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a key in different components whose profiles leave a link possible.

    Rows come in order of key and block pair; one such group is held at a time.
    Each row has the smallest keys of its node; if two nodes share one of these,
    the pair comes out at the smallest such key only, otherwise at every key.
    """

    def is_place(key: int, mine: np.ndarray, keys: np.ndarray) -> bool:
        shared, i, j = np.intersect1d(mine >> 1, keys >> 1, assume_unique=True, return_indices=True)
        shared = shared[((mine[i] | keys[j]) & 1) == 1]
        return not len(shared) or shared[0] == key

    def pairs(key: int, rows: list[tuple]) -> pa.RecordBatch:
        node, root, own, block, size, profile, keys = (list(c) for c in zip(*rows))
        node, root, own, block, size = (np.array(c) for c in (node, root, own, block, size))
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if (root != root[0]).any():
            width = min(map(len, profile))
            parts = np.stack([folded(p, width) for p in profile]).astype(np.int16)
            inner = (block == block[0]).all()
            for i in range(len(node) - 1):
                use = (root[i + 1 :] != root[i]) & (own[i] | own[i + 1 :])
                if not inner:
                    use &= block[i + 1 :] != block[i]
                use &= np.abs(size[i + 1 :] - size[i]) <= allowed(size[i + 1 :] + size[i])
                at = np.flatnonzero(use) + i + 1
                if len(at):
                    at = at[np.abs(parts[at] - parts[i]).sum(axis=1, dtype=np.int32) <= allowed(size[at] + size[i])]
                    at = np.array([j for j in at if is_place(key, keys[i], keys[j])], np.int64)
                    a.append(np.minimum(node[at], node[i]))
                    b.append(np.maximum(node[at], node[i]))
        arrays = [pa.array(np.concatenate(c), pa.int64()) for c in (a, b)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    current, rows = None, []
    for batch in batches:
        columns = ("key", "_low", "_high", "node", "root", "own", "_block", "n")
        profiles, lists = batch.column("profile"), batch.column("keys")
        for i, (key, low, high, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in columns))):
            if (key, low, high) != current:
                if len(rows) > 1:
                    yield pairs(current[0], rows)
                current, rows = (key, low, high), []
            rows.append((*row, profiles[i].as_py(), np.array(lists[i].values, np.int64)))
    if len(rows) > 1:
        yield pairs(current[0], rows)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the node's set (ids may be repeated)."""
    for batch in batches:
        texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.large_binary())]
        right = [node_of(s) == v for s, v in zip(shingle_sets(texts), batch.column("node").to_pylist())]
        yield batch.select(["node", "text"]).filter(pa.array(right, pa.bool_()))


def _similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose shared elements are at least 80 % of all."""
    last: tuple[int | None, np.ndarray] = None, np.empty(0, np.uint64)
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        text_a, text_b = (batch.column(c).cast(pa.large_binary()) for c in ("text_a", "text_b"))
        keep = []
        for i in range(len(a)):
            if a[i] != last[0]:
                last = a[i], next(shingle_sets([text_a[i].as_py()]))
            left, right = last[1], next(shingle_sets([text_b[i].as_py()]))
            shared = 0
            if 100 * min(len(left), len(right)) >= 80 * max(len(left), len(right)):
                shared = len(np.intersect1d(left, right, assume_unique=True))
            keep.append(100 * shared >= 80 * (len(left) + len(right) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def similarity_classes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    classes = materialize(texts.mapInArrow(_classes, CLASSES), "classes")
    largest = classes.agg(F.max("n_shingles")).first()[0] or 0

    keyed = texts.mapInArrow(_signatures(part_keys(spark, n), bands(largest)), PACKED).repartition(n, "part")
    stars = materialize(keyed.mapInArrow(_stars, "key bigint, head bigint, node bigint, own boolean"), "stars")
    profiles = classes.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("profile").alias("profile"))
    profiles = materialize(profiles, "profiles")
    release_shuffles(spark)

    def near(pairs: DataFrame) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(profiles.select(*[F.col(c).alias(f"{c}_{x}") for c in ("n", "profile")], F.col("node").alias(x)), x)
        return pairs.mapInArrow(_near, PAIRS)

    def similar(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs, "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ids = classes.select("node", "doc_id").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("id"))
        known = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).select("node", "text")
        known = materialize(known.mapInArrow(_texts, "node bigint, text string").dropDuplicates(["node"]), "texts")
        for x in "ab":
            pairs = pairs.join(known.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")), x)
        return materialize(pairs.mapInArrow(_similar, PAIRS), "similar")

    links = similar(near(stars.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()))
    roots = components(links)
    release_shuffles(spark)

    # second round: members of a key that the first round left in different components
    def rooted(rows: DataFrame, column: str, name: str) -> DataFrame:
        at = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        joined = rows.join(at, F.col(column) == F.col("_node"), "left")
        return joined.withColumn(name, F.coalesce("_root", column)).drop("_node", "_root")

    marked = materialize(rooted(rooted(stars, "head", "head_root"), "node", "root"), "marked")
    # the head has met all members; keys with two other components or more are still open
    others = marked.groupBy("key").agg((F.min("root") != F.max("root")).alias("several"))
    members = marked.join(others.where("several").select("key"), "key", "left_semi").select("key", "node", "root", "own")
    members = materialize(members, "open")
    release_shuffles(spark)
    code = F.col("key") * 2 + F.col("own").cast("bigint")
    keys = members.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(code)), 1, SKETCH).alias("keys"))
    # dealt into blocks while rows are narrow: profiles join them after that, and are shuffled once with them
    members = spread(members, ["key"], "node", GROUP).join(profiles, "node").join(keys, "node")
    members = members.repartition(n, "key", "_low", "_high").sortWithinPartitions("key", "_low", "_high")
    more = similar(members.mapInArrow(_apart, PAIRS).distinct())
    release_shuffles(spark)
    if not more.isEmpty():
        roots = components(stack(links, more))

    placed = classes.where("n_shingles > 0").select("node", "doc_id")
    placed = rooted(placed, "node", "root")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("least"))
    of_root = rooted(classes.select("doc_id", "n_shingles", "node"), "node", "root").join(least, "root", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return of_root.select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents of ``docs`` without those that a document with a smaller id stands for."""
    found = similarity_classes(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = materialize(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "kept")
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("id"))

    def met(which: str) -> DataFrame:
        ids = kept.where(which).select(F.col("doc_id").alias("wanted"))
        return rows.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("row.*")

    return stack(met("n = 1"), met("n > 1").dropDuplicates(["doc_id", "text"]))
