import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinis.llm import fill_in_middle as fim
from affinis.llm import line_dedup, queries, term_search
from tests.llm.conftest import ODD

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lines -------------------------------------------------------------------------------------


def brute_lines(rows, min_docs, keep_first=False):
    """``(doc_id, n_lines, n_dropped, text)`` of every row, from the definition."""
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    docs, first = {}, {}
    signed = {}
    for doc_id, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            docs.setdefault(key(line), set()).add(doc_id)
            signed.setdefault(key(line), []).append((doc_id, text, pos))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for pos, line in enumerate(lines):
            shared = key(line) != "" and len(docs[key(line)]) >= min_docs
            if shared and keep_first:  # the first by id, then by text, then by position
                first.setdefault(key(line), min(signed[key(line)], key=lambda r: (r[0] is not None, r[0] or 0, r[2])))
                shared = (doc_id, text, pos) != first[key(line)]
            if not shared:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def dedup(docs, **options):
    got = line_dedup.without_lines(docs, line_dedup.line_bitmaps(docs, **options)).collect()
    return sorted(map(tuple, got), key=str)


def line_corpus(seed, n_docs=120, n_lines=40):
    """One line that most documents have, some that several have, and lines in odd cases and blanks."""
    rng = random.Random(seed)
    pool = [f"line number {i}" for i in range(n_lines)]
    rows = []
    for d in range(n_docs):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 6))] + [f"only in {d}"]
        if rng.random() < 0.7:
            lines.insert(rng.randint(0, len(lines)), rng.choice(["Most HAVE this", " \tmost have this\r", "most have this"]))
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("n", [1, 3, 16])
def test_lines_equal_brute_force_over_any_ranges(documents, partitions, n):
    partitions(n)
    rows = line_corpus(n) + [(r[0], r[1]) for r in ODD] + [(200, "most have this"), (200, "most have this"), (None, "most have this")]
    for options in ({"min_docs": 10}, {"min_docs": 2}, {"min_docs": 1}):
        assert dedup(documents(rows), **options) == sorted(brute_lines(rows, **options), key=str)


@pytest.mark.parametrize("n", [1, 16])
def test_first_occurrences_stay(documents, partitions, n):
    partitions(n)
    rows = line_corpus(5) + [(150, "only in 150\nonly in 150\nlast"), (None, "most have this")]
    for min_docs in (1, 2, 10):
        want = brute_lines(rows, min_docs, keep_first=True)
        assert dedup(documents(rows), min_docs=min_docs, keep_first=True) == sorted(want, key=str)


def test_equal_rows_keep_the_same_lines(documents, partitions):
    partitions(8)
    rows = [(7, "a line\nanother\na line")] * 500
    assert set(dedup(documents(rows), min_docs=1, keep_first=True)) == {(7, 3, 1, "a line\nanother")}
    assert set(dedup(documents(rows), min_docs=2)) == {(7, 3, 0, "a line\nanother\na line")}


def test_runs_over_batches_and_ranges_are_settled_together():
    """The stream of one range, cut into batches anywhere, says the same."""
    rows = sorted((h, h, d, 0, p) for h, docs in ((1, 3), (2, 30), (3, 1), (4, 12)) for d in range(docs) for p in range(2))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 4 + (pa.int32(),))]
    table = pa.RecordBatch.from_arrays([*columns, pa.array([9] * len(rows), pa.int32())], names=[*line_dedup.ORDER, "n_lines"])
    whole = None
    for size in (1000, 1, 3, 7):
        batches = [table.slice(a, size) for a in range(0, len(rows), size)]
        out = pa.Table.from_batches(list(line_dedup.stream_ranges(10, False)(iter(batches)))).to_pylist()
        dropped = sorted((r["h1"], r["doc_id"], r["pos"]) for r in out if r["kind"] == line_dedup.DROP)
        opened = sorted((r["h1"], r["doc_id"], r["pos"]) for r in out if r["kind"] == line_dedup.OPEN)
        edges = [(r["h1"], r["docs"], r["doc_id"], r["last_doc"]) for r in out if r["kind"] == line_dedup.EDGE]
        whole = whole or (dropped, opened, edges)
        assert (dropped, opened, edges) == whole
        assert edges == [(1, 3, 0, 2), (4, 12, 0, 11)]
        assert len(opened) == 6 and {h for h, _, _ in dropped} == {2, 4}


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 1000, 100_000):
        gone = np.flatnonzero(rng.random(n) < 0.3)
        keep = line_dedup.packed(gone, n)
        assert line_dedup.unpacked(keep, n).tolist() == [i not in set(gone.tolist()) for i in range(n)]
    assert len(line_dedup.packed(np.arange(100_000), 100_000)) < 200


def test_a_very_long_text_among_short_ones(documents):
    rows = [(d, "shared line\n" + f"own {d}") for d in range(10)] + [(10, "\n".join(["shared line", "x"] * 60_000))]
    got = dict((r[0], r) for r in dedup(documents(rows), min_docs=10))
    assert got[10][1:3] == (120_000, 60_000) and got[10][3] == "\n".join(["x"] * 60_000)
    assert got[3] == (3, 2, 1, "own 3")


# --- search ------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_search(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in asked.items():
        scored = []
        for d, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            score = 0
            for t, times in query.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, n, d, -s) for n, (s, _, _, d) in enumerate(sorted(scored, key=lambda r: r[:3])[:k], 1)]
    return sorted(out, key=str)


def search_corpus(seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma9", "ÄRGER", "ärger", "中文", "the", "THE", "x", "alphabet", "é"]
    docs = [(d, "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "_"]) for _ in range(rng.randint(0, 30)))) for d in range(80)]
    items = [(i, " ".join(rng.choice(words + ["absent"]) for _ in range(rng.randint(0, 6)))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("limit", [1, 40, term_search.BLOCK_CHARS])
def test_search_equals_brute_force_in_any_blocks(spark, documents, limit):
    docs, items = search_corpus(limit % 7)
    docs += [(r[0], r[1]) for r in ODD] + [(3, "alpha beta"), (3, "alpha beta"), (None, "alpha beta")]
    items += [(None, "alpha"), (None, "beta x"), (5, "alpha again"), (20, None), (21, ""), (22, "absent")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING").selectExpr("*", "1 AS score", "2 AS rank", "'a' AS term")
    got = term_search.rank_documents(documents(docs), bench, limit=limit).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == brute_search(docs, items)


def test_best_keeps_ties_by_id_when_it_is_cut_often(monkeypatch):
    rng = np.random.default_rng(2)
    best, rows = term_search.Best(3, 4), []
    for at in range(0, 3000, 100):
        scores, ids = rng.integers(0, 6, (100, 3)), rng.permutation(10_000)[:100]
        best.add(scores, ids, np.zeros(100, np.int64))
        best.rows()
        rows += [(item, -int(s[item]), int(d)) for s, d in zip(scores, ids) for item in range(3) if s[item]]
    want = [r for item in range(3) for r in sorted(x for x in rows if x[0] == item)[:4]]
    assert [(int(i), -int(s), int(d)) for i, s, _, d in best.rows().T] == want


def test_large_scores_are_exact(spark, documents, monkeypatch):
    """Beyond 2^53 doubles would lose units; whole numbers are summed then."""
    docs, items = search_corpus(3)
    items = [(0, " ".join(t for _, t in items for t in [t] * 40_000))]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = term_search.rank_documents(documents(docs), bench).select("item_id", "rank", "doc_id", "score").collect()
    want = brute_search(docs, items)
    assert sorted(map(tuple, got), key=str) == want and want[0][3] > 0


def test_search_of_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "alpha")], "item_id BIGINT, text STRING")
    assert term_search.rank_documents(documents([]), bench).count() == 0
    assert term_search.rank_documents(documents([(1, "alpha")]), bench.limit(0)).count() == 0


# --- fill in the middle ------------------------------------------------------------------------


def brute_middle(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, n, form, a, b - a, s + p + m if form == "spm" else p + s + m


def middle_texts(seed=4, n=400):
    rng = random.Random(seed)
    letters = ["a", "b", "<", ">", "P", "S", "M", " ", "\n", "é", "߿", "中", "￿", "\U0001f600", "é", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 9, 40, 200]))) for _ in range(n)]
    return [(d, t) for d, t in enumerate(texts + ["x<P>y", "<S>", "a<M", "<<P", "\U0001f600" * 9])]


def test_middle_equals_brute_force_and_is_restored(documents, partitions):
    partitions(3)
    rows = middle_texts() + [(r[0], r[1]) for r in ODD] + [(900, "é" * 300_000 + "a" * 200_001), (-5, "negative id")]
    cut = fim.fill_in_middle(documents(rows)).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = cut.collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((brute_middle(*r) for r in rows), key=str)
    assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(d), t or "") for d, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(documents([])).count() == 0


def test_rank_and_select_at_every_byte():
    texts = ["", "a", "é", "", "中文字", "\U0001f600" * 5, "abcdefgh", "", "x" * 17 + "é" * 3, ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(t.encode()) for t in texts])
    units = fim.Units(data, bounds)
    ends = [i + 1 for i in range(len(data)) if i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80]
    places = np.arange(len(data) + 1)
    assert units.rank(places).tolist() == [sum(e <= p for e in ends) for p in places]
    assert units.select(np.arange(len(ends) + 1)).tolist() == [0, *ends]


def test_middle_of_slices_and_of_bytes_that_are_no_text():
    h = [np.array([3, 5, 7], np.int64)] * 4
    texts = pa.array(["skipped", "abc", None, "déf"]).slice(1)
    whole = fim.cut_batch(texts, h, 0, 0)
    assert [c.to_pylist() for c in whole][0] == [3, 0, 3]
    odd = np.frombuffer(b"\x80\x80a\xff\x80", np.uint8)
    assert fim.Units(odd, np.array([0, 1, 5])).rank(np.array([0, 1, 5])).tolist() == [0, 1, 4]


# --- registered queries ------------------------------------------------------------------------


def test_registered_queries_give_their_digests(spark, documents, tmp_path):
    rows = line_corpus(9, 60) + [(300, None), (301, "")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(i, t) for i, t in rows[:5]]
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    lines = queries.op11_line_dedup(spark, str(tmp_path)).collect()
    want = [(d, n, k, sha(t)) for d, n, k, t in brute_lines(rows, 10)]
    assert sorted(map(tuple, lines)) == sorted(want)
    found = queries.op12_term_search(spark, str(tmp_path)).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, found), key=str) == brute_search(rows, items)
    middle = queries.op13_fill_in_middle(spark, str(tmp_path)).collect()
    want = {d: (*brute_middle(d, t)[:5], sha(brute_middle(d, t)[5]), sha(t or "")) for d, t in rows}
    assert {r.doc_id: tuple(r) for r in middle} == want
