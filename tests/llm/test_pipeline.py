import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from affinis.llm import decontamination, mixing, pii
from affinis.llm.oracles import MIX
from tests.llm.conftest import ODD

SYLLABLES = {
    "de": "der die und ich nicht mit auf werden schon zwischen".split(),
    "fr": "le la que nous avec pour dans être toujours maison".split(),
    "en": "the and with that which through would there people".split(),
}
ITEM = "a question of the benchmark about the number of people there"


def prose(rng, lang, n):
    words = SYLLABLES[lang]
    return " ".join(rng.choice(words) + rng.choice(["", "", rng.choice(words)]) for _ in range(n))


def corpus(seed=1, size=60):
    rng = random.Random(seed)
    rows = []
    for d in range(size):
        lang = rng.choice(list(SYLLABLES))
        rows.append((d, prose(rng, lang, rng.randint(30, 80)), lang, rng.choice(["a", "b", None])))
    rows += [(100 + d, rows[d][1], rows[d][2], "a") for d in range(0, size, 10)]  # exact copies
    rows += [(200 + d, rows[d][1] + " once", rows[d][2], "b") for d in range(5, size, 10)]  # near copies
    rows += [(300, f"{rows[1][1]} {ITEM} {rows[2][1]}", "en", "a"), (301, f"{rows[3][1]} " + ITEM.replace("number", "numbre"), "en", "a")]
    rows += [(302, f"{prose(rng, 'en', 40)} write to jane.roe@example.org", "en", "b"), (303, "12 34 !!", "en", "a")]
    rows += [(304, "12 34 !!", "en", "a"), (305, None, None, None), (306, "", "en", "b")]
    return rows


def shingles(text):
    words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each(rows):
    """The smallest id of each class of linked documents, by comparing all."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [r for i, r in enumerate(rows) if r[0] == least[find(i)]]


def redacted(text):
    spans = sorted((a, -b, kind) for kind, a, b, _ in pii.finder()(text))
    for a, b, kind in reversed(spans):
        text = text[:a] + f"<{kind}>" + text[-b:]
    return text


def mixed(rows):
    """``(doc_id, copies)`` by the SQL of the mix."""
    import pandas as pd

    db = duckdb.connect()
    db.register("documents", pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"]))
    return {d: taken // size for d, size, _, _, taken in db.execute(MIX).fetchall() if size and taken}


def written(spark, documents, path, rows, items=((0, ITEM),)):
    documents(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(items), "item_id BIGINT, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run_equals_brute_force(spark, documents, tmp_path):
    rows = corpus()
    folder = written(spark, documents, tmp_path, rows)
    got = cp.run(spark, folder)
    assert got.columns == [*documents([]).columns, "mix_copy"]
    want = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    want = one_of_each(want)
    match = decontamination.matcher([(0, ITEM)])
    want = [r for r in want if not match(r[1])]
    want = [(r[0], redacted(r[1]), *r[2:]) for r in want]
    ids = {r[0] for r in want}
    assert {300, 301, 303, 304, 305, 306}.isdisjoint(ids) and not any(100 <= d < 300 for d in ids) and 302 in ids
    copies = mixed(want)
    texts = {r[0]: r[1] for r in want}
    found = got.select("doc_id", "text", "mix_copy", "id", "`a.b`").collect()
    assert sorted((r.doc_id, r.text, r.mix_copy) for r in found) == sorted(
        (d, texts[d], c) for d, n in copies.items() for c in range(1, n + 1)
    )
    assert "<email>" in texts[302] and {(r.id, r["a.b"]) for r in found} == {(0, 8)}


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_stages_take_odd_and_empty_tables(spark, documents, tmp_path, name, stage):
    folder = written(spark, documents, tmp_path, ODD + corpus(2, 20))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(spark, docs, folder)
    last = ["mix_copy"] if name == "mixing" else []
    assert out.columns == [*docs.columns, *last]
    assert out.where(F.col("doc_id").between(100, 250)).count() > 0 or name == "ngram_jaccard_join"
    assert stage(spark, docs.where("false"), folder).count() == 0


def test_short_texts_of_one_language_stay(spark, documents, tmp_path):
    rng = random.Random(3)
    rows = corpus(4) + [(500 + i, prose(rng, lang, n), lang, "a") for i, (lang, n) in enumerate((x, n) for x in SYLLABLES for n in (3, 5, 8))]
    folder = written(spark, documents, tmp_path, rows)
    kept = cp.identify_language(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert {r[0] for r in kept.where("doc_id >= 500").select("doc_id").collect()} == set(range(500, 509))


def test_mixed_rows_numbers_rows_that_share_id_source_and_size(documents):
    rows = [(1, "a b c", None, "x"), (1, "d e f", None, "x"), (1, "d e f", None, "x"), (None, "g h", None, None), (2, None, None, "x")]
    rows += [(10 + i, "w " * (i + 1), None, "y") for i in range(6)]
    taken = mixing.mix(documents(rows)).groupBy("doc_id", "size").agg(F.sum("copies").alias("n")).collect()
    out = mixing.mixed_rows(documents(rows)).collect()
    got = {}
    for r in out:
        key = r.doc_id, len((r.text or "").split())
        got[key] = got.get(key, 0) + 1
    assert got == {(r.doc_id, r["size"]): r.n for r in taken if r.n}
    assert max(r.mix_copy for r in out) <= 3


def test_mix_shuffles_texts_once(documents):
    docs = documents(corpus(5, 30))
    plan = mixing.mixed_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_count") <= 2  # the two branches read one exchange of the rows


def test_short_items_are_reported_but_take_nothing_away(spark, documents):
    docs = documents([(1, "so the answer is Forty-Two."), (2, "forty-twosome"), (3, "x " + ITEM)])
    bench = spark.createDataFrame([(7, "forty-two"), (8, ITEM), (9, "  "), (10, None)], "item_id BIGINT, text STRING")
    hits = decontamination.find_leaks(docs, bench).select("doc_id", "item_id", "distance", "start", "end").collect()
    assert sorted(map(tuple, hits)) == [(1, 7, 0, 17, 26), (3, 8, 0, 2, 2 + len(ITEM))]
    for limit in (1, 10**6):
        assert {r[0] for r in decontamination.without_leaks(docs, bench, limit=limit).select("doc_id").collect()} == {1, 2}
    many = spark.createDataFrame([(i, f"{i} {ITEM} {i}") for i in range(5)] + [(9, "x " + ITEM)], "item_id BIGINT, text STRING")
    assert {r[0] for r in decontamination.without_leaks(docs, many, limit=1).select("doc_id").collect()} == {1, 2}
