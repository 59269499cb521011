import hashlib
import random
import time

import numpy as np
import pytest

from affinis.llm import decontamination, language_id, ngram_join, pii, suffix_dedup
from affinis.llm.components import components
from tests.llm.conftest import ODD


def near_copies(rng, groups=8):
    """Groups of texts between which some words differ, chains of them, and passages many texts share."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows, n = [], 0
    for g in range(groups):
        base = [word() for _ in range(rng.choice([3, 4, 6, 12, 30, 90, 250]))]
        for _ in range(12):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.2:
                text += passage
            rows.append((n := n + 1, " ".join(text)))
    return rows


def brute_classes(rows):
    sets = []
    for _, text, *_ in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        least[g] = min(least.get(g, r[0]), r[0])
    return sorted((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group))


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 5)])
def test_classes_equal_all_pairs(documents, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "GROUP", block)
    rows = near_copies(random.Random(seed)) + [(900, "Same text HERE"), (901, "same\ttext here"), (902, ""), (903, None)]
    got = ngram_join.similarity_classes(documents(rows).repartition(3)).collect()
    assert sorted(map(tuple, got)) == brute_classes(rows)


def test_odd_rows_and_one_of_each(documents):
    got = ngram_join.similarity_classes(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    rows = near_copies(random.Random(3), 3)
    kept = ngram_join.one_of_each(documents(rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in brute_classes(rows)})
    assert ngram_join.similarity_classes(documents([])).count() == 0


def test_bands_bound_the_difference():
    layout = ngram_join.bands(5000)
    for b in layout[::4]:
        for low in {b.low, (b.low + b.high) // 2, b.high}:
            for high in {low, low * 5 // 4}:
                shared = -(-4 * (low + high) // 9)
                assert low + high - 2 * shared <= ngram_join.most_apart(b.high)
        units = b.segments * (1 + b.deletions)
        assert b.segments == 0 or units >= ngram_join.most_apart(b.high) + 1 + 2 * b.spare * (1 + b.deletions)


def test_layout_of_very_long_texts_takes_no_time():
    start = time.process_time()
    layout = ngram_join.bands(1_000_000)
    assert time.process_time() - start < 20
    assert layout[-1].high >= 1_000_000
    for b in layout:
        kept = b.segments - 2 * b.spare
        assert not b.segments or kept * (1 + b.deletions) >= ngram_join.most_apart(b.high) + 1


def test_components(spark):
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(30)] + [(rng.randrange(300, 330), rng.randrange(300, 330)) for _ in range(20)]
    group = {}
    for _ in range(50):
        for a, b in pairs:
            group[a] = group[b] = min(group.get(a, a), group.get(b, b))
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT")).collect()}
    assert {k: got.get(k, k) for k in group} == group


def brute_removals(rows):
    seen, out = {}, []
    for key, text, *_ in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            if key is not None:
                s = data[k : k + 50]
                seen[s] = min(seen.get(s, key), key)
    for key, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if key is not None and seen[data[k : k + 50]] < key:
                gone[k : k + 50] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((str(key), len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_removals_equal_brute_force(documents, seed):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("ab é\n") for _ in range(rng.randrange(30, 120))) for _ in range(12)]
    rows = [(k, "".join(rng.choice(stock) + rng.choice("xyz") for _ in range(rng.randrange(6)))) for k in range(60)]
    rows += ODD + [(70, "a" * 400), (71, "b" + "a" * 300), (72, "a" * 400), (73, "ab" * 90), (74, "ba" * 60)]
    got = suffix_dedup.removals(documents(rows).repartition(3)).collect()
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert found == brute_removals(rows)
    assert suffix_dedup.removals(documents([])).count() == 0


def test_anchors_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 3000, dtype=np.uint8).tobytes()
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    parts = suffix_dedup.anchors(data)
    spread = lambda t: [(int(h), int(p), s) for h, p, a, b in zip(*t) for s in range(a, b + 1)]
    assert spread(parts) == spread(whole)


def sellers(pattern, text):
    column, best = list(range(len(pattern) + 1)), (len(pattern), 0)
    for j, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(column[i - 1] + (p != c), column[i] + 1, new[-1] + 1))
        best, column = ((new[-1], j) if new[-1] < best[0] else best), new
    return best


def test_edit_distance_equals_the_table():
    rng = random.Random(6)
    for _ in range(500):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(30)))
        assert decontamination.best_place(pattern, text) == sellers(pattern, text)


def test_leaks_within_the_budget_are_found(documents, spark):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [(k, text(100)) for k in range(6)] + [(90, None), (91, "short")]
    rows, want = list(ODD), set()
    for k, item in items[:6]:
        for edits in (0, 3, 6, 30):
            chars = list(item)
            for at in rng.sample(range(len(chars)), edits):
                chars[at] = "Z"
            key = 100 + 10 * k + edits % 7
            rows.append((key, text(200) + "".join(chars).upper() + text(50)))
            want |= {(key, k, edits)} if edits <= 6 else set()
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = decontamination.find_leaks(documents(rows), benchmark, limit=150).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == want
    kept = decontamination.without_leaks(documents(rows), benchmark, limit=150)
    assert kept.count() == len(rows) - len(want) and kept.columns == documents(rows).columns
    assert decontamination.find_leaks(documents(ODD), benchmark.limit(0)).count() == 0


def test_disguised_personal_data():
    find = pii.finder()
    cases = {
        "mail jоhn.dоe@exаmple.com now": ("email", "jоhn.dоe@exаmple.com"),
        "write john dot doe at mail dot example dot com please": ("email", "john dot doe at mail dot example dot com"),
        "john [at] example [dot] com": ("email", "john [at] example [dot] com"),
        "us​er@exa​mple.com": ("email", "us​er@exa​mple.com"),
        "call plus one five five five two three four five six seven eight ok": ("phone", "plus one five five five two three four five six seven eight"),
        "ip one nine two dot one six eight dot one dot one end": ("ip", "one nine two dot one six eight dot one dot one"),
        "x １９２.168.0.1": ("ip", "１９２.168.0.1"),
    }
    for text, (kind, span) in cases.items():
        assert (kind, span) in {(k, text[a:b]) for k, a, b, _ in find(text)}
    for text in ("look at the one dot on it", "one two three", None, "", "meet at noon. dot"):
        assert find(text) == []


def test_long_texts_take_linear_time():
    find = pii.finder()
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + "(" * 200_000, "one " * 50_000, "а" * 100_000):
        find(text)


def test_redaction_keeps_rows_and_columns(documents):
    rows = ODD + [(10, "a b@c.de d"), (11, "card 4785380592391139 or +1 (743) 555-3824")]
    got = {(r.doc_id, r.text) for r in pii.redact_personal_data(documents(rows)).collect()}
    assert (10, "a <email> d") in got and (11, "card <card> or <phone>") in got and (1, None) in got
    assert pii.find_personal_data(documents([])).count() == 0


def test_languages_are_told_apart(documents):
    rng = random.Random(8)
    stock = {"aa": "la lo mi pa", "bb": "sch ung der ich", "cc": "tion eux le que"}
    text = lambda lang, n: " ".join(rng.choice(stock[lang].split()) + rng.choice(stock[lang].split()) for _ in range(n))
    rows = [(k, text(lang, 40), lang, "s") for k, lang in enumerate(list(stock) * 40)]
    out = language_id.held_out
    from pyspark.sql import functions as F

    frame = documents(rows + ODD)
    names, logs = language_id.learn(documents(rows).where(~out(F.col("doc_id"))))
    got = language_id.identify(frame.withColumn("held", out(F.col("doc_id"))), names, logs).collect()
    known = {k: lang for k, _, lang, _ in rows}
    assert names == sorted(stock) and all(r.lang_pred == known[r.doc_id] for r in got if r.doc_id in known and r.doc_id > 6)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if not r.text or not r.text.strip())
    classify = language_id.classifier(names, logs)
    lang, share = classify(text("aa", 60) + " " + text("bb", 30))
    assert lang == "aa" and 0.5 < share < 0.85
    assert language_id.classifier([], np.empty((0, language_id.BUCKETS)))("text") == ("und", 0.0)
