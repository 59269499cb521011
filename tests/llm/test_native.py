import re

from pyspark.sql import functions as F

from affinis.llm import license_scan, mixing, secret_scan
from affinis.llm.common import regex_spans, running_totals
from tests.llm.conftest import ODD

KEY = "AKIA" + "ABCDEFGHIJ234567"
TEXTS = [
    f"x {KEY} y Password: \"hunter22\" z token='short' {'0af' * 9}",
    "api_key = ABCDEF/+=. secret:abc apikey=123456 PASSWD = 'a_b-c.d/e'",
    "ghp_" + "a1" * 18 + " and AKIAshort and " + "f" * 23 + " " + "0" * 24 + "g",
    "\U0001f600 token=é token= abcdef\ntoken=abcdefg",
    "no secrets here",
    f"ASIA{'A1' * 8} github_pat_{'a_' * 12} SG.{'a-' * 9}.{'b_' * 17} shpca_{'0aF' * 11} dop_v1_{'0f' * 32}",
    f"https://hooks.slack.com/services/{'T0/' * 8} https://discordapp.com/api/webhooks/12/{'x-' * 11} 123456789:AA{'z_' * 16}",
    f"key-{'0a' * 16} sq0csp-{'a-' * 12} pypi-AgEI{'c_' * 26} hf_{'Q9' * 16} AccountKey={'a+/=' * 10} NRAK-{'A0' * 14}",
    f"lin_api_{'b1' * 20} postgres://user:pass@db.example.org/x https://user@host http://a:b@c ftp://me:secret@h",
]


def test_running_totals_and_spans(spark):
    lists = [[], [5], [1, 2, 3], list(range(100))]
    frame = spark.createDataFrame([(x,) for x in lists], "x ARRAY<BIGINT>")
    want = [[sum(x[: i + 1]) for i in range(len(x))] for x in lists]
    assert [r[0] for r in frame.select(running_totals(F.col("x"))).collect()] == want
    text = "aabéab\U0001f600aa"
    got = spark.createDataFrame([(text,)], "t STRING").select(regex_spans(F.col("t"), F.lit("a+")).alias("s")).first().s
    assert [(s.start, s.end) for s in got] == [m.span() for m in re.finditer("a+", text)]


def test_trigram_queries_hold_for_every_match():
    samples = {
        "assign": ["password=abcdef", 'API_KEY" : "abcdef', "apikey=zzzzzz"],
        "access": [KEY],
        "github": ["ghs_" + "a" * 40],
        "stripe": ["sk_test_" + "a" * 20, "rk_live_" + "b" * 20],
        "pem": ["-----BEGIN EC PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"],
        "bearer": ["Bearer " + "a" * 24],
    }
    for rule in secret_scan.RULES:
        groups = secret_scan.trigram_query(rule.pattern)
        for text in samples.get(rule.kind, []):
            low = text.lower()
            assert all(any(all(t in low for t in way) for way in ways) for ways in groups)
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == []


def test_secrets_equal_python(documents):
    rows = ODD + [(10 + k, t) for k, t in enumerate(TEXTS)]
    got = secret_scan.scan_secrets(documents(rows)).collect()
    want = []
    for key, text, *_ in [(*r, None) for r in rows]:
        spans = []
        for order, rule in enumerate(secret_scan.RULES):
            for m in secret_scan.compiled()[rule.kind].finditer(text or ""):
                if len(m[rule.group]) >= rule.floor:
                    spans.append((m.start(), order, rule.kind, m.end()))
        want.append((key, sorted(spans)))
    order = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=order) == sorted(want, key=order)
    assert secret_scan.scan_secrets(documents([])).count() == 0


def test_licenses(documents):
    rows = ODD + [
        (10, "Released under the MIT License. Under the\tMIT license!"),
        (11, "Licensed under the Apache License, Version 2.0."),
        (12, "This work is licensed under the GNU Lesser General Public License, version 3."),
        (13, "CC-BY-NC and cc by nc; nothing else"),
        (14, "a mit license b under the mit licenses"),
        (15, "SPDX-License-Identifier: MPL-2.0 is not a name here; Mozilla Public License 2.0 license"),
    ]
    got = {(r.doc_id, r.n_words): r for r in license_scan.scan_licenses(documents(rows)).collect()}
    by_id = {k[0]: r for k, r in got.items()}
    assert by_id[10].n_base == 2 and (by_id[10].first_word, by_id[10].last_word) == (1, 5)
    assert by_id[10].labels == ["mit"] == by_id[10].base_labels
    assert by_id[11].labels == ["apache-2"] and by_id[11].n_base == 1
    assert by_id[12].labels == ["lgpl-3"] and by_id[12].base_labels == []
    assert by_id[13].n_base == 2 and by_id[13].base_labels == ["cc-by-nc"]
    assert by_id[14].base_labels == [] and by_id[14].labels == ["mit"]
    assert "mpl-2" in by_id[15].labels
    assert by_id[1].n_words == 0 and by_id[1].score == 0.0 and by_id[2].labels == []
    assert license_scan.scan_licenses(documents(rows)).count() == len(rows)
    assert license_scan.scan_licenses(documents([])).count() == 0
    assert len(license_scan.signatures()) > 200


def sizes_of(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]


def test_mix_meets_targets_and_repeats_itself(documents):
    rows = ODD + [(100 + k, "w " * (k % 17), "en", f"s{k % 5}" if k % 3 else "hot") for k in range(900)]
    first = mixing.mix(documents(rows)).collect()
    again = mixing.mix(documents(rows[::-1]).repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(first, key=key) == sorted(again, key=key)
    assert sorted(r.size for r in first) == sorted(sizes_of(rows))
    total, targets, taken = sum(sizes_of(rows)), {}, {}
    for r in first:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        targets[r.source_size, r.target] = r.target
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    assert sum(taken.values()) <= total
    largest = max(sizes_of(rows))
    assert all(abs(taken[k] - targets[k]) <= 2 * largest or k[0] < 6000 for k in targets)
    assert all(t <= 3 * k[0] + 1e-6 for k, t in targets.items())


def test_slots_do_not_change_the_mix(documents, monkeypatch):
    rows = [(k, "w " * (1 + k % 9), None, "a" if k % 2 else "b") for k in range(300)]
    key = lambda r: (r.doc_id, r.taken)
    whole = sorted(map(key, mixing.mix(documents(rows)).collect()))
    monkeypatch.setattr(mixing, "SLOT_ROWS", 7)
    assert sorted(map(key, mixing.mix(documents(rows)).collect())) == whole
    mixed = mixing.mixed_rows(documents(rows))
    assert sorted((r.doc_id, r.n) for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()) == [
        (d, t // (1 + d % 9)) for d, t in whole if t
    ]
    assert mixing.mix(documents([])).count() == 0


def test_every_rule_has_a_sample():
    """Each shape occurs in the texts that are compared with Python's engine."""
    found = {kind for kind, p in secret_scan.compiled().items() if any(p.search(t) for t in TEXTS)}
    assert {r.kind for r in secret_scan.RULES} - found <= {"gitlab", "slack", "google", "stripe", "npm", "jwt", "pem", "bearer"}


def test_homoglyphs_are_undone_and_texts_without_any_are_looked_at_once():
    from timeit import repeat

    from affinis.llm.pii import Tape, undo_homoglyphs

    undo = undo_homoglyphs()
    tape = undo(Tape.of("xé​а１z"))
    assert (tape.text, list(tape.starts), list(tape.ends)) == ("xéa1z", [0, 1, 3, 4, 5], [1, 2, 4, 5, 6])
    accented = Tape.of("Größe café señor " * 20_000)
    assert undo(accented) is accented
    look = min(repeat(lambda: set(accented.text), number=1, repeat=5))
    assert min(repeat(lambda: undo(accented), number=1, repeat=5)) < 6 * look
