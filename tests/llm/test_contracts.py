"""Base detectors and registered queries against the words of their definitions."""

import hashlib
import random
import re
import time

import pytest

from affinis.llm import language_id, license_scan, pii, queries
from tests.llm.conftest import ODD

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def odd_texts(seed, pieces, n=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(n)]


PERSONAL = [
    "a", "Z.b", "_%+-", "@", "@x", ".com", ".", "..", "-", " ", "  ", "(", ")", "+", "+4", "7", "42", "255", "256", "1.2.3.4",
    "010.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "55 01", "x@y.z", "é", "\n", " at ", " dot ", "four ", "٣",
]


def test_base_detectors_equal_their_expressions():
    find = pii.finder()
    for text in odd_texts(1, PERSONAL):
        got = [(kind, a, b) for kind, a, b, base in find(text) if base]
        want = sorted(base_spans(text), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert got == want, text


def test_spelled_hosts_of_any_length():
    find = pii.finder()
    host = " dot ".join(f"h{i}" for i in range(30))
    assert find(f"write to me at {host} now") == [("email", 9, 15 + len(host), False)]
    names = " dot ".join(f"n{i}" for i in range(20))
    text = f"write {names} at example dot org please"
    assert find(text) == [("email", 6, text.index(" please"), False)]
    long = "b" * 100
    assert find(f"{long} at {long} dot org") == [("email", 0, 12 + 2 * len(long), False)]


def test_time_of_personal_data_is_linear():
    find = pii.finder()

    def took(n):
        started = time.perf_counter()
        for unit in ("a dot b at c dot d ", "x@", "1.", "at a dot ", "+1 ", "a" * 20, " dot a"):
            find(unit * (n // len(unit)))
        return time.perf_counter() - started

    took(1000)
    short, long = took(40_000), took(400_000)
    assert long < 40 * max(short, 0.02)


LICENSE_PIECES = [
    "under", "the", "MIT", "mit", "license", "License", "apache", "version", "2", "cc", "by", "nc", " ", "-", "\n", ", ", ".", "é", "under the mit license",
    "Apache License, Version 2", "CC BY-NC", " ", "_",
]
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def license_counts(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_license_phrases_equal_a_scan_of_words(documents):
    rows = [(i, t) for i, t in enumerate(odd_texts(2, LICENSE_PIECES, 400))] + [(1000 + i, r[1]) for i, r in enumerate(ODD)]
    got = license_scan.scan_licenses(documents(rows)).collect()
    found = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) for r in got}
    assert found == {d: license_counts(t) for d, t in rows}


@pytest.fixture
def tables(spark, documents, tmp_path):
    def make(rows):
        documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return make


def test_op2_gives_counts_and_digest(spark, tables):
    rows = [(i, t) for i, t in enumerate(odd_texts(3, PERSONAL, 300))] + [(900, None), (901, "")]
    for r in queries.op2_pii(spark, tables(rows)).collect():
        base = sorted(base_spans(dict(rows)[r.doc_id] or ""), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_op6_gives_joined_labels(spark, tables):
    rows = [(1, "Under the MIT license, CC BY NC"), (2, None), (3, "cc by nc cc by nc")]
    got = {r.doc_id: r for r in queries.op6_licenses(spark, tables(rows)).collect()}
    assert (got[1].base_labels, got[1].n_base, got[1].first_word, got[1].last_word) == ("cc-by-nc,mit", 2, 0, 4)
    assert (got[2].base_labels, got[2].n_words, got[2].first_word, got[2].score) == ("", 0, None, 0.0)
    assert (got[3].n_base, got[3].last_word) == (2, 3)


def test_languages_of_held_out_documents(spark):
    """Accuracy on the documents that were not learned from, of the given table."""
    found = queries.op10_language_id(spark, "/root/testdata/sf0.01").where("held_out")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_tied_languages_take_the_first_name():
    import numpy as np

    classify = language_id.classifier(["aa", "bb"], np.zeros((2, language_id.BUCKETS)))
    assert classify("some words of no language")[0] == "aa"
