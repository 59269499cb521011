import random
import re
from collections import Counter

import numpy as np
import pytest

from affinis.llm import quality, token_counts
from tests.llm.conftest import ODD

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def length(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_pre_tokens_are_those_of_the_library(library):
    cut, rng = token_counts.pre_tokenizer(PATH), random.Random(1)
    letters = "ab'stredvmlé²½  \x85  \t\n09٣中<|endoftext|>.,!​"
    for k in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        text = text + "<|endoftext|>" * (k % 2) + text
        assert sum(length(library, p) for p in cut(text)) == length(library, text)


def test_counts_equal_the_library(documents, library):
    rng = random.Random(2)
    rows = ODD + [(100 + k, " ".join(rng.choice(["the", "of", "xyzzy", "café", "\n"]) for _ in range(k * 7))) for k in range(60)]
    got = token_counts.count_tokens(documents(rows).repartition(3), PATH).collect()
    key = lambda t: (str(t[0]), t[1], t[2])
    want = [(r[0], len((r[1] or "").encode()), length(library, r[1])) for r in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(documents([]), PATH).count() == 0


def brute_counts(text):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    lines = [x for x in text.split("\n") if word.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for k, w in enumerate(windows) if often[w] > 1 for j in range(k, k + 8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)]


def test_statistics_equal_brute_force():
    rng = random.Random(3)
    for k in range(400):
        text = "".join(rng.choice(["a ", "b ", "éc ", "\n", "#", "d\n", "\x1c"]) for _ in range(rng.randrange(90)))
        assert quality.statistics(text.encode())[0] == brute_counts(text)


def test_monotone_trees():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * rng.random(3000) + 0.4 * (x[:, 1] > 0.5)) < 0.9).astype(float)
    trees = quality.fit(x, y, (-1, 0, 1))
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.9
    for f, sign in ((0, -1), (2, 1)):
        line = np.tile(x[:50], (40, 1))
        line[:, f] = np.repeat(np.linspace(0, 1, 40), 50)
        steps = np.diff(trees.scores(line).reshape(40, 50), axis=0)
        assert (sign * steps >= -1e-12).all()
    assert quality.fit(x, np.ones(3000), (0, 0, 0)) is None


def test_judgement(documents, spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    good = [(k, " ".join(rng.choice(words) for _ in range(80))) for k in range(100)]
    bad = [(200 + k, " ".join(rng.choice(words) + "%%%" for _ in range(80))) for k in range(100)]
    labels = spark.createDataFrame(
        [(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(None, 1, 0), (7, None, 0), (9999, 1, 1)],
        "doc_id BIGINT, quality INT, toxic INT",
    )
    rows = quality.judge(documents(good + bad + ODD), labels).collect()
    kept = {r.doc_id for r in rows if r.kept}
    assert len(rows) == 209 and kept >= {d for d, _ in good[10:]} and not kept & {d for d, _ in bad}
    assert all(r.base_failed for r in rows if r.n_words < 20)
    free = quality.judge(documents(good), labels.limit(0)).collect()
    assert all(r.kept for r in free)
