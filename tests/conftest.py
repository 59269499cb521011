import random
import sys
import tempfile
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="affinis-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def partitions(spark):
    """Set the number of shuffle partitions for one test."""

    def use(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))

    yield use
    use(4)


def skewed_rates(seed=5, users=40, items=30):
    """Whole-number rates with two long histories and three items nearly everyone has."""
    rng = random.Random(seed)
    rates = {}
    for user in range(users):
        size = items - 3 if user < 2 else rng.randint(1, 6)
        for item in rng.sample(range(items), size):
            rates[user, item] = float(rng.randint(1, 5))
        for item in (0, 1, 2):
            if rng.random() < 0.8:
                rates[user, item] = float(rng.randint(1, 5))
    return rates


def histories(rates):
    out = {}
    for user, item in rates:
        out.setdefault(user, set()).add(item)
    return out


def brute_swing(rates, alpha=0.5, weight=lambda n: 1.0):
    """Swing scores in whole units of 1e-10, from the definition."""
    baskets, scores = histories(rates), {}
    for u, v in combinations(sorted(baskets), 2):
        shared = sorted(baskets[u] & baskets[v])
        if len(shared) < 2:
            continue
        value = weight(len(baskets[u])) * weight(len(baskets[v])) / (alpha + len(shared)) * 1e10
        term = int(value + 0.5)
        for pair in combinations(shared, 2):
            scores[pair] = scores.get(pair, 0) + term
    return scores


def rates_frame(spark, rates):
    rows = [(u, i, r) for (u, i), r in rates.items()]
    return spark.createDataFrame(rows, "user BIGINT, item BIGINT, rate DOUBLE")
