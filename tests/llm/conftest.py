from __future__ import annotations

import random

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """The texts of the smallest test table by id."""
    return duckdb.connect().execute(f"select doc_id, text from '{SMALL}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def passages():
    """Random texts over a small vocabulary that share passages, with copies, near copies and edge cases."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Été", "ÑU", "x", "naïve,"]
    shared = [" ".join(rng.choices(words, k=rng.randint(12, 40))) for _ in range(6)]
    texts: list[str | None] = []
    for _ in range(120):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(3)]
        parts[1:1] = rng.sample(shared, rng.randint(0, 2))
        texts.append("\n".join(parts))
    for base in texts[:12]:
        for _ in range(4):
            changed = base.split(" ")
            for _ in range(rng.randint(0, 3)):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            texts.append(" ".join(changed))
    texts += [None, "", " \t\n", "one", "One", "a b c d", "A  b\tc d", "aaaa" * 60, "aaaa" * 61, "ab" * 100]
    texts += [" ".join(rng.choices(words, k=30_000)), shared[0], shared[0].upper()]
    rng.shuffle(texts)
    return list(enumerate(texts, 3))


@pytest.fixture(scope="session")
def docs(spark, passages):
    """The passages as a table, in several partitions, with columns whose names the operators use themselves."""
    rows = [(i, t, f"kept{i}", i % 3) for i, t in passages]
    return spark.createDataFrame(rows, "doc_id long, text string, items string, size int").repartition(5)
