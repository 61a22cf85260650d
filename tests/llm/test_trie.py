"""The prefix trie against a plain version."""

from __future__ import annotations

import random

import pytest
from helpers import trie as plain
from llm_fixtures import empty  # noqa: F401  (fixture)
from pyspark.sql import functions as F

from aurum.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in ("d", "node", "no", "id", "words", "digest", "_part", "_i", "_place", "parent", "at"):
        df = df.withColumn(name, F.lit("clash"))
    out = trie.prefix_trie(*trie.rebuilt(trie.turns(df)))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def conversations(n, rng):
    rows = []
    for c in range(n):
        for t in range(rng.randrange(7)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]),
                         rng.choice(["", None, "hi there", "a b\tc", "é x"]) if rng.random() < 0.8 else f"own {c} {t}"))
    return rows


@pytest.mark.parametrize("last", [20_000, 40])
def test_random_conversations(spark, empty, monkeypatch, last):  # noqa: F811
    monkeypatch.setattr(trie, "LAST_ARCS", last)
    monkeypatch.setattr(trie, "CHUNK_CHARS", 30)
    rng = random.Random(last)
    rows = conversations(150, rng)
    rows += [(-7, 0, "user", "neg"), (None, 0, "user", "nobody"), (10_000, 5, "user", "no base " * 3000)]
    rows += rows[:40]  # repeated rows are further turns
    assert got(spark, rows) == sorted(plain(rows), key=repr)


def test_hot_conversation_and_copies(spark, empty, monkeypatch):  # noqa: F811
    """One conversation with a third of all rows, many equal ones, equal rows."""
    monkeypatch.setattr(trie, "LAST_ARCS", 100)
    rows = [(20, None, "user", "again and again")] * 150 + [(20, i, "user", f"turn {i}") for i in range(150)]
    rows += [(c, t, r, x) for c in range(100, 250) for t, r, x in ((0, "user", "hello you"), (1, "assistant", "hello"))]
    assert got(spark, rows) == sorted(plain(rows), key=repr)


def test_turnless_and_empty(spark, empty):  # noqa: F811
    rows = [(c, 0, "user", "x") for c in (41, 42, 43, 44, 45)]  # no base: short ones lose all turns
    assert got(spark, rows) == sorted(plain(rows), key=repr)
    assert got(spark, []) == []


def test_list_rank_rounds(spark, empty, monkeypatch):  # noqa: F811
    monkeypatch.setattr(trie, "LAST_ARCS", 10)
    order = list(range(1, 500))
    random.Random(3).shuffle(order)
    chain = [0, *order]
    arcs = spark.createDataFrame([(a, b, a % 3) for a, b in zip(chain, [*order, None])], "id long, next long, w long")
    want, upto = [], 0
    for a in chain:
        want.append((a, upto))
        upto += a % 3
    assert sorted(tuple(r) for r in trie.list_rank(arcs, ["w"]).collect()) == sorted(want)
