"""The phrase collocation operator against a plain version."""

from __future__ import annotations

import random

import pytest
from helpers import SCHEMA, collocations as plain, doc, edge_docs
from llm_fixtures import edge, empty  # noqa: F401  (fixtures)

from aurum.llm import collocations, wordcount

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def got(df, **more):
    out = collocations.collocations(df, **more)
    return sorted(tuple(r) for r in out.select(*COLUMNS).collect())


def test_edge_documents(edge):  # noqa: F811
    docs = [(d[2], d[1]) for d in edge_docs()]
    for top, least in ((2000, 10), (3, 2)):
        assert got(edge, top=top, least=least) == sorted(plain(docs, top, least))


@pytest.mark.parametrize("top", [1, 4, 25, 400])
def test_random_phrases(spark, edge, top):  # noqa: F811
    """Small tops take several rounds: ties, swallowed pairs, languages of unequal size."""
    rng = random.Random(top)
    stock = [" ".join(rng.choice("abcdefghijkl") * rng.randrange(1, 3) for _ in range(rng.randrange(2, 5))) for _ in range(30)]
    docs = []
    for i in range(240):
        text = "".join(rng.choice([f"{rng.choice(stock)} ", f"{rng.choice('ABCdefxyz')} ", ", ", ".\n", "\t", "é;"])
                       for _ in range(rng.randrange(60)))
        docs.append(doc(i % 7, text, rng.choice(["en", "en", "en", "und", None, "", "x\x00y"])))
    want = plain([(d[2], d[1]) for d in docs], top, 3)
    assert got(spark.createDataFrame(docs, SCHEMA).repartition(3), top=top, least=3) == sorted(want)


def test_growth_stops_at_the_limit(spark, edge, monkeypatch):  # noqa: F811
    """Branches whose bound is below the limit are not counted."""
    grown = []
    real = collocations.triple_counts

    def spy(docs, pairs, grow, settle, seed, least):
        out = real(docs, pairs, grow, settle, seed, least)
        grown.append((grow.count(), settle.count(), out.count()))
        return out

    monkeypatch.setattr(collocations, "triple_counts", spy)
    text = " ".join(f"p{i} q{i} r{i}" for i in range(50)) + " " + " ".join(f"the w{i % 40}" for i in range(400))
    docs = [doc(i, text) for i in range(12)]
    assert got(spark.createDataFrame(docs, SCHEMA), top=5) == sorted(plain([(d[2], d[1]) for d in docs], 5))
    pairs = len({tuple(text.split()[i:i + 2]) for i in range(len(text.split()) - 1)})
    assert len(grown) == 1 and grown[0][0] < pairs


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    big = 3_000_000_000
    row = spark.range(1).select(collocations._score(F.lit(big), F.lit(big + 1), F.lit(big + 7)).alias("s")).first()
    assert row["s"] == 1_000_000 * big * big // ((big + 1) * (big + 7))


def test_empty(empty):  # noqa: F811
    assert got(empty) == []


def test_hash_collisions_take_another_seed(spark, edge, monkeypatch):  # noqa: F811
    docs = spark.createDataFrame([doc(1, "a b " * 20), doc(2, "c")], SCHEMA)
    real = wordcount.word_hash

    def same(seed):
        from pyspark.sql import functions as F
        return real(seed) if seed else F.lit(7).cast("long")

    monkeypatch.setattr(collocations, "word_hash", same)
    assert collocations.frequent_words(docs, 10)[2] == 1
