"""op7's model over code points against dictionaries."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import SCHEMA, doc
from llm_fixtures import edge, empty  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from aurum.llm import ngrams, queries


def _plain(texts):
    """p(gram) by the formulas, from dictionaries of strings."""
    tables = [Counter(("   " + t)[i:i + 4] for t in texts for i in range(len(t)))]
    for _ in range(3):
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables = tables[::-1]  # order 1 first

    def prob(g):
        if not g:
            return 1 / (len(tables[0]) + 1)
        own = tables[len(g) - 1]
        after = {x: n for x, n in own.items() if x[:-1] == g[:-1]}
        lower = prob(g[1:])
        if not after:
            return lower
        m = Counter(own.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0
        d = [0.0] + [min(max(i - (i + 1) * y * m[i + 1] / m[i] if m[i] else i / 2, .05), i - .05) for i in (1, 2, 3)]
        total = sum(after.values())
        n = after.get(g, 0)
        return (n - d[min(n, 3)]) / total + sum(d[min(x, 3)] for x in after.values()) / total * lower

    seen = {}
    return lambda g: seen[g] if g in seen else seen.setdefault(g, prob(g))


def _classified(docs, trusted):
    """(doc_id, lang, n_chars, perplexity, threshold, kept) of every document."""
    rows = [(i, lang or "und", t or "") for i, t, lang, *_ in docs]
    models = {}
    for lang in {x for _, x, _ in rows}:
        if any(t for i, x, t in rows if x == lang and i in trusted):
            models[lang] = _plain([t for i, x, t in rows if x == lang and i in trusted])
    out, good = [], defaultdict(list)
    for i, lang, t in rows:
        value = None
        if t and lang in models:
            value = math.exp(-sum(math.log(models[lang](("   " + t)[k:k + 4])) for k in range(len(t))) / len(t))
            if len(t) >= 200 and i in trusted:
                good[lang].append(value)
        out.append((i, lang, len(t), value))
    limit = {x: sorted(v)[math.ceil(.99 * len(v)) - 1] * 1.1 for x, v in good.items()}
    return [(*r, limit.get(r[1]), not (r[2] >= 200 and r[1] in limit and r[3] > limit[r[1]])) for r in out]


def _check(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3] or 0)
    got, want = sorted((tuple(r) for r in got), key=order), sorted(want, key=order)
    assert [r[:3] + r[5:] for r in got] == [r[:3] + r[5:] for r in want]
    for g, w in zip(got, want):
        for a, b in zip(g[3:5], w[3:5]):
            assert a == b if b is None else a == pytest.approx(b, rel=1e-5)


def _docs():
    rng = random.Random(9)
    words = {"en": ["the", "river", "Stone", "walks"], "zh": ["山水", "河流", "𠀀石", "走"], None: ["ẞx", "Ωmega", "é\x00", "#7"]}
    docs = []
    for i in range(36):
        lang = ["en", "zh", None][i % 3]
        docs.append(doc(i, " ".join(rng.choice(words[lang]) for _ in range(rng.choice([30, 90]))), lang))
    docs += [doc(100, "".join(rng.choice("qx#$%09") for _ in range(300)), "en"), doc(101, "𠀁河" * 150, "zh"), doc(102, "new " * 60, "xx"),
             doc(103, None, "en"), doc(104, "", "zh"), doc(None, "the river " * 25, "en"), doc(None, "the river " * 25, "en"), docs[0], docs[3]]
    return docs, {*range(0, 36, 2)}


@pytest.mark.parametrize("piece,cells", [(4_000_000, 1 << 25), (50, 10)])
def test_ngrams_against_dictionaries(spark, empty, monkeypatch, piece, cells):
    monkeypatch.setattr(ngrams, "PIECE", piece)
    monkeypatch.setattr(ngrams, "CELLS", cells)
    docs, trusted = _docs()
    labels = spark.createDataFrame([(i, 1) for i in trusted] + [(1, 0), (None, 1), (2, 0), (999, 1)], "doc_id long, quality long")
    table = spark.createDataFrame(docs, SCHEMA).repartition(3)
    before = spark.conf.get(ngrams.CLEANUP)
    _check(ngrams.classified(table.withColumn("part", F.lit(1)), labels).collect(), _classified(docs, trusted))
    assert spark.conf.get(ngrams.CLEANUP) == before


def test_ngrams_without_labels_or_documents(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality long")
    got = ngrams.classified(edge, none).collect()
    assert len(got) == edge.count() and all(r["kept"] and r["perplexity"] is None for r in got)
    assert ngrams.classified(empty, none).count() == 0


def test_op7_tells_letters_apart(spark, tmp_path):
    """Words of other letters than the trusted ones; folded to few symbols they read the same."""
    rng = random.Random(2)
    word = lambda first: "".join(chr(ord(first) + 8 * rng.randrange(3)) for _ in range(6))
    same = [" ".join(word("一") for _ in range(60)) for _ in range(30)]
    other = [t.translate({ord("一") + 8 * k: chr(ord("一") + 8 * (k + 100)) for k in range(3)}) for t in same]
    spark.createDataFrame([doc(i, t, "zh") for i, t in enumerate(same + other)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1) for i in range(25)], "doc_id long, quality long").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"]: r["kept"] for r in queries.QUERIES["op7_kneser"](spark, str(tmp_path)).collect()}
    assert len(kept) == 60 and not any(kept[i] for i in range(30, 60)) and sum(kept[i] for i in range(30)) >= 28
