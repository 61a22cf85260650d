"""The url filter against a plain version and by held-out accuracy."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import regex
from helpers import SCHEMA, doc, edge_docs
from llm_fixtures import edge, empty  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from aurum.llm import urls
from aurum.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"


def plain(pages, texts, rules):
    vocab = Counter(w for t in texts for w in regex.split(r"\P{L}+", (t or "").lower()) if 1 <= len(w) <= 24)
    total = sum(vocab.values())

    def split(run):
        best = [(0, 0, [])]
        for e in range(1, len(run) + 1):
            options = []
            for s in range(max(0, e - 24), e):
                w = run[s:e]
                cost = math.log(total / vocab[w]) if vocab[w] else math.log(max(total, 1) / 10) + len(w) * math.log(10)
                options.append((best[s][0] + round(1e6 * cost), best[s][1] + 1, s, best[s][2] + [w]))
            c, k, _, w = min(options, key=lambda o: o[:3])
            best.append((c, k, w))
        return best[-1][2]

    rows = []
    for page_id, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [(len(h + p), -i, h + p, v) for i, (v, h, p) in enumerate(rules)
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        tokens = [f + w for f, x in (("h", host), ("p", path))
                  for r in regex.findall(r"\p{L}{1,256}|\p{Nd}{1,256}", x.lower())
                  for w in (split(r) if r[0].isalpha() else [f"#{len(r)}"])]
        rows.append((page_id, host, path, max(fit)[2:] if fit else (None, None), tokens))
    n = {v: Counter(t for r in rows if r[3][1] == v for t in r[4]) for v in ("block", "allow")}
    size = len(n["block"] | n["allow"])
    pages_of = Counter(r[3][1] for r in rows)
    out = []
    for page_id, host, path, (rule, verdict), tokens in rows:
        score = round(1e6 * math.log((pages_of["block"] + 1) / (pages_of["allow"] + 1)))
        for t in tokens:
            b, a = ((n[v][t] + 1) / (n[v].total() + size + 1) for v in ("block", "allow"))
            score += round(1e6 * (math.log(b) - math.log(a)))
        out.append((page_id, host, path, rule, verdict or ("block" if score > 0 else "allow"), score))
    return out


def judged(spark, pages, docs, rules=URL_RULES):
    df = spark.createDataFrame([(i, u, None) for i, u in pages], PAGES).repartition(3)
    for name in ("row", "host", "path", "rule", "verdict", "run", "key", "n", "token", "_n", "score"):
        df = df.withColumn(name, F.lit("clash"))
    out = urls.judged(df, docs, rules)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def same(got, want):
    want = sorted(want, key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) <= 5 and (g[4] == w[4] or abs(w[5]) <= 5)


EDGE = [None, "", "no scheme", "http://", "://x", "http://EXAMPLE.org/es/1", "https://a.example.org/en/1?x=/en/2",
        "https://a.example.org/en/2#://b.com/de/", "http://notexample.org", "http://org", "http://x.com/fr/", "http://x.com/de/q",
        "http://x.com/de", "http://com/de/é/漢字", "http://x.net/de/1234", "http://thehouseofwords.net/a-b_c.html",
        "http://" + "thewords" * 200 + ".net/" + "9" * 700, "http://x.net?", "ftp://u:p@x.com:80/fr/x//y"]


def test_edge_urls(spark, edge):  # noqa: F811
    docs = [*edge_docs(), doc(90, "the house of words " * 30), doc(91, "spam pills house")]
    pages = [(i % 15, u) for i, u in enumerate(EDGE * 2)] + [(None, EDGE[5])]
    df = spark.createDataFrame(docs, SCHEMA)
    same(judged(spark, pages, df), plain(pages, [d[1] for d in docs], URL_RULES))
    same(judged(spark, pages, df, []), plain(pages, [d[1] for d in docs], []))


def test_held_out_accuracy(spark, edge):  # noqa: F811
    """Names that run bad or good words together, never seen as a whole before."""
    rng = random.Random(2)
    good, bad, any_ = (w.split() for w in ("garden recipe museum school library health", "casino pills bets adult spam lottery",
                                           "the best my great online world"))
    pages, truth = [], {}
    for i in range(900):
        block = rng.random() < 0.4
        name = "".join([rng.choice(any_), rng.choice(bad if block else good), rng.choice(any_), rng.choice(bad if block else good)])
        labelled = i < 600
        pages.append((i, f"http://{name}{i}.net/{'x' if labelled and block else 'y' if labelled else 'z'}/{rng.randrange(99)}"))
        if not labelled:
            truth[i] = "block" if block else "allow"
    docs = spark.createDataFrame([doc(0, " ".join(good + bad + any_) * 3)], SCHEMA)
    out = judged(spark, pages, docs, [("block", "net", "/x/"), ("allow", "net", "/y/")])
    right = sum(truth[r[0]] == r[4] for r in out if r[0] in truth)
    assert right >= 0.97 * len(truth)


def test_segmentation():
    known = {(0, 3): 50, (3, 5): 40, (0, 8): 1, (8, 2): 9}
    assert urls.split("thehouseof", known, 1000) == ["the", "house", "of"]
    assert urls.split("zz", {}, 0) == ["z", "z"]


def test_empty(spark, edge, empty):  # noqa: F811
    assert judged(spark, [], edge) == []
    assert len(judged(spark, [(1, "http://a.net/b")], empty)) == 1
