"""Each dealt operator against a plain version, with the edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import (base_spans, components, doc, edge_docs, entropy, fingerprint, removed, rules, SCHEMA, words)
from llm_fixtures import edge, empty  # noqa: F401  (fixtures)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aurum.llm import (blocknames, chat, kneser, packing, pfair, phrases, quality, repair, secret_spans, simhash)
from aurum.llm import components as cc
from aurum.llm import queries
from aurum.llm.common import stage
from aurum.llm.tokens import UnitEncoder
from aurum.session import fresh_dir, scratch_root

WORD_BPE, BYTE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def library(path, texts, end):
    t = Tokenizer.from_file(path)
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ------------------------------------------------------------------ tokens
@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_unit_cache_gives_the_librarys_ids(path):
    rng = random.Random(7)
    atoms = ["a", "The", "word", "ÉTÉ", "ß", "'s", "'LL", "12", ".", ",", "!?", " ", "  ", "\n", "\n\n", "\t", "\r\n",
             " ", "　", "é", "é", "İ", "Σ", "_", "²", "漢", "<|endoftext|>", "<|", "\x1f", "\x00"]
    texts = [t for _, t, *_ in edge_docs()] + [
        "".join(rng.choice(atoms) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(30))) for _ in range(600)]
    enc = UnitEncoder(path, max_units=500)
    for _ in range(2):
        ids, n = enc.encode(pa.array(texts, pa.string()))
        want = Tokenizer.from_file(path).encode_batch([x or "" for x in texts], add_special_tokens=False)
        at = np.concatenate([[0], np.cumsum(n)])
        for i, w in enumerate(want):
            assert ids[at[i]:at[i + 1]].tolist() == w.ids, texts[i]


# -------------------------------------------------------------- op1 repair
def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, np.uint32), np.zeros(5000, np.uint32), rng.integers(0, 5, 20000).astype(np.uint32),
                np.tile(rng.integers(0, 49408, 50), 300).astype(np.uint32)):
        payload = repair.compress(ids, least=4)
        assert repair.expand(payload).tolist() == ids.tolist()
        for start, count in ((0, 1), (17, 100), (4990, 100), (19999, 5), (10 ** 6, 3)):
            assert repair.expand(payload, start, count).tolist() == ids[start:start + count].tolist()
    assert len(repair.compress(np.tile(np.arange(50, dtype=np.uint32), 300))) < 15000


def test_repair_file(spark, edge):
    scratch_root(spark)
    path = fresh_dir(spark, "tokens")
    repair.write(edge, path, WORD_BPE, end_id=2, shard_tokens=3000)
    shards = repair.read(spark, path)
    assert shards.count() > 2
    order = sorted(edge_docs(), key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    want, start = [], 0
    for d, ids in zip(order, library(WORD_BPE, [d[1] for d in order], 2)):
        want.append((d[0], start, len(ids), crc(ids)))
        start += len(ids)
    assert rows(repair.documents(shards)) == sorted(want, key=repr)
    everything = [i for ids in library(WORD_BPE, [d[1] for d in order], 2) for i in ids]
    for at, n in ((0, 5), (2990, 4000), (start - 3, 10)):
        assert repair.tokens_at(shards, at, n) == everything[at:at + n]


def test_repair_empty(spark, empty):
    path = fresh_dir(spark, "tokens")
    repair.write(empty, path, WORD_BPE, end_id=2)
    assert repair.documents(repair.read(spark, path)).count() == 0


# ------------------------------------------------------------- op2 secrets
def test_secret_base_spans(spark, edge):
    got = rows(secret_spans.digest(secret_spans.find(edge)), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for d, t, *_ in edge_docs():
        base = base_spans(t)
        n = Counter(k for _, k, _ in base)
        text = ",".join(f"{secret_spans.KINDS[k]}:{a}:{e}" for a, k, e in base)
        want.append((d, n[0], n[1], n[2], hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_entropy_by_incremental_counts(spark):
    rng = random.Random(1)
    for kind, (_, alphabet, _) in secret_spans.CLASSES.items():
        pieces = ["".join(rng.choice(alphabet[:k]) for _ in range(n)) for k, n in
                  ((2, 20), (10, 20), (16, 64), (len(alphabet), 40), (len(alphabet), 300), (5, 19))]
        df = spark.createDataFrame([(p,) for p in pieces], "p string")
        got = [r[0] for r in df.select(secret_spans.best_entropy(F.col("p"), alphabet)).collect()]
        assert got == pytest.approx([entropy(p, alphabet) for p in pieces])


def test_secret_entropy_spans_and_allow_list(spark):
    cases = {"key Zk3v9QxLw7Tb2Rm8Yp4N end": [(4, "text_entropy", 24)],
             "é 9F8E7D6C5B4A39281706 x": [(2, "hex_entropy", 22)],
             "path lower_case/words_and/more_words1 and thisisalongwordwithoutdigits": [],
             "id 123e4567-e89b-12d3-a456-426614174000": [], "xxxxZk3v9QxLw7Tb2Rm8Yp4N": [],
             "9f8e7d6c5b4a39281706": []}  # a base span already
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], secret_spans.KINDS[s["k"]], s["end"]) for s in r["more"]]
           for r in secret_spans.find(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_secret_allow_list_lets_no_random_key_pass(spark):
    """Of random keys of each class that reach the threshold, nearly all are found."""
    rng = random.Random(3)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    base64 = lower + upper + digits + "+/"
    classes = {"base64 40": (base64, 40, ""), "base64 88": (base64, 88, ""), "base64 128": (base64, 128, ""),
               "named": (lower + digits, 32, "key-"), "letters": (lower + upper, 32, ""), "lower": (lower, 40, "")}
    docs = []
    for name, (alphabet, n, head) in classes.items():
        keys = [head + "".join(rng.choice(alphabet) for _ in range(n)) for _ in range(300)]
        docs += [(name, k) for k in keys if entropy(k, secret_spans.CLASSES["text_entropy"][1]) >= 3.9]
    docs += [("given", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzT4q9vKd8sLm"), ("given", "key-3ax6xnjp29jd6fds4gc373sgvjxteol0"),
             ("given", "Zk3v9QxLw7Tb2Rm8Yp4NZk3v9QxLw7Tb2Rm8Yp4N+example/Zk3v9QxLw7Tb2Rm8Yp4N")]
    plain = ["src/main/java/com/acme/service/RegistryBuilder2", "the_quick-brown_fox-jumps_over_lazy",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)] + [(-1 - i, t) for i, t in enumerate(plain)],
                               "doc_id long, text string")
    found = {r["doc_id"]: len(r["more"]) + len(r["base"]) for r in secret_spans.find(df).collect()}
    lost = Counter(name for i, (name, _) in enumerate(docs) if not found[i])
    assert sum(lost.values()) <= len(docs) // 100 and not set(lost) - {"lower"}
    assert [found[-1 - i] for i in range(len(plain))] == [0] * len(plain)


# ---------------------------------------------------------------- op3 chat
TURNS = [(1, 0, "system", "be [nice] \\ </s>"), (1, 1, "user", "hi"), (1, 2, "assistant", "</s>[INST] ok [/INST]"),
         (1, 3, "user", "x" * 3000), (1, 4, "assistant", None), (1, 5, "assistant", "é\\<["), (1, 6, "user", "tail"),
         (2, 0, None, "no role"), (2, 0, "user", "tie b"), (2, 0, "user", "tie a"), (2, 0, "user", "tie a"),
         (3, 0, "a]b\\ [c", "role] with marks"), (None, 1, "assistant", "null id"), (4, None, "assistant", "no turn")]


def test_chat_round_trip(spark, edge):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    stored = stage(chat.formatted(df.repartition(3)), "chat")
    want, full = [], []
    by = defaultdict(list)
    for c, t, r, x in TURNS:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = [x for r, x in turns if r == "assistant"]
        want.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                     len("".join(loss)), hashlib.sha256("".join(loss).encode()).hexdigest(),
                     sum(len(chat.render(r, x)[0]) for r, x in turns)))
        for i, (r, x) in enumerate(turns):
            if r == "assistant":
                full.append((c, [chat.render(*t)[0] for t in turns[:i + 1]], x))
    assert rows(chat.read_back(stored)) == sorted(want, key=repr)
    got = chat.expand(stored).collect()
    assert sorted((r["conv_id"] or 0, r["text"], chat.unescape(r["text"][r["loss_start"]:r["loss_end"]])) for r in got) \
        == sorted((c or 0, "".join(p), x) for c, p, x in full)
    spans = {(r["conv_id"], r["example"]): (r["loss_start"], r["loss_end"]) for r in chat.examples(stored).collect()}
    assert spans == {(r["conv_id"], r["example"]): (r["loss_start"], r["loss_end"]) for r in got}


def test_chat_escapes_hide_all_marks():
    for text in ("</s>", "<s>[user] x</s>", "\\", "[\\", "]] ", "<\\/s>"):
        out = chat.escape(text)
        assert chat.unescape(out) == text and not any(m in out for m in ("<s>[", "</s>", "] ", "[INST]"))
        assert chat.parse(chat.render(text, text)[0]) == (text, text)


def test_chat_examples_in_full(spark, edge, monkeypatch):
    """The query reads each reply with its whole context, also in a long conversation."""
    long = [(9, i, ("user", "assistant")[i % 2], f"turn {i} [<\\ " * 5) for i in range(301)]
    df = spark.createDataFrame(TURNS + long, "conv_id long, turn long, role string, text string")
    stored = stage(chat.formatted(df.repartition(3)), "chat")
    assert rows(chat.read_examples(stored)) == rows(chat.read_back(stored))
    pieces = [chat.render(r, x)[0] for _, _, r, x in long]
    batch = (stored.where("conv_id = 9").orderBy("position").select(*chat._STORED)).toArrow().to_batches()
    full = list(chat._full(iter(batch), rest=True))
    assert [t for _, _, t, _, _ in full] == ["".join(pieces[:i + 1]) for i in [*range(1, 301, 2), 300]]
    with pytest.raises(Exception, match="missing before"):  # a context without one of its turns
        chat.read_examples(stored.where("conv_id != 9 OR position != 100")).collect()
    monkeypatch.setattr(chat, "read_back", None)  # not by single turns
    queries.QUERIES["op3_chat"](spark, "/root/testdata/sf0.001").count()


def test_chat_empty(spark, empty):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.formatted(df)).count() == 0


# ------------------------------------------------------------- op4 simhash
def test_simhash_components(edge):
    docs = edge_docs()
    fps = [fingerprint(t) for _, t, *_ in docs]
    want = zip([d[0] for d in docs], [f - (1 << 64) if f >> 63 else f for f in fps],
               components([d[0] for d in docs], fps))
    assert rows(simhash.near_duplicates(edge)) == sorted(want, key=repr)


def test_gray_index_finds_all_links():
    rng = np.random.default_rng(5)
    for n, spread in ((2, 64), (700, 8), (900, 12), (3000, 64)):
        center = rng.integers(0, 1 << 63, dtype=np.uint64)
        flips = [sum(1 << int(b) for b in rng.choice(spread, rng.integers(0, 5), replace=False)) for _ in range(n)]
        fp = np.unique(np.array([int(center) ^ f for f in flips], np.uint64) if spread < 64
                       else rng.integers(0, 1 << 63, n, dtype=np.uint64))
        bucket = np.sort(rng.integers(0, 3, len(fp)))
        label = np.arange(len(fp))
        order = np.lexsort((simhash.gray_rank(fp), bucket))
        fp, bucket = fp[order], bucket[order]
        simhash.GrayIndex(fp, bucket).links(3, label)
        want = np.arange(len(fp))
        i, j = np.nonzero((np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3) & (bucket[:, None] == bucket[None, :]))
        simhash.unite(want, i, j)
        assert label.tolist() == want.tolist()


def test_large_buckets_are_split_without_losing_links(spark, edge, monkeypatch):
    rng = np.random.default_rng(9)
    center = int(rng.integers(0, 1 << 62))
    fps = list({center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False))
                for _ in range(300)} | {int(x) for x in rng.integers(0, 1 << 62, 100)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    monkeypatch.setattr(simhash, "BLOCK", 16)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = dict(tuple(r) for r in cc.components(simhash.links(df)).collect())
    want = components(signed, fps)
    assert [found.get(f, f) for f in signed] == want


def test_components_of_a_long_chain_and_a_star(spark, edge):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 300)] + [(400, 400), (500, 499), (499, 500)]
    got = dict(tuple(r) for r in cc.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}, 499: 499, 500: 499}


def test_simhash_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


# ---------------------------------------------------------- op5 blocknames
@pytest.mark.parametrize("size, weak", [(4096, False), (7, False), (7, True)])
def test_block_names(edge, size, weak):
    docs = edge_docs()
    texts = [t or "" for _, t, *_ in docs]
    n = Counter(texts)
    keep = {t: max((d[0] for d in docs if (d[1] or "") == t and d[0] is not None), default=None) for t in texts}
    want = [(d[0], keep[t], n[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in zip(docs, texts)]
    hash_of = (lambda b: F.length(b).cast("long") % 3) if weak else F.xxhash64
    out = blocknames.duplicates(edge, size, hash_of)
    assert rows(out, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
    kept = out.where("kept").collect()
    assert Counter(r["text_sha256"] for r in kept) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in n)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_blocks_of_long_texts(spark):
    """Every level of the cut, with characters of one to four bytes, and texts of several megabytes."""
    alphabet = "aé字😀"
    long = [n for k in (1, 64, 4096, 262144) for n in (k * 3 - 1, k * 3, k * 3 + 1)]
    texts = ["".join(alphabet[(i * i + n) % 4] for i in range(n)) for n in (0, 1, 2, *long)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", blocknames._blocks(F.col("text"), 3).alias("b")).collect():
        assert r["b"] == ([r["text"][i:i + 3] for i in range(0, len(r["text"]), 3)] or [""])
    huge = spark.range(3).select(F.col("id").alias("doc_id"), F.concat(
        F.repeat(F.lit("abcdefg é"), 900_000), F.when(F.col("id") == 1, "x").otherwise("y")).alias("text"))
    got = {r["doc_id"]: r for r in blocknames.duplicates(huge).collect()}
    assert [got[i]["kept"] for i in range(3)] == [False, True, True] and got[0]["keep_id"] == 2
    assert got[1]["text_sha256"] == hashlib.sha256(("abcdefg é" * 900_000 + "x").encode()).hexdigest()


def test_block_names_empty(empty):
    assert blocknames.duplicates(empty).count() == 0


# ------------------------------------------------------------- op6 quality
def test_quality_counts(edge):
    m = "_measures"
    out = quality.judged(stage(quality.measured(edge, m), "m"), m).select("doc_id", "rank", f"{m}.*")
    got = rows(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for d, t, *_ in edge_docs():
        r = rules(t)
        want.append((d, *r, r[0] < 20 or 100 * r[4] > 30 * r[0]))
    assert got == sorted(want, key=repr)
    assert out.where("kept and base_failed").count() == 0


def _js(a, b):
    p, q = np.array(a, float) / sum(a), np.array(b, float) / sum(b)
    mid = (p + q) / 2
    part = lambda x: sum(v * math.log2(v / w) for v, w in zip(x, mid) if v > 0)
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


def test_quality_distances_and_guards(spark, edge):
    rng = random.Random(2)
    common = quality.COMMON_WORDS["en"]
    prose = lambda n: " ".join(rng.choice(common) if rng.random() < .4 else
                               "".join(rng.choice("aeinrst") for _ in range(6)) for _ in range(n)).capitalize() + "."
    docs = [doc(i, " ".join(prose(9) for _ in range(20))) for i in range(30)]
    docs += [doc(100, " ".join(f"w{rng.randrange(10 ** 6)}$$$" for _ in range(120))),
             doc(101, " ".join(f"w{rng.randrange(10 ** 6)}$$$" for _ in range(120)), None),
             doc(102, " ".join(f"w{rng.randrange(10 ** 6)}$$$" for _ in range(30))),
             doc(103, " ".join("".join(rng.choice("aeinrst") for _ in range(6)) for _ in range(200)))]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r["doc_id"]: r for r in quality.judged(stage(quality.measured(df, "q"), "q"), "q").select("doc_id", "q.*").collect()}
    assert all(got[i]["kept"] for i in range(30))
    assert [got[i]["kept"] for i in (100, 101, 102, 103)] == [False, True, True, False]
    sound = [r for r in got.values() if r["n_words"] >= quality.MIN_WORDS and r["common"] and not r["base_failed"]]
    classes, common = (np.sum([r[k] for r in sound], 0) for k in ("classes", "common"))
    for r in sound:
        assert r["class_distance"] == pytest.approx(_js(r["classes"], classes))
        assert r["word_distance"] == pytest.approx(_js(r["common"], common))
        assert sum(r["common"]) == r["n_words"] and sum(r["classes"]) == r["word_chars"] + r["classes"][0]


def test_quality_empty(empty):
    assert quality.judged(stage(quality.measured(empty), "m")).count() == 0


# -------------------------------------------------------------- op7 kneser
def _plain_kneser(texts):
    """log p of every gram that occurs, by the formulas, from dictionaries."""
    n, s = kneser.ORDER, kneser.SYMBOLS
    c = Counter(g for t in texts for g in kneser.grams([t])[0].tolist())
    orders = [c]
    for k in range(n - 1, 0, -1):
        orders.append(Counter(g % s ** k for g in orders[-1]))

    def prob(g, k):  # k: how many orders below the highest
        if k == n:
            return 1 / s
        own = orders[k]
        each = [own.get(g // s * s + w, 0) for w in range(s)]
        lower = prob(g % s ** (n - k - 1), k + 1)
        if not sum(each):
            return lower
        m = Counter(own.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0
        d = [0.0] + [min(max(i - (i + 1) * y * m[i + 1] / m[i] if m[i] else i / 2, .05), i - .05) for i in (1, 2, 3)]
        taken = [d[min(x, 3)] for x in each]
        return (each[g % s] - taken[g % s]) / sum(each) + sum(taken) / sum(each) * lower

    return lambda g: math.log(prob(g, 0))


def test_kneser_model_is_modified_kneser_ney():
    texts = ["The cat sat on the mat.", "A cat, a hat; the bat sat!", "éà 12 ß"]
    gram = np.concatenate([kneser.grams([t])[0] for t in texts])
    logp = kneser.model(np.bincount(gram, minlength=kneser.GRAMS))
    plain = _plain_kneser(texts)
    probe = np.concatenate([gram, np.random.default_rng(0).integers(0, kneser.GRAMS, 200)])
    assert logp[probe] == pytest.approx([plain(int(g)) for g in probe])
    assert np.exp(logp).reshape(-1, kneser.SYMBOLS).sum(1) == pytest.approx(1)
    joined, n = kneser.grams(texts)
    assert joined.tolist() == gram.tolist() and n.tolist() == [len(t) for t in texts]


def test_kneser_separates_held_out_documents(spark, edge):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["the", "and", "river", "stone", "walks", "over"]) for _ in range(80))
    bad = lambda: "".join(rng.choice("qxzjkvw#$%0") for _ in range(400))
    docs = [doc(i, good(), rng.choice(["en", "xx", None])) for i in range(60)]
    docs += [doc(100 + i, bad(), rng.choice(["en", "xx", None])) for i in range(20)]
    docs += [doc(200, None), doc(201, ""), doc(202, "short #$"), doc(203, bad(), "de"), doc(None, good()), doc(0, good())]
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100, 0), (None, 1), (7, 0)], "doc_id long, quality long")
    out = kneser.classified(spark.createDataFrame(docs, SCHEMA).withColumn("threshold", F.lit(1)), labels).collect()
    assert len(out) == len(docs)
    kept = defaultdict(list)
    for r in out:
        kept[r["doc_id"]].append(r["kept"])
    assert sum(kept[i][0] for i in range(40, 60)) >= 19
    assert not any(kept[100 + i][0] for i in range(20))
    assert all(all(kept[i]) for i in (200, 201, 202, 203))  # guards, and a language without trusted text
    texts = [t for d, t, lang, *_ in docs if d is not None and d < 40 and lang == "en"]
    plain = _plain_kneser(texts)
    one = next(d for d in docs if d[2] == "en" and d[0] == 101 or d[2] == "en" and d[0] is not None and d[0] >= 40 and d[1])
    want = math.exp(-np.mean([plain(int(g)) for g in kneser.grams([one[1]])[0]]))
    assert next(r["perplexity"] for r in out if r["doc_id"] == one[0]) == pytest.approx(want, rel=1e-4)


def test_kneser_without_labels_or_documents(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality long")
    assert all(r["kept"] for r in kneser.classified(edge, none).collect())
    assert kneser.classified(empty, none).count() == 0


# ------------------------------------------------------------- op8 phrases
@pytest.mark.parametrize("chunk", [20_000, 3])
def test_phrases(edge, monkeypatch, chunk):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    out = phrases.without_repeats(edge)
    assert rows(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(removed(edge_docs()), key=repr)


@pytest.mark.parametrize("chunk,hot", [(20_000, 50_000), (20_000, 60), (7, 4), (3, 1)])
def test_phrases_random_overlaps(spark, edge, monkeypatch, chunk, hot):
    """Also with nearly all anchors hot: many shards and shares."""
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "HOT", hot)
    rng = random.Random(11)
    pool = [[f"{a}{rng.randrange(50)}" for _ in range(40)] for a in "abcdefgh"]
    docs = []
    for i in range(120):
        out = []
        for _ in range(rng.randrange(6)):
            part, a = rng.choice(pool), rng.randrange(30)
            out += part[a:a + rng.randrange(10, 25)] + [f"u{rng.randrange(1000)}"] * rng.randrange(3)
        docs.append(doc(rng.randrange(100), " ".join(out)))
    got = phrases.without_repeats(spark.createDataFrame(docs, SCHEMA).repartition(4))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(removed(docs), key=repr)


def test_phrases_hot_anchor_in_every_document(spark, edge, monkeypatch):
    """Six words that all documents share, with the same or other words around them."""
    monkeypatch.setattr(phrases, "HOT", 40)
    rng = random.Random(5)
    docs = [doc(i, " ".join([*(f"l{rng.randrange(3) if i % 3 else i}x{k}" for k in range(8)), "all rights of this text reserved",
                             *(f"r{rng.randrange(3) if i % 3 else i}y{k}" for k in range(8))])) for i in range(300)]
    docs += [doc(None, docs[4][1]), docs[5], docs[5], doc(-1, docs[7][1] + " end")]
    often, hot, stretches = phrases.recurring(spark.createDataFrame(docs, SCHEMA))
    assert hot is not None and stretches > 40
    got = phrases.without_repeats(spark.createDataFrame(docs, SCHEMA).repartition(4))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(removed(docs), key=repr)


def test_phrases_empty(empty):
    assert phrases.without_repeats(empty).count() == 0


# --------------------------------------------------------------- op9 pfair
def test_mixing_lag_and_order(spark, edge):
    rng = random.Random(6)
    docs = [(i if i % 50 else None, rng.choice(["a"] * 6 + ["b", "c", "d", None])) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, source string").withColumn("rank", F.lit("x"))
    shares, rest, size = {"a": 3, "b": 2, "unused": 4}, 5, 4
    out = pfair.mixed(df.repartition(5), shares, rest, size).select("doc_id", "source", "rank", "_mix.*").collect()
    assert sorted((r["doc_id"], r["source"]) for r in out if r["doc_id"] is not None and r["source"]) == \
        sorted((d, s) for d, s in docs if d is not None and s) and len(out) == len(docs)
    blocks = Counter((r["slot"], r["pool"], r["block"]) for r in out)
    slots = sorted(blocks)
    assert [s for s, _, _ in slots] == list(range(len(slots)))
    assert max(blocks.values()) == size
    number, left = Counter(), Counter(p for _, p, _ in slots)
    share = {**shares, pfair.REST: rest}
    for slot, pool, block in slots:  # blocks of a pool in order
        assert block == number[pool]
        number[pool] += 1
    # less than one block from its part, round by round, while all pools have full rounds
    active = [p for p in share if left[p]]
    total = sum(share[p] for p in active)
    full = min(left[p] // share[p] for p in active) * total
    assert full > 2 * total
    done = Counter()
    for t, (_, pool, _) in enumerate(slots[:full], 1):
        done[pool] += 1
        assert all(abs(done[p] - t * share[p] / total) < 1 for p in active)


def test_mixing_empty_and_single(spark, edge, empty):
    assert pfair.mixed(empty, {"a": 1}, 1).count() == 0
    one = spark.createDataFrame([(1, "zzz")], "doc_id long, source string")
    assert one.count() == pfair.mixed(one, {"a": 1}, 2).count() == 1


# ------------------------------------------------------------ op10 packing
def test_packing(edge):
    out = packing.pack(edge, BYTE_BPE, 256, 0).collect()
    docs = edge_docs()
    want = Counter()
    for d, ids in zip(docs, library(BYTE_BPE, [d[1] for d in docs], 0)):
        for s in range(0, len(ids), 256):
            want[d[0], s, len(ids[s:s + 256]), crc(ids[s:s + 256]), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == want
    by = defaultdict(list)
    for r in out:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert sorted(by) == list(range(len(by)))


def test_plan_packs_places_every_length():
    rng = random.Random(8)
    for _ in range(50):
        histogram = Counter(rng.choice([1, 2, 3, 50, 99, 100, rng.randrange(1, 101)]) for _ in range(rng.randrange(400)))
        packs = packing.plan_packs(histogram, 100)
        placed = Counter()
        for lengths, n in packs:
            assert sum(lengths) <= 100 and n > 0
            for length in lengths:
                placed[length] += n
        assert placed == +histogram
    assert packing.plan_packs({}, 100) == []


def test_packing_empty(empty):
    assert packing.pack(empty, BYTE_BPE).count() == 0


def test_words_of_contract():
    assert words("a b\x1cc d\x0be") == ["a b\x1cc", "d", "e"]
