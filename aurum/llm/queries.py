"""The dealt operators as queries ``opN_<name>`` over the driver's tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir, prepare, scratch_root
from . import blocknames, chat, collocations, ngrams, packing, pfair, phrases, quality, repair, secret_spans, simhash, trie, urls
from .common import read_table, ship, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(prepare(spark)), sf_dir)
    QUERIES[fn.__name__] = run
    return run


@query
def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the compressed file, read it back."""
    scratch_root(spark)
    path = fresh_dir(spark, "llm-tokens")
    repair.write(read_table(spark, sf_dir, "documents"), path,
                 public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return repair.documents(repair.read(spark, path))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and entropy spans of all documents."""
    return secret_spans.digest(secret_spans.find(read_table(spark, sf_dir, "documents")))


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and the control-string one, store, read every example in full."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    stored = stage(chat.formatted(turns.unionByName(extra)), "chat")
    return chat.read_examples(stored)


def _escaped(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for c in "<[]":
        out = f"replace({out}, '{c}', '{c}' || chr(92))"
    return out


ORACLES["op3_chat"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                           (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(10 + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), 3, 3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query
def op5_blocknames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity classes of all documents."""
    return blocknames.duplicates(read_table(spark, sf_dir, "documents")).drop("rid")


ORACLES["op5_blocknames"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and divergence from the language for all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    m = stage(quality.measured(docs).drop("text"), "measures")
    return quality.judged(m).select(
        "doc_id", *[f"_measures.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                               "n_repeat_words", "base_failed", "kept")])


@query
def op7_kneser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under models of all trusted ones."""
    return ngrams.classified(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op8_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove passages that a document with a smaller id has as well."""
    return phrases.without_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


ORACLES["op8_phrases"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
        FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
bad AS (SELECT DISTINCT r, i + k AS p
        FROM win JOIN first USING (g), unnest(range(0, 13)) AS u(k) WHERE m < doc_id),
gone AS (SELECT r, list(p) AS ps FROM bad GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
         list_transform(list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(ps, p)), lambda p: w[p]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)"""


#: Target shares of the sources, in blocks per round; all others share the rest.
SHARES = {"src0": 5, "src1": 3, "src2": 3, "src3": 2, "src4": 2}
REST_SHARE = 9
BLOCK_DOCS = 8


@query
def op9_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mixed(docs, SHARES, REST_SHARE, BLOCK_DOCS).select("doc_id", "source", "_mix.*")


_SHARE_ROWS = ", ".join(f"('{s}', {n})" for s, n in {**SHARES, pfair.REST: REST_SHARE}.items())
ORACLES["op9_pfair"] = f"""
WITH RECURSIVE shares(pool, share) AS (VALUES {_SHARE_ROWS}),
d AS (SELECT doc_id, source, coalesce(pool, '{pfair.REST}') AS pool
      FROM documents LEFT JOIN shares ON source = pool),
numbered AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY doc_id % {pfair.BUCKETS}, doc_id) - 1 AS rank
             FROM d),
pools AS (SELECT pool, share, ceil(count(*) / {BLOCK_DOCS}::DOUBLE)::BIGINT AS blocks,
                 row_number() OVER (ORDER BY pool) AS i
          FROM d JOIN shares USING (pool) GROUP BY pool, share),
p AS (SELECT list(pool ORDER BY i) AS pool, list(share ORDER BY i) AS share, list(blocks ORDER BY i) AS blocks
      FROM pools),
run AS (  -- one row a slot: the round, the slot in it, blocks placed in it by each pool
  SELECT 0::BIGINT AS slot, 0::BIGINT AS round, 0::BIGINT AS t,
         list_transform(pool, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS pk, NULL::BIGINT AS k FROM p
  UNION ALL
  SELECT slot + 1, if(full_round, round + 1, round), if(full_round, 0, t + 1),
         if(full_round, list_transform(done, lambda x: 0::BIGINT),
            list_transform(done, lambda x, j: if(j = pick, x + 1, x))), pick, round * share[pick] + done[pick]
  FROM (
    SELECT *, t + 1 = total AS full_round,
      list_min(list_filter(list_transform(a, lambda x, j: if(done[j] < x AND (done[j] * total) // x <= t,
        {{'due': ((done[j] + 1) * total + x - 1) // x, 'j': j}}, NULL)), lambda x: x IS NOT NULL))['j'] AS pick
    FROM (SELECT *, list_sum(a)::BIGINT AS total
          FROM (SELECT run.slot, round, t, done, share, blocks,
                  list_transform(blocks, lambda b, j: greatest(0, least(share[j], b - round * share[j]))) AS a
                FROM run, p))
    WHERE total > 0)),
placed AS (SELECT pool[pk] AS pool, k AS block, slot - 1 AS slot FROM run, p WHERE pk IS NOT NULL)
SELECT doc_id, source, pool, block, slot, (rank % {BLOCK_DOCS})::BIGINT AS in_block
FROM (SELECT *, rank // {BLOCK_DOCS} AS block FROM numbered) JOIN placed USING (pool, block)"""


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 ids."""
    return packing.pack(read_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), 1024, 0)


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of all documents."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLES["op13_collocations"] = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
f AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f
      FROM w, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 10),
parts AS (SELECT lang, k, g, a, h, g[1:h] AS g1, g[h + 1:k] AS g2
          FROM (SELECT *, unnest(range(1, k)) AS h FROM c)),
cut AS (SELECT parts.lang, parts.k, parts.g, a, x.f AS l, y.f AS r, h,
               (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM parts JOIN f AS x ON x.lang = parts.lang AND x.g = g1 JOIN f AS y ON y.lang = parts.lang AND y.g = g2),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, h) = 1),
gone AS (SELECT DISTINCT x.lang, x.g FROM c AS x
         JOIN (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS g FROM c WHERE k = 3) AS y
           ON x.lang = y.lang AND x.g = y.g WHERE 100 * y.a >= 50 * x.a),
kept AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score, k
         FROM worst ANTI JOIN gone USING (lang, g))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score, k AS words
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000"""


#: (verdict, host, path)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query
def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url; words are those of all documents."""
    return urls.judged(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"), URL_RULES)


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt to share heads."""
    return trie.prefix_trie(*trie.rebuilt(trie.turns(read_table(spark, sf_dir, "conversations"))))


ORACLES["op12_trie"] = """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d,
                  sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
                  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS b,
          (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                           lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda v, z: if(v % 2 = 1, xor(v // 2, 3988292384), v // 2))), 4294967295) % 4)::BIGINT AS h
        FROM (SELECT DISTINCT c FROM t)),
len AS (SELECT c AS b, count(*) AS n FROM t GROUP BY c),
k AS (SELECT c, b, h, least(h, coalesce(n, 0)) AS k FROM ids LEFT JOIN len USING (b)),
r AS (SELECT k.c, t.d, t.g, t.w FROM k JOIN t ON t.c = k.b AND t.d <= k.k
      UNION ALL SELECT k.c, k.k + t.d - k.h, t.g, t.w FROM k JOIN t ON t.c = k.c AND t.d > k.h),
p AS (SELECT c, d, w, sha256(string_agg(g, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM r
      UNION ALL SELECT c, 0, 0, '' FROM ids),
size AS (SELECT c, max(d) AS n FROM p GROUP BY c),
nodes AS (SELECT node, d, min(c) AS c, count(*) AS n, max(w) AS w,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size.n), '')) AS ends
          FROM p JOIN size USING (c) GROUP BY node, d),
up AS (SELECT x.node, y.c, y.d FROM nodes AS x JOIN p ON p.c = x.c AND p.d = x.d - 1 JOIN nodes AS y ON y.node = p.node AND y.d = p.d),
kids AS (SELECT c, d, count(*) AS n FROM up GROUP BY c, d),
sub AS (SELECT y.c, y.d, count(*) FILTER (kids.n IS NULL) AS leaves, sum((x.n - 1) * x.w)::BIGINT AS saved
        FROM nodes AS x LEFT JOIN kids ON kids.c = x.c AND kids.d = x.d
        JOIN p ON p.c = x.c AND p.d <= x.d JOIN nodes AS y ON y.node = p.node AND y.d = p.d GROUP BY y.c, y.d)
SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, ends AS ends_sha256
FROM nodes LEFT JOIN up ON up.node = nodes.node LEFT JOIN kids ON kids.c = nodes.c AND kids.d = nodes.d
JOIN sub ON sub.c = nodes.c AND sub.d = nodes.d"""
