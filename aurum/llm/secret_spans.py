"""Secret scan: fixed patterns, and sliding-window entropy per character class.

Pattern kinds are matched leftmost and without overlap.  The entropy kinds look
at candidate strings, the longest runs of one character class.  A window of
``WINDOW`` characters slides over a candidate; the counts of its characters and
the sum of c * log2(c) are kept up by one character in, one out, and Shannon's
entropy is log2(WINDOW) - sum / WINDOW.  A candidate whose best window reaches
its class's threshold is a span, unless the allow-list suppresses it or a
pattern span overlaps it.

All of it is DataFrame functions on one row; a text's spans are as many as it
has matches.  Positions are code points, ends exclusive.  Null texts count as
empty, and have no spans; very long texts and candidates take time in
proportion.  Ties in the start are ordered by kind.  Repeated rows give
repeated rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty

# The contract's patterns.  {14,} and {16,} say the minimum length
# in the pattern itself: a run that fails has no other start that succeeds.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "hex_entropy", "text_entropy")

#: Candidates: class -> (pattern, alphabet in lower case first, least entropy of a window).
CLASSES = {
    "hex_entropy": (r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}(?![0-9A-Fa-f])",
                    "0123456789abcdefABCDEF", 3.0),
    "text_entropy": (r"(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]{20,}",
                     "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 3.9),
}
WINDOW = 20
#: What words, identifiers and paths do not have, in any segment: a digit before a
#: letter, five digits in a row, a capital that neither begins a hump of three
#: letters nor stands in capitals only, a lone letter before a capital, five
#: consonants in a row.
_UNLIKE_WORDS = (r"[0-9][A-Za-z]", r"[0-9]{5}", r"[A-Z][a-z](?![a-z])", r"[A-Z]{2}[a-z]", r"[a-z][A-Z](?![a-z])",
                 r"(?<![A-Za-z])[a-z][A-Z]", r"[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{5}")
#: A candidate that matches one of these, as a whole, is no secret: words,
#: identifiers and paths; numbers; UUIDs; short placeholders that begin or end
#: with a mark; alphabets.
ALLOW = (r"^(?!.*(?:" + "|".join(_UNLIKE_WORDS) + "))", r"^[0-9]+$",
         r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
         r"(?i)^(?=.{1,40}$)(?:(?:example|placeholder|xxxx|0123456789|abcdefgh)[0-9a-z].*"
         r"|.*(?:example(?:key)?|placeholder|xxxx))$",
         r"(?i)^(?:abcdefghijklmnopqrstuvwxyz|0123456789|[+/_=-]){1,8}$")
#: Hexadecimal strings are judged by their own class only.
ALLOW_OF = {"text_entropy": (*ALLOW, r"^[0-9A-Fa-f]+$")}


def _spans(text: Column, pattern: str, kind: str, fits=None) -> Column:
    """array<struct<start, k, end, piece>> of the pattern's matches."""

    def place(found: Column) -> Column:
        def walk(gaps: Column) -> Column:
            state = F.struct(F.lit(0).alias("at"), F.slice(F.array(F.struct(
                F.lit(0).alias("start"), F.lit(0).alias("k"), F.lit(0).alias("end"),
                F.lit("").alias("piece"))), 1, 0).alias("out"))

            def step(s: Column, i: Column) -> Column:
                piece, start = F.get(found, i), s["at"] + F.length(F.get(gaps, i))
                end = start + F.length(piece)
                return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(
                    start.alias("start"), F.lit(KINDS.index(kind)).alias("k"), end.alias("end"),
                    piece.alias("piece")))).alias("out"))

            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), state, step)["out"]

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), walk))

    placed = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    if fits is not None:
        placed = F.filter(placed, lambda s: fits(s["piece"]))
    empty = "array<struct<start:int,k:int,end:int,piece:string>>"
    return F.coalesce(placed.cast(empty), F.array().cast(empty))


def best_entropy(piece: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The largest entropy of a window of ``piece``, in bits per character."""

    def slide(codes: Column) -> Column:
        grows = F.array(*[F.lit(((c + 1) * math.log2(c + 1) if c else 0.0)
                                - (c * math.log2(c) if c else 0.0)) for c in range(window)])

        def step(s: Column, i: Column) -> Column:
            code = F.get(codes, i)
            out = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))
            less = F.transform(s["counts"], lambda c, j: F.when(j == out, c - 1).otherwise(c))
            # one character out, one in; the sum follows the two counts
            gone = F.when(out >= 0, F.get(grows, F.get(s["counts"], out) - 1)).otherwise(0.0)
            held = F.get(s["counts"], code) - F.when(out == code, 1).otherwise(0)
            total = s["sum"] - gone + F.get(grows, held)
            bits = F.when(i >= window - 1, math.log2(window) - total / window).otherwise(-1.0)
            return F.struct(
                F.transform(less, lambda c, j: F.when(j == code, c + 1).otherwise(c)).alias("counts"),
                total.alias("sum"), F.greatest(s["best"], bits).alias("best"))

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), F.struct(
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
            F.lit(-1.0).alias("best")), step)["best"]

    codes = F.transform(F.split(piece, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    return let(F.filter(codes, lambda c: c >= 0), slide)


def _secret(kind: str):
    _, alphabet, least = CLASSES[kind]

    def fits(piece: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOW_OF.get(kind, ALLOW):
            allowed = allowed | piece.rlike(pattern)
        return F.when(allowed, F.lit(False)).otherwise(best_entropy(piece, alphabet) >= least)

    return fits


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of the patterns) and more (spans of the method):
    arrays of (start, k, end, piece), k the index into ``KINDS``."""
    text = text_or_empty()
    base = F.concat(
        _spans(text, ASSIGN, "assign", lambda p: F.length(F.regexp_extract(p, ASSIGN, 2)) >= 12),
        _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))
    more = F.concat(*[_spans(text, CLASSES[k][0], k, _secret(k)) for k in CLASSES])

    def both(b: Column) -> Column:
        clear = F.filter(more, lambda s: ~F.exists(b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))
        return F.struct(F.sort_array(b).alias("base"), F.sort_array(clear).alias("more"))

    return docs.select("doc_id", let(base, both).alias("s")).select("doc_id", "s.base", "s.more")


def digest(spans: DataFrame) -> DataFrame:
    """The contract's columns: counts, hash of the base spans, all spans."""
    kinds = F.array(*map(F.lit, KINDS))

    def joined(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(
            ":", F.get(kinds, x["k"]), x["start"], x["end"])), ",")

    count = lambda k: F.size(F.filter("base", lambda s: s["k"] == k)).cast("long")
    return spans.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("base", "more"))).alias("spans"))
