"""Quality rules: counts per document and divergence from the language.

Base counts and the repeated eight-word windows are computed per document by
higher-order functions, without exploding words.  The method compares two
histograms of a document with those of its language, by Jensen-Shannon distance
(base 2, so from 0 to 1): character classes, and common words of the language.
The references are the sums of both histograms over all documents of the
language that pass the base rule and the minimum length; there is one row for
each language that has a word list, so they are broadcast.

Guards: a document with fewer than ``min_words`` words, or of a language
without a word list (or null), is judged by the base rule only.  Null text has
no words and fails.  Ties, repeated rows and extra columns change nothing; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, let, text_or_empty, words_of

# Common function words of the languages with references.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "ist", "im", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con"],
}
#: Longest Jensen-Shannon distance from the language that is still kept.
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.312
MIN_WORDS = 50
WINDOW = 8  # a power of two
CLASSES = ("blanks", "capitals", "digits", "punctuation", "symbols", "others")


def _count(text: Column, others: str) -> Column:
    """Characters that do not match the negated class ``others``."""
    return F.length(F.regexp_replace(text, others, ""))


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in windows found twice or more in the text, the first one included."""

    def covered(starts: Column) -> Column:
        # each start covers its window, less what the next start covers as well
        return F.aggregate(starts, F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("at")),
                           lambda s, i: F.struct(
                               (s["sum"] + F.least(F.lit(WINDOW), i - s["at"])).alias("sum"),
                               i.alias("at")))["sum"]

    def starts(pairs: Column) -> Column:
        def same(j: Column, k: Column) -> Column:  # equal hashes, and then equal words
            a, b = F.get(pairs, j), F.get(pairs, k)
            return F.when(a["h"] == b["h"], F.slice(words, a["i"] + 1, WINDOW)
                          == F.slice(words, b["i"] + 1, WINDOW)).otherwise(F.lit(False))
        twice = F.filter(F.transform(pairs, lambda p, j: F.when(
            F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
            p["i"])), lambda i: i.isNotNull())
        return F.sort_array(twice)

    def check(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(pairs, lambda p: covered(starts(p))))

    def doubled(each: Column, step: int) -> Column:
        # hash of 2 * step words from two hashes of step words
        return let(F.transform(each, lambda h, i: F.xxhash64(h, F.get(each, i + step))),
                   (lambda x: doubled(x, 2 * step)) if 2 * step < WINDOW else windows)

    def windows(each: Column) -> Column:
        return F.slice(each, F.lit(1), n - (WINDOW - 1))

    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda each: doubled(each, 1))
    return F.when(n < WINDOW, F.lit(0)).otherwise(let(hashes, check))


def _tally(words: Column, common: list[str]) -> Column:
    """Counts of each of ``common``, then of all other words."""
    def counts(found: Column) -> Column:
        def of(c: str) -> Column:
            return F.size(F.filter(found, lambda w: w == c)).cast("long")
        return F.array(*map(of, common), (F.size(words) - F.size(found)).cast("long"))

    longest = max(map(len, common))
    short = F.transform(F.filter(words, lambda w: F.length(w) <= longest), F.lower)
    return let(F.filter(short, lambda w: w.isin(common)), counts)


def _common(words: Column, lang: Column) -> Column:
    """The tally for the document's language, null for other languages."""
    out = F.lit(None).cast("array<long>")
    for code, common in COMMON_WORDS.items():
        out = F.when(lang == code, _tally(words, common)).otherwise(out)
    return out


def measures(text: Column, lang: Column) -> Column:
    """A struct with the base counts and both histograms of a text."""

    def of(words: Column) -> Column:
        n = F.size(words)
        chars = F.length(F.array_join(words, ""))
        lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.regexp_replace(x, BLANKS, "")) > 0)
        symbols = _count(text, r"[^#*$%&|<>]+")
        upper, digits, marks = (_count(text, p) for p in (r"[^\p{Lu}]+", r"[^0-9]+", r"[^.,;:!?]+"))
        classes = [F.length(text) - chars, upper, digits, marks, symbols]  # as CLASSES
        return F.struct(
            n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(words, n).cast("long").alias("n_repeat_words"),
            F.array(*[x.cast("long") for x in (*classes, F.length(text) - sum(classes, F.lit(0)))]).alias("classes"),
            _common(words, lang).alias("common"))

    return let(words_of(text), of)


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms, null if one is empty."""
    def part(x: Column, mid: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mid) / 2).otherwise(0.0)

    def of(totals: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda a, b: let(
            F.struct((a / totals["n"]).alias("p"), (b / totals["m"]).alias("q")),
            lambda x: part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)))
        return F.when((totals["n"] > 0) & (totals["m"] > 0),
                      F.sqrt(F.greatest(_total(terms), F.lit(0.0))))

    return let(F.struct(_total(counts).alias("n"), _total(reference).alias("m")), of)


def measured(docs: DataFrame, name: str = "_measures") -> DataFrame:
    """``docs`` (text, lang) with the struct of measures as a further column."""
    return docs.withColumn(name, measures(text_or_empty(), F.col("lang")))


def judged(docs: DataFrame, name: str = "_measures") -> DataFrame:
    """``docs`` with base_failed, class_distance, word_distance and kept inside
    the struct ``name``.  ``docs`` is read twice, so stage it before."""
    m = F.col(name)
    failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    languages = list(COMMON_WORDS)
    sound = docs.where(~failed & (m["n_words"] >= MIN_WORDS) & F.col("lang").isin(languages))

    def sums(column: Column, n: int) -> Column:
        return F.array(*[F.coalesce(F.sum(F.get(column, F.lit(i))), F.lit(0)) for i in range(n)])

    # one row for each language with a word list
    reference = sound.groupBy(F.col("lang").alias("_lang")).agg(
        sums(m["classes"], len(CLASSES)).alias("_classes"),
        sums(m["common"], 1 + max(map(len, COMMON_WORDS.values()))).alias("_common"))
    near = docs.join(F.broadcast(reference), F.col("lang") == F.col("_lang"), "left")
    size = F.size(m["common"])
    by_class = _distance(m["classes"], F.col("_classes"))
    by_word = _distance(m["common"], F.slice("_common", F.lit(1), F.greatest(size, F.lit(1))))
    guarded = m["n_words"] >= MIN_WORDS
    out = near.withColumn(name, m.withField("base_failed", failed)
                          .withField("class_distance", F.when(guarded, by_class))
                          .withField("word_distance", F.when(guarded, by_word)))
    m = F.col(name)
    far = (F.coalesce(m["class_distance"] > MAX_CLASS_DISTANCE, F.lit(False))
           | F.coalesce(m["word_distance"] > MAX_WORD_DISTANCE, F.lit(False)))
    return out.withColumn(name, m.withField("kept", ~m["base_failed"] & ~far)).drop(
        "_lang", "_classes", "_common")
