"""Quality rules by distribution divergence, in DataFrame functions only.

Each document's histograms of character classes and of its language's common
words are compared with language references by the Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1). The references are the summed
histograms of all documents of the language. Base rules come first: a document
with fewer than ``min_words`` words, or whose repeated 3-word windows cover more
than half of its words, fails.

Guards: the character verdict needs ``min_chars`` characters, the word verdict
``min_common_words`` words and a language with a common-word list; a document
below a guard is judged by the rest.

Defined results: a null text has no words and fails the base rules; a language
that is null or has no document that passes the base rules is compared with the
reference of all languages, and one without a word list on characters alone;
documents without a source are a source of their own; repeated rows are judged each; a null id is kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import SPACE, store

#: Common words of the languages with a list.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on",
           "this", "are", "from", "at"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem",
           "nicht", "ein", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans",
           "par", "sur", "pas", "au", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no",
           "una", "su", "al", "es"],
}
SYMBOLS = "#*$%&|<>"
CLASSES = ("upper", "other_letters", "digits", "symbols", "rest", "space")
WORD_BINS = 21  # twenty common words and all others
#: Language references are broadcast up to this number, and joined beyond it.
BROADCAST_LANGUAGES = 4096

MIN_WORDS = 50
MIN_CHARS = 200
MIN_COMMON_WORDS = 100
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.285


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more. Equal windows are
    neighbours in a sorted array, so long texts cost n log n."""
    def of_sorted(s: Column) -> Column:
        near = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        places = F.flatten(F.transform(near, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
        return F.size(F.array_distinct(places))

    def windows(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        bind(windows(F.size(words)), lambda w: F.when(
            F.size(F.array_distinct(F.transform(w, lambda x: x["h"]))) == F.size(w), F.lit(0)).otherwise(
            bind(F.sort_array(w), of_sorted))))


def word_list(lang: Column) -> Column:
    out = F.when(F.lit(False), F.array(F.lit("")))
    for code, words in COMMON_WORDS.items():
        out = out.when(lang == code, F.array(*[F.lit(w) for w in words]))
    return out


def measures(text: Column, lang: Column) -> Column:
    """One struct of all counts of a document."""
    clean = F.coalesce(text, F.lit(""))

    def by_words(w: Column) -> list[Column]:
        def histogram(common: Column) -> Column:
            return bind(F.filter(w, lambda x: F.array_contains(common, x)), lambda hits: F.concat(
                F.transform(common, lambda c: F.size(F.filter(hits, lambda x: x == c)).cast("long")),
                F.array((F.size(w) - F.size(hits)).cast("long"))))
        return [F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"),
                bind(word_list(lang), lambda c: F.when(c.isNotNull(), histogram(c))).alias("word_bins")]

    def by_chars(rest: Column) -> list[Column]:
        def counts(marks: Column) -> Column:
            symbols = F.length(marks) - F.length(F.translate(marks, SYMBOLS, ""))
            digits = F.length(marks) - F.length(F.regexp_replace(marks, r"[0-9]+", ""))
            upper = F.length(clean) - F.length(F.regexp_replace(clean, r"\p{Lu}+", ""))
            parts = [upper, F.length(clean) - F.length(rest) - upper, digits, symbols,
                     F.length(marks) - digits - symbols, F.length(rest) - F.length(marks)]
            return F.array(*[p.cast("long") for p in parts])
        return bind(F.regexp_replace(rest, SPACE + "+", ""), counts)

    lines = F.filter(F.split(clean, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    words = F.filter(F.split(clean, SPACE + "+", -1), lambda x: x != "")
    return F.struct(
        bind(words, lambda w: F.struct(*by_words(w))).alias("w"),
        bind(F.regexp_replace(clean, r"\p{L}+", ""), by_chars).alias("char_bins"),
        dup_lines.cast("long").alias("n_dup_lines"))


def base_failed() -> Column:
    words = F.col("m.w.n_words")
    return (words < MIN_WORDS) | (100 * F.col("m.w.n_repeat_words") > 50 * words)


def references(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ref_lang, char_ref, word_ref) of every language, and one row (char_ref)
    for all of them."""
    def shares(name: str, n: int) -> Column:
        total = F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.array(*[F.avg(F.get(F.col(name), F.lit(i)) / total) for i in range(n)])

    def means(name: str, n: int) -> Column:
        return F.array(*[F.avg(F.get(F.col(name), F.lit(i))) for i in range(n)]).alias(name)

    sources = measured.where(~base_failed()).groupBy("lang", "source").agg(
        shares("m.char_bins", len(CLASSES)).alias("char_ref"), shares("m.w.word_bins", WORD_BINS).alias("word_ref"))
    sources = store(sources, "source-references")
    own = (sources.where("lang IS NOT NULL").groupBy(F.col("lang").alias("ref_lang"))
           .agg(means("char_ref", len(CLASSES)), means("word_ref", WORD_BINS)))
    return own, sources.agg(means("char_ref", len(CLASSES)))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms with the same bins; null if
    either is empty."""
    def total(h: Column) -> Column:
        return F.aggregate(h, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0)))

    def half(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    def distance(t: Column) -> Column:
        parts = F.zip_with(counts, reference, lambda c, r: bind(
            F.struct((c / t["a"]).alias("p"), (r / t["b"]).alias("q")),
            lambda x: half(x["p"], x["q"]) + half(x["q"], x["p"])))
        return F.sqrt(F.greatest(F.lit(0.0), total(parts) / 2))

    return bind(F.struct(total(counts).alias("a"), total(reference).alias("b")),
                lambda t: F.when((t["a"] > 0) & (t["b"] > 0), distance(t)))


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", *keep: str, source: str = "source") -> DataFrame:
    """The columns ``keep`` in a struct ``row``, ``lang``, ``source`` (null if the
    table has none) and the counts ``m``."""
    row = F.struct(*[docs[k] for k in keep]).alias("row")
    origin = docs[source] if source in docs.columns else F.lit(None).cast("string")
    return docs.select(row, docs[lang].alias("lang"), origin.alias("source"), measures(docs[text], docs[lang]).alias("m"))


def judge(measured: DataFrame) -> DataFrame:
    """Adds char_distance, word_distance, base_failed and kept."""
    own, everything = references(measured)
    own = store(own, "language-references")
    few = own.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    rows = (measured.join(F.broadcast(own) if few else own, F.col("lang") == F.col("ref_lang"), "left")
            .withColumn("all_ref", everything.scalar()))
    words = F.col("m.w.n_words")
    chars = F.aggregate("m.char_bins", F.lit(0).cast("long"), lambda a, x: a + x)
    out = rows.select(
        "row", "m", base_failed().alias("base_failed"),
        F.when(chars >= MIN_CHARS, js_distance(F.col("m.char_bins"), F.coalesce("char_ref", "all_ref")))
        .alias("char_distance"),
        F.when(words >= MIN_COMMON_WORDS, js_distance(F.col("m.w.word_bins"), F.col("word_ref")))
        .alias("word_distance"))
    far = (F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False))
           | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, char_distance, word_distance of every row."""
    measured = store(measure(docs, text, lang, key), "quality")
    bins = F.col("m.char_bins")
    return judge(measured).select(
        F.col(f"row.{key}").alias(key), F.col("m.w.n_words").alias("n_words"),
        (F.get(bins, F.lit(0)) + F.get(bins, F.lit(1)) + F.get(bins, F.lit(2)) + F.get(bins, F.lit(3))
         + F.get(bins, F.lit(4))).alias("word_chars"),
        F.get(bins, F.lit(3)).alias("n_symbols"), F.col("m.n_dup_lines").alias("n_dup_lines"),
        F.col("m.w.n_repeat_words").alias("n_repeat_words"), "base_failed", "kept", "char_distance", "word_distance")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that pass, whole and with all their columns."""
    measured = store(measure(docs, text, lang, *docs.columns), "quality")
    return judge(measured).where("kept").select("row.*")
