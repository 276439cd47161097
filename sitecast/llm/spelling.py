"""Spelling variant grouping by PartEnum signatures.

Words are counted over all documents. Two words are near if one inserted,
deleted or replaced code point turns one into the other. To find all near pairs
without comparing words pairwise, a word is read as a binary vector: its letter
multiset, one dimension for the k-th copy of each letter. An insertion flips one
dimension and a replacement two, so near words lie within Hamming distance two.

PartEnum: the dimensions are dealt into ``PARTS`` parts, and for a distance of at
most k a word has one signature for each choice of PARTS - k parts, over its
dimensions in them. k flipped dimensions touch k parts at most, so near words
agree in a signature; the signatures are joined by equality and the pairs that
meet are verified. Replacements (k = 2, words of one length) and insertions
(k = 1, lengths one apart) have signatures of their own.

A signature that more than ``HEAVY`` words share (strings over few letters, say)
is split further, exactly: one edit leaves the first or the last half of the
shorter word as it is, so words meet there only by signature and one half.

Verification runs inside the join, so pairs that fail it are never rows: first a
64-bit parity sketch of the multiset (near words differ in two bits at most),
then the edit distance.

Defined results: a null or empty text has no words; a null doc_id is the empty
text in the hash that decides on damage; rows that repeat count each; a word
without a near word has n_near 0 and is its own root; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import LOWER, UPPER, arrow_rows, drop_stored, keyed_text, mix64, store

MIN_CHARS = 7
MIN_COUNT = 2
DAMAGE_MOD = 31
#: A form has at least so many times the word's occurrences.
FORM_RATIO = 10
PARTS = 6
#: Words of one signature above which halves join the key.
HEAVY = 4096
#: Words in one Arrow batch of the signature step.
WORD_ROWS = 20_000


def damaged(run: Column, doc_id: Column) -> Column:
    """The run, without one code point where the crc32 of ``<doc_id>:<run>`` is
    a multiple of DAMAGE_MOD."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "utf-8"))
    cut = (h % F.length(run)).cast("int")
    return F.when(h % DAMAGE_MOD == 0, F.concat(F.substring(run, F.lit(1), cut), F.substring(run, cut + 2, F.length(run)))
                  ).otherwise(run)


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of ``min_chars`` code points or more that occur
    ``min_count`` times or more. Occurrences are summed before the shuffle."""
    # shorter runs cannot give longer words; a match begins where its run begins
    runs = keyed_text(docs, key, text).select(key, F.explode(F.regexp_extract_all(
        text, F.lit(rf"[A-Za-zÀ-ÿ]{{{min_chars},}}"), F.lit(0))).alias("run"))
    words = runs.select(damaged(F.translate("run", UPPER, LOWER), F.col(key)).alias("word"))
    return (words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _dimensions(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every dimension that a word has: the word's number and a 64-bit hash;
    and the lengths of the words."""
    size = np.array([len(w) for w in words], np.int64)
    cps = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((cps, row))
    cps = cps[order]
    new = np.ones(len(cps), bool)
    new[1:] = (cps[1:] != cps[:-1]) | (row[1:] != row[:-1])
    begins = np.flatnonzero(new)
    copy = np.arange(len(cps)) - np.repeat(begins, np.diff(np.append(begins, len(cps))))
    return row, mix64((cps.astype(np.uint64) << np.uint64(32)) | copy.astype(np.uint64)), size


def _sums(values: np.ndarray, row: np.ndarray, n: int, op: np.ufunc) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if len(row):
        begins = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[begins]] = op.reduceat(values, begins)
    return out


def word_signatures(words: list[str], parts: int, flips: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The PartEnum signatures of every word for Hamming distance ``flips``
    (words x choices), the parity sketches and the lengths."""
    row, h, size = _dimensions(words)
    part = (mix64(h, 1) % np.uint64(parts)).astype(np.int64)
    of_part = [_sums(np.where(part == p, h, np.uint64(0)), row, len(words), np.add) for p in range(parts)]
    parity = _sums(np.uint64(1) << (mix64(h, 2) & np.uint64(63)), row, len(words), np.bitwise_xor)
    total = sum(of_part)
    out = [mix64(total - sum(of_part[p] for p in left_out), 8 * flips + c)
           for c, left_out in enumerate(combinations(range(parts), flips))]
    return np.stack(out, axis=1), parity, size


def signature_rows(words: DataFrame, flips: int, parts: int = PARTS) -> DataFrame:
    """sig, word, parity, with one row for each word and signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs, parity, _ = word_signatures(batch.column(0).to_pylist(), parts, flips)
            at = np.repeat(np.arange(len(parity)), sigs.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(sigs.ravel().view(np.int64)), batch.column(0).take(pa.array(at)),
                                              pa.array(parity[at].view(np.int64))], ["sig", "word", "parity"])

    return words.select("word").mapInArrow(run, "sig long, word string, parity long")


def _split_heavy(rows: DataFrame, heavy: DataFrame, shorter: Column) -> DataFrame:
    """Adds ``part``: null for the rows of a common signature, and one row each
    for the first and last half of the ``shorter`` length otherwise."""
    half = F.floor(shorter / 2).cast("int")
    first = F.concat(F.lit("<"), F.substring(F.col("word"), F.lit(1), half))
    last = F.concat(F.lit(">"), F.substring(F.col("word"), F.length("word") - (shorter - half) + 1, shorter))
    marked = rows.join(heavy.select("sig", F.lit(True).alias("heavy")), "sig", "left")
    return marked.withColumn("part", F.explode(F.when(F.col("heavy"), F.array(first, last)).otherwise(
        F.array(F.lit(""))))).drop("heavy")


def _pairs(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    near = (condition & (F.bit_count(F.col("a.parity").bitwiseXOR(F.col("b.parity"))) <= 2)
            & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    return a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.part") == F.col("b.part")) & near).select(
        F.col("a.word").alias("x"), F.col("b.word").alias("y"))


def near_pairs(words: DataFrame, parts: int = PARTS, heavy: int = HEAVY) -> DataFrame:
    """x, y: every pair of near words once."""
    common = lambda rows: store(
        rows.groupBy("sig").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > heavy), "heavy-signatures")
    length = F.length("word")
    # the length that both words of a pair have, or the shorter one's, belongs to the signature
    flat = signature_rows(words, 2, parts).withColumn("sig", F.xxhash64("sig", length))
    flat = _split_heavy(flat, common(flat), length)
    replaced = _pairs(flat, flat, F.col("a.word") < F.col("b.word"))
    step = signature_rows(words, 1, parts)
    short = step.withColumn("sig", F.xxhash64("sig", length))
    long = step.withColumn("sig", F.xxhash64("sig", length - 1))
    often = common(short.unionByName(long))
    inserted = _pairs(_split_heavy(short, often, length), _split_heavy(long, often, length - 1),
                      F.length("a.word") < F.length("b.word"))
    return replaced.unionByName(inserted).distinct()


def variant_forms(words: DataFrame, ratio: int = FORM_RATIO, parts: int = PARTS, heavy: int = HEAVY) -> DataFrame:
    """word, n, n_near, form, form_n of every row of ``words`` (word, n)."""
    spark = words.sparkSession
    with arrow_rows(spark, WORD_ROWS):
        pairs = store(near_pairs(words, parts, heavy), "near-pairs")
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    counts = words.select(F.col("word").alias("y"), F.col("n").alias("y_n"))
    best = (both.join(counts, "y").groupBy(F.col("x").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("y_n")).alias("neg"), F.col("y").alias("form"))).alias("best")))
    has_form = -F.col("best.neg") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, -F.col("best.neg")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word on the way from form to form. Each step
    multiplies n by the ratio at least, so ways are short and have no loop; every
    round joins the ways with themselves and doubles the steps taken."""
    ways = store(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = store(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                           F.col("further").isNotNull().alias("moved")), "ways")
        drop_stored(ways)
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        ways = moved.select("word", "root")
        ways.scratch = moved.scratch


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                      min_count: int = MIN_COUNT, parts: int = PARTS, heavy: int = HEAVY) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the corpus."""
    words = store(count_words(docs, min_chars, min_count, key, text), "words")
    forms = store(variant_forms(words, parts=parts, heavy=heavy), "forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
