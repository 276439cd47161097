"""Reversed lexical search: the queries are indexed, the documents stream by.

The items form a stated query set. They are taken in blocks of at most
``BLOCK_TERMS`` postings, which bounds every broadcast. For each block:

1. one pass over the documents counts, in each task, the documents that hold
   each of the block's terms (and once for all blocks N and L); the counts of
   the tasks are summed by Spark;
2. the inverted index of the block (term, then the items that hold it, and the
   term's weight) is broadcast, and a second pass sends each document's term
   counts through it. A task keeps a bounded heap of the best ``top``
   documents of every item, as arrays;
3. the heaps of all tasks are merged by a top-k window.

No document leaves its task, and what is shuffled is at most ``top`` rows for
each item and task.

The score is the contract's integer formula. Sums of up to 2^53 are exact in
the doubles that add them up; n * N is computed without a bound.

Defined results: a null or empty text has no term and no score; every row is a
document of its own, so rows that repeat a doc_id are ranked each; equal scores
rank by ascending doc_id (a null doc_id last); items that share an item_id are
one item with the terms of all of them; an item without terms or hits has no
row; a null item_id is an id of its own; extra columns are ignored; texts of any
length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.llm.common import keyed_text, mix64, rolling_hashes, ship, sub_batches

TOP = 10
#: Postings (item, term) of one block of items.
BLOCK_TERMS = 1 << 18
#: Cells of the score matrix (documents times items) computed at a time.
MAX_CELLS = 1 << 21
#: Stands for a null doc_id inside the arrays: it ranks last among equal scores.
NO_ID = np.iinfo(np.int64).max
#: Row of the statistics that holds N and L.
TOTALS = -1

_IS_TERM = np.zeros(256, bool)  # bytes of the characters that terms are made of
_IS_TERM[48:58] = _IS_TERM[65:91] = _IS_TERM[97:123] = _IS_TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the terms of all texts in ``data``, in order, and the
    number of the text that each belongs to."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_TERM[data]
    edge = inside.copy()
    edge[1:] ^= inside[:-1]
    first = np.zeros(len(data) + 1, bool)  # a text's first byte ends what the text before left open
    first[bounds] = True
    opens = inside & (edge | first)
    closes = np.zeros(len(data) + 1, bool)
    closes[1:] = inside[:-1] & (~inside[1:] | first[1:])
    s, e = np.flatnonzero(opens), np.flatnonzero(closes)
    h = mix64(rolling_hashes(_LOWER[data], s, e) + (e - s).astype(np.uint64))
    return h, np.searchsorted(bounds, s, side="right") - 1


class Index:
    """Inverted index over one block of items: ``terms`` (sorted hashes), and
    for term t the items ``items[starts[t]:starts[t + 1]]``."""

    def __init__(self, block: list[tuple[int | None, str]]):
        ids = {i: n for n, i in enumerate(dict.fromkeys(i for i, _ in block))}
        self.ids = list(ids)
        raw = [t.encode() for _, t in block]
        bounds = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
        h, row = term_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds)
        self.terms, at = np.unique(h, return_inverse=True)
        item = np.array([ids[i] for i, _ in block], np.int64)[row]
        pairs = np.unique(at.astype(np.int64) * len(self.ids) + item)  # each term once an item
        self.items = pairs % max(1, len(self.ids))
        self.starts = np.searchsorted(pairs // max(1, len(self.ids)), np.arange(len(self.terms) + 1))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that hold a term of the block, and those terms."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.terms, h)
        at[at == len(self.terms)] = 0
        hit = np.flatnonzero(self.terms[at] == h)
        return hit, at[hit]


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factors(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with n terms; products beyond 64 bits are taken exactly."""
    sizes, at = np.unique(n, return_inverse=True)
    return np.array([10 + 90 * int(x) * n_docs // n_terms for x in sizes], np.int64)[at]


class Heaps:
    """The best ``top`` (score, id) of every item, highest scores and then
    smallest ids first."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.item = self.id = self.score = np.zeros(0, np.int64)
        self.least = np.zeros(n_items, np.int64)  # score that a full heap asks for

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = (score > 0) & (score >= self.least[item])
        if not good.any():
            return
        item, doc, score = (np.concatenate([a, b[good]]) for a, b in (
            (self.item, item), (self.id, doc), (self.score, score)))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        begins = np.searchsorted(item, np.arange(len(self.least)))
        place = np.arange(len(item)) - begins[item]
        kept = place < self.top
        self.item, self.id, self.score = item[kept], doc[kept], score[kept]
        last = place == self.top - 1
        self.least[item[last]] = score[last]


def score_documents(index: Index, weights: np.ndarray, n_docs: int, n_terms: int, heaps: Heaps,
                    ids: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> None:
    """Add the scores of some documents to the heaps."""
    h, doc = term_hashes(data, bounds)
    n = np.bincount(doc, minlength=len(ids))
    place, term = index.find(h)
    if not len(place):
        return
    cells, tf = np.unique(doc[place] * len(index.terms) + term, return_counts=True)
    doc, term = cells // len(index.terms), cells % len(index.terms)
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length_factors(n, n_docs, n_terms)[doc]))
    # a few documents at a time: the score matrix stays bounded
    n_items = len(index.ids)
    step = max(1, MAX_CELLS // n_items)
    for lo in range(0, len(ids), step):
        a, b = np.searchsorted(doc, (lo, lo + step))
        if a == b:
            continue
        size = index.starts[term[a:b] + 1] - index.starts[term[a:b]]
        ends = np.cumsum(size)
        post = np.arange(ends[-1]) - np.repeat(ends - size - index.starts[term[a:b]], size)
        rows = min(step, len(ids) - lo)
        total = np.bincount(np.repeat(doc[a:b] - lo, size) * n_items + index.items[post],
                            weights=np.repeat(part[a:b], size).astype(np.float64), minlength=rows * n_items)
        cell = np.flatnonzero(total > np.tile(np.maximum(heaps.least - 1, 0), rows))
        heaps.add(cell % n_items, ids[lo + cell // n_items], total[cell].astype(np.int64))


def item_blocks(items: DataFrame, key: str, text: str, block_terms: int) -> Iterator[list[tuple[int | None, str]]]:
    """The query set in blocks, one at a time on the driver; the rows of one
    item_id share a block."""
    rows = items.select(F.col(key).cast("long").alias(key), text).where(F.length(text) > 0).orderBy(key)
    block: list[tuple[int | None, str]] = []
    held, last = 0, None
    for item, words in rows.toLocalIterator():
        if held >= block_terms and item != last:
            yield block
            block, held = [], 0
        block.append((item, words))
        held += 1 + len(words) // 2  # terms at most
        last = item
    if block:
        yield block


def _statistics(rows: DataFrame, shared) -> dict[int, tuple[int, int]]:
    """By term of the block: the number of documents that hold it; N and L
    under ``TOTALS``. Collected: one row a term of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        df = np.zeros(len(index.terms), np.int64)
        n_docs = n_terms = 0
        for part, data, bounds in sub_batches(batches):
            h, doc = term_hashes(data, bounds)
            n_docs += len(np.unique(doc))
            n_terms += len(h)
            place, term = index.find(h)
            df += np.bincount(np.unique(doc[place] * max(1, len(df)) + term) % max(1, len(df)), minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, TOTALS)), pa.array(np.append(df[at], n_docs)),
                                          pa.array(np.append(np.zeros(len(at), np.int64), n_terms))], ["term", "df", "n"])

    counted = rows.mapInArrow(run, "term long, df long, n long").groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("n"))
    return {r[0]: (r[1], r[2]) for r in counted.collect()}


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, key: str = "doc_id",
           text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_key, rank (int, from 1), key, score (long): the best ``top``
    documents of every item."""
    spark = docs.sparkSession
    ship(spark)
    rows = keyed_text(docs, key, text)
    out = None
    for block in item_blocks(items, item_key, item_text, block_terms):
        part = _search_block(rows, Index(block), top, key, item_key)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"{item_key} long, rank int, {key} long, score long")
    best = Window.partitionBy(item_key).orderBy(F.desc("score"), F.asc_nulls_last(key))
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select(item_key, "rank", key, "score"))


def _search_block(rows: DataFrame, index: Index, top: int, key: str, item_key: str) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(index)  # BLOCK_TERMS postings at most, but for one larger item
    stats = _statistics(rows, shared)
    n_docs, n_terms = stats.pop(TOTALS, (0, 0))
    weights = np.zeros(len(index.terms), np.int64)
    for term, (df, _) in stats.items():
        weights[term] = term_weight(n_docs, df)
    model = spark.sparkContext.broadcast((weights, n_docs, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        heaps = Heaps(len(known.ids), top)
        for part, data, bounds in sub_batches(batches):
            ids = part.column(0).fill_null(NO_ID).to_numpy()
            score_documents(known, *model.value, heaps, ids, data, bounds)
        names = pa.array(known.ids, pa.int64())
        yield pa.RecordBatch.from_arrays([names.take(pa.array(heaps.item)), pa.array(heaps.id, mask=heaps.id == NO_ID),
                                          pa.array(heaps.score)], [item_key, key, "score"])

    return rows.mapInArrow(run, f"{item_key} long, {key} long, score long")
