"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised (lower case, white space runs to one blank). A test item of
length m may occur with up to k = m // BUDGET_CHARS edits. It is split into
k + 1 pieces: an occurrence with k edits leaves one piece whole, so every
occurrence holds an exact piece. One pass of a multi-pattern automaton over the
document finds all piece hits, hits on neighbouring diagonals are merged, and
Myers' bit-parallel algorithm finds the least edit distance of the item to any
substring of the window around them.

Test items form a stated query set: they are handled in blocks of at most
``BLOCK_BYTES`` of text, which bounds the broadcast, and all documents are read
once for each block. No document is shuffled before it has a hit.

Defined results: a null or empty text has no hit; a null or empty item matches
nothing; equal items are reported each, under their own ids; rows of documents
that repeat give repeated hits, which are returned once for each (doc_id, item_id)
with the smallest distance; a null doc_id is kept; extra columns are ignored; a
document of any length is searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import keyed_text, ship

#: One edit is allowed for each so many characters of an item.
BUDGET_CHARS = 14
#: Normalised text of one block of test items.
BLOCK_BYTES = 8 << 20


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into edits + 1 parts of even length, with their places."""
    cuts = [len(item) * j // (edits + 1) for j in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def char_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for j, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << j
    return masks


def myers(item: str, masks: dict[str, int], text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to a substring of ``text`` and the end
    of the first such substring."""
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        d0 = (((eq & up) + up) ^ up) | eq | down
        hp = down | ~(d0 | up) & full
        hn = up & d0
        if hp & high:
            score += 1
        elif hn & high:
            score -= 1
        hp = (hp << 1) & full  # the first row stays 0: a match may begin anywhere
        hn = (hn << 1) & full
        up = hn | ~(d0 | hp) & full
        down = hp & d0
        if score < best:
            best, at = score, j + 1
            if not best:
                break
    return best, at


class Matcher:
    """Finds one block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], budget_chars: int):
        grouped: dict[str, list[int]] = {}
        for item_id, text in items:
            if norm := normalise(text or ""):
                grouped.setdefault(norm, []).append(item_id)
        self.items = [(t, ids, len(t) // budget_chars, char_masks(t)) for t, ids in sorted(grouped.items())]
        found: dict[str, list[tuple[int, int]]] = {}
        for n, (t, _, edits, _) in enumerate(self.items):
            for place, piece in pieces(t, edits):
                found.setdefault(piece, []).append((n, place))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, edits, end) of the best occurrence of every item found."""
        if not self.items:
            return []
        norm = normalise(text)
        diagonals: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(norm):
            for n, place in where:
                diagonals.setdefault(n, set()).add(end + 1 - size - place)
        out = []
        for n, starts in sorted(diagonals.items()):
            item, ids, edits, masks = self.items[n]
            best, at = len(item), 0
            for lo, hi in self.windows(sorted(starts), edits, len(item), len(norm)):
                d, e = myers(item, masks, norm[lo:hi])
                if d < best:
                    best, at = d, lo + e
                if not best:
                    break
            if best <= edits:
                out += [(i, best, at) for i in ids]
        return out

    @staticmethod
    def windows(starts: list[int], edits: int, m: int, n: int) -> Iterator[tuple[int, int]]:
        """Windows that hold every occurrence on the given diagonals; those
        that overlap are searched together."""
        lo = hi = None
        for s in starts:
            a, b = max(0, s - edits), min(n, s + m + edits)
            if lo is not None and a <= hi:
                hi = max(hi, b)
                continue
            if lo is not None:
                yield lo, hi
            lo, hi = a, b
        if lo is not None:
            yield lo, hi


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks; the driver holds one block at a time."""
    block: list[tuple[int, str]] = []
    held = 0
    for row in items.select(key, text).where(F.length(text) > 0).toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1].encode())
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, budget_chars: int = BUDGET_CHARS, block_bytes: int = BLOCK_BYTES,
            key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item_id, edits, end (in the normalised text): the best occurrence
    of every item in every document that holds it within the error budget."""
    spark = docs.sparkSession
    rows = keyed_text(docs, key, text)
    schema = f"{key} long, item_id long, edits long, end long"

    def searched(block: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)  # block_bytes of text at most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, budget_chars)
            for batch in batches:
                found = [(d.as_py(), *hit) for d, t in zip(batch.column(0), batch.column(1)) for hit in matcher(t.as_py())]
                yield pa.RecordBatch.from_pylist([dict(zip((key, "item_id", "edits", "end"), f)) for f in found],
                                                 pa.schema([(c, pa.int64()) for c in (key, "item_id", "edits", "end")]))

        return rows.mapInArrow(run, schema)

    out = None
    for block in item_blocks(items, item_key, item_text, block_bytes):
        part = searched(block)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return (out.groupBy(key, "item_id").agg(F.min(F.struct("edits", "end")).alias("m"))
            .select(key, "item_id", "m.edits", "m.end"))


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any occurrence of a test item, whole."""
    spark = docs.sparkSession
    ship(spark)
    keep = docs
    for block in item_blocks(items, "item_id", "text", BLOCK_BYTES):
        keep = _clean(keep, spark.sparkContext.broadcast(block), text)
    return keep


def _clean(docs: DataFrame, shared, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, BUDGET_CHARS)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            clean = np.array([not matcher(t.as_py() or "") for t in column], bool)
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
