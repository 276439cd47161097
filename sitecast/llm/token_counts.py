"""Token counts of the sections of a document by offset-mapped attribution.

A document is encoded once, whole. The byte offsets of its tokens become
character spans, and an interval join of the sorted spans with the sections
counts each section's tokens. A token that crosses a boundary is allocated by
``rule``: to the section that holds its first, middle or last character (the
middle of an even span is the earlier of the two). A token whose bytes are part
of one character spans that character.

Sections are the lines of the text (each with the line break that ends it), or
the spans of a given array column; given spans may overlap or leave gaps, and
each counts for itself.

Defined results: a null or empty text has one section of 0 characters and 0
tokens; repeated rows are counted each; a null id is kept; a null array of
sections gives no row; bounds beyond the text are cut to it; extra columns are
ignored; memory follows one document at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.bpe import byte_table, rank_encoder
from sitecast.llm.common import keyed_text, sub_batches

RULES = ("first", "middle", "last")


def token_spans(data: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [begin, end) of the tokens that tile ``data``."""
    char_at = np.cumsum((data & 0xC0) != 0x80) - 1  # character of each byte
    ends = np.cumsum(sizes[ids])
    return char_at[ends - sizes[ids]], char_at[ends - 1] + 1


def count_in_sections(begin: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                      rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allocated to each section [lo, hi), and tokens that lie partly
    outside it. Token spans are sorted, so both are binary searches."""
    home = {"first": begin, "middle": (begin + end - 1) // 2, "last": end - 1}[rule]
    own = np.searchsorted(home, hi) - np.searchsorted(home, lo)
    touching = np.searchsorted(begin, hi) - np.searchsorted(end, lo, side="right")
    inside = np.searchsorted(end, hi, side="right") - np.searchsorted(begin, lo)
    empty = hi <= lo
    return np.where(empty, 0, own), np.where(empty, 0, touching - np.maximum(0, inside))


def attribute(docs: DataFrame, ranks_path: str, rule: str = "first", key: str = "doc_id", text: str = "text",
              sections: str | None = None) -> DataFrame:
    """key, section (from 0), begin, end (characters), n_tokens, n_crossing.
    ``sections``: a column of type array<struct<begin, end>>, else lines."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks_path)
        for batch, data, bounds in sub_batches(batches, text):
            ids, _ = encoder(data, bounds)
            sizes = np.diff(byte_table(ranks_path)[1])
            if len(data):
                begin, end = token_spans(data, ids.astype(np.int64), sizes)
            else:
                begin = end = np.zeros(0, np.int64)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]  # n+1 document bounds
            if sections is None:
                breaks = np.flatnonzero(data == 10)
                after = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[breaks + 1]
                of_break = np.searchsorted(bounds, breaks, side="right") - 1
                doc = np.concatenate([np.arange(len(batch)), of_break])
                lo = np.concatenate([chars[:-1], after])
                order = np.lexsort((lo, doc))
                doc, lo = doc[order], lo[order]
                hi = np.append(lo[1:], 0)
                last = np.append(doc[1:] != doc[:-1], True)
                hi[last] = chars[1:][doc[last]]
            else:
                given = batch.column(2)
                doc = np.repeat(np.arange(len(batch)), [len(v.as_py() or ()) for v in given])
                flat = [s for v in given for s in (v.as_py() or ())]
                room = chars[1:] - chars[:-1]
                lo = chars[doc] + np.clip([s["begin"] or 0 for s in flat], 0, room[doc]).astype(np.int64)
                hi = chars[doc] + np.clip([room[d] if s["end"] is None else s["end"] for d, s in zip(doc, flat)],
                                          0, room[doc]).astype(np.int64)
            own, crossing = count_in_sections(begin, end, lo, hi, rule)
            base = np.searchsorted(doc, np.arange(len(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(np.arange(len(doc)) - base[doc], pa.int64()),
                 pa.array(lo - chars[doc], pa.int64()), pa.array(hi - chars[doc], pa.int64()),
                 pa.array(own, pa.int64()), pa.array(crossing, pa.int64())],
                names=[key, "section", "begin", "end", "n_tokens", "n_crossing"])

    rows = keyed_text(docs, key, text)
    if sections is not None:
        rows = keyed_text(docs, key, text, F.col(sections).alias("_spans"))
    return rows.mapInArrow(run, f"{key} long, section long, begin long, end long, n_tokens long, n_crossing long")
