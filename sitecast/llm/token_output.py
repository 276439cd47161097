"""Token ids as binary blocks: frequency ranks in a byte-aligned variable-length
code with separate control bytes.

Every id is replaced by its frequency rank in the whole corpus, so the commonest
256 ids take one data byte. A block holds a run of documents in ascending id
order: one control byte for each four ids (two bits each: data bytes less one),
then the data bytes, little-endian; zeros fill up the last four. Reading expands the control bytes by a
256-row numpy table, and ranks become ids by one more lookup.

A written dataset has three tables: ``blocks`` (part, block, doc_ids, lengths,
payload), ``ranks`` (rank -> id, at most the vocabulary) and ``index`` (first id
position of every block). Spark's writer commits them, so a lost executor only
repeats its blocks.

Defined results: a null text is the empty text and holds the end id alone; a
null id sorts first and is kept; rows that share an id are ordered by text;
an empty table gives empty tables; extra columns are ignored; a text longer
than a block's size makes a block of its own.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitecast.llm.bpe import CachedEncoder, binary_rows
from sitecast.llm.common import drop_stored, keyed_text, store, sub_batches

MAGIC = b"SVB1"
_CODES = np.arange(256)
_LENGTHS = np.stack([(_CODES >> (2 * k)) % 4 + 1 for k in range(4)], axis=1)
#: For each control byte, which of the 16 bytes of its four ids are stored.
STORED = (np.arange(4) < _LENGTHS[:, :, None]).reshape(256, 16)


def pack(values: np.ndarray) -> bytes:
    """Header, control bytes, data bytes of unsigned 32-bit values."""
    v = np.zeros(-(-len(values) // 4) * 4, "<u4")
    v[:len(values)] = values
    code = (v > 0xFF).view(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = v.view(np.uint8)[STORED[control].ravel()]
    return MAGIC + len(values).to_bytes(4, "little") + control.tobytes() + data.tobytes()


def unpack(block: bytes) -> np.ndarray:
    """The values of a packed block, by table lookup."""
    if block[:4] != MAGIC:
        raise ValueError("not a packed block of token ids")
    n = int.from_bytes(block[4:8], "little")
    n_control = -(-n // 4)
    control = np.frombuffer(block, np.uint8, n_control, 8)
    out = np.zeros(16 * n_control, np.uint8)
    out[STORED[control].ravel()] = np.frombuffer(block, np.uint8, offset=8 + n_control)
    return out.view("<u4")[:n]


class WithAddedTokens:
    """An encoder that leaves the texts that hold the string of an added token
    of the tokenizer (``<|endoftext|>``) to the library as loaded, whole."""

    def __init__(self, encoder: CachedEncoder, path: str):
        from tokenizers import Tokenizer
        self.encoder, self.library = encoder, Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.strings = re.compile(b"|".join(map(re.escape, added))) if added else None

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, cut = self.encoder(data, bounds)
        raw = data.tobytes()
        if self.strings is None or not self.strings.search(raw):
            return ids, cut
        parts = np.split(ids, cut[1:-1])
        for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if self.strings.search(raw, lo, hi):
                parts[k] = np.array(self.library.encode(raw[lo:hi].decode("utf-8"), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


@functools.lru_cache(4)
def library_encoder(path: str, added: bool = False) -> CachedEncoder | WithAddedTokens:
    """The tokenizers library behind the match cache: it encodes each distinct
    match of the pre-tokeniser once, which gives the ids of the whole text.
    ``added``: strings of added tokens give those tokens, as in the library as
    loaded; otherwise they are ordinary text."""
    if added:
        return WithAddedTokens(library_encoder(path), path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text

    size = np.zeros(t.get_vocab_size(), np.int64)
    for token, i in t.get_vocab().items():
        size[i] = len(token)  # one character stands for one byte

    # leading bytes of characters that are certainly no white space
    solid = [33 <= b < 127 or 0xC3 <= b < 0xE1 or 0xE4 <= b for b in range(256)]

    def alone(pieces: list[bytes]) -> list[list[int]]:
        return [e.ids for e in t.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)]

    def words(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Many matches go through the library as one text where that keeps
        them apart: those that begin with a blank as they are, others that
        begin with no white space each after a line break."""
        text = [p if p[0] == 32 and len(p) > 1 and solid[p[1]] else b"\n" + p if solid[p[0]] else b""
                for p in pieces]
        odd = [k for k, x in enumerate(text) if not x]
        ids = np.array(t.encode_batch_fast([b"".join(text).decode("utf-8")], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(size[ids])
        bounds = np.cumsum([0, *map(len, text)])
        cut = np.searchsorted(ends, bounds, side="right")
        if not np.array_equal(np.append(0, ends)[cut], bounds):
            raise ValueError("the tokenizer joined two matches")
        lo, hi = cut[:-1] + np.array([x[:1] == b"\n" for x in text], np.int64), cut[1:]
        extra = alone([pieces[k] for k in odd])
        ids = np.concatenate([ids, np.array([i for e in extra for i in e], np.uint32)])
        at = int(cut[-1])
        for k, e in zip(odd, extra):
            lo[k], hi[k] = at, at + len(e)
            at += len(e)
        count = hi - lo
        stop = np.cumsum(count)
        return ids[np.arange(int(stop[-1])) + np.repeat(lo - (stop - count), count)], count

    return CachedEncoder(words)


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, added: bool = False) -> DataFrame:
    """Rows (part, block, doc_ids, lengths, n_ids, ids) in ascending id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = library_encoder(tokenizer_path, added), TaskContext.get().partitionId()
        for block, (batch, data, bounds) in enumerate(sub_batches(batches)):
            ids, cut = encoder(data, bounds)
            ids = np.insert(ids, cut[1:], end_id).astype("<u4")
            n = np.diff(cut) + 1
            yield pa.RecordBatch.from_pydict({
                "part": [part], "block": [block],
                "doc_ids": pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                "lengths": pa.array([n.tolist()], pa.list_(pa.int64())),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "ids": pa.array([ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else ids.tobytes()], pa.binary()),
                "width": pa.array([2 if ids.max() < 1 << 16 else 4], pa.int32())})

    ordered = keyed_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part long, block long, doc_ids array<long>, lengths array<long>, "
                                   "n_ids long, ids binary, width int")


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}")


def count_ids(blocks: DataFrame) -> DataFrame:
    """(token_id, n) over the whole corpus, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw, width in zip(batch.column(0), batch.column(1)):
                c = np.bincount(_ids(raw.as_py(), width.as_py()))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                                         names=["token_id", "n"])

    return (blocks.select("ids", "width").mapInArrow(run, "token_id long, n long")
            .groupBy("token_id").agg(F.sum("n").alias("n")))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, added: bool = False) -> None:
    """Encode every document and write blocks, ranks and index below ``path``.
    ``added``: see ``library_encoder``."""
    spark = docs.sparkSession
    plain = store(tokenise(docs, tokenizer_path, end_id, added), "token-blocks")
    # at most one row for each id of the vocabulary
    by_rank = [r.token_id for r in count_ids(plain).orderBy(F.desc("n"), "token_id").collect()]
    (spark.createDataFrame([*enumerate(by_rank)], "rank int, token_id int")
     .coalesce(1).write.parquet(f"{path}/ranks"))
    rank_of = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    shared = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                ids = _ids(row.column(4)[0].as_py(), row.column(5)[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [*row.columns[:4], pa.array([pack(shared.value[ids])], pa.binary())],
                    names=["part", "block", "doc_ids", "lengths", "payload"])

    (plain.select("part", "block", "doc_ids", "lengths", "ids", "width")
     .mapInArrow(run, "part long, block long, doc_ids array<long>, lengths array<long>, payload binary")
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))
    # first position of each part from the parts' totals (one row for each
    # task of the writer), then of each block inside its part
    parts = plain.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    (plain.select("part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
     .join(before, "part").select("part", "block", (F.col("base") + F.col("inner")).alias("first"))
     .write.parquet(f"{path}/index"))
    drop_stored(plain)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written dataset: doc_id, start (ids of all documents
    before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()  # at most the vocabulary
    shared = spark.sparkContext.broadcast(np.array([r.token_id for r in ranks], np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                ids = shared.value[unpack(row.column(4)[0].as_py())]
                cut = np.concatenate([[0], np.cumsum(row.column(3).flatten().to_numpy())]).astype(np.int64)
                docs = row.column(2).flatten()
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row.column(0)[0], len(docs)), pa.repeat(row.column(1)[0], len(docs)), docs,
                     pa.array(cut[:-1], pa.int64()), pa.array(np.diff(cut), pa.int64()),
                     binary_rows(ids.astype("<u4"), cut)],
                    names=["part", "block", "doc_id", "inner", "n_tokens", "ids"])

    blocks = spark.read.parquet(f"{path}/blocks")
    index = spark.read.parquet(f"{path}/index")
    rows = (blocks.select("part", "block", "doc_ids", "lengths", "payload")
            .mapInArrow(run, "part long, block long, doc_id long, inner long, n_tokens long, ids binary"))
    return (rows.withColumn("ids_crc32", F.crc32("ids"))
            .join(index, ["part", "block"])
            .select("doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "ids"))


def crc32_le(ids: list[int]) -> int:
    """Checksum of ids as the dataset's reader computes it."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())



