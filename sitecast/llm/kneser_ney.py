"""Interpolated modified Kneser-Ney language model of order 2.

Spark counts the n-grams: tasks add up their own before the shuffle, and the
shuffle deals words by hash and word pairs by the hash of the first word (pairs
of very frequent first words by both, so no shard grows with one word). The
number of shards follows the bytes of the training texts, so that a shard's task
holds about as much at any size of the corpus. Each shard becomes a file of
sorted 64-bit hashes with parallel counts in the shared folder. Scoring tasks
open each shard's file once, keep it mapped, and look up the sorted distinct
words and pairs of a batch of documents; batches grow with the number of shards.
No model table passes through the driver, which sees a few sums a shard and the
statistics of the frequent first words (at most 1 / LEAST_SHARE of them, summed
by Spark).

Probability of w after v, with c the counts and n1, n2, n3 the numbers of words
seen once, twice, more often after v:

    p(w|v) = max(c(v,w) - D(c(v,w)), 0) / c(v) + (D1 n1 + D2 n2 + D3 n3) / c(v) * q(w)
    q(w)   = max(k(w) - E(k(w)), 0) / K + (E1 m1 + E2 m2 + E3 m3) / K / (V + 1)

k(w) is the number of distinct words before w, K their sum, m1 to m3 the numbers
of words with k = 1, 2, 3 or more, V the vocabulary; one place more is for words
never seen. D and E are the modified discounts from the numbers of pairs (words)
counted one to four times, clipped to [0, count]. After an unseen v, p is q.

Defined results: a null or empty text is the end token alone; repeated rows are
counted and scored each; a null key counts as the empty string for the split; a
corpus without training rows gives the uniform model of one place (score 0);
extra columns are ignored; texts are handled whole, in batches by size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import drop_stored, keyed_text, mix64, scratch_path, store, sub_batches, word_hashes
from sitecast.llm.shard_files import MappedArrays, OpenArrays, lookup, write_arrays

END, BEGIN = np.uint64(0x5DEECE66D1234567), np.uint64(0x1B873593CC9E2D51)
#: Tokens that a task adds up before it emits.
BUFFER = 1_000_000
#: Training text to a shard.
SHARD_BYTES = 16 << 20
#: A first word is frequent from a quarter of a shard's mean share of all tokens,
#: and from this share at least.
LEAST_SHARE = 2.0 ** -20
#: Text scored at a time: by the number of shards, within these bounds.
SCORE_BYTES, SCORE_BYTES_SHARD, MOST_SCORE_BYTES = 1 << 20, 4 << 10, 8 << 20
_MUL = np.uint64(0x9FB21C651E98DF25)

WORD_FILE = ["<u8", "<i8", "<i8"]            # word, count, distinct words before it
NARROW, WIDE = ["<u8", "<u4"], ["<u8", "<u8"]  # pair, count; wide where a count needs it
MOST_NARROW = (1 << 32) - 1
FIRST_FILE = ["<u8", "<i8", "<i4", "<i4", "<i4"]  # first word, c, n1, n2, n3


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)


def pair_key(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(first * _MUL + word, 8)


def pair_shard(first: np.ndarray, word: np.ndarray, frequent: np.ndarray, shards: int) -> np.ndarray:
    spread = lookup(frequent, first)[1]
    return (shard_of(first, shards) + np.where(spread, shard_of(word, shards), 0)) % shards


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with the end token after each text, and the texts' bounds."""
    words, cut = word_hashes(data, bounds)
    return np.insert(words, cut[1:], END), cut + np.arange(len(cut))


def firsts(words: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The token before each token."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[cut[:-1]] = BEGIN
    return before


def add_up(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of one occurrence of each, and sums."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
    if n is None:
        return s[new], order[new], np.diff(np.append(new, len(s)))
    return s[new], order[new], np.add.reduceat(n[order], new) if len(s) else n[:0]


def blobs(shard: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row for each shard with its slice of every column."""
    order = np.argsort(shard, kind="stable")
    ids, at = np.unique(shard[order], return_index=True)
    out = [pa.array(ids, pa.int64())]
    for c in columns:
        out.append(pa.array([p.tobytes() for p in np.split(c[order], at[1:])] if len(ids) else [], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["shard", *names])


def joined(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)


def buffered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and the tokens before them, in buffers."""
    words: list[np.ndarray] = []
    before: list[np.ndarray] = []
    held = 0
    for _, data, bounds in sub_batches(batches):
        w, cut = tokens(data, bounds)
        words.append(w)
        before.append(firsts(w, cut))
        held += len(w)
        if held >= BUFFER:
            yield np.concatenate(words), np.concatenate(before)
            words, before, held = [], [], 0
    if words:
        yield np.concatenate(words), np.concatenate(before)


def discounts(n: list[int]) -> list[float]:
    """Modified discounts for counts 1, 2 and 3 or more from the numbers of
    items counted one to four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [min(float(k), max(0.0, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else 0.0 for k in (1, 2, 3)]


def counts_of(values: np.ndarray) -> list[int]:
    return [int((values == k).sum()) for k in (1, 2, 3, 4)]


class Model:
    """What the workers need besides the files; a few thousand numbers."""

    def __init__(self, path: str, shards: int, total: int, vocabulary: int, pairs: int, d: list[float],
                 e: list[float], spare: float, frequent: np.ndarray, frequent_stats: np.ndarray,
                 word_shards: set[int], pair_shards: dict[int, bool]):
        self.path, self.shards, self.total, self.vocabulary, self.pairs = path, shards, total, vocabulary, pairs
        self.d, self.e, self.spare = np.array([0.0, *d]), np.array([0.0, *e]), spare
        self.frequent, self.frequent_stats = frequent, frequent_stats
        # those that have a file; whether the pair counts are wide
        self.word_shards, self.pair_shards = word_shards, pair_shards

    def words(self, w: np.ndarray, files: OpenArrays) -> tuple[np.ndarray, np.ndarray]:
        """Counts and lower-order probabilities of sorted distinct words."""
        c, k = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
        shard = shard_of(w, self.shards)
        order = np.argsort(shard, kind="stable")
        for s, idx in each_shard(shard, order, self.word_shards):
            keys, count, before = files.get(f"{self.path}/word-{s}", WORD_FILE)
            at, there = lookup(keys, w[idx])
            c[idx[there]], k[idx[there]] = count[at[there]], before[at[there]]
        q = np.maximum(k - self.e[np.minimum(k, 3)], 0) / max(1, self.pairs) + self.spare / (self.vocabulary + 1)
        return c, q

    def pairs_after(self, first: np.ndarray, word: np.ndarray, q: np.ndarray, files: OpenArrays) -> np.ndarray:
        """p(word | first) of distinct pairs."""
        c = np.zeros(len(first), np.int64)
        total = np.zeros(len(first), np.int64)
        n = np.zeros((3, len(first)), np.int64)
        key = pair_key(first, word)
        shard = pair_shard(first, word, self.frequent, self.shards)
        order = np.lexsort((key, shard))
        for s, idx in each_shard(shard, order, self.pair_shards):
            keys, count = files.get(f"{self.path}/pair-{s}", WIDE if self.pair_shards[s] else NARROW)
            at, there = lookup(keys, key[idx])
            c[idx[there]] = count[at[there]]
            keys, size, *ns = files.get(f"{self.path}/first-{s}", FIRST_FILE)
            at, there = lookup(keys, first[idx])
            total[idx[there]] = size[at[there]]
            for row, own in zip(n, ns):
                row[idx[there]] = own[at[there]]
        at, there = lookup(self.frequent, first)
        if there.any():
            total[there] = self.frequent_stats[0][at[there]]
            n[:, there] = self.frequent_stats[1:, at[there]]
        seen = np.maximum(total, 1)
        p = np.maximum(c - self.d[np.minimum(c, 3)], 0) / seen + (self.d[1:, None] * n).sum(axis=0) / seen * q
        return np.where(total > 0, p, q)


def each_shard(shard: np.ndarray, order: np.ndarray, filled: set[int] | dict[int, bool]) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that has a file, with the places of its entries in order."""
    ids, at = np.unique(shard[order], return_index=True)
    yield from ((s, idx) for s, idx in zip(ids.tolist(), np.split(order, at[1:])) if s in filled)


def frequent_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each frequent first word of each shard, with its statistics there."""
    for batch in batches:
        for w, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(w, "<i8")), *map(pa.array, np.frombuffer(n, "<i8").reshape(4, -1))],
                                             names=["w", "c", "n1", "n2", "n3"])


def train(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> Model:
    """Count the texts of ``docs`` and write the model's files below ``path``."""
    spark = docs.sparkSession
    rows = keyed_text(docs, key, text)
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(4, -(-size // SHARD_BYTES))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in buffered(batches):
            w, _, n = add_up(words)
            yield blobs(shard_of(w, shards), [w, n.astype("<u4")], ["w", "n"])

    def sum_words(group: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        w, _, n = add_up(joined(table, "w", "<u8"), joined(table, "n", "<u4").astype(np.int64))
        write_arrays(f"{path}/count-{group[0].as_py()}", [w, n])
        top = np.argsort(-n, kind="stable")[:64]
        return pa.table({"kind": ["words", "total", *["top"] * len(top)],
                         "w": pa.array([0, 0, *w[top].view(np.int64).tolist()], pa.int64()),
                         "n": pa.array([len(w), int(n.sum()), *n[top].tolist()], pa.int64())})

    sums = store(rows.mapInArrow(count_words, "shard long, w binary, n binary")
                 .repartition(shards, "shard").groupBy("shard")
                 .applyInArrow(sum_words, "kind string, w long, n long"), "lm-words")
    found = {r.kind: r.s for r in sums.where("kind <> 'top'").groupBy("kind").agg(F.sum("n").alias("s")).collect()}
    vocabulary, total = found.get("words", 0), found.get("total", 0)
    # fewer than 1 / LEAST_SHARE rows
    least = total * max(0.25 / shards, LEAST_SHARE)
    often = [r.w for r in sums.where((F.col("kind") == "top") & (F.col("n") > least)).select("w").collect()]
    frequent = np.unique(np.append(np.array(often, np.int64).view(np.uint64), BEGIN))
    drop_stored(sums)
    shared = spark.sparkContext.broadcast(frequent)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, before in buffered(batches):
            _, at, n = add_up(pair_key(before, words))
            a, b = before[at], words[at]
            order = np.argsort(a, kind="stable")  # runs of equal first words compress well
            a, b, n = a[order], b[order], n[order]
            yield blobs(pair_shard(a, b, shared.value, shards), [a, b, n.astype("<u4")], ["a", "b", "n"])

    def sum_pairs(group: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        s = group[0].as_py()
        a, b, n = joined(table, "a", "<u8"), joined(table, "b", "<u8"), joined(table, "n", "<u4")
        keys, at, n = add_up(pair_key(a, b), n.astype(np.int64))
        wide = bool((n > MOST_NARROW).any())
        write_arrays(f"{path}/pair-{s}", [keys, n.astype((WIDE if wide else NARROW)[1])])
        first, _, own = add_up(a[at], n)
        ns = [add_up(a[at], hit.astype(np.int64))[2] for hit in (n == 1, n == 2, n >= 3)]
        hot = lookup(shared.value, first)[1]
        write_arrays(f"{path}/first-{s}", [first[~hot], own[~hot], *[x[~hot].astype("<i4") for x in ns]])
        after, _, before = add_up(b[at])
        spread = blobs(shard_of(after, shards), [after, before.astype("<u4")], ["w", "n"])
        head = pa.RecordBatch.from_pydict({
            "shard": pa.array([-1, -2], pa.int64()),
            "w": pa.array([np.array([s, wide, *counts_of(n)], "<i8").tobytes(), first[hot].tobytes()], pa.binary()),
            "n": pa.array([b"", np.stack([own[hot], *[x[hot] for x in ns]]).astype("<i8").tobytes()], pa.binary())})
        return pa.Table.from_batches([head, spread])

    out = store(rows.mapInArrow(count_pairs, "shard long, a binary, b binary, n binary")
                .repartition(shards, "shard").groupBy("shard").applyInArrow(sum_pairs, "shard long, w binary, n binary"), "lm-pairs")
    seen, pair_shards = np.zeros(4, np.int64), {}
    for r in out.where("shard = -1").select("w").toLocalIterator():  # one row a shard
        s, wide, *n = np.frombuffer(r.w, "<i8").tolist()
        pair_shards[s] = bool(wide)
        seen += np.array(n)
    stats = np.zeros((4, len(frequent)), np.int64)
    for r in (out.where("shard = -2").mapInArrow(frequent_rows, "w long, c long, n1 long, n2 long, n3 long")
              .groupBy("w").agg(*[F.sum(x) for x in ("c", "n1", "n2", "n3")]).collect()):  # one row a frequent word
        stats[:, np.searchsorted(frequent, np.array([r[0]]).view(np.uint64))[0]] = r[1:]

    def sum_before(group: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        s = group[0].as_py()
        w, _, k = add_up(joined(table, "w", "<u8"), joined(table, "n", "<u4").astype(np.int64))
        with MappedArrays(f"{path}/count-{s}", WORD_FILE[:2]) as (words, count):
            at, there = lookup(w, words)
            before = np.where(there, k[at], 0)
            write_arrays(f"{path}/word-{s}", [words, count, before])
            del words, count
        return pa.table({"n": pa.array([[s, int(k.sum()), *counts_of(k), int((k >= 3).sum())]], pa.list_(pa.int64()))})

    word_shards = [r.n for r in out.where("shard >= 0").repartition(shards, "shard").groupBy("shard")
                   .applyInArrow(sum_before, "n array<long>").collect()]
    k = np.array(word_shards, np.int64).reshape(-1, 7)[:, 1:].sum(axis=0).tolist()  # one row a shard
    drop_stored(out)
    e = discounts(k[1:5])
    spare = (e[0] * k[1] + e[1] * k[2] + e[2] * k[5]) / k[0] if k[0] else 1.0
    return Model(path, shards, total, vocabulary, k[0], discounts(seen.tolist()), e, spare, frequent, stats,
                 {r[0] for r in word_shards}, pair_shards)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, base_score, score of every row: base_score adds
    one to the word counts, score is the model's log10 probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    size = min(MOST_SCORE_BYTES, max(SCORE_BYTES, SCORE_BYTES_SHARD * model.shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, files = shared.value, OpenArrays()
        for batch, data, bounds in sub_batches(batches, text, size):
            words, cut = tokens(data, bounds)
            distinct, which = np.unique(words, return_inverse=True)
            c, q = m.words(distinct, files)
            before = firsts(words, cut)
            _, at, n = add_up(pair_key(before, words))
            order = np.argsort(pair_key(before, words), kind="stable")
            p = np.empty(len(words))
            p[order] = np.repeat(np.log10(m.pairs_after(before[at], words[at], q[which[at]], files)), n)
            base = np.log10((c + 1) / (m.total + m.vocabulary + 1))[which]
            begins = cut[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(cut), pa.int64()),
                 pa.array(np.add.reduceat((c > 0)[which].astype(np.int64), begins), pa.int64()),
                 pa.array(np.add.reduceat(base, begins)), pa.array(np.add.reduceat(p, begins))],
                names=[key, "n_tokens", "n_known", "base_score", "score"])

    return keyed_text(docs, key, text).mapInArrow(
        run, f"{key} long, n_tokens long, n_known long, base_score double, score double")


def held_out(key: str = "doc_id"):
    """crc32 of the key as text, modulo 7, is 2."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows that are not held out and score every row."""
    path = scratch_path(docs.sparkSession, "lm")
    model = train(docs.where(~held_out(key)), path, key, text)
    # the scores are small; stored, the step runs with small Arrow batches
    return store(score(docs, model, key, text), "lm-scores").select(
        key, held_out(key).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
