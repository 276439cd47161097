"""Jaccard self-join of documents on word shingles: size-aware, heavy-light.

A document's set holds its distinct ``K``-word shingles. Two documents link when
100 * intersection >= 80 * union. Documents with equal sets form a class, and
one representative of each class takes part in the join.

Two sets that link share at least ceil(0.8 * larger size) shingles. Small sets
enumerate all subsets of that fixed size, so linked small sets meet in an equal
subset. Large sets are found by scanning inverted lists: of a set of n shingles
ordered rarest first, the first n - ceil(0.8 n) + 1 are indexed, and linked sets
meet in one of these lists. The boundary between small and large is the size at
which the estimated entries plus scanned list positions are fewest, computed
from the counted sizes. Sets a little smaller than the boundary are indexed
both ways, as their partner may be large.

The order of the shingles is any fixed total order: first those not known to be
frequent, by hash, then the frequent ones, by hash. Which shingles count as
frequent affects speed only; the table of at most ``MAX_FREQUENT`` hashes is the
one broadcast, and its bound is that parameter.

Lists never expand into all their pairs. Each list offers its members one centre
(the member with fewest rare shingles). A document is verified first against the
centre it shares most lists with, then against those centres that are not in its
component yet; lists that then lie in one component are settled, since only
components are asked for. What remains is the pairs of a list in different components, cut by
the size and position filters before they are made. Before whole sets are
compared, a pair must pass its parity sketches, which bound the difference of the
sets from below and so lose no link.

Defined results: a null or empty text, or one without words, has an empty set,
links with nothing and is its own component; with fewer than K words the whole
sequence is the one shingle; rows that share a doc_id are one node of the link
graph; a row with a null doc_id is returned with a null component and takes no
part; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.llm.bpe import binary_rows
from sitecast.llm.common import among, drop_stored, keyed_text, mix64, store, sub_batches, word_hashes
from sitecast.llm.components import connected_components

K = 5
#: Broadcast bound: 2^20 hashes of 8 bytes.
MAX_FREQUENT = 1 << 20
#: A shingle counted this often is treated as frequent.
FREQUENT = 16
#: Bytes of text shingled at a time.
TEXT_BYTES = 1 << 18
#: Sizes for which subsets may be enumerated.
MAX_SMALL = 16


def least_shared(n: int | np.ndarray) -> int | np.ndarray:
    """ceil(0.8 n): shingles that a set of n shares with any partner."""
    return -(-4 * n // 5)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words, cut = word_hashes(data, bounds)
    mul = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(words) - K + 1), np.uint64)
    for j in range(K):
        rolled = rolled * mul + words[j:j + len(rolled)]
    rolled = mix64(rolled, 1)
    for i in range(len(cut) - 1):
        lo, hi = int(cut[i]), int(cut[i + 1])
        if hi - lo >= K:
            yield np.unique(rolled[lo:hi - K + 1])
        elif hi > lo:
            h = np.uint64(hi - lo)
            for w in words[lo:hi]:
                h = mix64(np.array([h], np.uint64), 2)[0] ^ w
            yield mix64(np.array([h], np.uint64), 3)
        else:
            yield np.zeros(0, np.uint64)


def survey(docs: DataFrame) -> DataFrame:
    """One pass over the texts: (kind 0, set size up to MAX_SMALL * 2, count)
    and (kind 1, shingle hash, documents) of shingles that repeat inside a
    task's buffer."""
    top = 2 * MAX_SMALL

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(top + 1, np.int64)
        buffer: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(buffer), return_counts=True)
            keep = n > 1
            return pa.RecordBatch.from_pydict({
                "kind": pa.array(np.ones(keep.sum(), np.int32)), "value": pa.array(h[keep].view(np.int64)),
                "n": pa.array(n[keep].astype(np.int64))})

        for _, data, bounds in sub_batches(batches, limit=TEXT_BYTES):
            for s in shingle_sets(data, bounds):
                sizes[min(len(s), top)] += 1
                buffer.append(s)
                held += len(s)
            if held > 1_000_000:
                yield flush()
                buffer, held = [], 0
        if buffer:
            yield flush()
        yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(top + 1, np.int32)),
                                          "value": pa.array(np.arange(top + 1)), "n": pa.array(sizes)})

    return docs.mapInArrow(run, "kind int, value long, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))


def subset_count(n: int) -> int:
    """Subsets that a small set of n enumerates: of every size that a pair
    with a partner of n to 1.25 n may share."""
    return sum(comb(n, c) for c in {least_shared(b) for b in range(n, 5 * n // 4 + 1)} if c <= n)


def boundary(sizes: dict[int, int], list_length: float) -> int:
    """Largest size that enumerates subsets: the cheapest of 0 .. MAX_SMALL in
    entries plus scanned positions."""
    def cost(x: int) -> float:
        small = sum(n * subset_count(s) for s, n in sizes.items() if 0 < s <= x)
        large = sum(n * (s - least_shared(s) + 1) * (1 + list_length)
                    for s, n in sizes.items() if s >= max(1, least_shared(x + 1)))
        return small + large
    return min(range(MAX_SMALL + 1), key=cost)


def subset_keys(s: np.ndarray) -> list[int]:
    """Keys of a small set's subsets; the key depends on members and size."""
    n, out = len(s), []
    for c in sorted({int(least_shared(b)) for b in range(n, 5 * n // 4 + 1)}):
        if c <= n:
            out += [hash((c, *part)) for part in combinations(s.tolist(), c)]
    return out


def parity_sketch(s: np.ndarray) -> bytes:
    """One parity bit for each bucket of the set's hashes, with at least as many
    buckets as shingles (a power of two, 64 or more). Every shingle in which two
    sets differ flips one bit, so two sketches of one length differ in at most
    as many bits as the sets in shingles; halves fold by exclusive or."""
    m = max(64, 1 << max(0, len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1,
                       bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the shingles in which two sets differ."""
    if len(x) < len(y):
        x, y = y, x
    a, bits = int.from_bytes(x, "little"), 8 * len(x)
    while bits > 8 * len(y):
        bits //= 2
        a = (a >> bits) ^ (a & ((1 << bits) - 1))
    return (a ^ int.from_bytes(y, "little")).bit_count()


def signatures(docs: DataFrame, frequent: np.ndarray, small: int) -> DataFrame:
    """doc_id, n, k1, k2 (key of the set), rare (shingles not known to be
    frequent), keys (index keys as 64-bit little-endian: the prefix in rarest
    order, then the subsets), n_prefix, sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch, data, bounds in sub_batches(batches, limit=TEXT_BYTES):
            rows: list[tuple[int, int, int, int, int]] = []
            keys: list[np.ndarray] = []
            sketches: list[bytes] = []
            for s in shingle_sets(data, bounds):
                n = len(s)
                if len(hot) and n:
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    known = hot[at] == s
                else:
                    known = np.zeros(n, bool)
                rare = n - int(known.sum())
                prefix = np.zeros(0, np.uint64)
                if n >= max(1, least_shared(small + 1)):
                    size = n - least_shared(n) + 1
                    prefix = s[~known][:size]
                    if len(prefix) < size:
                        prefix = np.concatenate([prefix, s[known][:size - len(prefix)]])
                subsets = np.array(subset_keys(s) if 0 < n <= small else [], np.int64).view(np.uint64)
                rows.append((n, int(mix64(s, 4).sum(dtype=np.uint64).view(np.int64)),
                             int(mix64(s, 5).sum(dtype=np.uint64).view(np.int64)), rare, len(prefix)))
                keys.append(np.concatenate([prefix, subsets]))
                sketches.append(parity_sketch(s))
            cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
            cols = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(cols[:, j]) for j in range(5)],
                 binary_rows(np.concatenate(keys).astype("<u8"), cut), pa.array(sketches, pa.binary())],
                names=["doc_id", "n", "k1", "k2", "rare", "n_prefix", "keys", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, rare long, n_prefix long, keys binary, "
                                "sketch binary")


def list_entries(indexed: DataFrame) -> DataFrame:
    """Inverted-list entries (key, rep, n, rare, pos) of the representatives;
    pos counts from 1 in the rarest-first order and is 0 for a subset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                rep, n, rare, n_prefix, raw = (c for c in batch.slice(lo, 1000).columns)
                keys = [np.frombuffer(k, "<u8") for k in raw.to_pylist()]
                count = np.array([len(k) for k in keys], np.int64)
                ends = np.cumsum(count)
                pos = np.arange(int(ends[-1])) - np.repeat(ends - count, count) + 1
                pos[pos > np.repeat(n_prefix.to_numpy(), count)] = 0
                # prefix keys and subset keys of the same value must not meet
                flat = np.concatenate(keys)
                flat = np.where(pos > 0, flat, mix64(flat, 6))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat.view(np.int64)), *[pa.array(np.repeat(c.to_numpy(), count)) for c in (rep, n, rare)],
                     pa.array(pos)], names=["key", "rep", "n", "rare", "pos"])

    return (indexed.select("rep", "n", "rare", "n_prefix", "keys").where(F.length("keys") > 0)
            .mapInArrow(run, "key long, rep long, n long, rare long, pos long"))


def may_link(a: str, b: str) -> str:
    """Size and position filters of a pair that meets in a list."""
    need = f"ceil(4.0D * ({a}n + {b}n) / 9)"
    return (f"5 * least({a}n, {b}n) >= 4 * greatest({a}n, {b}n) AND ({a}pos = 0 OR "
            f"1 + least({a}n - {a}pos, {b}n - {b}pos) >= {need})")


def centred(entries: DataFrame) -> DataFrame:
    """Entries of lists with two members or more, with the list's centre.

    Lists of rare keys are short, so a window holds each. Lists of frequent keys
    reduce to their centre before the shuffle, and the join back to their
    members can be split."""
    centre = F.struct("rare", "rep", "n", "pos")
    rare = entries.where("pos BETWEEN 1 AND rare")
    w = Window.partitionBy("key")
    short = (rare.withColumn("c", F.min(centre).over(w)).withColumn("size", F.count(F.lit(1)).over(w))
             .where("size > 1"))
    often = entries.where("pos = 0 OR pos > rare")
    heads = often.groupBy("key").agg(F.min(centre).alias("c"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return short.unionByName(often.join(heads, "key")).select(
        "key", "rep", "n", "rare", "pos", F.col("c.rep").alias("c_rep"), F.col("c.n").alias("c_n"),
        F.col("c.pos").alias("c_pos"))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles) of the documents whose ids are in ``wanted`` (rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in sub_batches(batches, limit=TEXT_BYTES):
            sets = list(shingle_sets(data, bounds))
            cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_rows(np.concatenate(sets).astype("<u8"), cut)],
                                             names=["rep", "shingles"])

    return (among(docs, wanted, "doc_id")
            .mapInArrow(run, "rep long, shingles binary").dropDuplicates())


def apart(pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) that are not in one component yet."""
    left = placed.select(F.col("node").alias("a"), F.col("component").alias("x"))
    right = placed.select(F.col("node").alias("b"), F.col("component").alias("y"))
    return (pairs.distinct().join(left, "a", "left").join(right, "b", "left")
            .where("coalesce(x, a) <> coalesce(y, b)").select("a", "b"))


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) whose sketches do not rule a link out: sets
    that link differ in at most a ninth of their summed sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, x, y = (c.to_pylist() for c in batch.columns)
            keep = [9 * least_difference(s, t) <= size for size, s, t in zip(n, x, y)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sketches.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    return (pairs.distinct().join(left, "a").join(right, "b").select("a", "b", F.expr("na + nb"), "x", "y")
            .mapInArrow(run, "a long, b long").distinct())


def link(docs: DataFrame, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by the whole sets of their documents."""
    pairs = store(possible(pairs, sketches), "pairs")
    ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
    sets = store(sets_of(docs, ids), "sets")
    out = store(verified(pairs, sets), "links")
    drop_stored(pairs, sets)
    return out


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= 80 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long").distinct())


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (smallest id reachable by links) of every
    row; equal rows are returned as often as they occur."""
    rows = keyed_text(docs, key, text).withColumnRenamed(key, "doc_id").withColumnRenamed(text, "text")
    seen = store(survey(rows), "survey")
    sizes = {r.value: r.n for r in seen.where("kind = 0").collect()}  # 2 * MAX_SMALL + 1 rows
    repeated = seen.where("kind = 1")
    frequent = np.sort(np.array([r.value for r in repeated.where(F.col("n") >= FREQUENT)
                                 .orderBy(F.desc("n"), "value").limit(MAX_FREQUENT).select("value").collect()],
                                np.int64).view(np.uint64))
    length = repeated.agg(F.avg("n")).first()[0] or 1.0
    small = boundary(sizes, length)
    signed = store(signatures(rows, frequent, small), "signatures")
    drop_stored(seen)

    same = ["k1", "k2", "n"]
    # stored, so that the join below reads plain shuffles and a class of a third
    # of all rows can be split
    classes = store(signed.where("doc_id IS NOT NULL AND n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep")),
                    "classes")
    member = store(signed.select("doc_id", *same).join(classes, same, "left")
                   .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("node")),
                   "members")
    by_id = member.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.bool_or(F.expr("node = doc_id")).alias("rep"))
    twice = by_id.where("lo < hi").select("doc_id")
    one_id = member.join(twice, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    copies = by_id.where("NOT rep").select("doc_id")
    indexed = among(signed.where("doc_id IS NOT NULL AND n > 0"), copies, "doc_id", keep=False)
    indexed = indexed.withColumnRenamed("doc_id", "rep")
    sketches = store(indexed.select("rep", "n", "sketch"), "sketches")
    lists = store(centred(list_entries(indexed)), "lists")
    drop_stored(signed, classes)

    # each document is first held against the centre it shares most lists with
    near = store(lists.where("rep <> c_rep").where(may_link("", "c_"))
                 .groupBy("rep", "c_rep").agg(F.count(F.lit(1)).alias("lists")), "near")
    best = near.groupBy("rep").agg(F.max(F.struct("lists", -F.col("c_rep"))).alias("m")).select(
        "rep", (-F.col("m.col2")).alias("c_rep"))
    first = link(rows, best.select(F.least("rep", "c_rep").alias("a"), F.greatest("rep", "c_rep").alias("b")), sketches)
    links = store(first.unionByName(one_id), "links")
    placed = connected_components(links)
    other = apart(near.select(F.least("rep", "c_rep").alias("a"), F.greatest("rep", "c_rep").alias("b")), placed)
    links = store(links.unionByName(link(rows, other, sketches)), "links")
    drop_stored(near)
    joined = connected_components(links)
    placed = (lists.join(joined, lists["rep"] == joined["node"], "left")
              .withColumn("comp", F.coalesce("component", "rep")))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    open_lists = store(placed.join(mixed.select("key"), "key", "left_semi").select("key", "rep", "n", "pos", "comp"),
                       "open-lists")
    x, y = open_lists.alias("x"), open_lists.alias("y")
    rest = (x.join(y, F.expr("x.key = y.key AND x.rep < y.rep AND x.comp <> y.comp AND " + may_link("x.", "y.")))
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")))
    found = connected_components(links.unionByName(link(rows, rest, sketches)))
    drop_stored(lists, open_lists, sketches)
    return member.join(found, "node", "left").select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the
    document with the smallest id stays, once; rows with a null id stay."""
    groups = jaccard_components(docs, key, text)
    stay = groups.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("_stay")).distinct()
    once = Window.partitionBy(key).orderBy(F.xxhash64(text), text)
    kept = docs.join(stay, docs[key] == stay["_stay"], "left_semi")
    first = kept.withColumn("_nth", F.row_number().over(once)).where("_nth = 1").drop("_nth")
    return first.unionByName(docs.where(F.col(key).isNull()))
