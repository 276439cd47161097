"""Byte-level BPE encoding and decoding.

Pre-tokenisation without a regex: every code point gets a class from an array
lookup, a small automaton over the classes says where the pattern
``public_tokenizers.PATTERN`` starts a new match, and the automaton runs as an
associative scan. Each symbol is a transition function (state -> state);
blocks of symbols are composed side by side, the block functions are combined
by a doubling scan, and a second sweep turns the entry state of each block into
the state before every symbol. The resulting slices feed a cached pair merge,
and the byte offset of every token is kept, so decoding can address any token.

Defined results: a null text is the empty text and has no tokens; rows repeat
as they come; a null ``doc_id`` stays null; texts of any length go through in
segments that end at a match boundary, so memory does not follow the longest
text; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitecast.llm.common import keyed_text, mix64, rolling_hashes, sub_batches

OTHER, LETTER, NUMBER, SPACE_CLS = 0, 1, 2, 3

#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Letters and numbers that Unicode 16 added to the version of
#: Python's own tables (first and last code point).
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
               (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
               (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
               (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
               (0x16D40, 0x16D6C), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
               (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

#: Code points handled by one scan.
SEGMENT = 1 << 20

# Symbols: the class of a code point with the bounded look-ahead folded in.
S_OTHER, S_LETTER, S_NUMBER, S_QUOTE1, S_QUOTE2, S_BLANK, S_GAP_END, S_GAP = range(8)
# States: what the match in progress is made of.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_GAP, LAST_OF_QUOTE, IN_QUOTE = range(8)
N_STATES = 8
FIRST = 8       # added to the symbol of a text's first code point
IDENTITY = 16   # padding


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a match) for [symbol, state]."""
    nxt = np.zeros((17, N_STATES), np.uint8)
    cut = np.ones((17, N_STATES), bool)
    target = {S_OTHER: IN_OTHERS, S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_QUOTE1: LAST_OF_QUOTE,
              S_QUOTE2: IN_QUOTE, S_BLANK: AFTER_BLANK, S_GAP_END: START, S_GAP: IN_GAP}
    for sym, state in target.items():
        nxt[sym, :] = state
    # a run goes on, and one blank in front belongs to the run
    for sym, run in ((S_OTHER, IN_OTHERS), (S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS)):
        cut[sym, [run, AFTER_BLANK]] = False
    # a quote inside a run of others, or after a blank, is no contraction
    for sym in (S_QUOTE1, S_QUOTE2):
        nxt[sym, [IN_OTHERS, AFTER_BLANK]] = IN_OTHERS
        cut[sym, [IN_OTHERS, AFTER_BLANK]] = False
    # the letters of a contraction
    nxt[S_LETTER, IN_QUOTE], cut[S_LETTER, IN_QUOTE] = LAST_OF_QUOTE, False
    nxt[S_LETTER, LAST_OF_QUOTE], cut[S_LETTER, LAST_OF_QUOTE] = START, False
    cut[S_GAP, IN_GAP] = False
    # a text's first code point starts a match whatever stood before it
    nxt[FIRST:FIRST + 8] = nxt[:8, [START]]
    nxt[IDENTITY], cut[IDENTITY] = np.arange(N_STATES), False
    return nxt, cut


NEXT, CUT = _transitions()
#: The function of two symbols in a row, flat: [first, second, state].
NEXT_TWO = NEXT[np.arange(17)[None, :, None], NEXT[:, None, :]].ravel()


@functools.lru_cache(1)
def class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    t = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for lo, hi in ranges:
            t[lo:hi + 1] = kind
    t[WHITE_SPACE] = SPACE_CLS
    return t


def symbols(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``first`` marks where texts begin."""
    n = len(cps)
    cls = class_table()[cps]
    sym = cls.copy()  # OTHER, LETTER and NUMBER keep their codes
    ends = np.ones(n, bool)  # last code point of its text
    ends[:-1] = first[1:]
    is_space = cls == SPACE_CLS
    more_space = np.zeros(n, bool)
    more_space[:-1] = is_space[1:]
    more_space |= ends
    sym[is_space] = S_GAP_END
    sym[is_space & (cps == 0x20)] = S_BLANK
    sym[is_space & more_space] = S_GAP
    q = np.flatnonzero((cps == 0x27) & ~ends)
    if len(q):
        c1 = cps[q + 1]
        one = np.isin(c1, [ord(c) for c in "stmd"])
        q2 = np.minimum(q + 2, n - 1)
        c2 = np.where(ends[q + 1], 0, cps[q2])
        two = ((c1 == ord("r")) | (c1 == ord("v"))) & (c2 == ord("e")) | (c1 == ord("l")) & (c2 == ord("l"))
        sym[q[one]] = S_QUOTE1
        sym[q[two]] = S_QUOTE2
    sym[first] += FIRST
    return sym


def scan_states(sym: np.ndarray) -> np.ndarray:
    """State before each symbol: the prefix composition of the transition
    functions, applied to START."""
    n = len(sym)
    width = max(1, min(8192, n // 64))
    steps = -(-n // (2 * width)) * 2
    padded = np.full(width * steps, IDENTITY, np.uint8)
    padded[:n] = sym
    cols = np.ascontiguousarray(padded.reshape(width, steps).T)  # one row per step
    flat = NEXT.ravel()
    base = cols * np.uint8(N_STATES)
    twos = (cols[::2].astype(np.uint16) * np.uint16(17) + cols[1::2]) * np.uint16(N_STATES)
    fn = np.tile(np.arange(N_STATES, dtype=np.uint8), (width, 1))
    for row in twos:  # compose inside every block at once, two symbols a step
        fn = NEXT_TWO.take(row[:, None] + fn)
    d = 1
    while d < width:  # inclusive doubling scan over the block functions
        fn[d:] = np.take_along_axis(fn[d:], fn[:-d].copy(), axis=1)
        d *= 2
    state = np.full(width, START, np.uint8)
    state[1:] = fn[:-1, START]
    out = np.empty((steps, width), np.uint8)
    for j in range(steps):
        out[j] = state
        state = flat.take(base[j] + state)
    return out.T.ravel()[:n]


def match_starts(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indexes of the code points that start a match of the pattern."""
    if not len(cps):
        return np.zeros(0, np.int64)
    sym = symbols(cps, first)
    return np.flatnonzero(CUT[sym, scan_states(sym)])


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte index of each."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    if len(at) == len(data):
        return data.astype(np.uint32), at
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), at


def pretokens(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte index of every match start in the UTF-8 texts ``data`` cut at
    ``bounds``. Works through segments; a segment ends at a match start whose
    look-ahead was complete, so the next one begins in the start state."""
    starts: list[np.ndarray] = []
    begins = np.unique(bounds[:-1][bounds[:-1] < bounds[1:]])
    pos, size = 0, SEGMENT
    while pos < len(data):
        end = min(len(data), pos + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        cps, at = code_points(data[pos:end])
        first = np.zeros(len(cps), bool)
        own = begins[(begins >= pos) & (begins < end)] - pos
        first[np.searchsorted(at, own)] = True
        first[0] = True
        m = match_starts(cps, first)
        if end < len(data):
            m = m[m <= len(cps) - 4]
            if len(m) < 2:  # one match longer than the segment
                size *= 2
                continue
            starts.append(at[m[:-1]] + pos)
            pos += int(at[m[-1]])
            size = SEGMENT
        else:
            starts.append(at[m] + pos)
            pos = end
    return np.concatenate(starts) if starts else np.zeros(0, np.int64)


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: again and again join the leftmost pair of lowest rank.
    Long pieces use a heap over linked neighbours, so cost stays n log n."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, none = len(piece), 1 << 60
    get = ranks.get
    if n <= 100:
        parts = [piece[i:i + 1] for i in range(n)]
        pair = [get(piece[i:i + 2], none) for i in range(n - 1)]
        while pair:
            low = min(pair)
            if low == none:
                break
            i = pair.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]
    end = list(range(1, n + 1))  # end of the part that begins at i
    prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray([1]) * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j] = 0
        end[i], nxt[i] = stop, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
            if (r := get(piece[i:end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := get(piece[prev[i]:stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class CachedEncoder:
    """Encodes UTF-8 texts, merging each distinct match once.

    The cache is a direct-mapped table in numpy: a match's 64-bit hash picks the
    slot, and the hash, the length and the first eight bytes must agree. Matches
    that are not there are encoded together and take over their slots. The
    cache starts over after ``max_words`` distinct matches."""

    SLOTS = 1 << 21

    def __init__(self, encode_words: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 max_words: int = 1_000_000):
        self.encode_words, self.max_words = encode_words, max_words
        self.reset()

    def reset(self) -> None:
        self.hash = np.zeros(self.SLOTS, np.uint64)
        self.head = np.zeros(self.SLOTS, np.uint64)
        self.word = np.full(self.SLOTS, -1, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.ptr, self.words = np.zeros(1 << 16, np.int64), 0

    def add(self, pieces: list[bytes]) -> None:
        ids, count = self.encode_words(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.words + len(count) + 1 > len(self.ptr):
            self.ptr = np.concatenate([self.ptr, np.zeros_like(self.ptr)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.ptr[self.words + 1:self.words + 1 + len(count)] = self.used + np.cumsum(count)
        self.used += len(ids)
        self.words += len(count)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and each text's bounds."""
        starts = pretokens(data, bounds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        ends = np.append(starts[1:], len(data))
        if self.words > self.max_words:
            self.reset()
        h, head = span_hashes(data, starts, ends)
        slot = (h & np.uint64(self.SLOTS - 1)).astype(np.int64)
        wid = np.where((self.hash[slot] == h) & (self.head[slot] == head), self.word[slot], -1).astype(np.int64)
        missing = np.flatnonzero(wid < 0)
        if len(missing):
            _, at, which = np.unique(h[missing] ^ mix64(head[missing]), return_index=True, return_inverse=True)
            new = missing[at]
            base = self.words
            raw = data.tobytes()
            self.add([raw[x:y] for x, y in zip(starts[new].tolist(), ends[new].tolist())])
            wid[missing] = base + which
            # the last of several new matches in one slot stays there, whole
            keep = np.full(self.SLOTS if len(new) > self.SLOTS // 8 else 0, -1, np.int64)
            order = slot[new]
            if len(keep):
                keep[order] = np.arange(len(new))
                own = keep[order] == np.arange(len(new))
            else:
                last = dict(zip(order.tolist(), range(len(new))))
                own = np.zeros(len(new), bool)
                own[list(last.values())] = True
            put = order[own]
            self.hash[put], self.head[put] = h[new][own], head[new][own]
            self.word[put] = (base + np.arange(len(new)))[own]
        begin = self.ptr[wid]
        count = self.ptr[wid + 1] - begin
        stop = np.cumsum(count)
        ids = self.flat[np.arange(int(stop[-1])) + np.repeat(begin - (stop - count), count)]
        upto = np.concatenate([[0], stop])
        return ids, upto[np.searchsorted(starts, bounds)]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each byte span, and its length mixed with its first eight bytes."""
    h = mix64(rolling_hashes(data, starts, ends))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[starts]
    size = (ends - starts).astype(np.uint64)
    shift = np.uint64(8) * (np.uint64(8) - np.minimum(size, np.uint64(8)))
    return h, ((eight << shift) >> shift) + (size << np.uint64(56)) + size


@functools.lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(2)
def pair_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (left id, right id) of all pairs that make a token, and the
    token of each."""
    ranks = load_ranks(path)
    made = {}
    for token, i in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                made[left << 32 | right] = i
    keys = np.array(sorted(made), np.int64)
    return keys, np.array([made[k] for k in keys.tolist()], np.int64)


#: Matches up to this many bytes are merged side by side.
SHORT = 64
_NO_PAIR = np.int64(1) << 40


def merge_together(pieces: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many matches and each match's number of ids. Every round joins
    the leftmost pair of lowest rank in all matches at once; only the pairs
    beside a join are looked up again, and finished matches step aside."""
    ranks = load_ranks(path)
    keys, made = pair_table(path)

    def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return np.where(keys[at] == wanted, made[at], _NO_PAIR) if len(keys) else np.full(len(left), _NO_PAIR)

    out: list = [None] * len(pieces)
    short = []
    for k, p in enumerate(pieces):
        whole = ranks.get(p)
        if whole is not None:
            out[k] = [whole]
        elif len(p) > SHORT:
            out[k] = merge_pairs(p, ranks)
        else:
            short.append(k)
    if short:
        single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        raw = [pieces[k] for k in short]
        ids = single[np.frombuffer(b"".join(raw), np.uint8)]
        if (ids < 0).any():
            raise KeyError("the vocabulary lacks a byte")
        owner = np.repeat(np.array(short), [len(p) for p in raw])
        last = np.append(owner[1:] != owner[:-1], True)
        pair = np.full(len(ids), _NO_PAIR)
        pair[:-1] = rank_of(ids[:-1], ids[1:])
        pair[last] = _NO_PAIR
        while len(ids):
            begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            low = np.minimum.reduceat(pair, begin)
            size = np.diff(np.append(begin, len(ids)))
            done = low == _NO_PAIR
            if done.any():
                gone = np.repeat(done, size)
                left_over, of = ids[gone], owner[gone]
                bounds = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of)).tolist()
                values, names = left_over.tolist(), of.tolist()
                for a, b in zip(bounds, bounds[1:]):
                    out[names[a]] = values[a:b]
                ids, owner, pair, last = ids[~gone], owner[~gone], pair[~gone], last[~gone]
                if not len(ids):
                    break
                low, size = low[~done], size[~done]
            hit = np.flatnonzero(pair == np.repeat(low, size))
            hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])]  # the leftmost of each match
            ids[hit] = pair[hit]
            last[hit] = last[hit + 1]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            at = hit - np.arange(len(hit))  # places after the joins
            ids, owner, pair, last = ids[stay], owner[stay], pair[stay], last[stay]
            new = np.full(len(at), _NO_PAIR)
            inner = np.flatnonzero(~last[at])
            new[inner] = rank_of(ids[at[inner]], ids[at[inner] + 1])
            pair[at] = new
            before = at[(at > 0) & (owner[np.maximum(at - 1, 0)] == owner[at])] - 1
            pair[before] = rank_of(ids[before], ids[before + 1])
    return (np.array([i for m in out for i in m], np.uint32), np.array([len(m) for m in out], np.int64))


@functools.lru_cache(2)
def rank_encoder(path: str) -> CachedEncoder:
    return CachedEncoder(lambda pieces: merge_together(pieces, path))


@functools.lru_cache(2)
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes end to end, and the bounds of each id."""
    ranks = load_ranks(path)
    by_id = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
    return np.frombuffer(b"".join(by_id), np.uint8), bounds


def decode_ids(ids: np.ndarray, path: str) -> np.ndarray:
    """Bytes of the ids by one gather from the byte table."""
    blob, bounds = byte_table(path)
    ids = ids.astype(np.int64)
    size = bounds[ids + 1] - bounds[ids]
    ends = np.cumsum(size)
    return blob[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(bounds[ids] - (ends - size), size)]


def binary_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of a numpy array as an Arrow binary column."""
    width = values.dtype.itemsize
    offs = pa.array((bounds * width).astype(np.int32), pa.int32())
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1,
                                       [None, offs.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def encode(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, ``ids`` (little-endian unsigned 32-bit),
    ``offsets`` (byte offset of each token in the text, same coding),
    ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks_path)
        for batch, data, bounds in sub_batches(batches, text):
            ids, cut = encoder(data, bounds)
            _, sizes = byte_table(ranks_path)
            ends = np.cumsum(sizes[ids.astype(np.int64) + 1] - sizes[ids.astype(np.int64)])
            begin = np.concatenate([[0], ends])[:-1] - np.repeat(bounds[:-1], np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), binary_rows(ids.astype("<u4"), cut), binary_rows(begin.astype("<u4"), cut),
                 pa.array(np.diff(cut), pa.int64())], names=[key, "ids", "offsets", "n_tokens"])

    return keyed_text(docs, key, text).mapInArrow(run, f"{key} long, ids binary, offsets binary, n_tokens long")


def decode(encoded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """Adds ``decoded`` (the bytes of the ids) to the rows of ``encode``; a
    null ``ids`` decodes to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                out = [decode_ids(np.frombuffer(v or b"", "<u4"), ranks_path).tobytes()
                       for v in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())],
                                                 names=[*part.schema.names, "decoded"])

    return (encoded.select(key, "ids", "n_tokens")
            .mapInArrow(run, f"{key} long, ids binary, n_tokens long, decoded binary"))
