"""op1, op4, op9: encoders against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitecast.llm import bpe, token_output
from sitecast.llm.q_bpe import RANKS
from sitecast.llm.q_tokens import TOKENIZER
from sitecast.llm.token_counts import attribute

LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def encode(texts, encoder=None):
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    ids, cut = (encoder or bpe.rank_encoder(RANKS))(np.frombuffer(b"".join(raw), np.uint8), bounds)
    return [ids[cut[i]:cut[i + 1]].tolist() for i in range(len(raw))]


ALPHABET = [*"aB'stmdrevl  \n\t1²½!?.-é世　 \x85\x1c😀́", "'s", "'re", "'ll", "  "]


@pytest.mark.parametrize("segment", [1 << 20, 16])
def test_matches_the_library_on_mixed_text(segment, monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", segment)
    random.seed(3)
    texts = ["".join(random.choice(ALPHABET) for _ in range(random.randint(0, 60))) for _ in range(800)]
    assert encode(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_any_text_round_trips(texts):
    got = encode(texts)
    assert got == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [bpe.decode_ids(np.array(i, np.uint32), RANKS).tobytes().decode() for i in got] == texts


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000 + " " * 999, "'" * 300, "é" * 700 + "s", ""])
def test_long_matches(text):
    assert encode([text])[0] == LIBRARY.encode_ordinary(text)


def test_every_code_point_has_the_librarys_class():
    texts = [f"a{c}a1{c}1 {c}" for c in map(chr, range(0, 0x30000, 7)) if not "\ud800" <= c <= "\udfff"]
    assert encode(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_cache_starts_over():
    encoder = bpe.CachedEncoder(bpe.rank_encoder(RANKS).encode_words, max_words=20)
    for k in range(6):
        texts = [" ".join(f"x{j}y{k}" for j in range(30)) + " the end"]
        assert encode(texts, encoder) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_library_cache_gives_whole_text_ids():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    random.seed(4)
    texts = ["".join(random.choice(ALPHABET) for _ in range(random.randint(0, 60))) for _ in range(600)]
    assert encode(texts, token_output.library_encoder(TOKENIZER)) == [
        t.encode(x, add_special_tokens=False).ids for x in texts]


def test_added_tokens_as_in_the_library_as_loaded(spark, tmp_path):
    from sitecast.llm.q_tokens import op1_token_output
    texts = ["one <|endoftext|> two", "plain", "<|endoftext|><|endoftext|>", "", "<|endoftext", "|> x", "é<|endoftext|>"]
    t = Tokenizer.from_file(TOKENIZER)
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert want[0] == [505, 220, 50256, 734]
    assert encode(texts, token_output.library_encoder(TOKENIZER, added=True)) == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for r in op1_token_output(spark, str(tmp_path)).orderBy("doc_id").collect():
        ids = [*want[r.doc_id], 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), token_output.crc32_le(ids))
        start += len(ids)


def test_encode_and_decode_rows(docs):
    rows = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect())
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded).decode()) for r in rows)
    assert got == want
    assert all(np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary(bytes(r.decoded).decode()) for r in rows)


def test_offsets_address_tokens(docs):
    for r in bpe.encode(docs, RANKS).join(docs.where("doc_id = 10").select("doc_id", "text"), "doc_id").collect():
        ids, at = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.offsets, "<u4")
        raw = r.text.encode()
        for i, o in zip(ids, at):
            token = LIBRARY.decode_single_token_bytes(int(i))
            assert raw[o:o + len(token)] == token


def test_op4_whole_table(spark):
    from sitecast.llm.q_bpe import op4_bpe
    got = {r.doc_id: r for r in op4_bpe(spark, "/root/testdata/sf0.001").collect()}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = LIBRARY.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=70))
def test_pack_round_trip(values):
    block = token_output.pack(np.array(values, np.uint32))
    assert token_output.unpack(block).tolist() == values
    n_data = sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert len(block) == 8 + -(-len(values) // 4) + n_data + -len(values) % 4  # the last four are filled up with zeros


def test_unpack_refuses_other_bytes():
    with pytest.raises(ValueError):
        token_output.unpack(b"nothing here")


def test_written_dataset(spark, docs, tmp_path):
    token_output.write_tokens(docs, f"file://{tmp_path}/t", TOKENIZER)
    rows = token_output.read_tokens(spark, f"file://{tmp_path}/t").orderBy("start").collect()
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    want = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start = 0
    for r, d in zip(rows, want, strict=True):
        ids = [*t.encode(d.text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    # the commonest id has rank 0
    top = spark.read.parquet(f"file://{tmp_path}/t/ranks").where("rank = 0").first().token_id
    counts = np.bincount(np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]))
    assert counts[top] == counts.max()


def test_written_empty_table(spark, no_docs, tmp_path):
    token_output.write_tokens(no_docs, f"file://{tmp_path}/t", TOKENIZER)
    assert token_output.read_tokens(spark, f"file://{tmp_path}/t").count() == 0


def spans(text):
    """(first char, end char) of each token, by brute force."""
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    at, out = 0, []
    for i in LIBRARY.encode_ordinary(text):
        n = len(LIBRARY.decode_single_token_bytes(i))
        out.append((char_of[at], char_of[at + n - 1] + 1))
        at += n
    return out


@pytest.mark.parametrize("rule", ["first", "middle", "last"])
def test_attribution_by_brute_force(docs, rule):
    got = {}
    for r in attribute(docs, RANKS, rule).collect():
        got.setdefault(r.doc_id, []).append(r)
    for d in docs.dropDuplicates(["doc_id"]).collect():
        text = d.text or ""
        home = {"first": lambda b, e: b, "middle": lambda b, e: (b + e - 1) // 2, "last": lambda b, e: e - 1}[rule]
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append((at, min(len(text), at + len(line) + 1)))
            at += len(line) + 1
        rows = sorted(got[d.doc_id], key=lambda r: r.section)[::2 if d.doc_id == 5 else 1]
        assert [(r.begin, r.end) for r in rows] == lines
        s = spans(text)
        assert [r.n_tokens for r in rows] == [sum(lo <= home(b, e) < hi for b, e in s) for lo, hi in lines]
        assert [r.n_crossing for r in rows] == [
            sum(b < hi and e > lo and not (lo <= b and e <= hi) for b, e in s) if hi > lo else 0 for lo, hi in lines]
        assert sum(r.n_tokens for r in rows) == len(s)


def test_attribution_to_given_spans(spark):
    rows = spark.createDataFrame([(1, "héllo wörld again", [(0, 5), (3, 999), (-4, 2), (9, 9)]), (2, None, None), (3, "x", [])],
                                 "doc_id long, text string, s array<struct<begin: long, end: long>>")
    got = sorted(attribute(rows, RANKS, "first", sections="s").collect(), key=lambda r: r.section)
    s = spans("héllo wörld again")
    assert [(r.begin, r.end) for r in got] == [(0, 5), (3, 17), (0, 2), (9, 9)]
    assert [r.n_tokens for r in got] == [sum(lo <= b < hi for b, _ in s) for lo, hi in [(0, 5), (3, 17), (0, 2), (9, 9)]]
    with pytest.raises(ValueError):
        attribute(rows, RANKS, "nearest")


def test_empty_tables(no_docs):
    assert bpe.decode(bpe.encode(no_docs, RANKS), RANKS).count() == 0
    assert attribute(no_docs, RANKS).count() == 0
