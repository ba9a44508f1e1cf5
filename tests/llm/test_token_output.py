"""Token shards: ids against the tokenizers library, keyed access, perfect hash."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkyard.llm.token_output import (
    Mph, PieceEncoder, build_mph, encode_and_read, fingerprint, locate_tokens, lookup_tokens, write_tokens,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _brute(rows):
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    coded = [(k, tok.encode(t or "", add_special_tokens=False).ids + [2]) for k, t in rows]
    for k, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]))):
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def _norm(rows):
    return sorted(rows, key=lambda r: r[1])


def test_odd_rows_read_back_as_encoded(spark, odd_docs, odd_rows):
    got = [tuple(r) for r in encode_and_read(odd_docs, PATH).collect()]
    assert _norm(got) == _norm(_brute([(r[0], r[1]) for r in odd_rows]))


def test_no_rows(no_docs):
    assert encode_and_read(no_docs, PATH).count() == 0


def test_small_shards_and_lookup(spark, odd_docs, odd_rows, workdir):
    path = f"{workdir}/tokens"
    write_tokens(odd_docs, path, PATH, shard_bytes=500, range_bytes=20_000)
    assert spark.read.parquet(f"{path}/shards").count() > 10
    asked = spark.createDataFrame([(5,), (8,), (None,), (999,), (-3,)], "doc_id long")
    got = sorted(((r["key"] is not None, r["key"] or 0, r["start"], r["n_ids"], np.frombuffer(r["ids"], "<u2").tolist())
                  for r in lookup_tokens(spark, path, asked).collect()))
    tok = Tokenizer.from_file(PATH)
    want = {(k, s): n for k, s, n, _ in _brute([(r[0], r[1]) for r in odd_rows])}
    assert [(g[1] if g[0] else None, g[2]) for g in got] == sorted(
        [k for k in want if k[0] in (5, 8, None)], key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    text = dict((r[0], r[1]) for r in odd_rows)
    for has, key, _, n, ids in got:
        if has:
            assert ids == tok.encode(text[key], add_special_tokens=False).ids + [2] and len(ids) == n
    assert locate_tokens(spark, path, asked.where("doc_id = 999")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab .,\n\t'sé1_!\u00a0\u3000\x00\x1c漢<|>")), max_size=25), max_size=8))
def test_pieces_equal_the_whole(texts):
    enc = PieceEncoder.shared(PATH)
    got = [np.frombuffer(x, enc.width).tolist() for x in enc.encode(texts, 2)]
    assert got == [enc.tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-2**63, 2**63 - 1), max_size=300))
def test_perfect_hash_is_minimal_and_found_again(keys):
    keys = np.array(sorted(keys), np.int64)
    index, slots = build_mph(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert Mph(index).slots(keys).tolist() == slots.tolist()
    table = np.empty(len(keys), np.uint64)
    table[slots] = fingerprint(keys)
    other = np.setdiff1d(np.arange(1000, dtype=np.int64) * 7919 + 13, keys)
    at = Mph(index).slots(other)
    assert not any(table[s] == f for s, f in zip(at, fingerprint(other)) if s >= 0)


def test_only_the_usual_split_is_cut_into_pieces():
    texts = ["Hello World. A  b,c\nd", "don't stop", "  x ", "Ünïcode, é."]
    for name, cut in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        enc = PieceEncoder(public_tokenizers.path(name))
        assert enc.cuts is cut
        assert [np.frombuffer(x, enc.width).tolist() for x in enc.encode(texts, 2)] == [
            enc.tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_pieces_forgotten_and_met_again():
    enc = PieceEncoder(PATH, keep=50)
    texts = [" ".join(f"word{i % 97}x" for i in range(k, k + 60)) + ". Ende, été\nneu" for k in range(0, 900, 45)]
    for at in (0, 7, 14, 0):
        some = texts[at: at + 7]
        assert [np.frombuffer(x, enc.width).tolist() for x in enc.encode(some, 2)] == [
            enc.tok.encode(t, add_special_tokens=False).ids + [2] for t in some]
    assert len(enc.late[0]) < 200


def test_many_ranges_from_sampled_keys(spark, workdir):
    docs = spark.range(5000).selectExpr("id * 3 AS doc_id", "concat('text number ', id) AS text")
    write_tokens(docs, f"{workdir}/many", PATH, range_bytes=1000)
    assert spark.read.parquet(f"{workdir}/many/shards").select("shard").distinct().count() > 60
    starts = encode_and_read(docs, PATH).orderBy("doc_id").collect()
    assert [r["start"] for r in starts] == list(np.cumsum([0] + [r["n_tokens"] for r in starts[:-1]]))


def test_a_new_piece_costs_little_beside_the_pieces_held():
    """Learning pieces copies the rows that tell where ids lie, never the ids of every piece piece by piece."""
    enc, rng = PieceEncoder(PATH), np.random.default_rng(3)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (60_000, 9)).tolist()]
    enc.encode([" ".join(words)], 2)
    held = sum(x.nbytes for x in enc.late)
    assert len(enc.late[0]) > 59_000
    texts = ["one newpieceqq two", words[0] + " " + words[-1] + " again"]
    tracemalloc.start()
    try:
        got = [np.frombuffer(x, enc.width).tolist() for x in enc.encode(texts, 2)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.5 * held
    assert got == [enc.tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]
