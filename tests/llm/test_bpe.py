"""Merges of many pieces side by side and of long pieces, against the tiktoken library; encoding shuffles nothing."""

from __future__ import annotations

import random

import numpy as np
import pytest

from rollbook.llm import bpe, queries

WORDS = ["the", " children", "'ll", "  ", "\n\n", "12345", " naïve", "œuvre", "😀😀", "日本語", " x²", "_#_", "\x00\x01", "aaaaaaaa", " internationalisation", "zqxjkv"]


@pytest.fixture(scope="module")
def known():
    tiktoken, P = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks, pattern = queries.tokenizer()
    return ranks, pattern, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_pieces() -> list[bytes]:
    r = random.Random(5)
    made = ["".join(r.choice("aeioustrn ") for _ in range(n)) for n in range(1, 140, 3)] + ["x" * n for n in (1, 2, 63, 64, 65, 700)]
    return [w.encode() for w in [*WORDS, *made, *made[:3]]] + [bytes(r.randrange(256) for _ in range(n)) for n in (1, 9, 70)]


@pytest.mark.parametrize("long", [bpe.LONG, 0, 10_000])
def test_pieces_merge_as_tiktoken_does(known, monkeypatch, long):
    monkeypatch.setattr(bpe, "LONG", long)
    pieces = odd_pieces()
    ids, at = bpe.merge_pieces(pieces, bpe.Merges(known[0]))
    assert [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:], strict=True)] == [known[2]._core_bpe.encode_single_piece(p) for p in pieces]


def test_no_pieces_and_bytes_without_a_rank(known):
    ids, at = bpe.merge_pieces([], bpe.Merges(known[0]))
    assert len(ids) == 0 and at.tolist() == [0]
    with pytest.raises(ValueError, match="no rank"):
        bpe.merge_pieces([b"ab"], bpe.Merges({b"a": 0}))


def test_encoding_shuffles_nothing_and_takes_long_pieces(spark, known):
    ranks, pattern, enc = known
    texts = ["ab" * 60_000, None, "", " ".join(WORDS)]
    out = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ranks, pattern)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r.ids for r in out.collect()}
    assert {i: got[i] for i in (1, 2, 3)} == {i: enc.encode_ordinary(texts[i] or "") for i in (1, 2, 3)}
    assert b"".join(enc.decode_single_token_bytes(x) for x in got[0]) == texts[0].encode()


def test_pairs_are_found_where_their_places_clash():
    """Every pair of a small vocabulary, also those that share a place in the table; any other pair has none."""
    ranks = {bytes([x]): x for x in range(256)} | {bytes([x, y]): 256 + 60 * x + y for x in range(60) for y in range(60)}
    merges = bpe.Merges(ranks)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(256), np.arange(256), indexing="ij"))
    want = np.where((a < 60) & (b < 60), 256 + 60 * a + b, bpe.NONE)
    assert merges.look_up(a, b).tolist() == want.tolist() and len(merges.by_key()) == 3600
    assert bpe.Merges({bytes([x]): x for x in range(256)}).look_up(a, b).min() == bpe.NONE


def test_pieces_are_remembered(monkeypatch):
    ranks = {bytes([x]): x for x in range(256)} | {b"ab": 256, b"abc": 257}
    merges, asked, plain = bpe.Merges(ranks), [], bpe.merge_pieces
    monkeypatch.setattr(bpe, "merge_pieces", lambda p, m: asked.append(list(p)) or plain(p, m))
    monkeypatch.setattr(bpe, "KEPT", 2)
    for pieces in ([b"abd", b"abcab"], [b"zz", b"abcab", b"abd"], [b"zz", b"abd", b"q" * 99], []):
        ids, at = merges.encode(pieces)
        want, ends = plain(pieces, merges)
        assert (ids.tolist(), at.tolist()) == (want.tolist(), ends.tolist())
    assert asked == [[b"abd", b"abcab"], [b"zz"], [b"zz", b"q" * 99], []]


def test_ids_as_bytes(spark):
    from rollbook.llm import token_shards
    ranks = {bytes([x]): x for x in range(256)} | {b"ab": 256, b" ab": 300}
    docs = spark.createDataFrame([(1, "ab ab zé"), (2, None), (3, ""), (4, "ab" * 50)], "doc_id int, text string")
    made = bpe.encode(docs, ranks, r" ?\p{L}+|\s+", keep=("doc_id",), width=2)
    want = token_shards.packed(bpe.encode(docs, ranks, r" ?\p{L}+|\s+", keep=()), 2)
    assert made.dtypes == [("doc_id", "int"), ("ids", "binary")]
    assert [bytes(r.ids) for r in made.orderBy("doc_id").collect()] == [bytes(r.ids) for r in want.collect()]
    with pytest.raises(ValueError):
        bpe.encode(docs, ranks, r" ?\p{L}+|\s+", width=1)
