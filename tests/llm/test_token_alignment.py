"""Two tokenizers over one text, against plain loops, and on awkward input."""

from __future__ import annotations

import collections
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rollbook.llm import queries, token_alignment
from tokenizers import Tokenizer

DIR = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(both, text: str | None):
    """Groups of one text as lists of A ids and B ids, by walking both token lists."""
    a, b = both
    if not text:
        return []
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    ta = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    tb = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    if b"".join(x for _, x in ta) != whole or b"".join(x for _, x in tb) != whole:
        return []
    groups, at_a, at_b = [([], [])], 0, 0
    while ta or tb:
        if at_a == at_b and (groups[-1][0] or groups[-1][1]):
            groups.append(([], []))
        if at_a <= at_b:
            i, x = ta.pop(0)
            groups[-1][0].append(i)
            at_a += len(x)
        else:
            i, x = tb.pop(0)
            groups[-1][1].append(i)
            at_b += len(x)
    return groups


def expected(both, texts: list[str | None]) -> list[tuple]:
    groups = [plain(both, t) for t in texts]
    links = [collections.Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in groups]
    count = collections.Counter(p for c in links for p in c)
    most: dict[int, int] = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    told = [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g) for g in groups]
    return [(sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), sum(k for (x, y), k in c.items() if count[x, y] == most[x]), sum(k * count[p] for p, k in c.items()),
             hashlib.sha256(s.encode()).hexdigest() if s else "") for g, c, s in zip(groups, links, told, strict=True)]


def run(docs, pattern=public_tokenizers.PATTERN):
    aligned = token_alignment.with_row_numbers(token_alignment.align(docs, A, B, pattern, keep=("doc_id",)))
    counts = token_alignment.pair_counts(aligned)
    told = aligned.select("_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts")
    rows = token_alignment.score(told, counts, keep=("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")).collect()
    return [(r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")) for r in rows]


TEXTS = [None, "", " ", "   \n\t ", "a", "naïve œuvre 😀 ½ x²", "x" * 3000, "<|endoftext|> and </s> <s> <0x41> ▁ mark", "\x00\x01 b", "don't we'll    it's\n\n\nok now 12345 _#_",
         " leading", "trailing  ", "日本語のテキスト", "é" * 200, "  two  spaces  ", "▁under", "ﬁ ligature", "﻿bom", "a b", "=" * 333, "the cat the cat", "the cat the cat"]


@pytest.mark.parametrize("bound", [400_000, 40, 0])
def test_matches_plain_loops(spark, both, monkeypatch, bound):
    monkeypatch.setattr(token_alignment, "FREQUENT", bound)  # the others are joined
    docs = spark.createDataFrame([(i, t, "g", "p") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, groups string, pairs string")
    got = dict(run(docs))
    want = expected(both, TEXTS)
    for i in range(len(TEXTS)):
        assert got[i] == want[i], TEXTS[i]


def test_ids_as_ranks(both):
    """Both ways to run A agree: on the file's merges, and on how every kind of character is cut."""
    with open(A, "rb") as fa, open(B, "rb") as fb:
        a_file, b_file = fa.read(), fb.read()
    assert token_alignment.ranks_suffice(a_file)
    spec = json.loads(a_file)
    spec["model"]["merges"][1000], spec["model"]["merges"][1001] = spec["model"]["merges"][1001], spec["model"]["merges"][1000]
    assert not token_alignment.ranks_suffice(json.dumps(spec).encode())
    slow, fast = (token_alignment.Tokenizers(a_file, b_file, p) for p in (None, public_tokenizers.PATTERN))
    texts = [t for t in TEXTS if t] + [f"a{c}b 1{c}2 {c} {c}{c} !{c}? \n{c}\n x" for c in map(chr, [*range(0x3000), *range(0xD7A0, 0xD800), *range(0xE000, 0x1F800, 7)])]
    assert slow.encode_a(texts) == fast.encode_a(texts)


def test_without_a_pattern(spark, both):
    docs = spark.createDataFrame(list(enumerate(TEXTS[5:12])), "doc_id bigint, text string")
    assert sorted(run(docs, None)) == sorted(enumerate(expected(both, TEXTS[5:12])))


def test_odd_rows(spark, both):
    docs = spark.createDataFrame([(None, "one text"), (3, "one text"), (3, "another text"), (4, None)], "doc_id bigint, text string")
    assert sorted(run(docs), key=str) == sorted(zip([None, 3, 3, 4], expected(both, ["one text", "one text", "another text", None]), strict=True), key=str)
    bad = docs.filter("doc_id = 4").select("doc_id", F.expr("cast(X'61FF62' as string)").alias("text"))
    assert run(bad) == [(4, (0, 0, 0, 0, 0, 0, ""))]
    assert run(docs.limit(0)) == []


def test_long_texts_in_parts(both, monkeypatch):
    with open(A, "rb") as fa, open(B, "rb") as fb:
        tok = token_alignment.Tokenizers(fa.read(), fb.read())
    assert tok.cuts
    text = "\n".join(t for t in TEXTS if plain(both, t)) * 30 + " and so on, it's said: 12 x" * 200
    monkeypatch.setattr(token_alignment, "PART", 50)
    parts = tok.parts(text)
    assert len(parts) > 50 and " ".join(parts) == text
    changed = next(t for t in TEXTS if t and not plain(both, t))
    rows = [token_alignment.Row(), token_alignment.Row()]
    token_alignment.align_parts(tok, rows, [(0, "one part"), (1, "fine"), (0, changed), (0, "last")])
    assert rows[0] is None and rows[1].done()[0][0] == 1
    row = token_alignment.Row()
    for at in range(0, len(parts), 7):
        token_alignment.align_parts(tok, [row], [(0, p) for p in parts[at: at + 7]])
    n, groups, pairs, counts = row.done()
    want = plain(both, text)
    assert groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want) and n[2] == len(want)
    assert dict(zip(pairs.tolist(), counts.tolist(), strict=True)) == collections.Counter((x << 32) + y for ga, gb in want for x in ga for y in gb)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 4), min_size=1, max_size=40), st.sampled_from([1, 3, 1000]))
def test_groups_and_links(a_size, b_size, large):
    total = max(sum(a_size), sum(b_size))
    a_size, b_size = ([*x, total - sum(x)] if sum(x) < total else x for x in (a_size, b_size))
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    last_a, last_b = token_alignment.terminals(a_end, b_end)
    common = sorted(set(a_end.tolist()) & set(b_end.tolist()))
    for ends, last in ((a_end, last_a), (b_end, last_b)):
        assert [int(a_end[x]) for x in last] == [min(c for c in common if c >= e) for e in ends.tolist()]
    number = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    at = [np.searchsorted(x, np.arange(len(common) + 1)) for x in number]
    ids = np.arange(len(a_end)) % 3, np.arange(len(b_end)) % 2
    old, token_alignment.LARGE = token_alignment.LARGE, large
    try:
        t, p, k = token_alignment.link_pairs(*ids, *at, np.arange(len(common)) // 2)
    finally:
        token_alignment.LARGE = old
    want = collections.Counter((g // 2, int(ids[0][i] << 32 | ids[1][j])) for g in range(len(common)) for i in range(at[0][g], at[0][g + 1]) for j in range(at[1][g], at[1][g + 1]))
    assert dict(zip(zip(t.tolist(), p.tolist(), strict=True), k.tolist(), strict=True)) == want and list(zip(t, p, strict=True)) == sorted(zip(t, p, strict=True))


def test_query_matches_plain_loops(spark, both):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], expected(both, [r.text for r in docs]), strict=True))
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in queries.op11_cross_tokenizer_alignment(spark, DIR).collect()}
    assert got == want
