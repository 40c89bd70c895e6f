import base64
import hashlib

import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import AWKWARD, awkward

from tidemart.llm import bpe, queries

PATH = public_tokenizers.path(queries.RANKS)
RAW = open(PATH, "rb").read()
RANKS = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in RAW.splitlines())}
WHOLE = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
# Tiny leaves, so that short texts are joined many times over.
TINY = {n: bpe.ByteBpe(RAW, public_tokenizers.PATTERN, leaf_chars=n) for n in (1, 2, 5, 16)}


def digests(text):
    ids = WHOLE.encode_ordinary(text)
    decimal = " ".join(map(str, ids))
    return len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_query_against_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_byte_bpe"](spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: digests(t) for i, t in texts.items()}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab c's'll 12.\n\t!  \x1c\x85\xa0é́中ß🙂"), st.characters(exclude_categories=["Cs"])), max_size=90))
@pytest.mark.parametrize("leaf", TINY)
def test_joined_halves_equal_the_whole(leaf, text):
    ids = TINY[leaf].encode(text)
    assert ids.tolist() == WHOLE.encode_ordinary(text)
    assert TINY[leaf].decode(ids) == text.encode()


@pytest.mark.parametrize(
    "text", ["a" * 20_000, " " * 9_000 + "x", "ab1!" * 5_000, "中文字" * 4_000, "don't " * 3_000, "\n \n" * 4_000]
)
def test_texts_without_easy_cuts(text):
    ids = bpe.ByteBpe(RAW, public_tokenizers.PATTERN).encode(text)
    assert ids.tolist() == WHOLE.encode_ordinary(text)


def test_no_call_of_the_library():
    """Every text goes through leaves, joins and the rank table."""
    assert not hasattr(bpe, "tiktoken")


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300) | st.lists(st.sampled_from([b"a", b"ab", b" the", b"\xc3", b"\xa9"]), max_size=90).map(b"".join))
def test_both_ways_of_merging_equal_the_library(data):
    table = bpe.RankTable(RANKS)
    want = tuple(WHOLE._core_bpe.encode_single_piece(data)) if data else ()
    assert table._by_search(data) == want and table._by_heap(data) == want


def test_long_matches_that_grow_over_many_joins():
    text = " ".join("ab" * n + "!?" * n for n in (1, 30, 31, 32, 33, 64, 65, 100, 1000)) + " " * 300 + "\u00a0" * 70
    for leaf in (1, 7, 96):
        coder = bpe.ByteBpe(RAW, public_tokenizers.PATTERN, leaf_chars=leaf)
        assert coder.encode(text).tolist() == WHOLE.encode_ordinary(text)


def test_contractions_cut_anywhere():
    text = "we'll they've I'd 'll''ll x'l l'r e 're''s' s"
    for leaf in (1, 2, 3, 4, 5):
        coder = bpe.ByteBpe(RAW, public_tokenizers.PATTERN, leaf_chars=leaf)
        for start in range(len(text)):
            assert coder.encode(text[start:]).tolist() == WHOLE.encode_ordinary(text[start:])


def test_patterns_with_gaps_and_groups():
    pattern = r"([a-z]+)|[0-9]"
    gaps = tiktoken.Encoding("gaps", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    text = "ab, cd 12 ef" * 40 + "g" * 200 + " - " + "h" * 90
    assert bpe.ByteBpe(RAW, pattern, leaf_chars=9).encode(text).tolist() == gaps.encode_ordinary(text)
    with pytest.raises(ValueError, match="look behind"):
        bpe.ByteBpe(RAW, r"(?<=a)b|.")


def test_few_remembered_matches(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "some words that differ and some words that do not " * 20
    assert bpe.ByteBpe(RAW, public_tokenizers.PATTERN).encode(text).tolist() == WHOLE.encode_ordinary(text)


def test_awkward_rows(spark):
    ranks = bpe.vocabulary(spark, PATH)
    rows = bpe.round_trip(awkward(spark), ranks, public_tokenizers.PATTERN, with_ids=True).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows), key=str)
    assert got == sorted(((i, *digests(t or "")) for i, t in AWKWARD), key=str)
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_encode_then_decode(spark):
    ranks = bpe.vocabulary(spark, PATH)
    ids = bpe.encode(awkward(spark), ranks, public_tokenizers.PATTERN)
    data = bpe.decode(ids, ranks, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, bytes(r.data).decode()) for r in data.collect()), key=str)
    assert got == sorted(((i, t or "") for i, t in AWKWARD), key=str)


def test_empty_table(spark):
    ranks = bpe.vocabulary(spark, PATH)
    assert bpe.round_trip(awkward(spark, []), ranks, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(awkward(spark, []), ranks, public_tokenizers.PATTERN).count() == 0
