"""Encoding against tiktoken and against merging pair by pair; decoding in blocks of any size."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.conftest import SF_DIR
from tests.llm.samples import EDGES, text
from tidemart.llm import byte_bpe as b
from tidemart.llm.common import table

PARAMS = b.BpeParams(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
RANKS = b.read_ranks(PARAMS.ranks)


@pytest.fixture(scope="module")
def merges():
    return b.Merges(RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PARAMS.pattern, mergeable_ranks=RANKS, special_tokens={})


def ids(encoder, t: str, **how) -> list[int]:
    return np.frombuffer(b"".join(encoder.blocks(t, **how)), "<u4").tolist()


def odd_text(r: random.Random) -> str:
    kinds = ["abcdefgh ", "étà ñ中文字 ", "  \n\t\r'", "0123456789.,;!?'stred llve", " \x85\x1c\x1f\xa0  a", "😀🎉👍🏽 x",
             "аеиоу абв", "العربية", "ｱｲｳ ９８", "é ö"]
    return "".join(r.choice(r.choice(kinds)) for _ in range(r.randrange(60)))


def test_words_are_cut_only_where_the_pattern_allows_it():
    assert b.SPACE_OPENS == public_tokenizers.PATTERN


def test_texts_equal_tiktoken(merges, reference):
    r, encoder = random.Random(1), b.Encoder(merges, PARAMS)
    for _ in range(4000):
        t = odd_text(r)
        assert ids(encoder, t) == ids(encoder, t, size=5) == reference.encode_ordinary(t), t


@pytest.mark.parametrize("steps", [40, 5000, 10**6])
def test_single_matches_with_full_and_empty_tables(merges, reference, steps):
    r, tokens, machine = random.Random(2), list(RANKS), b.Transducer(merges, steps)
    for _ in range(4000):
        match = b"".join(r.choice(tokens) for _ in range(r.randrange(1, 5)))
        assert machine.encode(match) == reference._core_bpe.encode_single_piece(match)
    long = b"ab" * 3000 + b"hello" * 900 + "é".encode() * 1001
    assert machine.encode(long) == reference._core_bpe.encode_single_piece(long)


def test_ranks_out_of_order_and_tokens_that_merging_never_gives():
    """Small vocabularies made at random, where merged tokens may rank before their parts."""
    r = random.Random(3)
    for _ in range(60):
        made = {bytes([r.choice(b"abc") for _ in range(r.randrange(2, 6))]) for _ in range(14)}
        order = [bytes([i]) for i in range(256)] + list(made)
        r.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        merges, other = b.Merges(ranks), tiktoken.Encoding("r", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
        for machine in (b.Transducer(merges, 30), b.Transducer(merges, 10**6)):
            for _ in range(60):
                match = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 14)))
                assert machine.encode(match) == other._core_bpe.encode_single_piece(match), (order[-20:], match)


def test_other_patterns_are_found_match_by_match(merges):
    params = b.BpeParams(PARAMS.ranks, r"\w+ |\W+|\w+")
    reference = tiktoken.Encoding("own", pat_str=params.pattern, mergeable_ranks=RANKS, special_tokens={})
    encoder, r = b.Encoder(merges, params), random.Random(4)
    for _ in range(300):
        t = odd_text(r)
        assert ids(encoder, t) == reference.encode_ordinary(t)


def test_decoding_in_any_blocks(merges):
    table_, r = b.DecodeTable(merges.token), random.Random(5)
    for _ in range(2000):
        some = np.array([r.randrange(50256) for _ in range(r.randrange(14))], np.uint32)
        whole = b"".join(merges.token[i] for i in some.tolist())
        blocks = np.split(some, sorted(r.randrange(len(some) + 1) for _ in range(3)))
        assert b"".join(b.decode_blocks(blocks, table_)) == whole
    encoder = b.Encoder(merges, PARAMS)
    for _ in range(500):
        t = odd_text(r)
        decoder, out = b.StreamDecoder(table_), []
        for one in ids(encoder, t):  # each block gives complete characters only
            out.append(decoder.text(np.array([one])))
            assert "�" not in out[-1]
        assert "".join(out) == t and decoder.finish() == b""


def brute(reference, rows):
    out = []
    for doc_id, t in rows:
        t = t or ""
        got = np.array(reference.encode_ordinary(t), "<u4")
        out.append((doc_id, len(got), hashlib.sha256(got.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_defined_cases_and_long_texts(docs, reference):
    long = text(7, 4000) + "x" * 30_000 + "  \n" * 500
    df = docs(*EDGES, (910, long), (911, " starts with a space"), (912, "ends "))
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id != 906]
    found = b.round_trip(df, PARAMS)
    assert sorted(map(tuple, found.where("doc_id <> 906 or doc_id is null").collect()), key=repr) == brute(reference, rows)
    # 200,000 letters in one match: slow for pair by pair merging, linear here
    back = b.decode(b.encode(df, PARAMS), PARAMS)
    assert sorted(map(repr, back.collect())) == sorted(
        repr(r) for r in df.selectExpr("doc_id", "coalesce(text, '') AS text").collect())
    assert b.round_trip(df.limit(0), PARAMS).count() == 0
    assert b.decode(df.selectExpr("doc_id", "cast(null AS binary) AS ids"), PARAMS).where("text is not null").count() == 0


def test_query_equals_tiktoken(spark, reference):
    from tidemart.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_byte_bpe"](spark, SF_DIR).collect()), key=repr) == brute(reference, docs)
