"""Token counts and packing against the tokenizers library itself."""

import zlib

import numpy as np
import pytest

from reelstat.llm import tokenizing
from reelstat.llm.packing import pack_documents, sum_of_squares
from reelstat.llm.queries import RANKS, TOKENIZER
from reelstat.llm.token_counts import token_counts


@pytest.fixture(scope="module")
def ids(odd_rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizing.public_path(TOKENIZER))
    return {r[1]: library.encode(r[1] or "", add_special_tokens=False).ids for r in odd_rows}


def test_shortcuts_equal_the_library(ids):
    for text, want in ids.items():
        text = text or ""
        assert tokenizing.ids(text, TOKENIZER, RANKS).tolist() == want
        words, special = tokenizing.pretokens(text, TOKENIZER)
        assert int(tokenizing.piece_counts(words, TOKENIZER).sum()) + special == len(want)


def test_counts(odd, odd_rows, ids):
    got = sorted((tuple(r) for r in token_counts(odd, TOKENIZER, limit=20).collect()), key=str)
    want = [(r[0], len((r[1] or "").encode()), len(ids[r[1]]), len(ids[r[1]]) > 20) for r in odd_rows]
    assert got == sorted(want, key=str)


def check_pieces(rows, ids_of, capacity):
    placed = {}
    for r in rows:
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


def test_packing(odd, odd_rows, ids):
    rows = pack_documents(odd, TOKENIZER, RANKS, capacity=64, group_pieces=32).collect()
    check_pieces(rows, ids, 64)
    want = []
    for r in odd_rows:
        own = [*ids[r[1]], 2]
        first = (len(own) - 1) % 64 + 1
        cuts = [0, *range(first, len(own) + 1, 64)]
        want += [(r[0], k, a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)


def test_sum_of_squares_is_near_the_bound():
    lengths = -np.sort(-np.random.default_rng(3).integers(1, 1025, 4000))
    sequence, offset = sum_of_squares(lengths, 1024)
    fill = np.bincount(sequence, weights=lengths)
    assert fill.max() <= 1024 and len(fill) <= 1.01 * lengths.sum() / 1024 + 1
    for s in range(50):
        own = np.flatnonzero(sequence == s)
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own])[:-1].tolist()]


def test_sum_of_squares_chooses_the_smallest_sum():
    # open gaps 5, 5 and 7 of 10; a 2 closes one of the two fives: 4 + 1 -> 1 + 1 + 1
    sequence, _ = sum_of_squares(np.array([5, 5, 3, 2] + [1] * 8), 10)
    assert sequence[3] in (0, 1)


def test_empty_table(none):
    assert token_counts(none, TOKENIZER).collect() == []
    assert pack_documents(none, TOKENIZER, RANKS).collect() == []
