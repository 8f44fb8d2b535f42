import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm.rans import MAX_LANES, SEGMENT, Coder, Table


def coder_of(ids):
    symbols, counts = np.unique(ids, return_counts=True)
    return Coder(Table.of_counts(symbols, counts))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=3000))
def test_round_trip(ids):
    ids = np.array(ids)
    coder = coder_of(ids)
    assert np.array_equal(coder.decode(coder.encode(ids)), ids)


def test_long_block_is_close_to_its_entropy_and_reads_from_every_checkpoint():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.5, 3 * SEGMENT * MAX_LANES + 12_345) % 5000
    coder = coder_of(ids)
    block = coder.encode(ids)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    entropy = -(share * np.log2(share)).sum() * len(ids) / 8
    assert len(block) < 1.1 * entropy
    span = SEGMENT * MAX_LANES
    for k in range(-(-len(ids) // span)):
        assert np.array_equal(coder.decode(block, k), ids[k * span : (k + 1) * span])


def test_one_symbol_and_no_symbol():
    ids = np.zeros(1000, np.int64)
    coder = coder_of(ids)
    assert np.array_equal(coder.decode(coder.encode(ids)), ids)
    assert len(coder.decode(coder.encode(ids[:0]))) == 0


def test_damage_is_found():
    ids = np.arange(5000) % 17
    coder = coder_of(ids)
    block = bytearray(coder.encode(ids))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        coder.decode(bytes(block))


def test_shares_cover_the_scale():
    table = Table.of_counts(np.array([5, 1, 9]), np.array([1, 10**12, 1]))
    assert table.shares.sum() == 1 << 20 and table.shares.min() >= 1 and list(table.symbols) == [1, 5, 9]
