import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hubbub.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def exact(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, PATTERN)


def ids_of(encoder, text):
    return [i for block in encoder.blocks(text) for i in block]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aabbctheing  \n\t'sé日²1!·.") + ["\x1c", "\U0001f600"]), max_size=60) | st.text(max_size=30))
def test_equals_the_library(encoder, exact, text):
    assert ids_of(encoder, text) == exact.encode_ordinary(text)


def test_forgetting_changes_nothing(ranks, exact):
    small = bpe.Encoder(ranks, PATTERN, max_pieces=3)
    small.machine.max_states = 5
    for text in ("a stumbling thinginess of thething", "aaaaaaaaaaaaaa", "xyzzyx " * 20):
        assert ids_of(small, text) == exact.encode_ordinary(text)


def test_emission_is_bounded(ranks):
    machine = bpe.Transducer(ranks)
    longest = max(map(len, ranks))
    state, done, raw = machine.start, 0, b"thethingishere" * 40
    for i, byte in enumerate(raw):
        move = machine.moves.get(state << 8 | byte) or machine._move(state, byte)
        state = move[0]
        done += sum(len(machine.bytes_of[t]) for t in move[1])
        assert i + 1 - done <= 2 * longest


def test_streamed_decoding(ranks, exact):
    text = "é日本\U0001f600 end"
    decoder = bpe.Decoder(ranks)
    singles = [ranks[bytes([b])] for b in text.encode()]
    assert "".join(decoder.feed([i]) for i in singles) + decoder.end() == text
    assert decoder.feed(singles[:1]) + decoder.end() == "�"


def test_odd_rows(odd, none, exact):
    for r in bpe.round_trip(odd.select("doc_id", "text"), PATH, PATTERN).collect():
        ids = exact.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    both = bpe.decoded(bpe.encoded(odd, PATH, PATTERN), PATH, PATTERN)
    assert all((r.text or "") == r.decoded for r in both.collect())
    assert bpe.encoded(none, PATH, PATTERN).count() == 0
