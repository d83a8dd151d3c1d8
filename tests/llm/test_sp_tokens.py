import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quorum.llm import sp_tokens

PROTO = sp_tokens.read_model(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=PROTO)


@pytest.fixture(scope="module")
def model():
    return sp_tokens.piece_model(PROTO)


def same(model, text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    mine = model.encode(text)
    assert np.frombuffer(mine, "<u4").tolist() == ids
    assert model.decode(mine) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(sp_tokens.piece_model(PROTO), text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "the", "aaaa", "==", "----", "ing", "▁", "é", "<s>", "</s>", "<0x0A>", "1", "漢", "\x00"]), max_size=40))
def test_repeats_and_spaces(parts):
    same(sp_tokens.piece_model(PROTO), "".join(parts))


def test_runs_of_pieces(model):
    rng, pieces = random.Random(1), sorted(model.id)
    for _ in range(1500):
        same(model, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 10))))


def test_any_ids_decode(model):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 31999), rng.randint(3, 258), 0, 1, 2]) for _ in range(rng.randint(0, 6))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == LIBRARY.decode(ids)


def test_small_caches_change_nothing():
    model = sp_tokens.PieceModel(PROTO)
    model.words.entries = model.parts.entries = 3
    for text in ("the same words the same words", "other words " * 5):
        same(model, text)


def test_tables(odd, empty):
    rows = sp_tokens.decode(sp_tokens.encode(odd, PROTO), PROTO).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = LIBRARY.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == LIBRARY.decode(ids)
        assert r.keep.startswith("x")
    assert sp_tokens.decode(sp_tokens.encode(empty, PROTO), PROTO).count() == 0
    clash = odd.withColumnRenamed("keep", "ids")
    assert sp_tokens.encode(clash, PROTO).columns.count("ids") == 1
