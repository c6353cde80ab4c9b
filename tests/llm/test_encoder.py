"""What the encoder keeps of the pieces it has seen."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd

from tidemark.llm import encoder
from tidemark.llm.catalogue import tokenizer_path

WORD = tokenizer_path("word_bpe_49k.json")


def test_a_chunk_costs_its_own_new_pieces(monkeypatch):
    """Sixty batches of new pieces: what is indexed altogether is a few times the pieces, not the known ones each time."""
    built, own = [], encoder.Encoder(WORD)

    def counting(data):
        built.append(len(data))
        return pd.Index(data)

    monkeypatch.setattr(encoder, "pd", SimpleNamespace(Index=counting, factorize=pd.factorize))
    n = 0
    for batch in range(60):
        texts = pd.Series([" ".join(f"w{batch}x{i}y{j}" for j in range(20)) for i in range(5)])
        for _ in own.each(texts):
            pass
        n += 100
    assert n <= sum(built) <= 10 * n


def test_pieces_of_many_batches_keep_their_ids(monkeypatch):
    """Old and new pieces mixed, over merges of the indexes and after everything was forgotten."""
    monkeypatch.setattr(encoder, "KEEP", 700)
    random = np.random.default_rng(5)
    own = encoder.Encoder(WORD, offsets=True)
    fast = encoder.Encoder(WORD)
    for batch in range(40):
        words = random.integers(0, 40 * (batch + 1), (4, 30))
        texts = [" ".join(f"é{w}ab" if w % 3 else f"w<|{w}" for w in line) for line in words]
        for kind in (own, fast):
            got = [(ids, where, spans) for _, _, ids, where, spans in kind.each(pd.Series(texts))]
            ids, where, spans = got[0]
            assert len(got) == 1
            for k, text in enumerate(texts):
                whole = kind.plain.encode(text, add_special_tokens=False)
                assert ids[where[k]: where[k + 1]].tolist() == whole.ids
                if kind.offsets:
                    assert [tuple(s) for s in spans[where[k]: where[k + 1]].tolist()] == whole.offsets
