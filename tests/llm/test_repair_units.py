"""op1: units that go to the library's model alone, and symbols expanded once."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from aurum.llm import repair
from aurum.llm.tokens import UnitEncoder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_plain_words_go_to_the_model_as_the_library_sends_them():
    enc, tok = UnitEncoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    assert enc.plain
    letters = "abyzßàéïñöøùÿ"
    rng = random.Random(1)
    units = ["".join(rng.choice(letters) for _ in range(rng.randrange(9))) + "".join(rng.choice("'!#_~[].*") for _ in range(rng.randrange(4)))
             for _ in range(800)]
    for u in units:
        assert enc._plain(u) == tok.encode(u, add_special_tokens=False).ids, u
    for u in ("don't", "a1", "Ab", "é", "ªb", "µ", "×", "a\x00", "漢"):
        assert enc._plain(u) is None
    mixed = units[:50] + ["don't", "a1", "漢字", ""] + units[50:90]
    ids, n = enc._library(mixed)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [tok.encode(u, add_special_tokens=False).ids for u in mixed]


def test_expand_works_each_symbol_out_once(monkeypatch):
    ids = np.tile(np.random.default_rng(5).integers(0, 900, 64).astype(np.uint32), 500)
    payload = repair.compress(ids, least=4)
    asked = []
    by_levels = repair._by_levels
    monkeypatch.setattr(repair, "_by_levels", lambda symbols, *rest: asked.append(len(symbols)) or by_levels(symbols, *rest))
    assert repair.expand(payload).tolist() == ids.tolist()
    assert repair.expand(payload, 777, 1000).tolist() == ids[777:1777].tolist()
    assert max(asked) <= 64
