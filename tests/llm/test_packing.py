"""Hot groups and the word encoder of the packer."""

import random

import numpy as np
import pytest

from corpusmill.llm import packing, queries
from corpusmill.llm.bytesets import join_bytes


def test_equal_rows_and_full_windows_spread(documents):
    """400 equal documents that fill a window each, and 600 equal rows without an id."""
    full = " ".join(["a"] * 63)                                      # with the end id a window of 64
    rows = [(i, full, "s") for i in range(400)] + [(None, "b " * 9 + "c", "s") for _ in range(600)]
    got = packing.pack(documents(rows).repartition(4), vocabulary=queries.vocabulary(), capacity=64, block_windows=8).collect()
    whole = [r for r in got if r.length == 64]
    assert len(whole) == 400 and len({r.sequence_id for r in whole}) == 400 and all(r.offset == 0 for r in whole)
    rest = [r for r in got if r.length < 64]
    assert len(rest) == 600 and {r.sequence_id for r in rest}.isdisjoint({r.sequence_id for r in whole})
    per_block = {}
    for r in rest:
        per_block[r.sequence_id >> 32] = per_block.get(r.sequence_id >> 32, 0) + 1
    assert len(per_block) > 5 and max(per_block.values()) < 200
    filled = {}
    for r in rest:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64


@pytest.mark.parametrize("remembered", [30, 500_000])
def test_encoder_equals_tokenizer(monkeypatch, remembered):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing.WordEncoder, "_REMEMBERED", remembered)
    rng = random.Random(remembered)
    bits = ["the", "Über", "x", "中文", "§", " £ ", "<|endoftext|>", "<|", "\t", "\n", "don't", "1234", "word.", "end,", "Mixed", "a.b", "x..", "?", "straße,", "naïve.", "ΑΣ", "ας", "слово", "ﬁn", "e\u0301", "ĳ", "İ", "ʼn", "ǆ", "é", " ", "…", "👍", "ſ"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    tool, code = packing.WordEncoder(queries.vocabulary()), Tokenizer.from_file(queries.vocabulary())
    for lo in range(0, 300, 50):
        part = texts[lo:lo + 50]
        ids, edge = tool.encode(*join_bytes([t.encode() for t in part]))
        for k, t in enumerate(part):
            assert ids[edge[k]:edge[k + 1]].tolist() == code.encode(t, add_special_tokens=False).ids
    assert np.array_equal(tool.encode(*join_bytes([b""]))[1], [0, 0])
