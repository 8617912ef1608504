"""Cross-tokenizer alignment against both tokenizers on whole texts and plain byte ranges."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pytest

from corpusmill.llm import crosstoken

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RNG = random.Random(5)


@pytest.fixture(scope="module")
def tools():
    return crosstoken.ByteLevel(A), crosstoken.Pieces(B)


def _plain(rows, tools):
    """Groups and links of whole texts by intervals of bytes; then corpus-wide counts."""
    a_tool, b_tool = tools
    out = []
    for doc, text in rows:
        if not text:
            out.append((doc, 0, 0, [], Counter()))
            continue
        raw = (" " + text).encode()
        a = a_tool._tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = b_tool._model.encode(text)
        spans = []
        for ids, tool in ((a, a_tool), (b, b_tool)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(tool.bytes[i]), i))
                at += len(tool.bytes[i])
            spans.append(own)
        if any(b"".join(tool.bytes[i] for i in ids) != raw for ids, tool in ((a, a_tool), (b, b_tool))):
            out.append((doc, 0, 0, [], Counter()))
            continue
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, lo = [], 0
        for e in common:
            groups.append(tuple([i for s, t, i in own if lo <= s and t <= e] for own in spans))
            lo = e
        links = Counter((i, j) for s, t, i in spans[0] for u, v, j in spans[1] if s < v and u < t)
        out.append((doc, len(a), len(b), groups, links))
    held = Counter(p for *_, links in out for p in links)
    top = defaultdict(int)
    for (i, j), n in held.items():
        top[i] = max(top[i], n)
    return sorted(str((doc, n_a, n_b, len(groups), sum(links.values()), sum(n for (i, j), n in links.items() if held[i, j] == top[i]),
                       sum(n * held[p] for p, n in links.items()),
                       ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
                  for doc, n_a, n_b, groups, links in out)


def _texts():
    bits = ["the", " ", "  ", "\n", "é", "中文", "don't", "<|endoftext|>", "</s>", "<0x41>", " ", "　", "\t", "'s", "12,345", "naïve",
            "​", "x\u0000y", "🎉", "\r\n", "_a_", " ", "ﬁ", "antidisestablishment", ".", "...", "A", "’", "é"]
    out = ["".join(RNG.choice(bits) + RNG.choice(["", " "]) for _ in range(RNG.randrange(1, 40))) for _ in range(300)]
    return out + [" ", "  ", "a ", " a", "\n ", "▁", "a ▁ b", "same text", "same text", "long " * 1_500, "<unk> <s>"]


def test_equals_whole_text_encoding(spark, tools):
    rows = [(i % 290, t) for i, t in enumerate(_texts())] + [(None, "null id"), (1, None), (2, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, g int, pairs string, groups string")
    got = crosstoken.cross_align(docs.repartition(3), path_a=A, path_b=B, group_bytes=2000).collect()
    assert sorted(str((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)) for r in got) == _plain(rows, tools)
    short = crosstoken.cross_align(docs, path_a=A, path_b=B, digest=True).collect()
    assert sorted((str(r.doc_id), r.groups) for r in short) == sorted(
        (str(r.doc_id), sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in got)


def test_empty_table(spark):
    assert crosstoken.cross_align(spark.createDataFrame([], "doc_id long, text string"), path_a=A, path_b=B).collect() == []


def test_forgetting_changes_nothing(tools, monkeypatch):
    monkeypatch.setattr(crosstoken.StretchAligner, "_REMEMBERED", 20)
    import numpy as np

    tool = crosstoken.StretchAligner(A, B)
    texts = _texts()[:120]
    for text in texts + texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        one = tool.read(raw, np.array([0, len(raw)], np.int64))[0]
        fresh = crosstoken.StretchAligner(A, B) if text == texts[0] else None
        if fresh:
            assert fresh.read(raw, np.array([0, len(raw)], np.int64))[0][4] == one[4]
        assert one[0] == (len(tools[0]._tokenizer.encode(" " + text).ids) if one[4] else 0)


def test_align_by_hand():
    import numpy as np

    common, cut_a, cut_b, ends, i, j = crosstoken.align(np.array([2, 1, 4]), np.array([1, 2, 4]))
    assert (common, cut_a, cut_b) == ([3, 7], [2, 3], [2, 3])
    assert list(zip(ends.tolist(), i.tolist(), j.tolist())) == [(1, 0, 0), (2, 0, 1), (3, 1, 1), (7, 2, 2)]
