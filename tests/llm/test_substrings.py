"""op6 and op9 against brute force, with nulls, empty and long texts, ties, repeats and empty tables."""

import random

import pytest

from corpusmill.llm import suffixes
from corpusmill.llm.superkmers import dedup_windows
from corpusmill.llm.suffixes import dedup_substrings, merge_runs

RNG = random.Random(5)
VOCAB = ["ab", "é", "the", "Über", "x"] + [f"w{i}" for i in range(40)]


def _prose(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def _cases():
    a, b = _prose(300), _prose(60)
    return [(1, a, "s"), (2, "  " + b + "\n\t" + a[:400], "s"), (3, None, "s"), (4, "", None), (5, a, "s"), (5, a, "s"),
            (5, b, "s"), (None, a, "s"), (7, "short", "s"), (8, b[:-3] + " " + b, "s"), (9, "De " * 200, "s"),
            (10, "x " + "De " * 150, "s"), (11, "a\0" * 80 + a[100:300], "s"), (12, _prose(4000) + a, "s")]


def _windows(rows, units, span):
    """(unit list, removed mask) per row: the removal rule stated over sets of whole windows."""
    cut = [(i, units(t or "")) for i, t, _ in rows]
    least = {}
    for i, u in cut:
        if i is not None:
            for a in range(len(u) - span + 1):
                k = tuple(u[a:a + span])
                least[k] = min(i, least.get(k, i))
    out = []
    for i, u in cut:
        gone = [False] * len(u)
        for a in range(len(u) - span + 1 if i is not None else 0):
            if least[tuple(u[a:a + span])] < i:
                gone[a:a + span] = [True] * span
        out.append((i, u, gone))
    return out


def _key(r):
    return tuple((x is None, x or 0) if not isinstance(x, (str, bytes)) else x for x in r)


@pytest.mark.parametrize("group_bytes", [2000, 1 << 20])
def test_word_windows(documents, group_bytes):
    rows = _cases()
    got = dedup_windows(documents(rows), group_bytes=group_bytes).collect()
    want = [(i, len(u), sum(g), b" ".join(w for w, x in zip(u, g) if not x).decode())
            for i, u, g in _windows(rows, lambda t: t.encode().split(), 13)]
    assert sorted(map(_key, map(tuple, got))) == sorted(map(_key, want))


@pytest.mark.parametrize("group_bytes", [2000, 1 << 20])
def test_byte_strings(documents, group_bytes):
    rows = _cases()
    got = dedup_substrings(documents(rows), group_bytes=group_bytes).collect()
    want = []
    for i, u, g in _windows(rows, lambda t: list(t.encode()), 50):
        spans = sum(x and not (k and g[k - 1]) for k, x in enumerate(g))
        want.append((i, len(u), sum(g), spans, bytes(x for x, y in zip(u, g) if not y)))
    assert sorted(map(_key, [tuple(r)[:4] + (bytes(r.kept),) for r in got])) == sorted(map(_key, want))


def test_groups_have_no_largest_size(documents, monkeypatch):
    rng = random.Random(7)
    shared, long = rng.randbytes(100).hex(), rng.randbytes(17 << 19).hex()       # 17 MiB of text that repeats nothing
    got = {r.doc_id: tuple(r)[1:4] + (bytes(r.kept).decode() == t,) for r, t in zip(
        dedup_substrings(documents([(1, shared, "s"), (2, long + shared, "s")])).orderBy("doc_id").collect(), (shared, long))}
    assert got == {1: (200, 0, 0, True), 2: (len(long) + 200, 200, 1, True)}
    monkeypatch.setattr(suffixes, "_STRETCH", 64)
    test_byte_strings(documents, 1 << 20)                            # strings across the borders of stretches


def test_empty_tables(documents):
    none = documents([])
    assert dedup_windows(none).collect() == [] and dedup_substrings(none).collect() == []


def test_loser_tree_is_a_stable_merge_with_its_prefix_array():
    items = [bytes(RNG.choice(b"ab") for _ in range(RNG.randint(1, 16))) for _ in range(200)]
    runs = [sorted(items[k::7]) for k in range(7)]
    flat = [x for r in runs for x in r]

    def common(x, y):
        return next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))

    words = [[int.from_bytes(x[j:j + 8].ljust(8, b"\0"), "big") for x in flat] for j in (0, 8)]
    begin, lcp = [], []
    for r in runs:
        begin.append(len(lcp))
        lcp += [0] + [common(x, y) for x, y in zip(r, r[1:])]
    order, share = merge_runs(words, [len(x) for x in flat], lcp, begin, begin[1:] + [len(flat)])
    merged = [flat[k] for k in order]
    assert merged == sorted(items)
    assert share[1:] == [common(x, y) for x, y in zip(merged, merged[1:])]


def test_words_with_colliding_hashes_stay(documents):
    """Thue-Morse words and their complements: polynomial hashes modulo 2^64 are equal for every odd base."""
    bits = [bin(i).count("1") & 1 for i in range(1 << 11)]
    word, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [(i, " ".join([word if i % 2 else other] * 16) + f" end{i}", "s") for i in range(1, 25)]
    got = {r.doc_id: r.n_removed for r in dedup_windows(documents(rows), group_bytes=1 << 22).collect()}
    assert got == {i: 16 if i > 2 else 0 for i in range(1, 25)}
