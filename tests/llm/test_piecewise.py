"""Piecewise fingerprints restated byte by byte on Python integers, likeness by plain dynamic programming."""

import random

import pytest

from corpusmill.llm import piecewise

M = (1 << 64) - 1
RNG = random.Random(2)
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _mix(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & M
    return x ^ x >> 31


def _fingerprint(text):
    size = 4
    while size * 64 < len(text):
        size *= 2
    coded = [_mix(b + 1) for b in text]
    out = [str(size)]
    for every in (size, 2 * size):
        chunks, now = [], []
        for i, v in enumerate(coded):
            now.append(v)
            if i >= 5:
                roll = coded[i - 5]
                for u in coded[i - 4:i + 1]:
                    roll = ((roll << 7 | roll >> 57) + u) & M
                if _mix(roll) % every == 0:
                    chunks.append(now)
                    now = []
        if now:
            chunks.append(now)
        codes = [_mix(sum(v * pow(0x9E3779B97F4A7C15, j, 1 << 64) for j, v in enumerate(c)) & M) >> 52 for c in chunks]
        out.append("".join(B64[c >> 6] + B64[c & 63] for c in codes))
    return ":".join(out)


def _likeness(a, b):
    if a == b:
        return 1.0
    (na, *sa), (nb, *sb) = a.split(":"), b.split(":")
    pairs = {(1, 1): [(0, 0), (1, 1)], (2, 1): [(0, 1)], (1, 2): [(1, 0)]}.get((int(na) // min(int(na), int(nb)), int(nb) // min(int(na), int(nb))), [])
    best = 0.0
    for i, j in pairs:
        x, y = ([s[k:k + 2] for k in range(0, len(s), 2)] for s in (sa[i], sb[j]))
        if x == y and (x or i == 0):
            best = 1.0
        if x and y:
            row = [0] * (len(y) + 1)
            for u in x:
                new = [0]
                for k, v in enumerate(y):
                    new.append(row[k] + 1 if u == v else max(row[k + 1], new[k]))
                row = new
            best = max(best, 2 * row[-1] / (len(x) + len(y)))
    return best


def _text(n):
    return bytes(RNG.choice(b"abcdefgh \n\xc3\xa9") for _ in range(n))


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 40, 255, 256, 257, 3000, 20_000])
def test_fingerprint_restated(n, monkeypatch):
    text = _text(n)
    want = _fingerprint(text)
    assert piecewise.fingerprint(text) == want
    monkeypatch.setattr(piecewise, "_STEP", 97)                      # rolled in stretches: the same borders
    assert piecewise.fingerprint(text) == want


def test_likeness_restated():
    for _ in range(60):
        a = _text(RNG.randrange(0, 2500))
        cut = RNG.randrange(0, len(a) + 1)
        b = RNG.choice([a[:cut] + _text(RNG.randrange(0, 300)) + a[cut:], a[:cut], _text(RNG.randrange(0, 2500)), a + a])
        x, y = piecewise.fingerprint(a), piecewise.fingerprint(b)
        assert piecewise.likeness(x, y) == pytest.approx(_likeness(x, y)) == piecewise.likeness(y, x)
        assert 0 <= piecewise.likeness(x, y) <= 1


@pytest.mark.parametrize("huge", [100, (1 << 63) - 50, -(1 << 63)])
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_rows_without_ids_spread_and_chain(documents, ranges, huge):
    """Many null ids, equal rows among them, and a repeated id: every row's next is the row behind it in the order."""
    import xxhash

    rows = [(None, f"text {i % 40} é", "s") for i in range(120)] + [(None, None, "s")] * 30 + [(i, f"id {i}", "s") for i in range(9)]
    rows += [(4, t, "s") for t in ("b", "a", "a")] + [(huge + i, f"huge {i}", "s") for i in range(40)]

    def key(r):
        text = (r[1] or "").encode()
        value = xxhash.xxh64_intdigest(text, 42) if r[0] is None else r[0]
        return r[0] is None, -(((value + 2 ** 63) % 2 ** 64 - 2 ** 63) >> (12 if r[0] is None else 0)), text

    order = sorted(rows, key=key)
    want = sorted(str((r[0], order[(k + 1) % len(order)][0], piecewise.edit(r[1] or "", order[(k + 1) % len(order)][1] or "")))
                  for k, r in enumerate(order))
    got = piecewise.compare_with_next(documents(rows).repartition(7), ranges=ranges).collect()
    assert sorted(str((r.doc_id, r.next_id, r.edited)) for r in got) == want
