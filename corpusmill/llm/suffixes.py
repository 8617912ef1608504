"""Exact byte-substring dedup by a common-prefix-aware distributed merge sort of suffixes.

Every string of ``span`` (50) bytes has an *anchor*: the leftmost position of its
smallest mixed 8-byte gram. Equal strings have their anchor at the same place, so
only the suffixes that start at anchors need sorting (about one byte in 22), each
with the few bytes to its left that its strings reach back to.

1. A group sorts its anchored suffixes and cuts the sorted order by leading gram
   into one run per bucket. Runs are front-coded: the length of the prefix shared
   with the predecessor, then only the new bytes.
2. A bucket rebuilds its runs and merges them with a loser tree that carries each
   head's common prefix with the last output: unequal lengths decide a match
   without looking at bytes, equal lengths compare from there on. The merge yields
   the common-prefix array for free. Suffixes whose context no second document
   shares are set aside before the merge; no string of theirs can match.
3. For each distance from string start to anchor, runs of the common-prefix array
   (right of the anchor) and of the same array of the left contexts give exact
   classes of equal strings; each takes its smallest document.

Hot passages: equal suffixes with equal left context inside a group are combined
before the exchange (only the smallest document's travel), so a passage that a
third of all documents hold puts one suffix per group into its bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm import exchange as X
from corpusmill.llm.bytesets import mix, sliding_min, take_ranges

_GRAM = 8
_POS_BITS = 24                                    # anchors: 40 hash bits, then the position in the stretch
_STRETCH = 1 << 20                                # string starts scanned at a time
# document id, anchor in the group (low 32 bits), shared prefix, bytes right and left of the anchor, new bytes,
# left bytes, anchor >> 32
_PIECE = [np.int64, np.uint32, np.uint8, np.uint8, np.uint8, np.uint8, np.uint8, np.uint8]
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _loads(padded: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit value at every byte offset."""
    return np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))


def _masked(words: list[np.ndarray], length: np.ndarray) -> list[np.ndarray]:
    """Keep only the first ``length`` bytes (most significant first) of multi-word keys."""
    out = []
    for j, w in enumerate(words):
        keep = np.clip(length - 8 * j, 0, 8).astype(np.uint64)
        full = keep >= 8
        mask = np.where(full, np.uint64(0xFFFFFFFFFFFFFFFF),
                        ~(np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(keep, np.uint64(7)) * np.uint64(8)))
        out.append(w & np.where(keep == 0, np.uint64(0), mask))
    return out


def _common(words: list[np.ndarray], length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each key with its predecessor in ``order`` (0 for the first)."""
    n = len(order)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    open_ = np.ones(n - 1, bool)
    for w in words:
        s = w[order]
        x = s[1:] ^ s[:-1]
        same = np.zeros(n - 1, np.int64)
        for k in range(1, 8):
            same += x < np.uint64(1 << (8 * k))
        same += x == 0
        out[1:] += np.where(open_, same, 0)
        open_ &= x == 0
        if not open_.any():
            break
    lens = length[order]
    out[1:] = np.minimum(out[1:], np.minimum(lens[1:], lens[:-1]))
    return out


def _fold(words: list[np.ndarray], extra: np.ndarray, salt: int) -> np.ndarray:
    h = mix(extra.astype(np.uint64) + np.uint64(salt))
    for w in words:
        h = mix(h ^ w)
    return h


def _anchors(text: X.GroupText, span: int):
    """Anchor, first and last string start of every anchored suffix, with its document.

    Starts are scanned in stretches that read ``span - 1`` bytes on: an anchor depends on its
    own string only, so a group has no largest size. A suffix that a stretch's end cuts gives
    two entries, whose strings are its own.
    """
    n, none = len(text.data), np.zeros(0, np.int64)
    if n < span:
        return none, none, none, none, None
    padded = np.concatenate((np.zeros(64, np.uint8), text.data, np.zeros(72, np.uint8)))
    loads = _loads(padded)
    low = np.uint64((1 << _POS_BITS) - 1)
    found = []
    for base in range(0, n - span + 1, _STRETCH):
        m = min(_STRETCH, n - span + 1 - base)                       # string starts of this stretch
        grams = m + span - _GRAM
        key = (mix(loads[64 + base:64 + base + grams]) & ~low) | np.arange(grams, dtype=np.uint64)
        anchor = (sliding_min(key, span - _GRAM + 1) & low).astype(np.int64) + base
        start = np.arange(base, base + m)
        doc = np.searchsorted(text.offs, start, "right") - 1
        ok = (start + span <= text.offs[doc + 1]) & text.known[doc]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1])
        stop = ok.copy()
        stop[:-1] &= ~ok[1:] | new[1:]
        first = np.flatnonzero(new)
        found.append((anchor[first], start[first], start[stop], doc[first]))
    return *(np.concatenate(x) for x in zip(*found)), loads


def _merged(start: np.ndarray, end: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that ranges cover; each range lies in one text and runs stop at text borders ``offs``."""
    if len(start) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    doc = np.searchsorted(offs, start, "right")
    head = np.concatenate(([True], (start[1:] > reach[:-1]) | (doc[1:] != doc[:-1])))
    return start[head], reach[np.append(head[1:], True)]


def _scatter(text: X.GroupText, buckets: int, span: int):
    none = np.zeros(0, np.int64)
    p, s0, s1, d, loads = _anchors(text, span)
    if len(p) == 0:
        return [], [], (none, none)
    ll, rl = p - s0, s1 + span - p
    nr, nl = -(-span // 8), -(-(span - _GRAM) // 8)
    right = _masked([loads[p + 64 + 8 * j].byteswap() for j in range(nr)], rl)
    left = _masked([loads[p + 64 - 8 * (j + 1)] for j in range(nl)], ll)
    # combine equal contexts of the group; 128 bits stand for (left, right)
    both = rl * 256 + ll
    h1, h2 = _fold(right + left, both, 1), _fold(right + left, both, 2)
    ids = text.id[d]
    order = np.lexsort((ids, h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    head = np.flatnonzero(new)
    low = np.empty(len(order), np.int64)
    low[order] = np.repeat(ids[order][head], np.diff(np.append(head, len(order))))
    travel = ids == low
    done = _merged(s0[~travel], (s1 + span)[~travel], text.offs)
    p, ids, ll, rl = p[travel], ids[travel], ll[travel], rl[travel]
    right, left = [w[travel] for w in right], [w[travel] for w in left]
    bucket = (mix(right[0] + np.uint64(3)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort([rl, *right[::-1], bucket])
    lcp = _common(right, rl, order)
    p, ids, ll, rl, bucket = p[order], ids[order], ll[order], rl[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    lcp[cut] = 0
    cuts = np.concatenate(([0], cut, [len(p)]))
    fresh, back = take_ranges(text.data, p + lcp, rl - lcp), take_ranges(text.data, p - ll, ll)
    fe, be = np.concatenate(([0], np.cumsum(rl - lcp))), np.concatenate(([0], np.cumsum(ll)))
    names, blobs = [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        names.append(int(bucket[a]))
        blobs.append(X.pack_blob([ids[a:b], p[a:b].astype(np.uint32), lcp[a:b].astype(np.uint8), rl[a:b].astype(np.uint8),
                                  ll[a:b].astype(np.uint8), fresh[fe[a]:fe[b]], back[be[a]:be[b]],
                                  (p[a:b] >> 32).astype(np.uint8)]))
    return names, blobs, done


def _be_words(matrix: np.ndarray) -> list[np.ndarray]:
    wide = np.zeros((len(matrix), -(-matrix.shape[1] // 8) * 8), np.uint8)
    wide[:, :matrix.shape[1]] = matrix
    return [np.ascontiguousarray(wide[:, j:j + 8]).view(">u8")[:, 0].astype(np.uint64) for j in range(0, wide.shape[1], 8)]


def _unfold(lcp, rl, ll, fresh, back, span):
    """Right contexts from their front coding, left contexts read away from the anchor."""
    n, col = len(rl), np.arange(span)
    right = np.zeros((n, span), np.uint8)
    right[(col >= lcp[:, None]) & (col < rl[:, None])] = fresh
    row = np.arange(n)
    for c in range(span):
        own = lcp <= c
        if not own.all():
            right[:, c] = right[np.maximum.accumulate(np.where(own, row, 0)), c]
    right[col >= rl[:, None]] = 0
    width = span - _GRAM
    left = np.zeros((n, width), np.uint8)
    left[np.arange(width) >= (width - ll)[:, None]] = back          # right-aligned, then reversed
    return right, np.ascontiguousarray(left[:, ::-1])


def _shared(key: np.ndarray, doc: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Rows (of ``use``) whose key a second document also has."""
    out = np.zeros(len(key), bool)
    at = np.flatnonzero(use)
    if len(at) < 2:
        return out
    order = at[np.argsort(key[at], kind="stable")]
    k, d = key[order], doc[order]
    head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    many = np.minimum.reduceat(d, head) < np.maximum.reduceat(d, head)
    out[order] = np.repeat(many, np.diff(np.append(head, len(k))))
    return out


def merge_runs(words: list[list[int]], length: list[int], lcp: list[int], begin: list[int], end: list[int]):
    """Merge sorted runs ``[begin, end)`` with a loser tree; returns the order and its common-prefix array.

    ``share[r]`` is the prefix that run r's head has in common with the last output.
    The head with the longer one is smaller; only ties look at words, from the known
    prefix on. A finished run has -1 and loses to all.
    """
    k = len(begin)
    size = 1
    while size < k:
        size *= 2
    cur, share = list(begin) + [0] * (size - k), [0] * k + [-1] * (size - k)
    total = sum(e - b for b, e in zip(begin, end))
    last = len(words)

    def beats(a: int, b: int) -> bool:
        ha, hb = share[a], share[b]
        if ha != hb:
            return ha > hb
        if ha < 0:
            return True
        i, j = cur[a], cur[b]
        w = ha >> 3
        while w < last:
            x, y = words[w][i], words[w][j]
            if x != y:
                break
            w += 1
        li, lj = length[i], length[j]
        if w == last:
            first, same = (li, a) <= (lj, b), min(li, lj)
        else:
            first, same = x < y, min(8 * w + ((64 - (x ^ y).bit_length()) >> 3), li, lj)
        share[b if first else a] = same
        return first

    losers = [0] * size
    winners = [0] * (2 * size)
    winners[size:] = range(size)
    for node in range(size - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        if beats(a, b):
            winners[node], losers[node] = a, b
        else:
            winners[node], losers[node] = b, a
    run = winners[1] if size > 1 else 0
    order, common = [0] * total, [0] * total
    for out in range(total):
        at = cur[run]
        order[out], common[out] = at, share[run]
        at += 1
        cur[run] = at
        share[run] = lcp[at] if at < end[run] else -1
        node = (size + run) >> 1
        while node:
            other = losers[node]
            ha, hb = share[run], share[other]
            if hb > ha or (hb == ha and not beats(run, other)):
                losers[node] = run
                run = other
            node >>= 1
    return order, common


def _settle(blobs: list[bytes], span: int):
    none = np.zeros(0, np.int64)
    parts = [X.open_blob(z, _PIECE) for z in blobs]
    src = np.repeat(np.arange(len(parts)), [len(q[0]) for q in parts])
    ids, pos, lcp, rl, ll = (np.concatenate([q[j] for q in parts]).astype(np.int64) for j in range(5))
    pos += np.concatenate([q[7] for q in parts]).astype(np.int64) << 32
    fresh, back = (np.concatenate([q[j] for q in parts]) for j in (5, 6))
    right, left = _unfold(lcp, rl, ll, fresh, back, span)
    rw, lw = _be_words(right), _be_words(left)
    # a shared string holds `reach` bytes left of the anchor and its gram, or span - reach from the anchor on
    reach = (span - _GRAM) // 2
    tail, lead = span - reach, np.full(len(ids), reach, np.int64)
    near = _shared(_fold(_masked(rw, np.full(len(ids), tail, np.int64)), lead, 3), ids, rl >= tail)
    near |= _shared(_fold(_masked(lw, lead) + rw[:1], lead, 4), ids, ll >= reach)
    keep = np.flatnonzero(near)
    if len(keep) < 2:
        return none, none, none
    # the prefix shared with the kept predecessor: the least over the skipped stretch
    lcp = np.minimum.reduceat(lcp[:keep[-1] + 1], np.concatenate(([0], keep[:-1] + 1)))
    return _classes(src[keep], ids[keep], pos[keep], lcp, rl[keep], ll[keep],
                    [w[keep] for w in rw], [w[keep] for w in lw], span)


def _classes(src, ids, pos, lcp, rl, ll, rw, lw, span):
    cut = np.flatnonzero(np.diff(src)) + 1
    lcp[np.concatenate(([0], cut)).astype(np.int64)] = 0
    begin, end = [0, *cut.tolist()], [*cut.tolist(), len(src)]
    order, common = merge_runs([w.tolist() for w in rw], rl.tolist(), lcp.tolist(), begin, end)
    order, common = np.array(order), np.array(common)
    src, ids, pos, rl, ll = src[order], ids[order], pos[order], rl[order], ll[order]
    lw = [w[order] for w in lw]
    lorder = np.lexsort([ll, *lw[::-1]])
    lcommon = _common(lw, ll, lorder)
    far = np.full(len(ids), -1, np.int64)                            # covered strings: farthest and nearest start
    near = np.full(len(ids), span, np.int64)
    for back in range(span - _GRAM + 1):
        use = np.flatnonzero((ll >= back) & (rl >= span - back))
        if len(use) < 2:
            continue
        rclass = np.cumsum(common < span - back)[use]
        lclass = np.empty(len(ids), np.int64)
        lclass[lorder] = np.cumsum(lcommon < back)
        key = rclass * (len(ids) + 1) + lclass[use]
        o = np.argsort(key, kind="stable")
        k, d = key[o], ids[use][o]
        head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        low = np.repeat(np.minimum.reduceat(d, head), np.diff(np.append(head, len(k))))
        hit = use[o[d > low]]
        far[hit] = back                                              # back only grows
        near[hit] = np.minimum(near[hit], back)
    hit = np.flatnonzero(far >= 0)
    return src[hit], pos[hit] - far[hit], pos[hit] - near[hit] + span


def _finish(text: X.GroupText, start, end) -> pa.Table:
    a, b = _merged(start, end, text.offs)
    at = np.searchsorted(a, text.offs)
    spans = np.diff(at)
    total = np.concatenate(([0], np.cumsum(b - a)))
    removed = total[at[1:]] - total[at[:-1]]
    kept = []
    for raw, x, i, j in zip(text.texts, text.offs[:-1].tolist(), at[:-1].tolist(), at[1:].tolist()):
        cuts = [0, *np.stack((a[i:j], b[i:j]), 1).ravel() - x, len(raw)]
        kept.append(raw if i == j else b"".join(raw[p:q] for p, q in zip(cuts[::2], cuts[1::2])))
    return pa.table({"doc_id": pa.array(text.ids, pa.int64()), "n_bytes": pa.array(np.diff(text.offs), pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                     "kept": pa.array(kept, pa.binary())})


def dedup_substrings(docs: DataFrame, *, span: int = 50, id_col: str = "doc_id", text_col: str = "text",
                     group_bytes: int = X.GROUP_BYTES) -> DataFrame:
    """Remove each byte covered by a ``span``-byte string that also starts in a document of smaller id.

    Returns ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and ``kept``
    (the remaining bytes, binary because a cut may split a code point) for every row.
    Matches never cross documents; strings are judged on the input. ``span`` is 16 to
    255. Defined cases: a null or empty text has no bytes; texts under ``span`` bytes
    lose nothing; rows that repeat an id are one document; a row with a null id has no
    order, loses nothing and takes nothing; an empty table gives an empty result; other
    columns are not read and not returned.
    """
    if not 16 <= span <= 255:
        raise ValueError("span must be 16 to 255 bytes")
    groups = X.group_documents(docs, id_col, text_col, group_bytes)
    return X.remove_covered(groups, lambda text, n: _scatter(text, n, span), lambda blobs: _settle(blobs, span),
                            _finish, OUT)
