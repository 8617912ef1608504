"""Substring dedup by super-k-mer partitioning.

A *window* is ``k`` consecutive words of one document. Each window has a minimiser:
the smallest mixed hash among its ``m``-word grams. Consecutive windows that share
it form a super-k-mer, which travels as one packed string (the text slice) to the
bucket of that minimiser, so equal windows always meet. A bucket turns words into
exact dictionary ids, sorts its windows and finds each one's smallest document;
equal hashes are confirmed word by word.

Hot passages: equal super-k-mers inside a group are combined before the exchange.
Only those of the group's smallest document travel; every later document of the
group is covered there and then, so a passage that a third of all documents hold
puts at most one piece per group in its bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm import exchange as X
from corpusmill.llm.bytesets import covered, mix, range_hash, runs_of, sliding_min, take_ranges, word_bounds

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_PIECE = [np.int64, np.uint32, np.uint32, np.uint8]      # document id, first word in the group, bytes, text
OUT = "doc_id long, n_words long, n_removed long, kept string"


def _word_hashes(data, starts, ends, base):
    return range_hash(mix(data.astype(np.uint64) + np.uint64(base & 0xFFFF) + np.uint64(1)), starts, ends, base)


def _smallest(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Smallest ``doc`` among the stretches ``words[start:end]`` that are equal; hashes only bring them together.

    Of unequal stretches with equal hashes, equal ones may stay apart: those are then settled elsewhere.
    """
    mixed = mix(words.astype(np.uint64) + np.uint64(5))
    size = ends - starts
    keys = [size, *(range_hash(mixed, starts, ends, b) for b in _BASES)]
    order = np.lexsort(keys)
    new = np.zeros(len(doc), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    pair = np.flatnonzero(~new)
    if len(pair):
        this, before, n = starts[order[pair]], starts[order[pair - 1]], size[order[pair]]
        same = take_ranges(words, this, n) == take_ranges(words, before, n)
        new[pair] = ~np.logical_and.reduceat(same, np.cumsum(n) - n)
    at = np.flatnonzero(new)
    low = np.minimum.reduceat(doc[order], at) if len(at) else doc[:0]
    out = np.empty(len(doc), doc.dtype)
    out[order] = np.repeat(low, np.diff(np.append(at, len(doc))))
    return out


def _word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exact number of each word among the distinct words."""
    length = ends - starts
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(np.concatenate(([0], np.cumsum(length))).astype(np.int64)),
         pa.py_buffer(take_ranges(data, starts, length))])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _scatter(text: X.GroupText, buckets: int, k: int, m: int):
    none = np.zeros(0, np.int64)
    starts, ends, first = word_bounds(text.data, text.offs)
    n = len(starts)
    if n < k:
        return [], [], (none, none)
    hashes = _word_hashes(text.data, starts, ends, _BASES[0])
    gram = hashes[:n - m + 1].copy()
    for j in range(1, m):
        gram += hashes[j:n - m + 1 + j] * np.uint64(2 * j + 3)
    least = sliding_min(mix(gram), k - m + 1)                       # of the window that starts at each word
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n - k + 1]
    ok = (np.arange(n - k + 1) + k <= first[doc + 1]) & text.known[doc]
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    s0 = np.flatnonzero(new)
    if len(s0) == 0:
        return [], [], (none, none)
    stop = ok.copy()
    stop[:-1] &= ~ok[1:] | new[1:]
    w1 = np.flatnonzero(stop) + k                                   # last word + 1
    d = doc[s0]
    ids = text.id[d]
    low = _smallest(_word_ids(text.data, starts, ends), s0, w1, ids)
    travel = ids == low
    done = X.settled_runs(n, first, s0[~travel], w1[~travel])
    s0, w1, ids = s0[travel], w1[travel], ids[travel]
    bucket = (mix(least[s0] + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    s0, w1, ids, bucket = s0[order], w1[order], ids[order], bucket[order]
    size = ends[w1 - 1] - starts[s0]
    raw = take_ranges(text.data, starts[s0], size)
    edge = np.concatenate(([0], np.cumsum(size)))
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
    names, blobs = [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        names.append(int(bucket[a]))
        blobs.append(X.pack_blob([ids[a:b], s0[a:b].astype(np.uint32), size[a:b].astype(np.uint32),
                                  raw[edge[a]:edge[b]]]))
    return names, blobs, done


def _exact_groups(ids: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort windows and mark where a new word sequence begins; word ids decide, the hash only orders."""
    mixed = mix(ids.astype(np.uint64) + np.uint64(11))
    h = range_hash(mixed, at, at + k, _BASES[0])
    order = np.argsort(h, kind="stable")
    s, a = h[order], at[order]
    new = np.ones(len(a), bool)
    new[1:] = s[1:] != s[:-1]
    pair = np.flatnonzero(~new)
    same = np.ones(len(pair), bool)
    for j in range(k):
        same &= ids[a[pair] + j] == ids[a[pair - 1] + j]
    if not same.all():                                              # equal hashes, other words: sort by the words
        order = np.lexsort([ids[at + j] for j in range(k)])
        a = at[order]
        new = np.zeros(len(a), bool)
        new[0] = True
        for j in range(k):
            col = ids[a + j]
            new[1:] |= col[1:] != col[:-1]
    return order, new


def _settle(blobs: list[bytes], k: int):
    parts = [X.open_blob(z, _PIECE) for z in blobs]
    src = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    doc_id, pos, size, data = (np.concatenate([p[j] for p in parts]) for j in range(4))
    offs = np.concatenate(([0], np.cumsum(size.astype(np.int64))))
    starts, ends, first = word_bounds(data, offs)
    ids = _word_ids(data, starts, ends)
    nwin = np.diff(first) - (k - 1)
    piece = np.repeat(np.arange(len(nwin)), nwin)
    rel = np.arange(len(piece)) - np.repeat(np.cumsum(nwin) - nwin, nwin)
    at = first[piece] + rel
    order, new = _exact_groups(ids, at, k)
    groups = np.flatnonzero(new)
    d = doc_id[piece[order]]
    low = np.repeat(np.minimum.reduceat(d, groups), np.diff(np.append(groups, len(d))))
    hit = np.zeros(len(at), bool)
    hit[order] = d > low
    a, b = runs_of(hit, np.concatenate(([0], np.cumsum(nwin))))
    p = piece[a] if len(a) else np.zeros(0, np.int64)
    begin = pos[p].astype(np.int64) + rel[a]
    return src[p], begin, begin + (b - a) + k - 1


def _finish(text: X.GroupText, start, end) -> pa.Table:
    words = [raw.split() for raw in text.texts]                     # bytes.split: exactly the ASCII white space
    first = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    gone = covered(int(first[-1]), start, end)
    total = np.concatenate(([0], np.cumsum(gone)))
    removed = total[first[1:]] - total[first[:-1]]
    kept = [b" ".join(w if r == 0 else [w[j] for j in np.flatnonzero(~gone[a:b])])
            for w, r, a, b in zip(words, removed, first[:-1], first[1:])]
    return pa.table({"doc_id": pa.array(text.ids, pa.int64()), "n_words": pa.array(np.diff(first), pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()),
                     "kept": pa.array(kept, pa.binary()).cast(pa.string())})


def dedup_windows(docs: DataFrame, *, k: int = 13, m: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  group_bytes: int = X.GROUP_BYTES) -> DataFrame:
    """Remove each word covered by a ``k``-word window that also starts in a document of smaller id.

    Returns ``doc_id, n_words, n_removed, kept`` (kept words joined by one space) for
    every row. Words are runs of anything but U+0020 and U+0009-U+000D. Windows are
    judged on the input. Defined cases: a null or empty text has no words and keeps
    an empty string; texts under ``k`` words lose nothing; rows that repeat an id are
    one document (none is smaller than the other); a row with a null id has no order,
    so it loses nothing and takes nothing from others; an empty table gives an empty
    result; other columns are not read and not returned.
    """
    groups = X.group_documents(docs, id_col, text_col, group_bytes)
    return X.remove_covered(groups, lambda text, n: _scatter(text, n, k, m), lambda blobs: _settle(blobs, k),
                            _finish, OUT)
