"""Alignment of two tokenizers' ids of the same text, and how often id pairs meet corpus-wide.

Token ends are cumulative byte offsets. A dictionary from end to token index is built
for each tokenizer; the ends that both dictionaries hold cut both id lists into groups,
in which every A token is linked to the B tokens that share a byte with it.

Both tokenizers also part a text before each space that follows a character other than
white space, so a text is aligned stretch by stretch, and stretches that were seen are
remembered. Documents are taken in groups of a bounded number of text bytes: a group
sends each distinct pair with the number of its documents once, the counts are summed
over groups, and a group gets back the counts of its own pairs. Links of documents
never cross a shuffle one by one.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.bytesets import byte_list, column_bytes, room, take_ranges
from corpusmill.session import cut_lineage

#: Text bytes of one group of documents.
GROUP_BYTES = 8 << 20
#: Pair key = A id * _WIDE + B id; above any vocabulary's size.
_WIDE = 1 << 31
_DOC = "g long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary"
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def byte_level_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"               # Spark already runs a task per core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True                 # their strings in a text are plain text
        letters = byte_level_letters()
        self.bytes = {}
        for entry, number in self._tokenizer.get_vocab(with_added_tokens=True).items():
            try:
                self.bytes[number] = bytes(letters[c] for c in entry)
            except KeyError:                                         # not an entry of bytes
                self.bytes[number] = entry.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a ``sentencepiece`` model with byte fallback that adds a space in front."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._space = self._model.piece_to_id("▁")
        self.bytes = {}
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space; a lone space is a piece of its own inside a text."""
        ids = self._model.encode([t[1:] for t in texts], num_threads=1)
        return [own if len(t) > 1 else [self._space] for own, t in zip(ids, texts)]


def align(size_a: np.ndarray, size_b: np.ndarray) -> tuple[list[int], list[int], list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two lists of tokens that spell the same bytes, from the tokens' byte sizes.

    Returns the common ends in order, the number of A and of B tokens up to each (the
    groups are the slices between), and the links in order: their last bytes' ends, A
    token and B token. Two tokens share bytes exactly where one of the ends falls in both.
    """
    ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
    index_a, index_b = (dict(zip(ends.tolist(), range(1, len(ends) + 1))) for ends in (ends_a, ends_b))
    common = sorted(index_a.keys() & index_b.keys())
    ends = _merged(ends_a, ends_b)
    return (common, [index_a[e] for e in common], [index_b[e] for e in common],
            ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends))


class _Vocabulary:
    """A tokenizer's entries as bytes in one array, and its ids as text."""

    def __init__(self, entries: dict[int, bytes]):
        n = max(entries) + 1
        parts = [entries.get(i, b"") for i in range(n)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.name = [str(i).encode() for i in range(n)]

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return take_ranges(self.data, self.at[ids], self.size[ids])


class _Store:
    """Distinct stretches in the order they were met: counts, the groups' text, and pair keys in one flat array."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.groups: list[bytes | None] = []                         # None: the tokens' bytes differ
        self.stats = np.zeros((1 << 12, 3), np.int64)                # A ids, B ids, groups
        self.edge, self.keys = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, stretches: list[bytes], groups: list[bytes | None], stats: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.groups)
        m, used = n + len(stretches), int(self.edge[n])
        self.number.update(zip(stretches, range(n, m)))
        self.groups += groups
        if m > len(self.stats):
            self.stats = np.concatenate([self.stats, np.zeros((max(m, len(self.stats)), 3), np.int64)])
        self.stats[n:m] = stats
        self.edge, self.keys = room(self.edge, m + 1), room(self.keys, used + len(keys))
        self.edge[n + 1:m + 1] = used + np.cumsum(sizes)
        self.keys[used:used + len(keys)] = keys

    def spans(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.edge[numbers]
        return at, self.edge[numbers + 1] - at


class StretchAligner:
    """Aligns whole texts, each distinct stretch once while it is remembered.

    Stretches of the last two generations are remembered; a generation ends after so many.
    """

    _REMEMBERED = 400_000

    def __init__(self, path_a: str, path_b: str):
        self.tools = ByteLevel(path_a), Pieces(path_b)
        self.vocabularies = [_Vocabulary(t.bytes) for t in self.tools]
        self._new, self._old = _Store(), _Store()

    def _learn(self, stretches: list[bytes]) -> None:
        texts, good = [], np.ones(len(stretches), bool)
        for k, s in enumerate(stretches):
            try:
                texts.append(s.decode())
            except UnicodeDecodeError:                               # no tokenizer gives these bytes back
                texts.append(" ")
                good[k] = False
        length = np.array([len(s) for s in stretches], np.int64)
        ids, count = [], []
        for tool, words in zip(self.tools, self.vocabularies):
            own = tool.encode(texts)
            count.append(np.array([len(x) for x in own], np.int64))
            ids.append(np.fromiter(itertools.chain.from_iterable(own), np.int64, int(count[-1].sum())))
            good &= _sums(words.size[ids[-1]], count[-1]) == length
        # of the sizes that agree, compare the bytes; then only the stretches that agree are left
        for k, words in enumerate(self.vocabularies):
            raw = np.frombuffer(b"".join([s for s, g in zip(stretches, good.tolist()) if g]), np.uint8)
            differs = words.spell(ids[k][np.repeat(good, count[k])]) != raw
            good[np.flatnonzero(good)[_sums(differs, length[good]) > 0]] = False
        ids = [x[np.repeat(good, n)] for x, n in zip(ids, count)]
        a, b = (words.size[x] for words, x in zip(self.vocabularies, ids))
        common, cut_a, cut_b, ends, i, j = align(a, b)
        name_a, name_b = (list(map(words.name.__getitem__, x.tolist())) for words, x in zip(self.vocabularies, ids))
        text = [b",".join(name_a[p:q]) + b"|" + b",".join(name_b[r:s])
                for p, q, r, s in zip([0, *cut_a], cut_a, [0, *cut_b], cut_b)]
        edges = np.cumsum(length[good])                              # a stretch's end is a common end
        groups_to, links_to = np.searchsorted(common, edges, "right"), np.searchsorted(ends, edges, "right")
        stats, sizes = np.zeros((len(stretches), 3), np.int64), np.zeros(len(stretches), np.int64)
        stats[good] = np.stack([count[0][good], count[1][good], np.diff(groups_to, prepend=0)], axis=1)
        sizes[good] = np.diff(links_to, prepend=0)
        joined = iter([b";".join(text[p:q]) for p, q in zip([0, *groups_to[:-1].tolist()], groups_to.tolist())])
        self._new.add(stretches, [next(joined) if g else None for g in good.tolist()], stats, ids[0][i] * _WIDE + ids[1][j], sizes)

    def _numbers(self, kinds: list[bytes]) -> np.ndarray:
        if len(self._new.groups) > self._REMEMBERED:
            self._old, self._new = self._new, _Store()
        new, old = self._new, self._old
        unmet = [s for s in kinds if s not in new.number]
        if unmet and old.groups:                                     # stretches still in use come along
            known = [s for s in unmet if s in old.number]
            if known:
                at = np.array([old.number[s] for s in known], np.int64)
                lo, sizes = old.spans(at)
                new.add(known, [old.groups[k] for k in at.tolist()], old.stats[at], take_ranges(old.keys, lo, sizes), sizes)
                unmet = [s for s in unmet if s not in old.number]
        if unmet:
            self._learn(unmet)
        return np.fromiter(map(new.number.__getitem__, kinds), np.int64, len(kinds))

    def read(self, data: np.ndarray, offs: np.ndarray):
        """Per text: A ids, B ids, groups, links, the groups' text; and its distinct pair keys with their occurrences.

        Texts that are empty or whose token bytes differ from theirs have none.
        """
        n = len(offs) - 1
        data, offs = _with_space(data, offs)
        cuts = _merged(offs, _cuts(data))
        coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1,
                                      [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
                                      ).dictionary_encode()
        kinds = self._numbers(byte_list(coded.dictionary))
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        store = self._new
        text = [store.groups[k] for k in kinds.tolist()]
        whole = np.array([t is not None for t in text], bool)[which]
        stats = store.stats[kinds][which]
        at, size = (x[which] for x in store.spans(kinds))
        first = np.searchsorted(cuts, offs).tolist()
        out = []
        for i in range(n):
            lo, hi = first[i], first[i + 1]
            if offs[i + 1] - offs[i] <= 1 or not whole[lo:hi].all():  # the space alone: an empty text
                out.append((0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            keys, times = np.unique(take_ranges(store.keys, at[lo:hi], size[lo:hi]), return_counts=True)
            n_a, n_b, groups = stats[lo:hi].sum(axis=0).tolist()
            out.append((n_a, n_b, groups, int(times.sum()), b";".join(map(text.__getitem__, which[lo:hi].tolist())), keys, times))
        return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distinct values of two ascending arrays, ascending."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    return both[np.append(True, both[1:] != both[:-1])] if len(both) else both


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts`` consecutive values."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    edge = np.concatenate(([0], np.cumsum(counts)))
    return total[edge[1:]] - total[edge[:-1]]


def _with_space(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text with a space in front."""
    n = len(offs) - 1
    out = np.empty(len(data) + n, np.uint8)
    new = offs + np.arange(n + 1)
    out[new[:-1]] = 0x20
    body = np.ones(len(out), bool)
    body[new[:-1]] = False
    out[body] = data
    return out, new


def _cuts(data: np.ndarray) -> np.ndarray:
    """Spaces after a character that is surely not white space."""
    at = np.flatnonzero(data == 0x20)
    at = at[at > 2]
    p, q, r = data[at - 1].astype(np.int64), data[at - 2].astype(np.int64), data[at - 3].astype(np.int64)
    two, three = q << 8 | p, r << 16 | q << 8 | p
    # white space and format characters beyond ASCII, as their UTF-8 bytes
    blank = (p < 0x21) | (p == 0x7F) | (two == 0xC285) | (two == 0xC2A0) | (three == 0xE19A80) | (three == 0xE1A08E)
    blank |= (three >= 0xE28080) & (three <= 0xE281AF) | (three == 0xE38080) | (three == 0xEFBBBF)
    return at[~blank]


_ALIGNERS: dict[tuple[str, str], StretchAligner] = {}


def aligner(path_a: str, path_b: str) -> StretchAligner:
    """One aligner per worker process: what it has learnt serves the tasks that follow."""
    known = _ALIGNERS.get((path_a, path_b))
    if known is None:
        known = _ALIGNERS[path_a, path_b] = StretchAligner(path_a, path_b)
    return known


def _squeeze(*arrays: np.ndarray) -> bytes:
    raw = np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.astype(np.int64).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=3, write_checksum=False).compress(raw)


def _open(z: bytes, count: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(z)
    out, at = [], 8 * count
    for n in np.frombuffer(raw, np.int64, count).tolist():
        out.append(np.frombuffer(raw, np.int64, n, at))
        at += 8 * n
    return out


def _grouped(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, group_bytes: int,
             digest: bool) -> DataFrame:
    """A row per document with its pairs, and per group a last row (no counts) with its distinct pairs and their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = aligner(path_a, path_b)
        g, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            data, offs = column_bytes(batch.column(1))
            ids, at = batch.column(0).to_pylist(), 0
            while at < len(ids):                                     # about 2 MB of text at a time
                to = min(len(ids), max(at + 1, int(np.searchsorted(offs, offs[at] + (2 << 20)))))
                found = tool.read(data[offs[at]:offs[to]], offs[at:to + 1] - offs[at])
                yield _rows(g, ids[at:to], found, digest)
                held.append(np.unique(np.concatenate([f[5] for f in found]), return_counts=True))
                size += int(offs[to] - offs[at])
                at = to
                if size >= group_bytes:
                    yield _group_row(g, held)
                    g, held, size = g + 1, [], 0
        if held:
            yield _group_row(g, held)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _DOC)


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      names=["g", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])


def _rows(g: int, ids: list, found: list, digest: bool) -> pa.RecordBatch:
    groups = [(sha256(f[4]).hexdigest() if f[4] else "") if digest else f[4].decode() for f in found]
    return _batch([[g] * len(ids), ids, *([f[k] for f in found] for k in range(4)), groups, [_squeeze(f[5], f[6]) for f in found]])


def _group_row(g: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    docs = np.bincount(where, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)
    return _batch([[g], [None], [None], [None], [None], [None], [None], [_squeeze(keys, docs)]])


def _pairs(rows: DataFrame) -> DataFrame:
    """``g, pair, n``: the distinct pairs of each group and the number of its documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, docs = _open(z, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), g)), pa.array(keys), pa.array(docs)],
                                                 names=["g", "pair", "n"])

    return rows.where("n_a is null").select("g", "pairs").mapInArrow(run, "g long, pair long, n long")


def pair_counts(pairs: DataFrame, wide: int) -> DataFrame:
    """``pair, held, best``: documents that hold each pair linked, and whether no pair of its A id has more."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("held"))
    most = F.max("held").over(Window.partitionBy(F.expr(f"pair div {wide}")))    # at most one row per B id
    return counts.select("pair", "held", (F.col("held") == most).alias("best"))


def cross_align(docs: DataFrame, *, path_a: str, path_b: str, digest: bool = False, id_col: str = "doc_id",
                text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Align every text's ids under two tokenizers and count how widely its linked id pairs are held.

    ``path_a`` is a byte-level vocabulary (texts get a space in front), ``path_b`` a
    sentencepiece model that adds one; both files are on every machine. Returns ``doc_id,
    n_a, n_b, n_groups, n_links, n_best`` (links whose pair is the most widely held of its
    A id, ties included), ``count_sum`` (documents that hold the pair, summed over links)
    and ``groups`` as ``a1,a2|b1;a3|b2,b3`` (its SHA-256 in hex with ``digest``, which
    keeps texts of several times the input out of the exchange).

    Defined cases: null and empty texts, and texts that the tokens' bytes don't give
    back (such as those holding U+2581), have zeros and empty groups; rows are documents,
    so rows that repeat an id or a text each count; null ids stay null; long texts are
    aligned whole; an empty table gives an empty result; other columns are not read.
    """
    rows = cut_lineage(_grouped(docs, path_a, path_b, id_col, text_col, group_bytes, digest))
    pairs = _pairs(rows)
    counts = pair_counts(pairs, _WIDE)
    back = pairs.select("g", "pair").join(counts, "pair")
    return rows.where("n_a is not null").groupBy("g").cogroup(back.groupBy("g")).applyInArrow(_finish, _OUT)


def _finish(docs: pa.Table, counts: pa.Table) -> pa.Table:
    order = np.argsort(counts["pair"].to_numpy())
    keys = counts["pair"].to_numpy()[order]
    held = counts["held"].to_numpy()[order]
    best = counts["best"].to_numpy()[order]
    n_best, total = [], []
    for z in docs["pairs"].to_pylist():
        own, times = _open(z, 2)
        at = np.searchsorted(keys, own)
        n_best.append(int(times[best[at]].sum()))
        total.append(int((times * held[at]).sum()))
    return pa.table({**{c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                     "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "groups": docs["groups"]})
