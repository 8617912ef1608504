"""The Merkle manifest against a plain restatement on lists."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle

COLS = "doc_id long, source string, lang string, n_chars long, text string, tree int, idx string, hash string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _plain(rows, arity):
    """Per row: leaf, subroot, root, proof digest, folded root; by walking lists of nodes."""
    def tree(leaves):
        proofs, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
        while len(nodes) > 1:
            for p, i in zip(proofs, at):
                lo = i // arity * arity
                p.append((nodes[lo:i], nodes[i + 1:lo + arity]))
            nodes = [_h(*nodes[k:k + arity]) for k in range(0, len(nodes), arity)]
            at = [i // arity for i in at]
        return nodes[0], proofs

    parts = {}
    for r in rows:
        v = list(r[:5])
        leaf = _leaf(v)
        if v[0] is not None and zlib.crc32(str(v[0]).encode()) % 7 == 0 and v[3] is not None:
            v[3] += 1
        parts.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, _leaf(v)))
    names = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    made = {k: tree([x[2] for x in sorted(parts[k])]) for k in names}
    root, above = tree([made[k][0] for k in names])
    out = []
    for k, up in zip(names, above):
        for (known, i, leaf, tried), own in zip(sorted(parts[k]), made[k][1]):
            h = tried
            for left, right in own + up:
                h = _h(*left, h, *right)
            digest = _h(*[x for left, right in own + up for x in left + right])
            out.append((i if known else None, leaf, made[k][0], root, digest, h, h == root))
    return sorted(map(str, out))


def _rows(n):
    rows = [(i, f"s{i % 3}", "en" if i % 4 else ["de", None, "", "fr"][i // 4 % 4], i * 3, f"text {i} é 中") for i in range(n)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (7, "s", "en", None, ""), (7, "s", "en", 5, "x" * 300_000),
             (8, "s", "xx", 1, "alone"), (8, "s8", "xx", 1, "alone"), (3, "s", "zz", 2, "one leaf")]
    return [r + (1, "c", "h") for r in rows]


@pytest.mark.parametrize("arity,band_levels,n", [(2, 12, 40), (2, 2, 150), (3, 1, 75), (2, 3, 0)])
def test_manifest_equals_lists(spark, arity, band_levels, n):
    rows = _rows(n)
    docs = spark.createDataFrame(rows, COLS).repartition(5)
    changed = {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1)
               .otherwise(F.col("n_chars"))}
    got = merkle.manifest(docs, fields=FIELDS, part_col="lang", changed=changed, arity=arity, band_levels=band_levels).collect()
    assert sorted(str((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)) for r in got) == _plain(rows, arity)
    assert all(merkle.fold(r.leaf, r.proof) == r.root for r in got)


def test_one_leaf_and_empty_table(spark):
    one = merkle.manifest(spark.createDataFrame([(1, "s", "en", 2, "t", 0, "", "")], COLS), fields=FIELDS, part_col="lang").collect()
    assert [(r.leaf == r.subroot == r.root, r.proof, r.proof_sha256, r.verified) for r in one] == [(True, "", _h(), True)]
    none = spark.createDataFrame([], COLS)
    assert merkle.manifest(none, fields=FIELDS, part_col="lang").collect() == []
    assert merkle.node_table(none, fields=FIELDS, part_col="lang").collect() == []


def test_intervals_nest(spark):
    docs = spark.createDataFrame(_rows(90), COLS)
    nodes = merkle.node_table(docs, fields=FIELDS, part_col="lang", arity=2, band_levels=2).collect()
    by = {}
    for r in nodes:
        by.setdefault((r.tree, r.level), []).append((r.lo, r.hi, r.hash))
    for (tree, level), own in by.items():
        own.sort()
        assert own[0][0] == 0 and all(a[1] == b[0] for a, b in zip(own, own[1:]))        # intervals tile the part
        for lo, hi, name in by.get((tree, level + 1), []):
            assert name == _h(*[h for a, b, h in own if lo <= a and b <= hi])
        if (tree, level + 1) not in by:
            assert len(own) == 1
