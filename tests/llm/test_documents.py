"""Operators on documents against plain restatements of their rules."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import linededup, mixing, packing, piecewise, quality, queries, simhash, topk
from corpusmill.llm.htmltext import extract, main_texts

RNG = random.Random(3)
SF = "/root/testdata/sf0.001"


def _prose(n):
    return " ".join(f"w{RNG.randrange(60)}" for _ in range(n))


def _rows():
    a = _prose(80)
    return [(1, a, "s"), (2, a.upper(), "s"), (3, a + " tail", "t"), (4, None, None), (5, "", "t"), (6, "one", "s"),
            (7, " \n ", "u"), (8, _prose(5000), "u"), (8, _prose(5000), "u"), (None, a, "s"), (9, "é 中 " * 30, "s")]


def test_simhash_components(documents):
    rows = _rows()
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_groups(documents(rows)).collect()}
    prints = []
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    root = list(range(len(prints)))
    for x, y in itertools.combinations(range(len(prints)), 2):
        if (prints[x][1] ^ prints[y][1]).bit_count() <= 2:
            old, new = root[y], root[x]
            root = [new if r == old else r for r in root]
    want = {(i, f"{f:016x}"): min(p[0] for p, r in zip(prints, root) if r == root[k] and p[0] is not None)
            for k, (i, f) in enumerate(prints)}
    assert got == want
    assert simhash.near_groups(documents([])).collect() == []


def test_keep_one_judges_rows(documents):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(90)) for x in "abcd")
    rows = [(3, a, "s"), (8, a.upper(), "s"), (8, b, "s"), (None, b, "s"), (None, c, "s"), (None, c, "s"), (None, c.upper(), "s"),
            (9, d, "s"), (9, d, "s"), (9, d, None), (9, d.upper(), "s"), (None, None, "s"), (12, "", "t"), (12, "", "t")]
    got = simhash.keep_one(documents(rows)).collect()
    assert len(got) == 5 and all(r.g == 1 and r.kept == "x" for r in got)
    assert {(r.doc_id, (r.text or "").lower()) for r in got} == {(3, a), (8, b), (None, c), (9, d), (12, "")}
    again = simhash.keep_one(documents(rows[::-1])).collect()        # the order of the rows doesn't matter
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert simhash.keep_one(documents([])).collect() == []


def test_line_dedup(documents):
    a = [f"a{k}" for k in range(12)]
    line = " ".join(a)
    rows = [(1, line + "\nshort\n\nshort", "s"), (2, "short\n" + " ".join(a[:5] + a[6:]) + "\n ", "s"),
            (3, "  " + line.replace(" ", " \t") + "\nnew", "s"), (4, " ".join(a[:-1] + ["z"]), "s"),
            (5, " ".join(a[::-1]), "s"), (6, None, "s"), (7, "", "s"), (None, "new\nlast", "s"), (8, " ".join(["q"] + a + ["r"]), "s")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in linededup.dedup_lines(documents(rows)).collect()}
    assert got == {1: (line + "\nshort\n", 4, 1), 2: (" ", 3, 2), 3: ("new", 2, 1), 4: ("", 1, 1),
                   5: (" ".join(a[::-1]), 1, 0), 6: (None, 0, 0), 7: ("", 1, 0), None: ("last", 2, 1),
                   8: (" ".join(["q"] + a + ["r"]), 1, 0)}
    assert linededup.dedup_lines(documents([])).collect() == []


def test_packing_round_trip(documents):
    from tokenizers import Tokenizer

    rows = _rows()
    got = packing.pack(documents(rows), vocabulary=queries.vocabulary(), capacity=64).collect()
    code = Tokenizer.from_file(queries.vocabulary())
    want = []
    for i, t, _ in rows:
        ids, at = code.encode(t or "", add_special_tokens=False).ids + [2], 0
        for n in packing.piece_lengths(len(ids), 64):
            want.append((i, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()), len(ids)))
            at += n
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    for _, own in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        own = list(own)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= 64


def test_differencing_is_near_equal_and_never_over():
    sizes = [RNG.randrange(1, 1025) for _ in range(700)]
    window = packing.pack_block(sizes, 4096)
    sums = np.bincount(window, weights=sizes)
    assert sums.max() <= 4096 and sums.sum() == sum(sizes) and len(sums) <= -(-sum(sizes) // 4096) + 1
    assert packing.pack_block([5], 4096) == [0]


def test_mix_targets_and_limits(documents):
    rows = _rows()
    out = mixing.taken(*mixing.mix_sources(documents(rows), block_words=8, shard_words=512)).collect()
    sizes = sorted(len((t or "").encode().split()) for _, t, _ in rows)
    assert sorted(r["size"] for r in out) == sizes and all(0 <= r.taken <= 2 * r["size"] for r in out)
    by = {}
    for r in out:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) <= 16 for (_, t), v in by.items())
    docs, draws = mixing.mix_sources(documents(rows), block_words=8, shard_words=512)
    spans = [(r.number, r.doc_start, r.copy, r.start, r.n_words) for r in draws.collect()]
    assert len({s[:4] for s in spans}) == len(spans)                 # disjoint draws
    assert mixing.targets([10, 100, 0], [5, 2, 1], 165, 2) == [20.0, 145.0, 0.0]
    assert mixing.taken(*mixing.mix_sources(documents([]))).collect() == []


def test_piecewise_next_and_edit(documents):
    rows = _rows()
    # null ids come last, by the falling upper 52 bits of the text's signed XXH64
    place = {r: xxhash.xxh64_intdigest((r[1] or "").encode(), 42) if r[0] is None else r[0] for r in rows}
    order = sorted(rows, key=lambda r: (r[0] is None, -(((place[r] + 2 ** 63) % 2 ** 64 - 2 ** 63) >> (12 if r[0] is None else 0)), (r[1] or "").encode()))
    got = piecewise.compare_with_next(documents(rows), ranges=5).collect()
    want = []
    for k, (i, t, _) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        want.append((i, len(t), e, piecewise.fingerprint(t.encode()), piecewise.fingerprint(e.encode())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint)) for r in got)
    long = _prose(3000)
    half = piecewise.edit(long, _prose(3000))
    assert 0.3 < piecewise.likeness(piecewise.fingerprint(long.encode()), piecewise.fingerprint(half.encode())) < 0.8
    assert piecewise.compare_with_next(documents([])).collect() == []


def test_exact_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(90)]
    vectors += [(90, vectors[0][1]), (91, None), (92, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (93, [float("nan")] * 6), (94, [1.0, 2.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(table, F.col("vec_id") % 20 == 0, k=5, block_rows=16, query_rows=2).collect()}
    whole = {i: np.floor(64 * np.array(x)).astype(int) for i, x in vectors[:91]}
    want = set()
    for i in range(0, 91, 20):
        best = sorted((-int(whole[i] @ whole[j]), j) for j in whole if j != i)[:5]
        want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert got == want
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_html_main_text(spark):
    page = ("<html><head><title>t</title></head><body><nav><a href=/>menu</a></nav><div class='ad'>buy</div>"
            "<div class=post-content><h1>T &amp; U</h1><p>One  long\n paragraph of text<p>Two <b>bold</b> words here</div>"
            "<div id=comments><p>reader says</p></div><footer>end</footer><script>var a='<p>';</script></body></html>")
    table = spark.createDataFrame([(1, "http://h.example/a", page), (2, "http://h.example/b", None), (3, None, ""), (1, "http://h.example/a", page)],
                                  "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    got = [(r.page_id, r.text, r.n_chars) for r in main_texts(table).orderBy("page_id").collect()]
    text = "T & U\nOne long paragraph of text\nTwo bold words here"
    assert got == [(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0)]
    assert extract("plain &lt; text", None)[0] == "plain < text"
    assert main_texts(table.limit(0)).collect() == []


def test_quality_separates_and_handles_empty(spark, documents):
    good = [(k, " ".join(f"word{RNG.randrange(300)}" for _ in range(120)), "s") for k in range(60)]
    bad = [(100 + k, " ".join(f"$$##{RNG.randrange(300)}!!" for _ in range(120)), "s") for k in range(60)]
    docs = documents(good + bad + [(500, None, "s"), (501, "", "s")])
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _, _ in good + bad], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert min(scores[i] for i, _, _ in good) > 0.7 > max(scores[i] for i, _, _ in bad)
    assert scores[500] == scores[501] and len(scores) == 122
    assert quality.score(documents([]), quality.fit(docs, labels.limit(0))).collect() == []


def test_quality_dictionaries_read_past_openings(spark, documents):
    rng = random.Random(4)
    rows = [rng.randbytes(1500).hex().encode() for _ in range(200)]
    held = quality._dictionary(rows, 20_000, 400)                    # under one piece a row
    at = [next(k for k in range(len(t)) if t[k:k + 90] in held) for t in rows]   # each row has its part
    assert 19_000 < len(held) < 21_000 and min(at) < 500 and max(at) > 2000 and len(set(at)) > 150
    # junk that stands only behind 20,000 bytes of ordinary text
    words = [f"word{k}" for k in range(3000)]
    plain = [" ".join(rng.choices(words, k=2500)) for _ in range(120)]
    junk = [" ".join(f"$$##{rng.randrange(300)}!!" for _ in range(2500)) for _ in range(40)]
    docs = documents([(k, t + " " + (junk[k - 40] if k >= 40 else plain[80 + k]), "s") for k, t in enumerate(plain[:80])])
    labels = spark.createDataFrame([(k, int(k < 40)) for k in range(80)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert min(scores[k] for k in range(40)) > 0.7 > max(scores[k] for k in range(40, 80))


def test_held_out_accuracy_and_pipeline(spark):
    rows = queries.op3_quality(spark, "/root/testdata/sf0.1").where("held_out").select("doc_id", "predicted")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    right = rows.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = docs.count()
    assert 0 < kept["simhash near-dedup"] <= kept["line dedup"] == kept["quality classifier"]
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.groupBy("sequence_id").sum("length").agg(F.max("sum(length)")).first()[0] <= 4096
    assert hashlib.sha256(str(sorted(map(tuple, packed.collect()))).encode()).hexdigest() == hashlib.sha256(
        str(sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))).encode()).hexdigest()
