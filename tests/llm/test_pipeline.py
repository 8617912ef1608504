"""The pipeline's stages on odd rows: nulls, empty and repeated texts, ties, clashing columns, empty tables."""

import random
import shutil

import pytest

import corpus_pipeline as P
from corpusmill.session import cut_lineage

SF = "/root/testdata/sf0.001"
COLS = "doc_id long, text string, lang string, source string, n_chars long, score int, at string, w string, block int"
RNG = random.Random(9)


def _prose(n):
    return "\n".join(" ".join(f"w{RNG.randrange(400)}" for _ in range(12)) for _ in range(n))


def _rows():
    a, b = _prose(12), _prose(20)
    base = [(1, a, "s1"), (2, b, "s2"), (2, b, "s2"), (None, a, None), (3, None, "s1"), (4, "", "s1"), (None, None, None), (5, " \n\t", "s2"),
            (6, a + "\nnot in a", "s1"), (7, _prose(400), "s3"), (8, "ab é 中", "s3"), (None, _prose(9), "s1"), (None, _prose(9), "s1")]
    return [(i, t, "en" if i else None, s, None if t is None else len(t), 1, "at", "w", 3) for i, t, s in base]


ROWS = _rows()


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ROWS, COLS).repartition(3)


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stage_takes_odd_and_empty_tables(spark, odd, name, stage):
    none = stage(spark, odd.limit(0), SF)
    assert none.collect() == []
    out = cut_lineage(stage(spark, odd, SF))
    if stage is not P.STAGES[-1][1]:
        assert out.columns == odd.columns == none.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
        assert all((r["score"], r["at"], r["w"], r["block"]) == (1, "at", "w", 3) for r in out.collect())


def test_line_dedup_keeps_rows_and_measures(spark, odd):
    out = P.drop_repeated_lines(spark, odd, SF).collect()
    assert len(out) == len(ROWS)
    assert all((r.text is None and r.n_chars == 0) or r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.doc_id == 6} == {"not in a"}


def test_near_copies_keep_one_of_a_group(spark, odd):
    out = P.drop_near_copies(spark, odd, SF).collect()
    texts = [r.text for r in out]
    assert len(texts) == len(set(texts)) and [r.doc_id for r in out].count(2) == 1
    assert sum(not (t or "").split() for t in texts) == 1            # null, empty and blank texts are one group


def test_mix_draws_words_of_its_documents(spark, odd):
    words = {(r[0], w) for r in ROWS for w in (r[1] or "").split()}
    out = P.mix(spark, odd, SF).collect()
    assert out and all((r.doc_id, w) in words for r in out for w in r.text.split())
    assert sorted(map(str, out)) == sorted(map(str, P.mix(spark, odd.repartition(5), SF).collect()))


def test_run_on_odd_rows_and_on_an_empty_table(spark, odd, tmp_path):
    for docs, name in ((odd, "odd"), (odd.limit(0), "none")):
        folder = tmp_path / name
        docs.write.parquet(str(folder / "documents.parquet"))
        shutil.copy(f"{SF}/labels.parquet", folder / "labels.parquet")
        got = P.run(spark, str(folder)).collect()
        assert (len(got) > 0) == (name == "odd")
        assert all(r.offset + r.length <= 4096 for r in got)
