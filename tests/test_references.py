"""Character references of the leaf form against Python's reader, which the nested form uses."""

import random
from html import unescape

from pyspark.sql import functions as F

from corpusmill.functions.html import decode_entities
from corpusmill.operators.blocks import extract_blocks

CASES = ["", "plain", "a & b", "AT&T", "&lt;b&gt;", "&amp;lt;", "&amp;amp;", "&copy 2020", "&copy2020", "&notit;", "&notin;", "&not", "&#65;&#66",
         "&#x41;&#X42;&#x43", "&#0;", "&#13;", "&#128;", "&#x80", "&#159;", "&#11;", "&#xFDD0;", "&#xFFFE;", "&#x10FFFF;", "&#x1F600;",
         "&#1114112;", "&#00000000000000065;", "&#99999999999999999999;", "&#x00000000041;", "&#xFFFFFFFFFFFFFFFFFF;", "&#xD800;",
         "&#;", "&#x;", "&;", "&&amp;&", "&nosuch;", "&ampersand;", "&AMP;x&AMPx", "&NotEqualTilde;", "&bne;", "&frac12;&frac12x", "&nbsp;&ensp;",
         "&thetasym;&Eacute", "é&eacute;&eacutex", "&amp", "&lt", "&quot;&apos;&#39;&apos", "&" + "a" * 60 + ";", "&sup", "&sup2;&sup2&supe;"]


def test_references_as_python_reads_them(spark):
    rng = random.Random(4)
    bits = ["&", "#", "x", "amp", "lt", ";", "copy", "not", "in", "1", "65", "41", "F", " ", "é", "<", "notin;", "acute"]
    cases = CASES + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 12))) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(cases)), "k int, t string").repartition(2)
    got = {r.k: r.d for r in rows.select("k", decode_entities(F.col("t")).alias("d")).collect()}
    assert {k: got[k] for k, t in enumerate(cases) if got[k] != unescape(t)} == {}


def test_both_forms_agree(spark):
    html = "".join(f"<p>{t}</p>" for t in CASES if "<" not in t and t.strip())
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    leaf, nested = ([(r.tag, r.text) for r in extract_blocks(pages, mode=m).orderBy("pos").collect()] for m in ("leaf", "nested"))
    assert leaf == nested
