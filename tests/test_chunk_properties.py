"""Random texts: the Spark fold equals a small position model of the chunk rules.

The model follows SURVEY §2.4 rule 5 (state: start st, last emit b): the next
emit is the first non-decimal unit u > b whose list length u - st + 1 equals
the size, or which ends in "." and equals the last sentence; the chunk is
s[st..u]; then st = max(st, u - overlap + 1).
"""

import re

from hypothesis import given, settings, strategies as st

from corpusmill.operators import chunking

WORDS = ["a", "bb", "X", "3.14", "12.5", "é", "ok", "no"]
ENDS = [".", ".", ".", "!", "?", ""]
SEPS = [" ", " ", "  ", "\n", " \n"]


def model(text, size, overlap):
    s = re.split(r"(?<=[.!?]) +", text)
    n = len(s)
    dec = [bool(re.match(r"^\d+\.\d+$", x)) for x in s]
    out, start, b = [], 1, 0
    while True:
        u = next((u for u in range(b + 1, n + 1) if not dec[u - 1] and (
            u - start + 1 == size or (s[u - 1].endswith(".") and s[u - 1] == s[-1]))), None)
        if u is None:
            return out
        out.append(" ".join(s[start - 1:u]).strip())
        start, b = max(start, u - overlap + 1), u


sentence = st.builds(lambda ws, e: " ".join(ws) + e,
                     st.lists(st.sampled_from(WORDS), min_size=1, max_size=3), st.sampled_from(ENDS))
text = st.builds(lambda parts, seps, tail: "".join(p + sep for p, sep in zip(parts, seps)) + tail,
                 st.lists(sentence, min_size=0, max_size=40),
                 st.lists(st.sampled_from(SEPS), min_size=40, max_size=40),
                 st.sampled_from(["", "X.", "3.14", " ", "X. X."]))


@settings(max_examples=8, deadline=None, derandomize=True)
@given(texts=st.lists(text, min_size=30, max_size=30),
       size=st.sampled_from([1, 3, 15]), overlap=st.sampled_from([0, 2, 5, 50]))
def test_fold_equals_model(spark, texts, size, overlap):
    df = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)],
                               "ord long, url string, text string")
    got = {}
    for r in chunking.chunk_records(df, size=size, overlap=overlap).collect():
        got.setdefault(r.ord, []).append((r.chunk_no, r.data))
    for i, t in enumerate(texts):
        assert [d for _, d in sorted(got.get(i, []))] == model(t, size, overlap), (t, size, overlap)
