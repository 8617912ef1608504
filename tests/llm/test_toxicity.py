"""The pattern grammar on sentences, and the fitted classifier on rows it didn't learn from."""

import pytest

from corpusmill.llm import queries, toxicity as T
from corpusmill.session import read_table

GRAMMAR = T.Grammar({**dict.fromkeys(T.INSULTS, 1.0), "zorb": 0.5, "blik$": 1.0})


def _kinds(text):
    total = {}
    for _, _, kinds in GRAMMAR.clauses(T.lower(text)):
        for k, v in kinds.items():
            total[k] = total.get(k, 0) + v
    return total


@pytest.mark.parametrize("text,kinds", [
    ("You are an idiot.", {"plain": 1, "addressed": 1}),
    ("An idiot, that.", {"plain": 1}),
    ("You are not an idiot.", {"negated": 1}),
    ("Not here, idiot.", {"plain": 1}),
    ("She said he is a clown.", {"reported": 1}),
    ('It read "worthless scum" there', {"reported": 2}),
    ('It read "a word" worthless', {"plain": 1}),
    ("I will kill you.", {"threat": 1}),
    ("I will find and hurt them.", {"threat": 1}),
    ("They kill time. You will see.", {}),
    ("IDIOTS! You moron!", {"plain": 2, "addressed": 1}),
    ("smidiot", {}), ("blikker", {}), ("blik zorbing", {"plain": 1.5}), ("", {}), ("...", {}),
])
def test_clauses(text, kinds):
    assert _kinds(text) == kinds


def test_whole_text_is_read():
    long = "word " * 200_000
    assert _kinds(long + "\nidiot " + long + ". moron") == {"plain": 2}
    assert GRAMMAR.features("") == [0.0] * 5 and GRAMMAR.features(long) == [0.0] * 5
    spans = [(lo, hi) for lo, hi, _ in GRAMMAR.clauses("fine. you idiot! fine; scum")]
    assert spans == [(5, 15), (22, 27)]


def test_composed_equals_machines_in_turn():
    import itertools

    machine = T.Composed(T.Insult(), T.Threat(), T.Target(), T.Negation(), T.Report())
    for word in itertools.product("IHMTNRQCO", repeat=4):
        state, tags, singles = machine.start, [], [[m, m.start, []] for m in machine.machines]
        for symbol in word:
            state, t = machine.step(state, symbol)
            tags.append(t)
            for one in singles:
                one[1], own = one[0].step(one[1], symbol)
                one[2].append(own)
        assert state == tuple(one[1] for one in singles)
        assert tags == [frozenset(x for one in singles for x in one[2][k]) for k in range(4)]


def test_odd_rows(spark):
    rows = [(1, "You idiot!", 5.0), (2, None, 5.0), (3, "", 5.0), (None, "You idiot!", 5.0), (1, "You idiot!", 5.0), (4, " \n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = T.score(docs, T.ToxicityModel(dict.fromkeys(T.INSULTS, 1.0))).collect()
    by = {(r.doc_id, r.text): r.score for r in got}
    assert len(got) == 6 and by[1, "You idiot!"] == by[None, "You idiot!"] > 0.5 and by[2, None] == by[3, ""] == by[4, " \n"] < 0.1
    assert T.score(docs.limit(0), T.ToxicityModel({})).collect() == []
    hits = T.matched_clauses(docs, T.ToxicityModel(dict.fromkeys(T.INSULTS, 1.0))).collect()
    assert sorted(str((r.doc_id, r.start, r.length, r.clause)) for r in hits) == sorted(
        str(x) for x in [(1, 0, 9, "You idiot"), (1, 0, 9, "You idiot"), (None, 0, 9, "You idiot")])
    none = spark.createDataFrame([], "doc_id long, toxic int, text string")
    for labels in (none, spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int")):
        model = T.fit(docs, labels)
        assert model.weights == T.PRIOR and set(T.INSULTS) <= set(model.insults)


def test_learns_stems_of_other_languages(spark):
    """Stems that mark toxic rows are found; words that are merely common are not, held-out rows are told apart."""
    import random

    rng = random.Random(1)
    prose = [f"ba{a}{b}" for a in "lmnr" for b in "aeiou"] + ["vekar", "velo"]

    def text(toxic):
        words = [rng.choice(prose) for _ in range(rng.randrange(60, 200))]
        for k in range(0, len(words), 30) if toxic else ():
            words[k] = "vequ" + rng.choice(["ta", "mo", "eur", "que"])
        return " ".join(words)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    learnt = set(model.insults) - set(T.INSULTS)
    assert learnt and all(s.startswith("vequ") for s in learnt)
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert all((got[i] >= 0.3) == bool(y) for i, _, y in rows if i % 3 == 0)


def test_held_out_accuracy(spark):
    """Rows whose labels were not learnt from, sf0.1: recall and precision at the contract's threshold."""
    sf = "/root/testdata/sf0.1"
    got = queries.op11_toxicity(spark, sf)
    held = got.where("held_out").join(read_table(spark, sf, "labels"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85 and n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01
    assert got.count() == read_table(spark, sf, "documents").count() and got.where("score not between 0 and 1").count() == 0
