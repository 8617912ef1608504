"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a string of symbols (insult, harm verb, modal, target, negation,
reporting verb, quotation mark, comma, other word). Five small transducers read it
side by side, composed into one machine: insults, threats (modal, harm verb and target
in turn), whether a target is addressed, whether an insult is negated, and whether it is
reported speech. The machine's output is an event per insult or threat with its
circumstances; a text's score is a logistic function of the events' weights for its
length, so matched clauses are scored, not isolated words.

Insults are words and word stems. A few are given; the others, of any language, are
learnt from labelled rows: stems whose presence (or density) marks toxic rows far more
often than others, chosen one after another by the toxic rows they newly explain.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusmill.session import cut_lineage

# The given vocabulary of the grammar.
INSULTS = "idiot moron imbecile scum loser clown stupid pathetic worthless disgusting trash vermin".split()
HARM = "kill hurt destroy beat burn stab shoot smash crush punch strangle".split()
MODALS = "will would gonna going should must shall i'll we'll they'll ought".split()
TARGETS = "you your yours u ya yourself they them their him her he she these those people everyone".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't doesn't didn't won't nicht kein keine pas jamais nunca".split()
REPORTS = "said says say called calls wrote writes quoted claimed claims according reported told tells".split()
QUOTES = "\"“”„«»"
CLAUSE_END = re.compile(r"[.!?;:|\r\n…]")

_TOKEN = re.compile(rf"[^\W_][\w'’]*|[{QUOTES},]")
_WORD = re.compile(r"[^\W\d_]+")
_SYMBOLS = {**dict.fromkeys(HARM, "H"), **dict.fromkeys(MODALS, "M"), **dict.fromkeys(TARGETS, "T"),
            **dict.fromkeys(NEGATIONS, "N"), **dict.fromkeys(REPORTS, "R"), **dict.fromkeys(QUOTES, "Q"), ",": "C"}

#: Circumstances of an event, and what a clause holding it counts before any label is seen.
KINDS = ("plain", "addressed", "negated", "reported", "threat")
PRIOR = (8.0, 2.0, 3.0, 3.0, 6.0)


@dataclass(frozen=True)
class FitLimits:
    """Bounds of the training sample, the only place where the classifier reads less than everything."""

    rows_per_class: int = 4000       # labelled rows per class: the least by hash of the text, read whole
    candidates: int = 4000           # stems that are weighed against each other
    vocabulary: int = 1000           # stems that enter the grammar
    calibration_share: float = 0.3   # of the sample, kept out of the vocabulary


@dataclass(frozen=True)
class ToxicityModel:
    insults: Mapping[str, float]     # stem -> weight; a stem that ends in $ is a whole word
    weights: tuple[float, ...] = PRIOR
    intercept: float = -3.0


# ---------------------------------------------------------------- transducers

class Transducer:
    """A Mealy machine: ``step(state, symbol)`` gives the next state and the tags of that symbol."""

    start = 0

    def step(self, state, symbol):
        raise NotImplementedError


class Insult(Transducer):
    def step(self, state, symbol):
        return 0, ("insult",) if symbol == "I" else ()


class Threat(Transducer):
    """Modal, within 3 words a harm verb, within 3 words a target."""

    def step(self, state, symbol):
        if symbol == "M":
            return 3, ()
        if symbol == "H" and 0 < state <= 3:
            return 6, ()
        if symbol in "TI" and state > 3:
            return 0, ("threat",)
        return (0 if state in (0, 1, 4) else state - 1), ()


class Target(Transducer):
    """Whether the clause has named a target by its end."""

    def step(self, state, symbol):
        return int(state or symbol == "T"), ()


class Negation(Transducer):
    """An insult up to 3 words after a negation; a comma ends its reach."""

    def step(self, state, symbol):
        if symbol == "N":
            return 3, ()
        if symbol == "C":
            return 0, ()
        return max(0, state - 1), ("negated",) if symbol == "I" and state else ()


class Report(Transducer):
    """An insult after a reporting verb of the clause, or inside quotation marks."""

    start = (0, 0)

    def step(self, state, symbol):
        told, quoted = state
        if symbol == "Q":
            return (told, 1 - quoted), ()
        return (int(told or symbol == "R"), quoted), ("reported",) if symbol == "I" and (told or quoted) else ()


class Composed:
    """The machines side by side: a state for each, all tags of a symbol; steps are remembered."""

    def __init__(self, *machines: Transducer):
        self.machines = machines
        self.start = tuple(m.start for m in machines)
        self._table: dict = {}

    def step(self, state, symbol):
        known = self._table.get((state, symbol))
        if known is None:
            moves = [m.step(s, symbol) for m, s in zip(self.machines, state)]
            known = tuple(s for s, _ in moves), frozenset(t for _, tags in moves for t in tags)
            self._table[state, symbol] = known
        return known


class Grammar:
    """Reads whole texts: finds insults and harm verbs, then runs the machine over their clauses."""

    def __init__(self, insults: Mapping[str, float]):
        import ahocorasick

        patterns: dict[str, list] = {}
        for stem, weight in [*insults.items(), *((v + "$", 0.0) for v in HARM)]:
            word = stem.rstrip("$")
            patterns.setdefault(word, []).append((len(word), stem.endswith("$"), weight))
        self._find = ahocorasick.Automaton()
        for word, kinds in patterns.items():
            self._find.add_word(word, kinds)
        self._find.make_automaton()
        self._machine = Composed(Insult(), Threat(), Target(), Negation(), Report())

    def _found(self, text: str) -> dict[int, float]:
        """Start of each matched word -> weight of its heaviest insult (0: a harm verb)."""
        out: dict[int, float] = {}
        for last, kinds in self._find.iter(text):
            goes_on = last + 1 < len(text) and text[last + 1].isalnum()
            for size, whole, weight in kinds:
                at = last + 1 - size
                if not (whole and goes_on) and (at == 0 or not text[at - 1].isalnum()):
                    out[at] = max(weight, out.get(at, 0.0))
        return out

    def clauses(self, text: str) -> Iterator[tuple[int, int, dict[str, float]]]:
        """Start, end and weight by kind of every clause with an event, in order; ``text`` is lower case."""
        found = self._found(text)
        if not found:
            return
        ends = [m.start() for m in CLAUSE_END.finditer(text)]
        for number in sorted({bisect.bisect_left(ends, at) for at in found}):
            lo = ends[number - 1] + 1 if number else 0
            hi = ends[number] if number < len(ends) else len(text)
            state, insults, kinds = self._machine.start, [], Counter()
            for token in _TOKEN.finditer(text, lo, hi):
                weight = found.get(token.start(), 0.0)
                state, tags = self._machine.step(state, "I" if weight else _SYMBOLS.get(token.group(), "O"))
                if "insult" in tags:
                    insults.append((weight, "negated" if "negated" in tags else "reported" if "reported" in tags else "plain"))
                if "threat" in tags:
                    kinds["threat"] += 1.0
            for weight, kind in insults:
                kinds[kind] += weight
                if kind == "plain" and state[2]:
                    kinds["addressed"] += weight
            if kinds:
                yield lo, hi, dict(kinds)

    def features(self, text: str) -> list[float]:
        """Weight of each kind per 50 words, damped in short texts and at most 2."""
        total = Counter()
        low = lower(text)
        for _, _, kinds in self.clauses(low):
            total.update(kinds)
        n = len(low.split()) if total else 0
        return [min(2.0, 50 * total[k] / (n + 50)) for k in KINDS]


def lower(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


# ---------------------------------------------------------------- learning

def _stems(text: str) -> tuple[Counter, int]:
    """How many words of the text each stem begins (or, with $, is), and the number of words."""
    words = Counter(_WORD.findall(lower(text)))
    out: Counter = Counter()
    for word, n in words.items():
        for k in range(3, min(8, len(word)) + 1):
            out[word[:k]] += n
        out[word + "$"] += n
    return out, sum(words.values())


def _dense(n: int, words: int) -> bool:
    return n > 1 and 150 * n >= words


def _count_stems(rows: DataFrame) -> DataFrame:
    """Documents of class 1 and 0 that hold each stem, and that hold it densely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def out():
            table = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string())] + [pa.array([v[k] for v in held.values()], pa.int64()) for k in range(4)],
                names=["stem", "n1", "n0", "d1", "d0"])
            held.clear()
            return table

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                stems, words = _stems(text.decode("utf-8", "replace"))
                for stem, n in stems.items():
                    v = held.setdefault(stem, [0, 0, 0, 0])
                    v[1 - y] += 1
                    v[3 - y] += _dense(n, words)
                if len(held) > 500_000:
                    yield out()
        yield out()

    counts = rows.select("y", "text").mapInArrow(run, "stem string, n1 long, n0 long, d1 long, d0 long")
    return counts.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("n1", "n0", "d1", "d0")])


def _lift(n1, n0, total1, total0):
    """Log of how much more often a stem is in class 1, counting one more document of class 0."""
    return math.log(max(n1, 1e-9) / total1) - math.log((n0 + 1) / (total0 + 1))


def _vocabulary(rows: DataFrame, totals: tuple[int, int], limits: FitLimits) -> dict[str, float]:
    """Stems chosen one after another by the rows of class 1 that they newly explain."""
    total0, total1 = totals
    out = dict.fromkeys(INSULTS, 1.0)
    if not total1 or not total0:
        return out
    least = max(3, math.ceil(total1 / 400))
    many = F.greatest(F.col("n1") * F.lit(total0 + 1) / ((F.col("n0") + 1) * total1),
                      F.col("d1") * F.lit(total0 + 1) / ((F.col("d0") + 1) * total1))
    best = (_count_stems(rows).where((F.col("n1") >= least) & (many >= 4.0))
            .withColumn("gain", F.col("n1") * F.log(many)).orderBy(F.desc("gain"), "stem").limit(limits.candidates).collect())
    stems = {}
    for r in best:
        plain, dense = _lift(r["n1"], r["n0"], total1, total0), _lift(r["d1"], r["d0"], total1, total0)
        by_density = r["d1"] * dense > r["n1"] * plain
        stems[r["stem"]] = (by_density, dense if by_density else plain, plain)
    seeds = tuple(INSULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found, words = _stems(text.decode("utf-8", "replace"))
                given = any(s.startswith(seeds) for s in found)
                rows.append([] if given else [s for s, n in found.items() if s in stems and (not stems[s][0] or _dense(n, words))])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["stems"])

    holding: dict[str, set[int]] = {}
    for i, r in enumerate(rows.where("y = 1").select("text").mapInArrow(run, "stems array<string>").collect()):
        for s in r["stems"]:
            holding.setdefault(s, set()).add(i)
    while len(out) < limits.vocabulary:
        holding = {s: v for s, v in holding.items() if len(v) >= least}
        if not holding:
            break
        # of stems that explain as much, the longest: it says least about other words
        s = max(holding, key=lambda s: (len(holding[s]) * stems[s][1], len(s), s))
        now = holding.pop(s)
        out[s] = min(1.0, max(0.2, stems[s][2] / 4))
        holding = {t: v - now for t, v in holding.items()}
    return out


def _calibrate(x: np.ndarray, y: np.ndarray, totals: tuple[int, int]) -> tuple[tuple[float, ...], float]:
    """Logistic weights by Newton steps, held to the prior by a ridge; classes count as among the labels."""
    prior = np.array([*PRIOR, -3.0])
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    if not pos or not neg:
        return PRIOR, -3.0
    weight = np.where(y == 1, totals[1] / pos, totals[0] / neg) * len(y) / sum(totals)
    rows = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.array([1.0] * x.shape[1] + [0.01])
    w = prior.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -35, 35)))
        grad = rows.T @ (weight * (p - y)) + ridge * (w - prior)
        hess = (rows * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    w[:-1] = np.maximum(w[:-1], 0)                                   # no pattern makes a text less toxic
    return tuple(w[:-1].tolist()), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, *, limits: FitLimits = FitLimits(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Vocabulary and weights from a bounded sample of labelled rows, read whole.

    The sample is the ``rows_per_class`` labelled rows of each class whose text hash is
    least, copies once; a share of it calibrates the weights and stays out of the
    vocabulary. Labels other than 0 and 1, null ids and null or empty texts teach
    nothing; a class without rows leaves the given vocabulary and weights.
    """
    named = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where(
        "y in (0, 1)").distinct()
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "text is not null and text <> ''").withColumn("h", F.xxhash64("text"))
    labelled = cut_lineage(text.select("id", "h").join(named, "id"))
    totals = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    chosen = []
    for y in (0, 1):
        least = (labelled.where(F.col("y") == y).groupBy("h").agg(F.min("id").alias("id"))
                 .orderBy("h").limit(limits.rows_per_class).collect())
        cut = math.ceil((1 - limits.calibration_share) * len(least))
        chosen += [(r["id"], r["h"], y, k >= cut) for k, r in enumerate(least)]
    sample = docs.sparkSession.createDataFrame(chosen, "id long, h long, y int, held boolean")
    rows = cut_lineage(text.join(F.broadcast(sample), ["id", "h"]).dropDuplicates(["h", "y"]).repartition(
        max(8, min(64, len(chosen) // 100)), "h"))
    taught = [sum(1 for c in chosen if c[2] == y and not c[3]) for y in (0, 1)]
    insults = _vocabulary(rows.where("not held"), (taught[0], taught[1]), limits)
    found = _features(rows.where("held"), insults).collect()
    found.sort(key=lambda r: (r["y"], r["h"]))
    weights, intercept = _calibrate(np.array([r["x"] for r in found]), np.array([r["y"] for r in found], float),
                                    (totals.get(0, 0), totals.get(1, 0)))
    return ToxicityModel(insults, weights, intercept)


def _features(rows: DataFrame, insults: Mapping[str, float]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for batch in batches:
            x = [grammar.features(t.decode("utf-8", "replace")) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))],
                                             names=["y", "h", "x"])

    return rows.select("y", "h", "text").mapInArrow(run, "y int, h long, x array<double>")


# ---------------------------------------------------------------- use

def score(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text",
          name: str = "score") -> DataFrame:
    """Add ``name`` (0 to 1, higher: toxic is likelier) to every row; only the whole text decides.

    A null or empty text has no events and gets the score of that; repeated rows get equal
    scores; an empty table gives an empty result; all columns of the input stay (a
    column called ``name`` is replaced).
    """
    held = astuple(model)                                            # a vocabulary of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults, weights, intercept = held
        grammar = Grammar(insults)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                x = [grammar.features((t or b"").decode("utf-8", "replace"))
                     for t in part.column(at_text).cast(pa.binary()).to_pylist()]
                z = np.clip(np.array(x) @ np.array(weights) + intercept, -35, 35)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-z)))],
                                                 names=[*part.schema.names, name])

    rows = docs.drop(name)
    at_text = rows.columns.index(text_col)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, DoubleType())]))


def matched_clauses(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every clause with an event: ``doc_id, start, length`` (code points), ``clause`` and a weight for each kind.

    Null and empty texts have none; repeated rows each give theirs; an empty table gives
    an empty result; other columns are not read.
    """
    insults = dict(model.insults)
    schema = "doc_id long, start long, length long, clause string, " + ", ".join(f"{k} double" for k in KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = (raw or b"").decode("utf-8", "replace")
                rows = [(doc, lo, hi - lo, text[lo:hi], *(kinds.get(k, 0.0) for k in KINDS))
                        for lo, hi, kinds in grammar.clauses(lower(text))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()] + [pa.float64()] * 5)],
                        names=["doc_id", "start", "length", "clause", *KINDS])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
