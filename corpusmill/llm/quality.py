"""Compression classifier: zstandard dictionaries of good and of bad labelled text.

A text is cut into blocks and each block is compressed twice, once with a dictionary
of good text and once with one of bad text. The size difference, normalised by the
text's bytes, is calibrated to a probability by a logistic fit on labelled rows that
went into neither dictionary. Every text is scored whole, those of the calibration
too; only fitting reads a bounded sample of rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusmill.session import cut_lineage


@dataclass(frozen=True)
class FitLimits:
    """Bounds of the training sample, the only place where the classifier reads less than everything."""

    rows_per_class: int = 3000       # labelled rows per class: the least by hash of the text
    sample_bytes: int = 16384        # of each such row, spread over all of it, may enter the dictionaries
    dictionary_bytes: int = 800_000  # per class
    piece_bytes: int = 400           # stretch of text put into a dictionary
    calibration_share: float = 0.25  # of the sample, kept out of the dictionaries


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    block: int = 1024
    smooth: int = 20
    level: int = 3


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary or b"\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def _difference(texts: list[bytes], model: QualityModel, good=None, bad=None) -> np.ndarray:
    """(bytes with the bad dictionary - bytes with the good one) per byte of text; 0 for empty texts."""
    good = good or _compressor(model.good, model.level)
    bad = bad or _compressor(model.bad, model.level)
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        gap = 0
        for at in range(0, len(text), model.block):
            part = text[at:at + model.block]
            gap += len(bad.compress(part)) - len(good.compress(part))
        out[i] = gap / (len(text) + model.smooth)
    return out


def _dictionary(rows: list[bytes], size: int, piece: int) -> bytes:
    """Stretches of about ``piece`` bytes at hashed offsets over each whole row, ``size`` bytes in all.

    Every row has an equal share; what short rows leave goes to longer ones. With many rows
    the stretches get shorter, no row is left out.
    """
    out, left = [[] for _ in rows], size
    for rank, i in enumerate(sorted(range(len(rows)), key=lambda i: len(rows[i]))):
        text = rows[i]
        take = min(len(text), left // (len(rows) - rank))
        left -= take
        n = max(1, round(take / piece)) if take < len(text) else 1
        for j in range(n):
            lo, hi, width = j * len(text) // n, (j + 1) * len(text) // n, take // n
            at = lo + xxhash.xxh64_intdigest(text, j) % (hi - lo - width + 1)
            out[i].append(text[at:at + width])
    return b"\n".join(x for parts in out for x in parts if x)


def _logistic(x: np.ndarray, y: np.ndarray, totals: tuple[int, int]) -> tuple[float, float]:
    """Platt scaling by Newton steps with smoothed targets; the slope never falls below 0.

    ``totals`` are the labelled rows of class 0 and 1: rows weigh so that each class
    counts as it does among the labels, not as in the sample.
    """
    prior = math.log((totals[1] + 1) / (totals[0] + 1))
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    if pos == 0 or neg == 0:
        return 0.0, prior
    weight = np.where(y == 1, totals[1] / pos, totals[0] / neg) * len(y) / sum(totals)
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = float(x.std()) or 1.0
    z = (x - x.mean()) / scale
    a, b = 0.0, prior
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        miss = weight * (p - target)
        grad = np.array([(miss * z).sum() + 1e-3 * a, miss.sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    if a <= 0:
        return 0.0, prior
    return a / scale, b - a * float(x.mean()) / scale


def fit(docs: DataFrame, labels: DataFrame, *, limits: FitLimits = FitLimits(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Dictionaries and calibration from a bounded sample of labelled rows.

    The sample is the ``rows_per_class`` labelled rows of each class whose text hash is
    least, so reruns agree and it doesn't follow the order of the table. Rows whose id
    has several labels count once for each. No labels at all give score 0.5.
    """
    named = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where(
        "y in (0, 1)").distinct()
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "text is not null and text <> ''").withColumn("h", F.xxhash64("text"))
    # who is in the sample is settled on ids and hashes; only the texts of the sample are read for it
    labelled = cut_lineage(text.select("id", "h").join(named, "id"))
    totals = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    chosen = []
    for y in (0, 1):
        least = labelled.where(F.col("y") == y).orderBy("h", "id").limit(limits.rows_per_class).collect()
        once = list({r["h"]: r["id"] for r in reversed(least)}.items())[::-1]    # copies of a text count once per class
        cut = math.ceil((1 - limits.calibration_share) * len(once))
        chosen += [(i, h, y, k >= cut) for k, (h, i) in enumerate(once)]
    sample = docs.sparkSession.createDataFrame(chosen, "id long, h long, y int, held boolean")
    rows = cut_lineage(text.join(F.broadcast(sample), ["id", "h"]))
    pieces = rows.where("not held").select("y", "h", _stretches(limits).alias("t")).collect()
    texts = {y: list({r["h"]: [bytes(x) for x in r["t"]] for r in sorted(pieces, key=lambda r: r["h"])
                      if r["y"] == y}.values()) for y in (0, 1)}
    model = _dictionaries(texts, limits)
    found = sorted({(r["y"], r["h"], r["x"]) for r in _differences(rows.where("held"), model).collect()})
    slope, intercept = _logistic(np.array([x for _, _, x in found]), np.array([y for y, _, _ in found], float),
                                 (totals.get(0, 0), totals.get(1, 0)))
    return replace(model, slope=slope, intercept=intercept)


def _stretches(limits: FitLimits):
    """A text as one stretch, or about ``sample_bytes`` of a longer one: stretches at hashed offsets over all of it."""
    count, width = max(1, limits.sample_bytes // limits.piece_bytes), limits.piece_bytes
    return F.expr(f"""if(octet_length(text) <= {max(limits.sample_bytes, count * width)}, array(cast(text as binary)),
        transform(sequence(0, {count - 1}), i -> substring(cast(text as binary), cast(1 + i * octet_length(text) div {count}
            + pmod(xxhash64(h, i), octet_length(text) div {count} - {width} + 1) as int), {width})))""")


def _dictionaries(texts: dict[int, list[list[bytes]]], limits: FitLimits) -> QualityModel:
    """The model without its calibration, from the stretches of each training row of class 0 and 1."""
    lines = {y: [[x for part in t for x in part.split(b"\n")] for t in texts[y]] for y in (0, 1)}
    # lines that several sample rows hold would tell rows apart, not quality
    seen = Counter(x for y in (0, 1) for t in lines[y] for x in set(t))
    own = {y: [b"\n".join(x for x in t if seen[x] == 1) for t in lines[y]] for y in (0, 1)}
    size = min([limits.dictionary_bytes, *(sum(map(len, own[y])) for y in (0, 1))])   # both alike: the larger one would win
    good, bad = (_dictionary(own[y], size, limits.piece_bytes) for y in (1, 0))
    return QualityModel(good, bad, 0.0, 0.0)


def _differences(rows: DataFrame, model: QualityModel) -> DataFrame:
    """``y, h`` and the difference ``x`` of each whole text of the calibration rows."""
    held = rows.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = QualityModel(*held.value)
        good, bad = _compressor(m.good, m.level), _compressor(m.bad, m.level)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_difference(texts, m, good, bad))],
                                             names=["y", "h", "x"])

    return rows.select("y", "h", "text").mapInArrow(run, "y int, h long, x double")


def score(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text",
          name: str = "score") -> DataFrame:
    """Add ``name`` (0 to 1, higher: good is likelier) to every row; only the text decides.

    A null or empty text has difference 0 and gets the score of that; repeated rows get
    equal scores; an empty table gives an empty result; all columns of the input stay
    (a column called ``name`` is replaced).
    """
    held = docs.sparkSession.sparkContext.broadcast(astuple(model))  # two dictionaries of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = QualityModel(*held.value)
        good, bad = _compressor(m.good, m.level), _compressor(m.bad, m.level)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or b"" for t in part.column(at_text).cast(pa.binary()).to_pylist()]
                z = np.clip(m.slope * _difference(texts, m, good, bad) + m.intercept, -35, 35)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-z)))],
                                                 names=[*part.schema.names, name])

    rows = docs.drop(name)
    at_text = rows.columns.index(text_col)
    schema = StructType([*rows.schema.fields, StructField(name, DoubleType())])
    return rows.mapInArrow(run, schema)
