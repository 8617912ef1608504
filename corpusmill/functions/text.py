"""Row-wise text column functions (all JVM-side, no Python per row)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters for which Python's str.isspace() is true: exactly the set that
# str.strip() removes. Built by rule so that strip semantics match.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# Fixed values that results depend on.
SENTENCE_BREAK = r"(?<=[.!?]) +"          # cut after . ! ? at runs of U+0020
DECIMAL_SENTENCE = r"(?U)^\d+\.\d+\n?\z"  # Python re.match(r"^\d+\.\d+$")
QUOTE_FROM = "’“”"          # right single, left double, right double
QUOTE_TO = "'\"\""
FIRST_SENTENCE = r"(?s)^(.*?[.!?]) "    # first element of the D2 split, when it cuts
FILE_KEY_SCHEME = r"https?://"
FILE_KEY_UNSAFE = r'[/:*?"<>|]'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: trim every Unicode whitespace character at both ends."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def split_sentences(c: Column | str) -> Column:
    """Split after ``.``/``!``/``?`` at runs of spaces; terminators stay."""
    return F.split(_col(c), SENTENCE_BREAK, -1)


def first_sentence(c: Column | str) -> Column:
    """First element of ``split_sentences`` without splitting the whole text."""
    c = _col(c)
    m = F.regexp_extract(c, FIRST_SENTENCE, 1)
    return F.when(m == "", c).otherwise(m)


def is_decimal(c: Column | str) -> Column:
    """A sentence that is only a decimal number such as ``3.14``."""
    return _col(c).rlike(DECIMAL_SENTENCE)


def preview(c: Column | str, width: int) -> Column:
    """Cut to ``width`` characters with a trailing ``...`` when longer."""
    if width < 3:
        raise ValueError("width must be at least 3")
    c = _col(c)
    return F.when(F.length(c) > width,
                  F.concat(F.substring(c, 1, width - 3), F.lit("..."))).otherwise(c)


def normalize_quotes(c: Column | str) -> Column:
    """Map U+2019 to ', U+201C and U+201D to "; U+2018 stays."""
    return F.translate(_col(c), QUOTE_FROM, QUOTE_TO)


def file_key(c: Column | str, max_len: int = 50) -> Column:
    """Drop every http(s):// and replace / : * ? " < > | by _, cut to max_len."""
    cleaned = F.regexp_replace(F.regexp_replace(_col(c), FILE_KEY_SCHEME, ""),
                               FILE_KEY_UNSAFE, "_")
    return F.left(cleaned, F.lit(max_len))
