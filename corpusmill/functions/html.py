"""B3b, B5, B7 as column expressions over raw HTML (no Python per row).

Leaf form of the block extractor: comments and script/style/template bodies
are cut, block start tags become U+0001 (tag name, U+0003), block end tags
U+0002, other tags vanish, then the string is split and references are decoded.
Characters U+0001-U+0004 of the page itself are escaped first and put back in
the pieces, so they never act as marks. Quoted attribute values may hold ">".
A block ends at its end tag or at the next block start, so no text repeats.
"""

from __future__ import annotations

import json
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import py_strip

# Fixed values.
BLOCK_TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
BOILERPLATE = ("Sorry, Internet Explorer is not supported",)
RAW_TEXT = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
            r"|<template\b.*?</template\s*>")
# what follows a tag's name: values quoted after "=" may hold ">"; an unclosed quote ends at ">"
_REST = r"""(?:(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>|[^>]*+>)"""
BLOCK_OPEN = rf"(?i)<(p|h[1-6])(?:>|(?=\s){_REST})"
BLOCK_CLOSE = r"(?i)</(?:p|h[1-6])\s*>"
ANY_TAG = rf"<[/!?]?[A-Za-z]{_REST}"
# links: anchors inside templates count, and the attribute is the one named href
RAW_LINKS = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
HREF = (r"""(?is)<a(?:[\s/]++(?!href[\s=])[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
        r"""[\s/]++href\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)""")
# The usual references, decoded by plain replacement; &amp; goes last so that
# text is decoded once. Texts with any other reference take the general way.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&reg;", "®"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&"),
)
OPEN_MARK, CLOSE_MARK, NAME_MARK, ESCAPE = "\u0001", "\u0002", "\u0003", "\u0004"
_CONTROL = "[\u0001-\u0004]"
_USUAL = "|".join(ref[1:] for ref, _ in ENTITIES)
_NUMBER = r"^(?:#([0-9]+)|#[xX]([0-9a-fA-F]+));?"
_NAME = r"^[^\t\n\f <&#;]{1,32};?"
# names that hold without a semicolon, too, longest first
_OPEN_NAMES = "^(?:" + "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))) + ")"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_entities(c: Column | str) -> Column:
    """Named and numeric character references, each decoded once."""
    c = _col(c)
    usual = c
    for ref, ch in ENTITIES:
        usual = F.replace(usual, F.lit(ref), F.lit(ch))
    other = c.rlike(f"&(?!{_USUAL})(?:#[0-9xX]|[A-Za-z])")
    return F.when(other, _decode_any(c)).otherwise(usual)


def _decode_any(c: Column) -> Column:
    """Each "&" starts a piece; a reference at its head becomes its characters, as the HTML standard reads it.

    Numbers of any length, a missing semicolon, the numbers that stand for other characters
    or for none, and names that hold without a semicolon as the longest that fits.
    """
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    odd = F.from_json(F.lit(json.dumps(_odd_numbers())), "map<string,string>")

    def piece(p: Column) -> Column:
        decimal, hexed = (F.regexp_replace(F.regexp_extract(p, _NUMBER, k), "^0+(?=.)", "") for k in (1, 2))
        low = (F.length(decimal) <= 7) & (F.length(hexed) <= 6)      # longer ones are no code points
        code = F.when(low, F.when(decimal != "", decimal.cast("long")).otherwise(F.conv(hexed, 16, 10).cast("long")))
        valid = (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        char = F.when(valid, F.coalesce(F.try_element_at(odd, code.cast("string")), plain)).otherwise(F.lit("\ufffd"))
        number, name = F.regexp_extract(p, _NUMBER, 0), F.regexp_extract(p, _NAME, 0)
        short = F.regexp_extract(p, _OPEN_NAMES, 0)
        known = F.try_element_at(names, name)

        def then(head: Column, text: Column) -> Column:
            return F.concat(text, F.substring(p, F.length(head) + 1, F.length(p)))

        return (F.when(number != "", then(number, char)).when(known.isNotNull(), then(name, known))
                .when(short != "", then(short, F.try_element_at(names, short))).otherwise(F.concat(F.lit("&"), p)))

    pieces = F.split(c, "&", -1)
    return F.concat(F.get(pieces, F.lit(0)), F.array_join(
        F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), piece), ""))


def _odd_numbers() -> dict[str, str]:
    """Numbers that don't stand for the code point of that number: control and non-characters."""
    codes = [*range(0xA0), *range(0xFDD0, 0xFDF0), *(plane << 16 | low for plane in range(17) for low in (0xFFFE, 0xFFFF))]
    return {str(n): out for n in codes if (out := unescape(f"&#{n};")) != chr(n)}


def _escape(c: Column) -> Column:
    out = c
    for ch, name in ((ESCAPE, "d"), (OPEN_MARK, "a"), (CLOSE_MARK, "b"), (NAME_MARK, "c")):
        out = F.replace(out, F.lit(ch), F.lit(ESCAPE + name))
    return F.when(c.rlike(_CONTROL), out).otherwise(c)


def _unescape(c: Column) -> Column:
    out = c
    for ch, name in ((OPEN_MARK, "a"), (CLOSE_MARK, "b"), (NAME_MARK, "c"), (ESCAPE, "d")):
        out = F.replace(out, F.lit(ESCAPE + name), F.lit(ch))
    return F.when(c.contains(ESCAPE), out).otherwise(c)


def marked_text(html: Column | str) -> Column:
    """HTML reduced to text with block marks; references are still to be decoded."""
    h = F.regexp_replace(_escape(_col(html)), RAW_TEXT, "")
    h = F.regexp_replace(h, BLOCK_OPEN, f"{OPEN_MARK}$1{NAME_MARK}")
    h = F.regexp_replace(h, BLOCK_CLOSE, CLOSE_MARK)
    return F.regexp_replace(h, ANY_TAG, "")


def leaf_blocks(marked: Column) -> Column:
    """array<struct<tag, raw>>: one entry per block start, in document order.

    Pass a column reference to ``marked_text``'s result (not the expression).
    """
    pieces = F.split(marked, OPEN_MARK, -1)
    body = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1)))
    return F.transform(body, lambda p: F.struct(
        F.lower(F.substring_index(p, NAME_MARK, 1)).alias("tag"),
        decode_entities(_unescape(F.substring_index(
            F.substring(p, F.instr(p, NAME_MARK) + 1, F.length(p)), CLOSE_MARK, 1))).alias("raw")))


def keep_block(raw: Column, phrases: tuple[str, ...] = BOILERPLATE) -> Column:
    """False when the (unstripped) block text contains a boilerplate phrase."""
    cond = F.lit(True)
    for p in phrases:
        cond = cond & ~raw.contains(p)
    return cond


def page_text_from_blocks(blocks: Column, phrases: tuple[str, ...] = BOILERPLATE) -> Column:
    """B5 row-wise: kept blocks stripped, joined by newline, newlines -> spaces."""
    kept = F.filter(blocks, lambda b: keep_block(b["raw"], phrases))
    return F.replace(F.array_join(F.transform(kept, lambda b: py_strip(b["raw"])), "\n"),
                     F.lit("\n"), F.lit(" "))


def _unquote(v: Column) -> Column:
    quoted = v.startswith('"') | v.startswith("'")
    return F.when(quoted, F.substring(v, 2, F.length(v) - 2)).otherwise(v)


def hrefs(html: Column | str) -> Column:
    """Href values of anchors outside comments/scripts, entities decoded.

    Double-quoted, single-quoted and bare values; empty values dropped. One
    regex pass captures the value with its quotes, which are then removed.
    """
    cleaned = F.regexp_replace(_col(html), RAW_LINKS, "")
    raw = F.regexp_extract_all(cleaned, F.lit(HREF), 1)
    return F.filter(F.transform(raw, lambda v: decode_entities(_unquote(v))), lambda v: v != "")
