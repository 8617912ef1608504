"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as word sequences, edits are counted in words. A line goes if an
earlier line (by document id, then line number) has the same words, or, where both
have at least ``min_words`` words, is one word edit away (a word changed, added or
removed). From 5 words on, lines one edit apart are alike to 0.8 or more.

1. Exact: lines are hashed (128 bits), each distinct one keeps its first place.
2. Who can have a partner: lines one edit apart share their first or their last half,
   counted for the longer line's length. Half keys are counted with partial sums;
   lines whose halves nobody shares drop out, whole and without loss.
3. Neighbourhood: with N the longer length, a line of N words emits one key per
   deleted word, a line of N - 1 words one key per gap, for the half that may differ.
   A key hashes (N, position, words before, words behind) from running hashes, so it
   costs the same at any length. Equal keys of different lines are one edit apart,
   so a class needs only its earliest member, never its pairs.
4. The earliest partner of each line is verified word by word. Keys have 64 bits, so a
   line could stay beside its partner if an unrelated earlier line had its key: one
   chance in 10^7 a key at 10^12 keys, and never a line removed in error.

Texts cross one exchange, by document; lines travel as hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\x09-\x0D\x20]{2,}|[\x09-\x0D]"
_WORD = r"[^\x09-\x0D\x20]"
_LAST_ID = (1 << 63) - 1


def _words_of(line: Column) -> Column:
    """The line's words joined by single spaces; the pattern runs only where there is something to change."""
    odd = F.contains(line, F.lit("  "))
    for c in "\t\x0b\f\r":
        odd = odd | F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, _SPACE, " ")).otherwise(line))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _running(hashes: Column, seed: int) -> Column:
    """Order-dependent hashes of the first 0, 1, 2, ... elements."""
    return F.aggregate(hashes, F.array(F.lit(seed).cast("long")),
                       lambda acc, x: F.array_append(acc, F.xxhash64(F.element_at(acc, -1), x)))


def _first_places(rows: DataFrame, min_words: int) -> DataFrame:
    """One struct ``f`` for each distinct line with words: first place ``n, l``, ``raw`` (32-bit hash of the line as it
    stands there: tells rows that repeat an id apart), ``nw`` and the hashes of its halves. The place leads the struct, so its minimum is the first."""
    line = rows.select("n", F.posexplode(_lines(F.col("text"))).alias("l", "line"))
    line = line.select("n", "l", F.hash("line").alias("raw"), _words_of(F.col("line")).alias("w")).where("w <> ''")
    line = line.withColumn("nw", F.octet_length("w") - F.octet_length(F.replace("w", F.lit(" "), F.lit(""))) + 1)
    half, more = F.floor(F.col("nw") / 2).cast("int"), F.floor((F.col("nw") + 1) / 2).cast("int")
    odd, enough = F.col("nw") % 2 == 1, F.col("nw") >= min_words

    def key(side: str, count: Column) -> Column:
        own = F.call_function("substring_index", F.col("w"), F.lit(" "), count if side == "p" else -count)
        return F.xxhash64(F.lit(side), count, own)

    keyed = line.select(
        F.xxhash64("w").alias("k1"), F.xxhash64(F.lit(7), F.col("w")).alias("k2"),
        F.struct("n", "l", "raw", "nw", F.when(enough, key("p", half)).alias("p0"), F.when(enough & odd, key("p", more)).alias("p1"),
                 F.when(enough, key("s", half)).alias("s0"), F.when(enough & odd, key("s", more)).alias("s1")).alias("f"))
    return keyed.groupBy("k1", "k2").agg(F.min("f").alias("f")).select("f")


def _candidates(firsts: DataFrame) -> DataFrame:
    """Lines that share a half with another line: place, ``raw`` and the forms to expand.

    A form is a side and the longer lengths N whose half it is: an even line has the
    same half for N = its length and one more, an odd line one half for each.
    """
    nw = F.col("f.nw")
    more = F.when(nw % 2 == 1, nw).otherwise(nw + 1)

    def form(key: str, side: str, low: Column, high: Column) -> Column:
        return F.struct(F.col(f"f.{key}").alias("half"), F.lit(side).alias("side"), low.alias("low"), high.alias("high"))

    forms = F.array(form("p0", "p", nw, more), form("s0", "s", nw, more), form("p1", "p", nw + 1, nw + 1),
                    form("s1", "s", nw + 1, nw + 1))
    halves = firsts.where("f.p0 is not null").select("f.n", "f.l", "f.raw", F.explode(forms).alias("form")).where(
        "form.half is not null").select("n", "l", "raw", "form.*")
    shared = halves.groupBy("half").count().where("count > 1").select("half")
    return halves.join(shared, "half").groupBy("n", "l", "raw").agg(
        F.collect_list(F.struct("side", "low", "high")).alias("forms"))       # at most four


def _keys(words: DataFrame) -> DataFrame:
    """Deletion and gap keys of each line, with its place."""
    hashes = F.transform(F.split("w", " "), lambda x: F.xxhash64(x))
    run = words.select("at", "forms", _running(hashes, 1).alias("before"), _running(F.reverse(hashes), 2).alias("behind"))
    form = run.select("*", F.explode("forms").alias("f")).select(
        "*", F.explode(F.sequence("f.low", "f.high")).alias("longer"))
    longer, half = F.col("longer"), F.floor(F.col("longer") / 2).cast("int")
    first = F.when(F.col("f.side") == "p", half).otherwise(F.lit(0))        # the half that may differ
    last = F.when(F.col("f.side") == "p", longer - 1).otherwise(longer - half - 1)
    every = F.transform(F.sequence(first, last), lambda i: F.xxhash64(
        longer, i, F.get("before", i), F.get("behind", longer - 1 - i)))
    return form.select("at", F.explode(every).alias("key"))


def _near_duplicates(cells: DataFrame) -> DataFrame:
    """Places of lines that have an earlier line one edit away, verified word by word."""
    own = F.get("cell", F.lit(0))
    keys = _keys(cells.select("at", own.getField("forms").alias("forms"), own.getField("w").alias("w")))
    least = keys.groupBy("key").agg(F.min("at").alias("partner"), F.count("*").alias("_n")).where(
        "_n > 1").select("key", "partner")
    pairs = keys.join(least, "key").where("at > partner").select("at", "partner").distinct()
    text = cells.select("at", own.getField("w").alias("own"))
    other = cells.select(F.col("at").alias("partner"), own.getField("w").alias("theirs"))
    both = pairs.join(text, "at").join(other, "partner").select(
        "at", F.split("own", " ").alias("a"), F.split("theirs", " ").alias("b"))
    # the first difference; a shorter line differs where it ends
    spot = both.select("*", F.array_position(F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int").alias("i"),
                       F.size("a").alias("na"), F.size("b").alias("nb"))
    rest_a = F.slice("a", F.col("i") + (F.col("na") >= F.col("nb")).cast("int"), F.col("na"))
    rest_b = F.slice("b", F.col("i") + (F.col("nb") >= F.col("na")).cast("int"), F.col("nb"))
    return spot.where("i > 0 and abs(na - nb) <= 1").where(rest_a == rest_b).select("at").distinct()


def dedup_lines(docs: DataFrame, *, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text",
                counts: bool = True) -> DataFrame:
    """Every input row with ``text_col`` reduced to its kept lines; all other columns stay.

    ``counts`` adds ``n_lines`` and ``n_removed`` (columns of these names are replaced).
    Lines end at U+000A; kept lines are unchanged and joined by U+000A, so a text that
    loses nothing is unchanged. Defined cases: lines without words are kept; null texts
    stay null and have no lines; rows that repeat an id are one document, each keeping a
    line where it is first at that line number; null ids come last, as one document; an
    empty table gives an empty result.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID))
    rows = docs.select(n.alias("n"), F.col(text_col).cast("string").alias("text"))
    firsts = _first_places(rows, min_words)
    # whole rows in one cell: both joins by document read the same exchange
    held = docs.select(n.alias("n"), F.array(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("cell")).repartition(parts, "n")
    text = F.get("cell", F.lit(0)).getField(text_col).cast("string")

    wanted = _candidates(firsts).groupBy("n").agg(F.collect_list(F.struct("l", "raw", "forms")).alias("wanted"))
    line = F.get("lines", F.col("c.l"))
    cells = held.join(wanted, "n").select("n", _lines(text).alias("lines"), F.explode("wanted").alias("c")).where(
        F.hash(line) == F.col("c.raw")).select(
        F.struct("n", "c.l", "c.raw").alias("at"),
        F.array(F.struct("c.forms", _words_of(line).alias("w"))).alias("cell")).repartition(parts, "at")
    near = _near_duplicates(cells)
    kept = firsts.select(F.struct("f.n", "f.l", "f.raw").alias("at")).join(near, "at", "left_anti")
    places = kept.groupBy("at.n").agg(F.collect_list(F.struct("at.l", "at.raw")).alias("kept"))
    joined = held.join(places, "n", "left").select(
        F.get("cell", F.lit(0)).alias("cell"), _lines(text).alias("lines"),
        F.coalesce("kept", F.array().cast("array<struct<l:int,raw:int>>")).alias("kept"))
    own = F.filter("kept", lambda x: F.hash(F.get("lines", x["l"])) == x["raw"])   # rows that repeat an id
    blank = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~F.rlike(F.get("lines", i), F.lit(_WORD)))
    places = F.array_sort(F.concat(F.transform(own, lambda x: x["l"]), blank))
    out = joined.select("cell", "lines", F.transform(places, lambda i: F.get("lines", i)).alias("left"))
    new = F.when(F.col("lines").isNotNull(), F.concat_ws("\n", "left")).alias(text_col)
    cols = [new if c == text_col else F.col("cell").getField(c).alias(c) for c in docs.columns
            if not counts or c not in ("n_lines", "n_removed")]
    if counts:
        some = F.col("lines").isNotNull()
        cols += [F.when(some, F.size("lines")).otherwise(0).cast("long").alias("n_lines"),
                 F.when(some, F.size("lines") - F.size("left")).otherwise(0).cast("long").alias("n_removed")]
    return out.select(*cols)
