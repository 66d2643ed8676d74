"""Line dedup: lines within one edit of an earlier line, found by a join of their deletion neighbourhoods.

A line's neighbourhood is the line itself and every variant with one character deleted. Two lines are within one
edit exactly when one is a variant of the other, or both have an equal variant with the character deleted at the
same place. The variants are emitted in two steps, so that a corpus of mostly unlike lines does not pay a key per
character: first with a whole segment deleted (a few keys per line), then, only where another line has the same
key, with each character of that segment deleted. One edit lies within one segment, so nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quakespark.llm.common import row_key, unused
from quakespark.session import checkpointed

#: Lines shorter than this many characters are compared for equality only.
MIN_CHARS = 16
#: Segments of a line, of which one is left out of a key.
SEGMENTS = 4
#: Lengths in a class share their segment borders; at most MIN_CHARS, and a multiple of SEGMENTS.
_CLASS = 8

#: Lines that hold at least one in so many of the repeated copies are joined by broadcast.
_COMMON = 2000

_POS = ("no_id", "doc_id", "key", "line_no")


def _pos() -> Column:
    """The order of lines: by doc_id (null ids last), then by the row's hash, then by place."""
    return F.struct(*_POS)


def lines_of(docs: DataFrame) -> DataFrame:
    """(no_id, doc_id, key, line_no, line): the lines of every whole text, without white space at their ends.

    Null texts have no lines. Blank lines are left out: they are layout and never count as repeats.
    """
    split = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        "doc_id",
        row_key("doc_id", "text").alias("key"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    return split.withColumn("line", F.trim("line", F.lit(" \t\r"))).filter(F.col("line") != "")


def _identity() -> list[Column]:
    """96 bits that stand for a line."""
    return [F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")]


def _borders(index: Column, length: Column) -> tuple[Column, Column]:
    """Characters before and after the segment that key ``index`` leaves out."""
    base = F.floor(length / _CLASS) * _CLASS + F.floor(index / SEGMENTS) * _CLASS
    part, q = F.floor(base / SEGMENTS), index % SEGMENTS
    return (part * q).cast("int"), (base - part * (q + 1)).cast("int")


def _segment_keys() -> Column:
    """Hashes of the line without one segment, for the class of its length and, at the upper end, for the next.

    A line one longer than this one is then in the same class, and the two agree outside the edited segment.
    """
    length = F.length("line")

    def key(i: int) -> Column:
        before, after = _borders(F.lit(i), length)
        rest = F.xxhash64(
            before, after, F.substring(F.col("line"), F.lit(1), before),
            F.substring(F.col("line"), length - after + 1, after),
        )
        return rest

    own = F.array(*(key(i) for i in range(SEGMENTS)))
    both = F.array(*(key(i) for i in range(2 * SEGMENTS)))
    none = F.array().cast("array<bigint>")
    return F.when(length < MIN_CHARS - 1, none).when(length % _CLASS == _CLASS - 1, both).otherwise(own)


def line_table(docs: DataFrame) -> DataFrame:
    """A row per line that is not blank: its position, identity and segment keys; texts stay behind."""
    return checkpointed(
        lines_of(docs).select(*_POS, *_identity(), _segment_keys().alias("keys"))
    )


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(h1, h2, n, head): each different line with its count, and the position and keys of its earliest copy."""
    head = F.min(F.struct(*_POS, "keys")).alias("head")
    return checkpointed(lines.groupBy("h1", "h2").agg(head, F.count(F.lit(1)).alias("n")))


def _candidates(distinct: DataFrame) -> DataFrame:
    """(h1, h2, head position, index, segment): keys of a line that another line has too."""
    keyed = distinct.select("h1", "h2", *(f"head.{c}" for c in _POS), F.posexplode("head.keys").alias("index", "segment"))
    shared = keyed.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("segment")
    return keyed.join(shared, "segment", "left_semi")


#: Bits of the filter that keeps unlike lines out of the shuffle that fetches texts: 8 MB, whatever the input.
_FILTER_BITS = 1 << 26


def _word_and_bit(column: str) -> tuple[Column, Column]:
    at = F.col(column).bitwiseAND(F.lit(_FILTER_BITS - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftright(at, 6).alias("word"), one


def _with_text(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` lines (h1, h2 and the position of one copy), each once, with their text.

    The broadcast side is a bit field of fixed size. A hit may be false; the join behind it is exact.
    """
    word, bit = _word_and_bit("h1")
    field = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    lines = lines_of(docs).select("key", "line_no", *_identity(), "line")
    word, bit = _word_and_bit("h1")
    near = (
        lines.withColumn("word", word)
        .join(F.broadcast(field), "word")
        .filter(F.col("bits").bitwiseAND(bit) != 0)
        .drop("word", "bits")
    )
    return wanted.join(near, ["h1", "h2", "key", "line_no"]).dropDuplicates(["h1", "h2"])


def near_links(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, h2, of_h1, of_h2): each line that is one edit from an earlier line, with the earliest such line.

    The longer of the two has ``MIN_CHARS`` characters; shorter pairs are left out before the earliest is taken.

    A group of equal variants is bounded by the alphabet (the lines in it differ in one character) or by the
    length times the alphabet, whatever the number of rows; no pairs are formed in it.
    """
    candidates = checkpointed(_candidates(distinct))
    wanted = candidates.select("h1", "h2", *_POS).dropDuplicates(["h1", "h2"])
    texts = checkpointed(_with_text(wanted, docs).select("h1", "h2", "line"))
    before, after = _borders(F.col("index"), F.length("line"))
    at = F.col("at")
    variants = (
        candidates.join(texts, ["h1", "h2"])
        .withColumn("middle", F.substring(F.col("line"), before + 1, F.length("line") - before - after))
        .withColumn("at", F.explode(F.sequence(F.lit(-1), F.length("middle") - 1)))
        .withColumn("short", F.when(at < 0, F.col("middle")).otherwise(
            F.concat(F.substring(F.col("middle"), F.lit(1), at), F.substring(F.col("middle"), at + 2, F.length("middle")))
        ))
        .select(
            F.xxhash64("segment", "short").alias("variant"), "at", F.struct(*_POS, "h1", "h2").alias("me"),
            (F.length("line") >= MIN_CHARS).alias("long"),
        )
    )
    here, same = W.partitionBy("variant"), W.partitionBy("variant", "at")
    grouped = (
        variants.withColumn("whole", F.min(F.when(at < 0, F.col("me"))).over(here))
        .withColumn("any", F.min(F.when(at >= 0, F.col("me"))).over(here))
        .withColumn("twin", F.min("me").over(same))
    )
    # deleted here: the undeleted line, or one with the same place deleted; not deleted: any that gives this one.
    # the latter is longer than this line; the others are not, and no partners of a line below MIN_CHARS
    partner = F.when(at < 0, F.col("any")).when(F.col("long"), F.least("whole", "twin"))
    found = (
        grouped.withColumn("of", partner)
        .filter(F.col("of") < F.col("me"))
        .groupBy("me.h1", "me.h2")
        .agg(F.min("of").alias("of"))
        .select("h1", "h2", F.col("of.h1").alias("of_h1"), F.col("of.h2").alias("of_h2"))
    )
    mine = texts.withColumnRenamed("line", "mine")
    other = texts.select(F.col("h1").alias("of_h1"), F.col("h2").alias("of_h2"), F.col("line").alias("other"))
    edits = F.levenshtein("mine", "other", 1)
    return (
        found.join(mine, ["h1", "h2"]).join(other, ["of_h1", "of_h2"])
        .filter(edits == 1)
        .select("h1", "h2", "of_h1", "of_h2")
    )


def _matched(lines: DataFrame, gone: DataFrame) -> DataFrame:
    """``lines`` joined with ``gone`` on the line's identity, common lines without a shuffle.

    At most ``_COMMON`` lines can each hold one in ``_COMMON`` of all copies, so these are safe to broadcast; what is
    left has no key of weight.
    """
    total = gone.agg(F.sum("n").alias("total"))
    often = F.col("n") * _COMMON >= F.col("total")
    marked = checkpointed(gone.crossJoin(total).withColumn("often", often).drop("n", "total"))  # one row is joined
    common, rest = (marked.filter(x).drop("often") for x in (F.col("often"), ~F.col("often")))
    keys = ["h1", "h2"]
    near = lines.join(F.broadcast(common), keys)
    return near.unionByName(lines.join(F.broadcast(common.select(keys)), keys, "left_anti").join(rest, keys))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, key, line_no, kind): the lines of ``docs`` (doc_id, text) that go; ``kind`` is exact or near.

    A line goes if the same line stands earlier (exact), or else if an earlier line is one edit away, the longer of
    the two having ``MIN_CHARS`` characters (near). Earlier lines count even where they go themselves. Rows that
    repeat both doc_id and text are one document here. Null texts and empty tables have no lines.
    """
    lines = line_table(docs)
    distinct = distinct_lines(lines)
    near = near_links(distinct, docs).select("h1", "h2", F.lit(True).alias("near"))
    gone = distinct.select("h1", "h2", "n", *(F.col(f"head.{c}").alias(f"first_{c}") for c in ("key", "line_no"))).join(
        near, ["h1", "h2"], "left"
    ).filter((F.col("n") > 1) | F.col("near"))
    first = (F.col("key") == F.col("first_key")) & (F.col("line_no") == F.col("first_line_no"))
    return (
        _matched(lines.select("doc_id", "key", "line_no", "h1", "h2"), checkpointed(gone))
        .filter(~first | F.col("near"))
        .select("doc_id", "key", "line_no", F.when(first, F.lit("near")).otherwise(F.lit("exact")).alias("kind"))
    )


def summary(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_exact, n_near, removed), a row for each row of ``docs``.

    ``n_lines`` counts lines that are not blank; ``removed`` names the lines that go by their number from 0, comma-joined.
    """
    gone = _by_document(repeated_lines(docs))
    counted = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(" \t\r")) != ""))
    all_docs = docs.select("doc_id", row_key("doc_id", "text").alias("key"), F.when(F.col("text").isNull(), 0).otherwise(counted).alias("n_lines"))
    zero = F.lit(0).cast("bigint")
    return all_docs.join(gone, "key", "left").select(
        "doc_id", F.col("n_lines").cast("bigint"), F.coalesce("n_exact", zero).alias("n_exact"),
        F.coalesce("n_near", zero).alias("n_near"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"),
    )


def _by_document(gone: DataFrame) -> DataFrame:
    """Lines that go, gathered for each document: no more than its own text has."""
    listed = gone.groupBy("key").agg(F.collect_set(F.struct("line_no", "kind")).alias("all"))
    count = lambda kind: F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("bigint")
    return listed.select(
        "key", F.array_sort(F.col("all.line_no")).alias("removed"), count("exact").alias("n_exact"), count("near").alias("n_near")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, every row and column, with the repeated lines taken out of ``text``; ``n_chars`` follows if present.

    A text whose lines all go becomes empty; null texts stay null.
    """
    key, removed = unused(docs, "_key"), unused(docs, "_removed")
    gone = _by_document(repeated_lines(docs)).select(F.col("key").alias(key), F.col("removed").alias(removed))
    lines = F.split("text", "\n")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    # the outer lambda binds the split text once; inlined below it would be split anew for each line
    kept = F.transform(F.array(lines), lambda all: F.array_join(F.transform(numbers, lambda i: F.get(all, i)), "\n"))[0]
    rows = docs.withColumn(key, row_key("doc_id", "text")).join(gone, key, "left")
    rows = rows.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col(removed).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return rows.select(*docs.columns)
