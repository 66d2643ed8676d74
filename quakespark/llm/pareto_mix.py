"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.llm.common import row_key, unused
from quakespark.operators.order import number_rows
from quakespark.session import checkpointed

#: Weights of the sources by code point, repeated; null last.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix over the words of all sources.
SHARE = 1.5
#: Copies of a document at most; a source's target stops at so many times its size.
COPIES = 2
SEED = "mix"
#: Buckets of a source's draw order, and of its last bucket taken.
BUCKETS = 1024


def size_of(text: str) -> Column:
    """Words of a text: runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _uniform() -> Column:
    """A number between 0 and 1, the same at every run: 52 bits of the MD5 of seed, id and text."""
    row = F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return (F.conv(F.substring(F.md5(row), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """(source, source_size, target): words of each source and words wanted of it.

    Sources share ``share`` times all words by weight; a target stops at ``copies`` times its source's size and what
    it leaves is shared anew by weight until no target is above.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = number_rows(sizes, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int"))
    table = checkpointed(numbered.select("source", "source_size", weight.alias("w"), (F.col("source_size") * copies).alias("most")))
    level, n_full = 0.0, -1
    while True:
        # a level shares out the rest over sources that are not full; it only rises
        full = F.col("w") * level > F.col("most")
        row = table.agg(
            F.sum("source_size").alias("all"), F.count_if(full).alias("n_full"), F.sum(F.when(full, F.col("most"))).alias("given"),
            F.sum(F.when(~full, F.col("w"))).alias("left"),
        ).first()
        if row["n_full"] == n_full or not row["left"]:
            break
        n_full = row["n_full"]
        level = (share * row["all"] - (row["given"] or 0)) / row["left"]
    if row["all"] is not None and not row["left"]:
        level = float("inf")
    return table.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("w") * level).alias("target"))


def _settle(rows: DataFrame, bucket: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose bucket is decided (``extra`` 0 or 1), and those of the one bucket of a source that its rest ends in.

    Only sums per bucket meet in a window: ``BUCKETS`` rows for a source, however many documents it has.
    """
    rows = rows.withColumn("_b", bucket)
    sums = rows.groupBy("source", "_b").agg(F.sum("size").alias("_sum"), F.first("rest").alias("_rest"))
    upto = F.sum("_sum").over(W.partitionBy("source").orderBy("_b").rowsBetween(W.unboundedPreceding, 0))
    state = sums.withColumn("_end", upto).select(
        F.col("source").alias("_source"), F.col("_b").alias("_bucket"), (F.col("_end") - F.col("_sum")).alias("_before"), "_end",
    )
    met = rows.join(state, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_b") == F.col("_bucket")))
    met = met.drop("_source", "_bucket", "_b")
    met = checkpointed(met)
    open_ = (F.col("_before") <= F.col("rest")) & (F.col("rest") < F.col("_end"))
    sure = met.filter(~open_).withColumn("extra", (F.col("_end") <= F.col("rest")).cast("int")).drop("_before", "_end")
    left = met.filter(open_).withColumn("rest", F.col("rest") - F.col("_before")).drop("_before", "_end")
    return sure, left


def drawn(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """(doc_id, key, size, source_size, target, taken, n_copies), a row for each row of ``docs`` (doc_id, text, source).

    A source that wants r times its words takes floor(r) whole copies of each document. The rest of its target is
    drawn without repeats at inclusion odds p / (1 - p), p = r - floor(r): documents are ranked by their random odds
    over these inclusion odds, and taken in that order while their middle lies within the rest, so a source ends at
    its target to within half a document. Null texts have size 0 and take nothing; rows that repeat are drawn each by
    itself; a null source is a source. No rows give no rows. All documents of a source have the same p, so the draw
    within a source is one at equal odds.
    """
    return _drawn(docs, ["doc_id", "text"], weights, share, copies)


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _drawn(docs: DataFrame, columns: list[str], weights: tuple, share: float, copies: int) -> DataFrame:
    """``drawn`` with a key over ``columns``."""
    sized = checkpointed(
        docs.select("doc_id", "source", row_key(*map(_quoted, columns)).alias("key"), size_of("text").alias("size"), _uniform().alias("u"))
    )
    wanted = targets(sized, weights, share, copies).withColumnRenamed("source", "_source")
    ratio = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    rows = (
        sized.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("whole", F.floor(ratio))
        .withColumn("p", ratio - F.col("whole"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    odds = F.try_divide((F.col("u") / (1 - F.col("u"))), F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("odds", odds).drop("_source", "u")
    # odds on the unit interval, in the same order
    place = F.col("odds") / (1 + F.col("odds")) * BUCKETS
    none = rows.filter(F.col("odds").isNull()).withColumn("extra", F.lit(0))
    sure, left = _settle(rows.filter(F.col("odds").isNotNull()), F.least(F.floor(place), F.lit(BUCKETS - 1)))
    sure2, left = _settle(left, F.least(F.floor((place - F.floor(place)) * BUCKETS), F.lit(BUCKETS - 1)))
    # about one in a million documents of a source is ranked row by row
    order = W.partitionBy("source").orderBy("odds", F.col("doc_id").asc_nulls_last(), "key").rowsBetween(W.unboundedPreceding, 0)
    last = left.withColumn("_upto", F.sum("size").over(order))
    last = last.withColumn("extra", (F.col("_upto") - F.col("size") / 2 <= F.col("rest")).cast("int")).drop("_upto")
    together = none.unionByName(sure).unionByName(sure2).unionByName(last)
    n = F.col("whole") + F.col("extra")
    return together.select(
        "doc_id", "key", "size", "source_size", "target", (n * F.col("size")).cast("bigint").alias("taken"), n.cast("int").alias("n_copies")
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """``docs`` with every column, each row as often as the mix takes it; documents without words are left out."""
    key, n = unused(docs, "_key"), unused(docs, "_n")
    counts = _drawn(docs, docs.columns, weights, share, copies).filter((F.col("n_copies") > 0) & (F.col("size") > 0))
    counts = counts.groupBy("key").agg(F.sum("n_copies").cast("int").alias(n), F.count(F.lit(1)).alias("rows"))
    counts = counts.withColumnRenamed("key", key).withColumnRenamed("rows", unused(docs, "_rows"))
    rows = docs.withColumn(key, row_key(*map(_quoted, docs.columns))).join(counts, key)
    once = F.col(unused(docs, "_rows")) == 1
    # rows that repeat in full stand for one another
    rows = rows.filter(once).unionByName(rows.filter(~once).dropDuplicates([key]))
    return rows.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
