"""Filter interaction audit: what each filter removes in every order, by joins of the ids that fail it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakespark.llm.common import from_text
from quakespark.session import checkpointed, scratch_path

#: The filters that look at one text, and the one that needs the other documents: the same text as a smaller id.
OF_TEXT, DUPLICATE = "ABCD", "E"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"


def failures(text: str) -> str:
    """Letters of the filters that a whole text fails; words are the runs without ASCII white space."""
    raw = text.encode()
    words = raw.split()
    fails = (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 10 * len(text),
        len(raw.translate(None, _SYMBOLS)) < len(raw),
    )
    return "".join(letter for letter, failed in zip(OF_TEXT, fails, strict=True) if failed)


def failing_ids(docs: DataFrame, labels: DataFrame, fails: Callable[[str], str] = failures) -> tuple[DataFrame, DataFrame]:
    """(members, failing): (rid, part, good, toxic) of every row of ``docs``, and (filter, rid), a table per filter.

    ``rid`` numbers the rows, so rows that share a doc_id, or have none, count as documents of their own.
    """
    def start() -> Callable[[list], list[tuple]]:
        return lambda texts: [(fails(t), hashlib.sha256(t.encode()).digest()) for t in texts]

    empty = F.lit("")
    read = docs.select("doc_id", F.coalesce("lang", empty).alias("part"), F.coalesce("text", empty).alias("text"))
    once = checkpointed(from_text(read, "fails string, digest binary", start).withColumn("rid", F.monotonically_increasing_id()))
    marks = labels.groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    no = F.lit(False)
    members = once.select("rid", "doc_id", "part").join(marks.filter("good OR toxic").hint("merge"), "doc_id", "left")
    members = checkpointed(members.select("rid", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")))

    copied = once.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = once.join(copied.hint("merge"), "digest").filter(F.col("doc_id") > F.col("first"))
    ids = once.filter("fails <> ''").select(F.explode(F.split("fails", "")).alias("filter"), "rid").unionByName(
        repeated.select(F.lit(DUPLICATE).alias("filter"), "rid")
    )
    spark = docs.sparkSession
    path = scratch_path(spark, "failing")
    ids.write.partitionBy("filter").parquet(path)
    # the ids grow with the documents: no side of a join with them is for broadcasting, however small it looks
    return members, spark.read.schema("rid bigint, filter string").parquet(path).select("filter", "rid").hint("merge")


def _prefix_steps(letters: str, size: int) -> Column:
    """The (prefix, filter) steps whose prefix has ``size`` letters, as an array."""
    steps = [("".join(p), f) for p in combinations(letters, size) for f in letters if f not in p]
    return F.array(*(F.struct(F.lit(p).alias("prefix"), F.lit(f).alias("filter")) for p, f in steps))


def prefix_counts(members: DataFrame, failing: DataFrame, letters: str) -> tuple[DataFrame, DataFrame]:
    """What every set of filters leaves, and what every further filter then meets.

    What is left of the documents depends on the set of filters before, not on their order, so each set (its letters
    sorted: ``prefix``) is worked out once, from the one without its last letter. Returns (prefix, part, kept) and
    (prefix, filter, part, removed, redundant, good_lost, toxic_lost); counts of zero have no row.
    """
    count = F.count(F.lit(1))
    met = checkpointed(members.select("rid", "part").join(failing, "rid"))
    left = members.withColumn("prefix", F.lit(""))
    kept, removed, redundant = [], [], []
    for size in range(len(letters) + 1):
        kept.append(left.groupBy("prefix", "part").agg(count.alias("kept")))
        if size == len(letters):
            break
        following = F.array(*(F.lit(x) for x in letters))
        asked = left.withColumn("filter", F.explode(F.filter(following, lambda x: ~F.contains(F.col("prefix"), x))))
        removed.append(
            asked.join(failing, ["filter", "rid"], "left_semi").groupBy("prefix", "filter", "part").agg(
                count.alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost")
            )
        )
        steps = F.filter(_prefix_steps(letters, size), lambda s: s["filter"] == F.col("own"))
        again = met.withColumnRenamed("filter", "own").select("rid", "part", F.explode(steps).alias("step")).select("rid", "part", "step.*")
        redundant.append(
            again.join(left.select("prefix", "rid").hint("merge"), ["prefix", "rid"], "left_anti").groupBy("prefix", "filter", "part").agg(
                count.alias("redundant")
            )
        )
        longer = asked.filter(F.col("filter") > F.substring("prefix", -1, 1))  # '' comes before all
        left = checkpointed(
            longer.join(failing, ["filter", "rid"], "left_anti").withColumn("prefix", F.concat("prefix", "filter")).drop("filter")
        )
    zero = F.lit(0).cast("bigint")

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for x in frames[1:]:
            out = out.unionByName(x)
        return checkpointed(out)

    found = union(removed).join(union(redundant), ["prefix", "filter", "part"], "full_outer")
    counts = [F.coalesce(c, zero).alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")]
    return union(kept), checkpointed(found.select("prefix", "filter", "part", *counts))


def audit(docs: DataFrame, labels: DataFrame, fails: Callable[[str], str] = failures, of_text: str = OF_TEXT) -> DataFrame:
    """A row per part, order of the filters and step: what the filter of that step does to the part's documents.

    ``docs`` (doc_id, text, lang; other columns are ignored), ``labels`` (doc_id, quality, toxic; a document counts as
    good or toxic if any of its labels says so). ``fails`` names the filters, of the letters ``of_text``, that a text
    fails; the one of repeated texts is added. Columns: part (a lang; null and empty are one part, the empty
    string), filter_order, step (from 1), kept, removed, redundant, good_lost, toxic_lost, unique_fails, shapley.
    Every row of ``docs`` counts, repeated ones too. Null texts are empty texts. Rows without doc_id fail no filter
    of repeated texts and have no labels. Without documents there are no rows, without labels the losses are zero.
    """
    if DUPLICATE in of_text:
        raise ValueError(f"{DUPLICATE} is the filter of repeated texts")
    letters = "".join(sorted([*of_text, DUPLICATE]))
    members, failing = failing_ids(docs, labels, fails)
    kept, found = prefix_counts(members, failing, letters)

    n = len(letters)
    orders = F.array(*(F.lit("".join(p)) for p in permutations(letters)))
    steps = (
        members.select("part").distinct()
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    )
    sorted_letters = lambda text: F.array_join(F.array_sort(F.split(text, "")), "")
    before = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    steps = steps.withColumn("prefix", sorted_letters(before)).withColumn(
        "after", sorted_letters(F.substring(F.col("filter_order"), F.lit(1), F.col("step")))
    )
    # an order of the letters before and one of those behind make an order with this step
    weight = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n))), F.length("prefix") + 1)
    others = F.replace(F.lit(letters), F.col("filter"), F.lit(""))
    by_filter = found.groupBy("filter", "part").agg(
        F.sum(F.col("removed") * weight).alias("shapley"),
        F.sum(F.when(F.col("prefix") == others, F.col("removed"))).alias("unique_fails"),
    )
    zero = F.lit(0).cast("bigint")
    numbers = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return (
        steps.join(found, ["prefix", "filter", "part"], "left")
        .join(kept.withColumnRenamed("prefix", "after"), ["after", "part"], "left")
        .join(by_filter, ["filter", "part"], "left")
        .select("part", "filter_order", "step", *(F.coalesce(c, zero).alias(c) for c in numbers))
    )
