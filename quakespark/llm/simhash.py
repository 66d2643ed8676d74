"""SimHash near-duplicates: tiled exact comparison of fingerprints by exclusive-or and bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakespark.llm.common import from_text, row_key, tasks, unused
from quakespark.operators.cluster import connected_components
from quakespark.session import checkpointed

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints per tile at most, on average over the hash that deals them out.
TILE = 4096
#: Comparisons held in memory at once.
_BLOCK = 1 << 20
_QUARTERS = 4


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of one text as a signed integer.

    A-Z are lower-cased, words are the runs without ASCII white space, shingles keep their repeats. A text with
    fewer words than a shingle counts as one shingle; a null text or one without words gives zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, len(grams))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK // 64):
        part = hashes[at : at + _BLOCK // 64]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` with the fingerprint ``fp`` in place of ``text``; other columns are passed on."""
    return from_text(docs, "fp bigint", lambda: lambda texts: [(fingerprint_of(t, shingle, seed),) for t in texts])


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter bit counts that a pair within ``radius`` can have, one of each +/- pair."""
    ball = [d for d in product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, d)) <= radius]
    return [d for d in ball if d >= (0,) * _QUARTERS]


def _code(counts: list) -> Column:
    """Bit counts as one number; eight bits each keep the sums with an offset apart."""
    return sum((c.cast("bigint") * (1 << 8 * i) for i, c in enumerate(counts)), F.lit(0))


def _forest(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite i and j, pair by pair, in a forest of smallest labels."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``radius`` between two tiles (``b`` None: inside one).

    Every pair is compared; of the pairs found a spanning forest is returned, so a tile of mutual near copies
    gives one link per fingerprint and not one per pair.
    """
    nodes = a if b is None else np.concatenate([a, b])
    first, other = a, (a if b is None else b)
    shift = 0 if b is None else len(a)
    labels = np.arange(len(nodes))
    rows = max(1, _BLOCK // max(1, len(other)))
    for at in range(0, len(first), rows):
        near = np.bitwise_count(first[at : at + rows, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            _forest(labels, i, j + shift)
    moved = np.nonzero(labels != np.arange(len(nodes)))[0]
    return nodes[moved].view(np.int64), nodes[labels[moved]].view(np.int64)


def links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect the distinct ``fp`` values exactly as all pairs within ``radius`` bits would.

    A tile holds fingerprints with the same bit counts in each quarter of the word. Two fingerprints within the
    radius have counts that differ by the radius at most in sum, so only such tile pairs meet; the others are
    skipped unread. Common counts are dealt to several tiles.
    """
    if radius < 0 or radius > 60:
        raise ValueError("radius must be from 0 to 60")
    spark = fingerprints.sparkSession
    n = tasks(spark)
    width = 64 // _QUARTERS
    quarter = [
        F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1))) for i in range(_QUARTERS)
    ]
    coded = fingerprints.select("fp").distinct().withColumn("counts", _code(quarter))
    sizes = coded.groupBy("counts").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("n_tiles"))
    tiles = checkpointed(
        coded.join(sizes, "counts")
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("n_tiles")).cast("int"))
        .groupBy("counts", "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    steps = [sum(d << 8 * i for i, d in enumerate(offset)) for offset in _offsets(radius)]
    home = tiles.select("counts", F.col("tile").alias("tile_b"), F.col("fps").alias("b")).repartition(n, "counts")
    visitor = tiles.select(
        F.explode(F.array(*(F.lit(s).cast("bigint") for s in steps))).alias("step"),
        "counts",
        F.col("tile").alias("tile_a"),
        F.col("fps").alias("a"),
    ).select((F.col("counts") + F.col("step")).alias("counts"), (F.col("step") == 0).alias("own"), "tile_a", "a")
    pairs = (
        visitor.repartition(n, "counts")
        .join(home, "counts")
        .filter(~F.col("own") | (F.col("tile_a") <= F.col("tile_b")))
        .select((F.col("own") & (F.col("tile_a") == F.col("tile_b"))).alias("same"), "a", "b")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                tile_links(a.view(np.uint64), None if same else b.view(np.uint64), radius)
                for same, a, b in zip(batch["same"], batch["a"], batch["b"], strict=True)
            ]
            if found:
                yield pd.DataFrame({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([y for _, y in found])})

    return pairs.mapInPandas(compare, "a bigint, b bigint").distinct()


def components(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component): each distinct ``fp`` with the smallest value reachable over links within ``radius`` bits."""
    found = connected_components(links(fingerprints, radius))
    both = fingerprints.select("fp").distinct().join(found.withColumnRenamed("id", "fp"), "fp", "left")
    return both.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id), a row for each row of ``docs`` (doc_id, text; other columns are ignored).

    ``component_id`` is the smallest doc_id reachable over links of ``radius`` or fewer differing bits. Equal
    fingerprints are linked, those of empty and null texts (zero) included. Rows without doc_id are linked like
    others but never give the name; a component of such rows alone has a null name. No rows give no rows.
    """
    prints = checkpointed(fingerprints(docs.select("doc_id", "text"), shingle))
    return prints.join(_names(prints, radius), "fp").select("doc_id", "fp", "component_id")


def _names(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) for each distinct ``fp`` of (doc_id, fp)."""
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = checkpointed(components(groups, radius).join(groups, "fp"))
    names = found.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return found.select("fp", "component").join(names, "component").select("fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: one row of each component stays.

    The row with the smallest doc_id stays (null ids last), among those the one with the smallest hash of its
    columns; of rows that repeat both doc_id and text one stays.
    """
    prints = checkpointed(fingerprints(docs.select("doc_id", row_key("doc_id", "text").alias("_key"), "text"), shingle))
    # nodes are fingerprints; the row that stays is the smallest (id, key) over a component
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key"))
    groups = prints.groupBy("fp").agg(first.alias("head"))
    found = components(groups, radius).join(groups, "fp")
    heads = found.groupBy("component").agg(F.min("head").alias("head")).select("head._key")
    kept = heads.join(prints.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")), "_key")
    key, copies = unused(docs, "_key"), unused(docs, "_n")
    kept = checkpointed(kept.select(F.col("_key").alias(key), F.col("_n").alias(copies)))
    rows = docs.withColumn(key, row_key("doc_id", "text")).join(kept, key)
    once = rows.filter(F.col(copies) == 1)
    repeated = rows.filter(F.col(copies) > 1).dropDuplicates([key])
    return once.unionByName(repeated).select(*docs.columns)
